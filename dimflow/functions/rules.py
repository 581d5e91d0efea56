"""The validation rules, as data.

One table drives both the valid/error split and the quality flags, so a row is
quarantined exactly when it raises a flag. ``holds`` is never null: each rule
states its own answer for a missing value. The positive form ("null or > 0")
is one that parquet scans can push down.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import add, and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from dimflow.schemas import LOAN_STATUSES, MAX_RATE, MIN_RATE


@dataclass(frozen=True)
class Rule:
    check: str
    holds: Callable[[], Column]


def _null_or(name: str, test: Callable[[Column], Column]) -> Callable[[], Column]:
    return lambda: F.col(name).isNull() | test(F.col(name))


RULES = (
    Rule("missing_customer_id", lambda: F.col("customer_id").isNotNull()),
    Rule("missing_loan_id", lambda: F.col("loan_id").isNotNull()),
    Rule("invalid_loan_amount", _null_or("loan_amount", lambda c: c > 0)),
    Rule("invalid_interest_rate", _null_or("interest_rate", lambda c: c.between(MIN_RATE, MAX_RATE))),
    Rule("invalid_term", _null_or("term_months", lambda c: c > 0)),
    Rule("invalid_status", _null_or("status", lambda c: c.isin(*LOAN_STATUSES))),
)
CHECKS = tuple(rule.check for rule in RULES)


def is_valid() -> Column:
    """True when every rule holds."""
    return reduce(and_, (rule.holds() for rule in RULES))


def flags() -> dict[str, Column]:
    """Check name -> 1 where the rule is broken, else 0."""
    return {rule.check: F.when(rule.holds(), 0).otherwise(1) for rule in RULES}


def broken_rules() -> Column:
    """The checks of the rules that a row breaks, in the order of the table; empty for a valid row."""
    broken = F.array_compact(F.array(*[F.when(~rule.holds(), F.lit(rule.check)) for rule in RULES]))
    # array_compact is not compiled, and most rows are valid: they do not come to it.
    return F.when(is_valid(), F.array().cast("array<string>")).otherwise(broken)


def issue_count() -> Column:
    """Sum of the flag columns of a row."""
    return reduce(add, (F.col(check) for check in CHECKS))
