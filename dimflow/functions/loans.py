"""Loan arithmetic as native expressions (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dimflow.schemas import MEDIUM_UP_TO, SMALL_BELOW


def monthly_payment(amount: Column, annual_rate: Column, term: Column) -> Column:
    """Amortised monthly payment; null where it is undefined.

    A missing or non-positive term has no payment. A missing or zero rate spreads
    the amount evenly. Otherwise amount * r / (1 - (1 + r)^-term) with r the
    monthly rate; null where the power leaves the range of a double (a rate of
    -1200 makes its base 0) or the divisor is 0.
    """
    monthly_rate = annual_rate / 100 / 12
    discount = F.pow(1 + monthly_rate, -term)
    overflows = F.abs(discount) == F.lit(float("inf"))
    amortised = F.when(~overflows, F.try_divide(amount * monthly_rate, 1 - discount))
    even = amount / term
    no_interest = annual_rate.isNull() | (annual_rate == 0)
    return F.when(term > 0, F.when(no_interest, even).otherwise(amortised))


def loan_category(amount: Column) -> Column:
    """Small / Medium / Large by amount. A missing amount counts as Large."""
    return (
        F.when(amount < SMALL_BELOW, "Small")
        .when(amount <= MEDIUM_UP_TO, "Medium")
        .otherwise("Large")
    )
