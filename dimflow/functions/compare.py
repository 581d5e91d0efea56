"""Change detection."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def any_differs(pairs: Iterable[tuple[str, str]]) -> Column:
    """True when any (left, right) column pair differs.

    Null against null is equal and null against a value differs; NaN equals NaN.
    """
    return reduce(or_, (~F.col(a).eqNullSafe(F.col(b)) for a, b in pairs))


def digestible(types: Iterable[T.DataType]) -> bool:
    """Whether `row_digest` tells all values of these types apart that differ: not in nested ones, whose nulls hash as nothing,
    nor in text with a collation of its own."""
    return all(t == T.StringType() if isinstance(t, T.StringType) else isinstance(t, T.AtomicType) for t in types)


def row_digest(columns: Iterable[str]) -> Column:
    """128 bits of some columns: equal where `any_differs` finds no difference, and else different but for odds of 2**-128.

    Each value is hashed by its bits, with its column's place, so no text form of a number, time zone or Java version has a part in
    it. NaN equals NaN, zero equals minus zero, and null has no part at all.
    """
    values = []
    for place, name in enumerate(columns):
        halves = [F.hex(F.xxhash64(F.lit(half), F.col(name))) for half in (0, 1)]
        values.append(F.when(F.col(name).isNotNull(), F.concat_ws(":", F.lit(str(place)), *halves)))
    return F.unhex(F.md5(F.concat_ws(",", *values)))
