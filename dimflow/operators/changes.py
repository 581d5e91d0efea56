"""Compare a batch slice with the current rows of a dimension."""

from __future__ import annotations

import hashlib
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.functions.compare import any_differs, digestible, row_digest
from dimflow.schemas import DimSpec
from dimflow.sources.staging import stage

NEW, CHANGED, SAME, ABSENT = "new", "changed", "same", "absent"
ACTION, WAS = "_action", "_was_"
DIGEST = "_digest_"  # how names of digest columns begin
FEW_KEYS = 500_000  # so many changed keys are broadcast


def classify(updates: DataFrame, current: DataFrame, spec: DimSpec) -> DataFrame:
    """Every key of either side, with ``updates`` and, as ``_was_*``, the current row.

    ``_action`` is new, changed or same for keys of the batch, and absent for the others. Both
    sides hold one row per key, so the one join cannot be skewed, and each side is shuffled once. A tracked
    column that the current rows lack counts as null there.
    """
    keys = list(spec.keys)
    current = with_tracked(current, updates, spec)
    before = current.select(
        *keys,
        *[F.col(c).alias(WAS + c) for c in current.columns if c not in keys],
        F.lit(True).alias("_was_there"),
    )
    differs = any_differs((c, WAS + c) for c in spec.tracked)
    action = (
        F.when(F.col("_came").isNull(), ABSENT)
        .when(F.col("_was_there").isNull(), NEW)
        .when(differs, CHANGED)
        .otherwise(SAME)
    )
    joined = updates.withColumn("_came", F.lit(True)).join(before, keys, "full_outer")
    return joined.withColumn(ACTION, action).drop("_came", "_was_there")


def with_tracked(current: DataFrame, updates: DataFrame, spec: DimSpec) -> DataFrame:
    """``current`` with the tracked columns it lacks, as nulls."""
    missing = [c for c in spec.tracked if c not in current.columns]
    return current.withColumns({c: F.lit(None).cast(updates.schema[c].dataType) for c in missing})


# Numeric types from the narrowest: a value of one has the same value in each after it (integers up to 2**53 in a double).
_WIDER = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DoubleType)


def wider(name: str, one: T.DataType, other: T.DataType) -> T.DataType:
    """The type of a column that has had both types; raises where a value of one may not fit."""
    if one == other:
        return one
    kinds = [T.DoubleType if isinstance(t, T.FloatType) else type(t) for t in (one, other)]
    if all(kind in _WIDER for kind in kinds):
        return max(kinds, key=_WIDER.index)()
    raise TypeError(f"{name} cannot change from {one.simpleString()} to {other.simpleString()}")


def of_one_type(updates: DataFrame, current: DataFrame | None, spec: DimSpec) -> tuple[DataFrame, DataFrame | None]:
    """Both sides with tracked columns of the wider type, where a source has begun to send another."""
    if current is None:
        return updates, None
    types = {
        c: wider(c, current.schema[c].dataType, updates.schema[c].dataType)
        for c in spec.tracked
        if c in current.columns
    }

    def cast(df: DataFrame) -> DataFrame:
        other = {c: F.col(c).cast(t) for c, t in types.items() if df.schema[c].dataType != t}
        return df.withColumns(other) if other else df

    return cast(updates), cast(current)


def to_apply(classified: DataFrame) -> DataFrame:
    """Rows that alter the dimension: changed and new keys."""
    return classified.filter(F.col(ACTION).isin(CHANGED, NEW))


def as_they_were(classified: DataFrame, spec: DimSpec, more: list[str | Column]) -> DataFrame:
    """The current rows behind ``classified``: keys, tracked columns and ``more``."""
    was = [F.col(WAS + c).alias(c) for c in spec.tracked]
    return classified.select(*spec.keys, *was, *more)


def untouched(classified: DataFrame) -> DataFrame:
    """Rows that stay as they are, keys missing from the batch included."""
    return classified.filter(F.col(ACTION).isin(SAME, ABSENT))


class Compared(NamedTuple):
    """A batch against the current rows: changed and new keys with their new values (staged), and the current rows of changed keys and
    of all others."""

    apply: DataFrame
    changed: DataFrame
    kept: DataFrame


def compare(updates: DataFrame, current: DataFrame, spec: DimSpec) -> Compared:
    """Compare by digests if the batch has them (current rows that have none get theirs from their attributes), else by attributes."""
    digest = digest_of(updates)
    if digest is not None:
        if digest not in current.columns:
            current = with_digest(with_tracked(current, updates, spec), spec)
    if current.isEmpty():
        # A first load, for one: all keys are new, and there is nothing to agree on.
        now = [*spec.columns, *([digest] if digest else []), F.lit(NEW).alias(ACTION)]
        none = with_tracked(current, updates, spec)
        return Compared(updates.select(*now), none, none)
    if digest is not None:
        return _by_digest(updates, current, spec, digest)
    compared = stage(classify(updates, current, spec))
    was = [F.col(WAS + c).alias(c) for c in current.columns if c not in spec.columns]
    changed = compared.filter(F.col(ACTION) == CHANGED)
    return Compared(
        apply=to_apply(compared).select(*spec.columns, ACTION),
        changed=as_they_were(changed, spec, was),
        kept=as_they_were(untouched(compared), spec, was),
    )


def _by_digest(updates: DataFrame, current: DataFrame, spec: DimSpec, digest: str) -> Compared:
    """Of the current rows, only keys and digests are read and shuffled to find what changes. Their attributes are read once that is
    known: of changed keys, and of the others to be written beside them. They meet few changed keys without a wide shuffle, and many
    in one, which is staged."""
    keys = list(spec.keys)
    before = current.select(*keys, F.col(digest).alias("_was_digest"), F.lit(True).alias("_was_there"))
    action = F.when(F.col("_was_there").isNull(), NEW).when(
        ~F.col(digest).eqNullSafe(F.col("_was_digest")), CHANGED
    )
    joined = updates.join(before, keys, "left").withColumn(ACTION, action)
    apply = stage(to_apply(joined).select(*spec.columns, digest, ACTION))
    changed = apply.filter(F.col(ACTION) == CHANGED).select(*keys)
    current = with_tracked(current, updates, spec)
    if changed.count() > FEW_KEYS:
        # Too many to broadcast: the current rows meet them in one wide shuffle, not in one for each part.
        met = stage(current.join(changed.withColumn("_met", F.lit(True)), keys, "left"))
        return Compared(apply, met.filter("_met").drop("_met"), met.filter("_met is null").drop("_met"))
    return Compared(apply, current.join(changed, keys, "left_semi"), current.join(changed, keys, "left_anti"))


def digest_name(rows: DataFrame, spec: DimSpec) -> str | None:
    """The name of the column with the digests of the tracked columns, by their names and types: digests of one name can be
    compared. None where the types have no digest."""
    types = [rows.schema[c].dataType for c in spec.tracked]
    if not digestible(types):
        return None
    text = ",".join(f"{c}:{t.simpleString()}" for c, t in zip(spec.tracked, types))
    return DIGEST + hashlib.sha256(text.encode()).hexdigest()[:12]


def with_digest(rows: DataFrame, spec: DimSpec) -> DataFrame:
    """``rows`` with digests by the types that they have now, and no other ones."""
    name, rows = digest_name(rows, spec), without_digests(rows)
    return rows if name is None else rows.withColumn(name, row_digest(spec.tracked))


def without_digests(rows: DataFrame) -> DataFrame:
    return rows.drop(*[c for c in rows.columns if c.startswith(DIGEST)])


def digest_of(rows: DataFrame) -> str | None:
    """The name of the digest column that rows have."""
    return next((c for c in rows.columns if c.startswith(DIGEST)), None)
