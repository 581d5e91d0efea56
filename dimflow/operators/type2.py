"""Type 2 dimensions: every version is a row, with its dates, in one table."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.operators.changes import ACTION, NEW, compare, digest_of, with_digest, with_tracked, without_digests
from dimflow.operators.surrogate import number_densely, place_in_order
from dimflow.schemas import OPEN_END, DimSpec

# The columns a Type 2 table adds to its keys and attributes.
TYPE2_SCHEMA = T.StructType(
    [
        T.StructField("surrogate_key", T.LongType()),
        T.StructField("effective_start_date", T.DateType()),
        T.StructField("effective_end_date", T.DateType()),
        T.StructField("is_current", T.BooleanType()),
    ]
)
TYPE2_COLUMNS = tuple(TYPE2_SCHEMA.names)


@dataclass(frozen=True)
class Type2Merge:
    """What one batch does to the current versions: ``expired`` ones end, ``kept`` ones
    stay, and ``inserted`` ones begin. ``delta`` is empty when nothing changes."""

    delta: DataFrame
    expired: DataFrame
    kept: DataFrame
    inserted: DataFrame

    @property
    def current(self) -> DataFrame:
        return self.kept.unionByName(self.inserted)


def no_type2(updates: DataFrame, spec: DimSpec) -> DataFrame:
    """An empty Type 2 dimension, for the first load."""
    blank = {f.name: F.lit(None).cast(f.dataType) for f in TYPE2_SCHEMA}
    return updates.select(*spec.columns).where(F.lit(False)).withColumns(blank)


def last_key(versions: DataFrame) -> DataFrame:
    """One row: the largest surrogate key, 0 when there are no versions."""
    return versions.agg(F.coalesce(F.max("surrogate_key"), F.lit(0)).alias("last_key"))


def merge_type2(
    updates: DataFrame,
    current: DataFrame | None,
    spec: DimSpec,
    process_date: dt.date,
    last_used: DataFrame | None = None,
) -> Type2Merge:
    """Merge a slice (one row per key) with the current versions; ``None`` means first load.

    A version covers [effective_start_date, effective_end_date). Changed keys get
    surrogate keys before new ones, each in key order, after ``last_used`` (one row; by
    default the largest current key). The comparison of both sides is staged once, and all
    parts of the merge agree on that copy. Digests that both sides have (`with_digest`) are compared in
    place of attributes, and go on into the current rows. Older versions are not needed and not read.
    """
    if current is None:
        current = no_type2(updates, spec)
    if last_used is None:
        last_used = last_key(current)
    digest = [c for c in (digest_of(updates),) if c]
    columns = [*spec.columns, *TYPE2_COLUMNS]
    run_date = F.lit(process_date).cast("date")
    compared = compare(updates, current, spec)
    changes_first = [F.col(ACTION) == NEW, *[F.col(k) for k in spec.keys]]
    delta = place_in_order(without_digests(compared.apply), changes_first)

    numbered = number_densely(delta, last_used)
    inserted = (with_digest(numbered, spec) if digest else numbered).withColumns(
        {
            "effective_start_date": run_date,
            "effective_end_date": F.lit(OPEN_END),
            "is_current": F.lit(True),
        }
    )
    ended = {"effective_end_date": run_date, "is_current": F.lit(False)}
    return Type2Merge(
        delta=delta,
        expired=compared.changed.withColumns(ended).select(*columns),
        kept=compared.kept.select(*columns, *digest),
        inserted=inserted.select(*columns, *digest),
    )


def apply_type2(
    updates: DataFrame, dim: DataFrame | None, spec: DimSpec, process_date: dt.date
) -> DataFrame:
    """The whole dimension after a slice. Closed versions pass through unshuffled."""
    if dim is None:
        dim = no_type2(updates, spec)
    merge = merge_type2(updates, dim.filter("is_current"), spec, process_date, last_key(dim))
    closed = with_tracked(dim.filter(~F.col("is_current")), updates, spec)
    return closed.unionByName(merge.expired).unionByName(merge.current)
