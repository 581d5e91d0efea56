"""Type 4 dimensions: a current table, and an append-only history beside it."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.operators.changes import compare, digest_of
from dimflow.schemas import DimSpec

# The columns the two Type 4 tables add.
CURRENT_SCHEMA = T.StructType([T.StructField("record_effective_date", T.DateType())])
HISTORY_SCHEMA = T.StructType(
    [
        T.StructField("record_effective_date", T.DateType()),
        T.StructField("record_end_date", T.DateType()),
        T.StructField("archived_at", T.TimestampType()),
    ]
)


@dataclass(frozen=True)
class Type4Merge:
    """What one batch does: ``archived`` is appended to history, ``kept`` and
    ``inserted`` (refreshed and new keys) are the next current table. ``delta`` is
    empty when nothing changes."""

    delta: DataFrame
    archived: DataFrame
    kept: DataFrame
    inserted: DataFrame

    @property
    def current(self) -> DataFrame:
        return self.kept.unionByName(self.inserted)


def no_type4(updates: DataFrame, spec: DimSpec) -> DataFrame:
    """An empty current table, for the first load."""
    blank = F.lit(None).cast("date")
    return (
        updates.select(*spec.columns)
        .where(F.lit(False))
        .withColumn("record_effective_date", blank)
    )


def merge_type4(
    updates: DataFrame, current: DataFrame | None, spec: DimSpec, process_date: dt.date
) -> Type4Merge:
    """Apply a slice (one row per key) to a current table; ``None`` means first load.

    The comparison of both sides is staged once: the archive and the rebuilt table read that
    copy, so they agree. Digests are compared as `merge_type2` does.
    """
    if current is None:
        current = no_type4(updates, spec)
    columns = [*spec.columns, *CURRENT_SCHEMA.names]
    digest = [c for c in (digest_of(updates),) if c]
    run_date = F.lit(process_date).cast("date")
    compared = compare(updates, current, spec)
    stamps = {"record_end_date": run_date, "archived_at": F.current_timestamp()}
    return Type4Merge(
        delta=compared.apply,
        archived=compared.changed.select(*columns).withColumns(stamps),
        kept=compared.kept.select(*columns, *digest),
        inserted=compared.apply.withColumn("record_effective_date", run_date).select(*columns, *digest),
    )
