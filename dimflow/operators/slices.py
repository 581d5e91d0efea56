"""The dimension slice of a batch: one row per business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.schemas import DimSpec


def latest_per_key(batch: DataFrame, spec: DimSpec, within: Sequence[str] = ()) -> DataFrame:
    """Keys and tracked columns of the latest row of every key, or of every key within each value of some columns.

    Latest means greatest ``spec.order_by``, then greatest remaining columns, so
    the choice never depends on row order. Rows with a null key are left out: they
    name no member of the dimension.

    ``max`` of a struct combines map-side, so a key that holds a third of the
    batch reaches the shuffle as one row per input task.
    """
    order = [c for c in spec.order_by if c not in spec.keys]
    rest = [c for c in spec.tracked if c not in order]
    latest = F.max(F.struct(*order, *rest)).alias("_latest")
    return (
        batch.dropna(subset=list(spec.keys))
        .groupBy(*within, *spec.keys)
        .agg(latest)
        .select(*within, *spec.keys, *[F.col(f"_latest.{c}").alias(c) for c in spec.tracked])
    )
