"""Dense surrogate keys in a global order, without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimflow.sources.staging import stage

# monotonically_increasing_id() is (partition << 33) + position in the partition.
_POSITION_BITS = 33
_POSITION_MASK = (1 << _POSITION_BITS) - 1


def place_in_order(rows: DataFrame, order: list[Column | str]) -> DataFrame:
    """Stage ``rows`` range-partitioned and sorted by ``order``, with the ``_spot`` of each.

    ``order`` must be unique. Staging fixes the partitions: range bounds are
    sampled, and whatever uses a spot has to see the same ones, also after an
    executor is lost.
    """
    return stage(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_spot", F.monotonically_increasing_id())
    )


def number_densely(
    placed: DataFrame, last_used: DataFrame, name: str = "surrogate_key"
) -> DataFrame:
    """Replace ``_spot`` by ``name``: last used + 1, + 2, ... in the placed order.

    ``last_used`` is one row with one number. A row's number is the size of the
    partitions before its own plus its position, so only the sizes, one row per
    partition, are gathered and broadcast.
    """
    part = F.shiftright("_spot", _POSITION_BITS).alias("_part")
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_rows"))
    sizes = sizes.unionByName(
        last_used.toDF("_rows").select(F.lit(-1).cast("bigint").alias("_part"), F.col("_rows").cast("bigint"))
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.sum("_rows").over(earlier).alias("_start"))
    position = F.col("_spot").bitwiseAND(F.lit(_POSITION_MASK))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + position + 1)
        .drop("_part", "_start", "_spot")
    )
