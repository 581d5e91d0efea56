"""Late batches: versions of the keys that a batch touches, cut anew from its date on.

A batch whose date lies before that of a batch merged earlier must not end versions that begin after it.
What is known of its keys from its date on - the version in force just before, the batch itself, and what each
later batch has shown, also where that was no change - is put in order, and a version starts wherever a
row differs from the one before. Keys that the batch does not touch are not read.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimflow.functions.compare import any_differs
from dimflow.operators.changes import FEW_KEYS, WAS, with_tracked
from dimflow.operators.slices import latest_per_key
from dimflow.schemas import OPEN_END, DimSpec
from dimflow.sources.staging import stage


@dataclass(frozen=True)
class Splice:
    """``outdated``: the versions that no longer hold as they were (keys and valid_from, once each).
    ``versions``: what holds instead, with the columns that ``carried`` names from the old version of the
    same key, start and values, null for new ones."""

    outdated: DataFrame
    versions: DataFrame


def observations(rows: DataFrame, spec: DimSpec, since: dt.date) -> DataFrame:
    """What each batch from a date on has shown of each key: one row per batch and key, with the date of the
    batch and its time of arrival."""
    batches = rows.filter(F.col("batch") >= F.lit(since))
    latest = latest_per_key(batches, spec, within=("batch", "ingestion_timestamp"))
    return latest.withColumnsRenamed({"batch": "_at", "ingestion_timestamp": "_came"})


def splice(
    touched: DataFrame, old: DataFrame, seen: DataFrame, spec: DimSpec, since: dt.date, carried: tuple[str, ...] = ()
) -> Splice:
    """Versions of the ``touched`` keys from ``since`` on.

    ``old`` has all versions of a dimension as [valid_from, valid_to); ``seen`` is what `observations` gives, of any
    keys. A version that began before ``since`` and is in force then is part of the result, as its end may change. Both
    are put together before they are shuffled, once, by key, and all that follows is done where a key's rows lie; a key has one
    row per batch, not per fact. Of few keys only their rows are shuffled.
    """
    keys, columns = list(spec.keys), list(spec.columns)
    since_ = F.lit(since).cast("date")
    touched, old = touched.select(*keys).distinct(), with_tracked(old, seen, spec)
    few = touched.count() <= FEW_KEYS
    if few:
        old, seen = (rows.join(F.broadcast(touched), keys, "left_semi") for rows in (old, seen))
    came = F.lit(None).cast(seen.schema["_came"].dataType)
    versions = old.select(
        *columns, F.col("valid_from").alias("_at"), came.alias("_came"), F.lit(True).alias("_is_old"), "valid_to", *carried
    )
    later = seen.filter(F.col("_at") >= since_).select(*columns, "_at", "_came", F.lit(False).alias("_is_old"))
    rows = versions.unionByName(later, allowMissingColumns=True)
    if not few:
        # An inner join, as a semi join would be moved below the union, and its parts shuffled again after it.
        rows = rows.join(touched, keys)
    rows = rows.withColumn("_before", F.col("_is_old") & (F.col("_at") < since_))
    # One version of those that began on a day has not ended on it, so the last is one.
    interval = F.struct("_at", "valid_to")
    rows = rows.withColumn("_last_before", F.max(F.when(F.col("_before"), interval)).over(Window.partitionBy(*keys)))
    scope = rows.filter(~F.col("_before") | (interval == F.col("_last_before"))).drop("_last_before")
    # What was in force just before comes twice: as an old version, and as the first point.
    roles = F.when(F.col("_before"), F.array(F.lit(True), F.lit(False))).otherwise(F.array("_is_old"))
    scope = scope.withColumn("_is_old", F.explode(roles))
    in_order = Window.partitionBy(*keys, "_is_old").orderBy("_at", F.col("_came").asc_nulls_first())
    was = {WAS + c: F.lag(c).over(in_order) for c in spec.tracked}
    points = scope.withColumns(
        {**was, "_first": F.row_number().over(in_order) == 1, "_at_before": F.lag("_at").over(in_order)}
    )
    begins = points.filter(F.col("_is_old") | F.col("_first") | any_differs((c, WAS + c) for c in spec.tracked))
    made = begins.withColumn("_until", F.lead("_at").over(in_order)).withColumns(
        {
            "valid_to": F.when(F.col("_is_old"), F.col("valid_to")).otherwise(F.coalesce("_until", F.lit(OPEN_END))),
            "_open": ~F.col("_is_old") & F.col("_until").isNull(),
        }
    )
    if carried:
        # A version keeps what it has if it begins as before, with the same values; of several that began on one day each
        # can be kept once at most: its place among equals counts.
        alike = Window.partitionBy(*columns, "_at").orderBy(F.desc("_is_old"), "valid_to", *carried)
        so_far = alike.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        theirs = F.collect_list(F.when(F.col("_is_old"), F.struct(*carried))).over(so_far)
        made = made.withColumns({"_theirs": theirs, "_place": F.row_number().over(alike)})
        its = F.get("_theirs", F.col("_place") - F.size("_theirs") - 1)
        made = made.withColumns({c: its.getField(c) for c in carried})
    # Of old versions, their keys and starts, once each.
    values = [F.when(~F.col("_is_old"), F.col(c)).alias(c) for c in (*spec.tracked, "valid_to", *carried)]
    named = ~F.col("_is_old") | ~F.col("_at").eqNullSafe(F.col("_at_before"))
    staged = stage(made.filter(named).select(*keys, F.col("_at").alias("valid_from"), *values, "_open", "_is_old"))
    return Splice(
        outdated=staged.filter("_is_old").select(*keys, "valid_from"),
        versions=staged.filter("not _is_old").select(*columns, "valid_from", "valid_to", "_open", *carried),
    )
