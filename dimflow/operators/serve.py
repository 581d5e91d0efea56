"""Read dimensions: the current rows, and the version valid on a date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimflow.schemas import OPEN_END, DimSpec
from dimflow.sources.staging import stage

#: Versions from which a key is cut into bins, and the days of a bin, at least.
CROWDED, BIN_DAYS = 64, 32
BIN = "bin_"


def current_rows(dim: DataFrame) -> DataFrame:
    """The current version of every key of a Type 2 dimension."""
    return dim.filter("is_current")


def type2_versions(dim: DataFrame, spec: DimSpec) -> DataFrame:
    """Versions of a Type 2 dimension as [valid_from, valid_to)."""
    return dim.select(
        *spec.columns,
        "surrogate_key",
        F.col("effective_start_date").alias("valid_from"),
        F.col("effective_end_date").alias("valid_to"),
    )


def type4_versions(current: DataFrame, history: DataFrame, spec: DimSpec) -> DataFrame:
    """Versions of a Type 4 dimension as [valid_from, valid_to)."""
    valid_from = F.col("record_effective_date").alias("valid_from")
    past = history.select(*spec.columns, valid_from, F.col("record_end_date").alias("valid_to"))
    live = current.select(*spec.columns, valid_from, F.lit(OPEN_END).alias("valid_to"))
    return past.unionByName(live)


def without_overlaps(versions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Versions cut where the next version of their key begins, empty ones left out.

    So a date has at most one version of a key: the one that began last. Of versions that begin on one
    day the one that ends last counts, then the greatest. Versions with a null key are left out.
    """
    rest = [c for c in versions.columns if c not in (*keys, "valid_from", "valid_to")]
    spans = versions.filter(F.col("valid_from") < F.col("valid_to")).dropna(subset=list(keys))
    in_time = Window.partitionBy(*keys).orderBy("valid_from", "valid_to", *rest)
    until = F.least("valid_to", F.lead("valid_from").over(in_time))
    return spans.withColumn("valid_to", until).filter(F.col("valid_from") < F.col("valid_to"))


def as_of_join(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    on_date: str,
    prefix: str = "dim_",
    timeline: bool = False,
    join_hint: str | None = None,
    binned: bool = False,
    crowded: int = CROWDED,
) -> DataFrame:
    """Left join: each fact with the version whose [valid_from, valid_to) holds its date.

    Version attributes get ``prefix``. A timestamp counts as its date. Where versions of a key overlap, the one that
    began last answers (see `without_overlaps`); empty ones (changed twice on a day) never match.
    The versions are sorted once and written, then joined on the keys with the dates as a
    condition: Spark broadcasts them if they are small, and splits a key that holds many facts. ``join_hint``
    (such as "merge") on the versions asks for another join.

    ``timeline`` is another way to the same rows, for keys with very many versions: the version is
    looked up once per distinct (key, date) and joined back on both. Facts combine to distinct pairs before
    the shuffle, and a key has at most one pair and one version per calendar day, so a hot
    key is a short timeline, walked once, and its facts spread over dates.

    ``binned`` is a third way, for keys with many versions and many facts: such a key (with more than ``crowded``
    versions) is joined on its bins of dates too, so it is spread over tasks and a fact meets the versions of its bin
    only, not all of its key (see `with_bins`). Other keys are joined as without.
    """
    keys = list(keys)
    attributes = [c for c in versions.columns if c not in keys]
    spans = without_overlaps(versions, keys)
    renamed = stage(spans.select(*keys, *[F.col(c).alias(prefix + c) for c in attributes]))
    day = prefix + "day_"
    dated = facts.withColumn(day, F.col(on_date).cast("date"))
    if binned:
        dated, renamed = with_bins(dated, renamed, keys, day, prefix, crowded)
        keys = [*keys, prefix + BIN]
    if timeline:
        found = _versions_on(dated.select(*keys, day), renamed, keys, day, prefix)
        joined = dated.join(found, [*keys, day], "left")
    else:
        theirs = {k: f"{prefix}key_{k}" for k in keys}
        on = [F.col(k) == F.col(theirs[k]) for k in keys] + [
            F.col(day) >= F.col(prefix + "valid_from"),
            F.col(day) < F.col(prefix + "valid_to"),
        ]
        right = renamed.withColumnsRenamed(theirs)
        joined = dated.join(right.hint(join_hint) if join_hint else right, on, "left")
    return joined.select(*facts.columns, *[prefix + c for c in attributes])


def with_bins(
    facts: DataFrame, versions: DataFrame, keys: list[str], day: str, prefix: str, crowded: int = CROWDED
) -> tuple[DataFrame, DataFrame]:
    """(facts, versions) with the bin of their dates: facts are in one bin each, versions in all that they reach into.

    A key with up to ``crowded`` versions has one bin. The versions of another must not overlap; from its first start to
    its last it is cut into bins of BIN_DAYS days, or of the mean length of a version if that is more, so its versions come to at most
    twice as many rows, whatever they are like; the last version, which may be open, has a bin of its own. A bin has no
    more versions than days. So a fact meets at most max(``crowded``, BIN_DAYS, the root of the key's days) versions.
    """
    start, end = F.col(prefix + "valid_from"), F.col(prefix + "valid_to")
    theirs = {k: f"{prefix}bin_key_{k}" for k in keys}
    spread = versions.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(f"{prefix}bin_n_"), F.min(start).alias(f"{prefix}bin_lo_"), F.max(start).alias(f"{prefix}bin_hi_")
    )
    mean = F.ceil(F.date_diff(f"{prefix}bin_hi_", f"{prefix}bin_lo_") / F.col(f"{prefix}bin_n_"))
    # One row per crowded key; staged, so that Spark knows its size when it joins.
    hot = stage(
        spread.filter(F.col(f"{prefix}bin_n_") > crowded)
        .select(*keys, f"{prefix}bin_lo_", f"{prefix}bin_hi_", F.greatest(F.lit(BIN_DAYS), mean).alias(f"{prefix}bin_width_"))
        .withColumnsRenamed(theirs)
    )

    def bin_of(date: Column) -> Column:
        return F.floor(F.date_diff(date, F.col(f"{prefix}bin_lo_")) / F.col(f"{prefix}bin_width_"))

    def with_hot(rows: DataFrame) -> DataFrame:
        return rows.join(hot, [F.col(k) == F.col(theirs[k]) for k in keys], "left")

    helpers = [f"{prefix}bin_lo_", f"{prefix}bin_hi_", f"{prefix}bin_width_", *theirs.values()]
    one, last = F.lit(0).cast("bigint"), F.lit(-1).cast("bigint")
    of_fact = F.when(F.col(f"{prefix}bin_width_").isNull(), one).when(F.col(day) >= F.col(f"{prefix}bin_hi_"), last).otherwise(bin_of(F.col(day)))
    of_version = (
        F.when(F.col(f"{prefix}bin_width_").isNull(), F.array(one))
        .when(start == F.col(f"{prefix}bin_hi_"), F.array(last))
        .otherwise(F.sequence(bin_of(start), bin_of(F.date_sub(end, 1))))
    )
    return (
        with_hot(facts).withColumn(prefix + BIN, of_fact).drop(*helpers),
        with_hot(versions).withColumn(prefix + BIN, F.explode(of_version)).drop(*helpers),
    )


def _versions_on(
    facts: DataFrame, versions: DataFrame, keys: list[str], on_date: str, prefix: str
) -> DataFrame:
    """The version of every distinct (key, date), found by one pass along each key's timeline."""
    attributes = [c for c in versions.columns if c not in keys]
    starts = versions.select(
        *keys,
        F.col(prefix + "valid_from").alias(on_date),
        F.lit(False).alias("_asked"),
        F.struct(*attributes).alias("_version"),
    )
    asked = (
        facts.dropna()
        .distinct()
        .withColumns({"_asked": F.lit(True), "_version": F.lit(None).cast(starts.schema["_version"].dataType)})
    )
    up_to_here = (
        Window.partitionBy(*keys)
        .orderBy(on_date, "_asked")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        starts.unionByName(asked)
        .withColumn("_version", F.last("_version", ignorenulls=True).over(up_to_here))
        .filter(F.col("_asked") & (F.col(on_date) < F.col(f"_version.{prefix}valid_to")))
        .select(*keys, on_date, *[F.col(f"_version.{c}").alias(c) for c in attributes])
    )
