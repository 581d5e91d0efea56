"""Quality flags, error rows and per-check metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.functions import rules


def flag_rows(df: DataFrame) -> DataFrame:
    """Add the six flag columns and ``quality_issue``, the number raised."""
    return df.withColumns(rules.flags()).withColumn("quality_issue", rules.issue_count())


def error_rows(flagged: DataFrame) -> DataFrame:
    """Rows with at least one flag, flags kept."""
    return flagged.filter(F.col("quality_issue") > 0)


def totals() -> dict[str, Column]:
    """The aggregates of `quality_totals` by name, for an aggregation or a write that observes them."""
    sums = {c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint") for c in rules.CHECKS}
    return {"total_records": F.count(F.lit(1)), "error_records": F.count_if(F.col("quality_issue") > 0), **sums}


def quality_totals(flagged: DataFrame) -> DataFrame:
    """One row: total_records, error_records and the sum of every flag, in one pass."""
    return flagged.agg(*[c.alias(name) for name, c in totals().items()])


def _percentage(count):
    return count / F.greatest(F.col("total_records"), F.lit(1)) * 100


def quality_metrics(totals: DataFrame) -> DataFrame:
    """Long form: one row (check, error_count, error_percentage) per check."""
    return totals.unpivot(["total_records"], list(rules.CHECKS), "check", "error_count").select(
        "check", "error_count", _percentage(F.col("error_count")).alias("error_percentage")
    )


def quality_report(totals: DataFrame) -> DataFrame:
    """One row: timestamp, totals, and a map check -> {error_count, error_percentage}."""
    entries = []
    for check in rules.CHECKS:
        entries += [
            F.lit(check),
            F.struct(
                F.col(check).alias("error_count"),
                _percentage(F.col(check)).alias("error_percentage"),
            ),
        ]
    return totals.select(
        F.current_timestamp().alias("timestamp"),
        "total_records",
        "error_records",
        F.create_map(*entries).alias("metrics"),
    )


def run_quality_checks(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(error rows, metrics in long form)."""
    flagged = flag_rows(df)
    return error_rows(flagged), quality_metrics(quality_totals(flagged))
