"""Split rows into valid ones and ones to quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.functions import rules
from dimflow.schemas import ERROR, VALID


def with_outcome(df: DataFrame) -> DataFrame:
    """Add ``outcome``: 'valid' or 'error'. Lets one pass write both sides."""
    return df.withColumn("outcome", F.when(rules.is_valid(), VALID).otherwise(ERROR))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, error): two lazy filters that partition ``df``."""
    return df.filter(rules.is_valid()), df.filter(~rules.is_valid())


def validity_counts(df: DataFrame) -> DataFrame:
    """One row: total_records, valid_records, error_records, from one scan."""
    valid = F.count_if(rules.is_valid())
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        valid.alias("valid_records"),
        (F.count(F.lit(1)) - valid).alias("error_records"),
    )
