"""The loan CSV scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.schemas import LOAN_SCHEMA


def read_loans_csv(spark: SparkSession, path: str, corrupt_column: str | None = None) -> DataFrame:
    """Loans from CSV files with a header line and a fixed schema.

    Columns bind by position. A value that does not parse becomes null, a short
    row is padded with nulls, and extra fields are dropped; name a
    ``corrupt_column`` to also keep the text of such rows.
    """
    reader = spark.read.option("header", True)
    schema = LOAN_SCHEMA
    if corrupt_column:
        schema = T.StructType([*LOAN_SCHEMA.fields, T.StructField(corrupt_column, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).csv(path)


def with_source(rows: DataFrame) -> DataFrame:
    """Rows of a file scan with the file each came from and the byte that its split of the file starts at."""
    return rows.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("source_start"),
    )
