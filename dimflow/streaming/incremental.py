"""Incremental batches: process only what arrived after a stored high-water mark."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.schemas import FIRST_MARK
from dimflow.sources.logs import append_row, read_log

# Fixed value: the field name of a stored mark.
MARK_SCHEMA = T.StructType([T.StructField("lastProcessedDate", T.TimestampType())])


def utc_from_micros(micros: int) -> dt.datetime:
    """The instant that Spark's ``unix_micros`` gave, with its zone stated."""
    return dt.datetime.fromtimestamp(0, dt.timezone.utc) + dt.timedelta(microseconds=micros)


def incremental_slice(
    df: DataFrame,
    after: dt.datetime | Column,
    up_to: dt.datetime | Column | None = None,
    column: str = "ingestion_timestamp",
) -> DataFrame:
    """Rows with after < column <= up_to; the comparison reaches the parquet scan."""
    rows = df.filter(F.col(column) > F.lit(after))
    return rows if up_to is None else rows.filter(F.col(column) <= F.lit(up_to))


def next_mark(batch: DataFrame, column: str = "ingestion_timestamp") -> DataFrame:
    """One row: the mark after ``batch``, null when it is empty.

    It is the largest value processed and not the clock, so rows that land during
    a run belong to the next one.
    """
    return batch.agg(F.max(column).alias("lastProcessedDate"))


def read_mark(spark: SparkSession, path: str) -> dt.datetime:
    """The stored mark; the first run starts from 1900-01-01 UTC.

    Marks are appended and the largest one counts, so there is no moment without
    a mark.
    """
    marks = read_log(spark, path, MARK_SCHEMA)
    micros = marks.agg(F.unix_micros(F.max("lastProcessedDate"))).first()[0]
    return FIRST_MARK if micros is None else utc_from_micros(micros)


def write_mark(spark: SparkSession, path: str, mark: dt.datetime) -> None:
    """Store a mark. Call last: everything up to it must be processed."""
    append_row(spark, path, MARK_SCHEMA, (mark,))
