"""Small append-only JSON datasets: audit rows, ingest log, commits and marks.

Each append adds one file, which appears whole or not at all, so the latest state
is always readable while it changes. Their size follows the number of runs, not
the data. A row of driver values is written by the driver, without a Spark job.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.sources.staging import filesystem_of
from dimflow.sources.tables import load_optional


def one_row(spark: SparkSession, schema: T.StructType, row: tuple) -> DataFrame:
    """Driver values as a DataFrame of literals, which needs no Python worker."""
    values = [F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(schema, row, strict=True)]
    return spark.range(0, 1, numPartitions=1).select(*values)


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty DataFrame that the optimizer knows to be empty."""
    return one_row(spark, schema, (None,) * len(schema)).where(F.lit(False))


def _text(value: object) -> str:
    if isinstance(value, dt.datetime):
        # Full precision: a mark cut to milliseconds would lie before the rows it covers.
        return value.astimezone(dt.timezone.utc).isoformat(timespec="microseconds")
    return value.isoformat()


def append_row(spark: SparkSession, path: str, schema: T.StructType, row: tuple) -> None:
    """Append one row of driver values."""
    values = {name: v for name, v in zip(schema.names, row, strict=True) if v is not None}
    line = json.dumps(values, default=_text) + "\n"
    name = f"{time.time_ns()}-{uuid.uuid4().hex}"
    filesystem, hidden = filesystem_of(spark, f"{path}/.{name}")
    out = filesystem.create(hidden)
    out.write(line.encode())
    out.close()
    if not filesystem.rename(hidden, filesystem_of(spark, f"{path}/part-{name}.json")[1]):
        raise OSError(f"cannot add a row to {path}")


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of the dataset; none when it does not exist yet."""
    df = load_optional(spark, path, schema, format="json")
    return no_rows(spark, schema) if df is None else df
