"""Parquet tables: optional loads and partitioned writes."""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from dimflow.sources.staging import filesystem_of, plain_columns

# Tables come out a quarter smaller than by snappy, in the same time.
CODEC = "zstd"

# So many files a task of a partitioned write has open. Only rows of further ones are sorted, and spilled where they are too many.
OPEN_FILES = 32
_SETTING = "spark.sql.maxConcurrentOutputFileWriters"
_lock = threading.Lock()
_inside: dict[SparkSession, int] = {}


def load_optional(
    spark: SparkSession, path: str, schema: T.StructType | None = None, format: str = "parquet"
) -> DataFrame | None:
    """The table at ``path``, or None when the path is missing. Any other failure
    raises, so a storage fault is never taken for a first load."""
    reader = spark.read.format(format)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


@contextmanager
def unsorted(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes in here do not sort their rows by partition, but have a file open for each. A session with a
    setting of its own for that keeps it. Writes may be side by side: the last one out takes the setting back."""
    with _lock:
        if spark in _inside or int(spark.conf.get(_SETTING, "0")) == 0:
            spark.conf.set(_SETTING, str(OPEN_FILES))
            _inside[spark] = _inside.get(spark, 0) + 1
            ours = True
        else:
            ours = False
    try:
        yield
    finally:
        if ours:
            with _lock:
                _inside[spark] -= 1
                if not _inside[spark]:
                    del _inside[spark]
                    spark.conf.unset(_SETTING)


def write_partitioned(
    df: DataFrame, path: str, partition_by: Sequence[str], mode: str = "append", counts: Mapping[str, Column] | None = None,
    gather: bool = True, finish: Callable[[DataFrame], DataFrame] | None = None,
) -> dict[str, int]:
    """Write ``df`` with one directory per value of the ``partition_by`` columns.

    Rebalancing gathers each value into few files; a value that holds a large
    share of the rows is split over as many tasks as its size calls for. Without ``gather`` nothing is shuffled, and each
    task writes a file for each value that it has: for few values. ``finish`` adds what need not be shuffled, as it is made of
    the other columns of a row.

    ``counts`` are aggregates that are observed in the write and returned. They are taken after the rebalancing,
    in the tasks that write: each of them counts once, however often a task or a stage before it is tried.
    """
    rows = df.hint("rebalance", *partition_by) if gather else df
    return _write(finish(rows) if finish else rows, path, partition_by, mode, counts)


def replace_folder(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), counts: Mapping[str, Column] | None = None
) -> dict[str, int]:
    """Write ``df`` as the whole content of ``path``, which it must not read from. ``counts`` are as in `write_partitioned`."""
    return _write(df, path, partition_by, "overwrite", counts)


def _write(
    df: DataFrame, path: str, partition_by: Sequence[str], mode: str, counts: Mapping[str, Column] | None
) -> dict[str, int]:
    observation = Observation() if counts else None
    if observation is not None:
        df = df.observe(observation, *[c.alias(name) for name, c in counts.items()])
    # Overwriting replaces all of ``path``, whatever the session says.
    writer = df.write.options(partitionOverwriteMode="static", compression=CODEC, **plain_columns(df)).mode(mode)
    with unsorted(df.sparkSession):
        writer.partitionBy(*partition_by).parquet(path)
    return {} if observation is None else observation.get


def input_stamp(spark: SparkSession, path: str) -> str:
    """A text that differs when the files at ``path`` do: their names, lengths and times."""
    filesystem, target = filesystem_of(spark, path)
    seen = []
    for found in filesystem.globStatus(target) or []:
        files = filesystem.listFiles(found.getPath(), True)
        while files.hasNext():
            file = files.next()
            seen.append(f"{file.getPath().toString()} {file.getLen()} {file.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()
