"""Intermediate tables in the folder the cluster shares.

A staged table cuts lineage where two consumers must see the same rows, survives
the loss of executors, and tells the planner its real size, so joins against it
are broadcast only when it is small.

Every staged folder has an owner: the job whose `staging_scope` it is in, which deletes
it on leaving, or else this process, which deletes it at `release` or when it ends.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from dimflow.schemas import MANY_VALUES

_open_scope: ContextVar[list[str] | None] = ContextVar("dimflow_staging", default=None)
_unscoped: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, or by setCheckpointDir."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return folder


def use_folder_if_unset(spark: SparkSession, folder: str) -> None:
    """Name a shared folder for a session that has none. Only where one machine is the whole
    cluster: a local session, without executors of its own."""
    master = spark.sparkContext.master
    unset = not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
    if unset and (master == "local" or master.startswith("local[")):
        spark.sparkContext.setCheckpointDir(folder)


def new_folder(spark: SparkSession, name: str = "staged") -> str:
    """A path in the shared folder that nothing else uses."""
    path = f"{shared_folder(spark).rstrip('/')}/dimflow/{name}-{uuid.uuid4().hex}"
    scope = _open_scope.get()
    if scope is not None:
        scope.append(path)
    else:
        _unscoped.append((spark, path))
    return path


def plain_columns(df: DataFrame) -> dict[str, str]:
    """Write options by which columns of many values get no dictionary: to make one and give it up takes a good part of a write."""
    return {f"parquet.enable.dictionary#{c}": "false" for c in df.columns if c in MANY_VALUES}


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of the copy."""
    spark = df.sparkSession
    path = new_folder(spark)
    df.write.options(**plain_columns(df)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_alone(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """Stage what ``build`` makes, and delete what was staged to make it."""
    path = new_folder(spark)
    with staging_scope(spark):
        df = build()
        df.write.options(**plain_columns(df)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what was staged inside. For jobs, whose results are written
    by then; not for a DataFrame that is still to be computed."""
    paths: list[str] = []
    token = _open_scope.set(paths)
    try:
        yield
    finally:
        _open_scope.reset(token)
        for path in paths:
            delete_folder(spark, path)


def release() -> None:
    """Delete all that was staged outside of scopes. Results that are still to be computed
    from it are lost."""
    while _unscoped:
        spark, path = _unscoped.pop()
        delete_folder(spark, path)


@atexit.register
def _release_at_exit() -> None:
    try:
        release()
    except Exception:  # the JVM may be gone; then nobody is left to ask
        _unscoped.clear()


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever filesystem holds it, if it is there."""
    filesystem, target = filesystem_of(spark, path)
    filesystem.delete(target, True)


def free_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files deleted that no query can read any more. Spark does so once the driver's JVM has collected garbage, for which one
    with memory to spare may wait half an hour, while the files of every step fill the disks."""
    spark.sparkContext._jvm.System.gc()


def filesystem_of(spark: SparkSession, path: str) -> tuple:
    """(Hadoop filesystem, path) of a path."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target
