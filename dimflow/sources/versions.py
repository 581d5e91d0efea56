"""Dimension tables on storage: a current snapshot, a growing history, a commit log.

Layout under a table's path::

    current/table_version=<n>/bucket=<b>   the current rows of a bucket of keys
    history/table_version=<n>              rows that version n ended, never rewritten
    outdated/table_version=<n>             keys and starts of older history rows that do not hold from version n on
    commits                                one JSON row per finished version

Keys are dealt out to a fixed number of buckets by hash. A version writes the buckets in
which something changed, and its commit row names the version that each bucket is at. A version exists
once its commit row does. Nothing a reader can see is overwritten or deleted: a run that dies
half-way leaves folders that no commit names, and the next run replaces them. `vacuum`, which
nothing here calls, deletes old snapshots. One writer per table at a time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.sources.logs import append_row, no_rows, read_log
from dimflow.sources.staging import delete_folder
from dimflow.sources.tables import load_optional, replace_folder, write_partitioned

COMMIT_SCHEMA = T.StructType(
    [
        T.StructField("version", T.IntegerType()),
        T.StructField("buckets", T.ArrayType(T.IntegerType())),  # the version each is at, or 0
        T.StructField("columns", T.StringType()),  # of the snapshot, as DDL
        T.StructField("last_key", T.LongType()),
        T.StructField("process_date", T.DateType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("source", T.StringType()),  # what was merged, where the caller names it
    ]
)
BUCKETS = 32


def last_commit(spark: SparkSession, path: str) -> Row | None:
    """The newest commit row, or None when the table does not exist."""
    commits = read_log(spark, f"{path}/commits", COMMIT_SCHEMA)
    return commits.orderBy(F.desc("version")).first()


def is_merged(spark: SparkSession, path: str, source: str) -> bool:
    """Whether a commit has merged a named source already."""
    return not read_log(spark, f"{path}/commits", COMMIT_SCHEMA).filter(F.col("source") == source).isEmpty()


def commit_at(spark: SparkSession, path: str, version: int) -> Row:
    """The commit row of a version."""
    row = read_log(spark, f"{path}/commits", COMMIT_SCHEMA).filter(F.col("version") == version).first()
    if row is None:
        raise ValueError(f"{path} has no version {version}")
    return row


def bucket_of(keys: Sequence[str], commit: Row | None) -> Column:
    """The bucket of a row's key. A table keeps the number of buckets it began with."""
    count = len(commit.buckets) if commit else BUCKETS
    return F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int")


def read_current(
    spark: SparkSession, path: str, commit: Row | None, buckets: Collection[int] | None = None
) -> DataFrame | None:
    """The snapshot ``commit`` names, or some buckets of it; None when the table does not exist.
    Columns that older files lack are null."""
    if commit is None:
        return None
    base, columns = f"{path}/current", T.StructType.fromDDL(commit.columns)
    held: dict[int, list[str]] = {}
    for b, version in enumerate(commit.buckets):
        if version and (buckets is None or b in buckets):
            held.setdefault(version, []).append(f"{base}/table_version={version}/bucket={b}")
    return _as_written(spark, path, columns, held, lambda reader, paths: reader.parquet(*paths))


def _as_written(
    spark: SparkSession, path: str, columns: T.StructType, held: dict[int, list[str]],
    load: Callable[[DataFrameReader, list[str]], DataFrame],
) -> DataFrame:
    """Folders by version, each read with the types that its version was written with, as ``columns``. Versions
    of one schema, which is the rule, are one scan."""
    written = _written_as(spark, path, columns, held) if held else {}
    parts = []
    for ddl in dict.fromkeys(written.values()):
        theirs = {f.name: f.dataType for f in T.StructType.fromDDL(ddl)}
        schema = T.StructType([T.StructField(f.name, theirs.get(f.name, f.dataType)) for f in columns])
        folders = [folder for version, paths in held.items() if written[version] == ddl for folder in paths]
        rows = load(spark.read.schema(schema), folders)
        parts.append(rows.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in columns if schema[f.name].dataType != f.dataType}))
    return reduce(DataFrame.unionByName, parts) if parts else no_rows(spark, columns)


def _written_as(spark: SparkSession, path: str, columns: T.StructType, versions: Iterable[int]) -> dict[int, str]:
    """The columns of each version as DDL: one text for all that differ in nothing but columns that they lack."""
    now = {f.name: f.dataType for f in columns}
    commits = read_log(spark, f"{path}/commits", COMMIT_SCHEMA).filter(F.col("version").isin(*versions))
    out = {}
    for row in commits.select("version", "columns").collect():  # a row per run
        other = [f for f in T.StructType.fromDDL(row["columns"]) if f.name in now and f.dataType != now[f.name]]
        out[row.version] = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in other) or "`_` int"
    return out


def holds_column(
    spark: SparkSession, path: str, commit: Row, name: str, buckets: Collection[int] | None = None
) -> bool:
    """Whether all files of a snapshot, or of some buckets of it, were written with a column of this name."""
    versions = {v for b, v in enumerate(commit.buckets) if v and (buckets is None or b in buckets)}
    commits = read_log(spark, f"{path}/commits", COMMIT_SCHEMA).filter(F.col("version").isin(*versions))
    rows = commits.select("columns").collect() if versions else []  # a row per run
    return all(name in T.StructType.fromDDL(row["columns"]).names for row in rows)


def read_history(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    commit: Row | None,
    keys: Sequence[str] = (),
    start: str | None = None,
    after: int = 0,
) -> DataFrame:
    """All committed history rows (of versions later than ``after``); none when there is no table, or no history yet. Columns
    that older versions lack are null. With ``keys`` and the column of ``start``, rows that a late batch has
    outdated are left out; without late batches nothing is joined."""
    version = T.StructField("table_version", T.IntegerType())
    with_version = T.StructType([*schema.fields, version])
    if commit is None or load_optional(spark, f"{path}/history", with_version) is None:
        return no_rows(spark, schema)
    # Versions are filtered as partitions, not listed: there is one scan for each schema that they have.
    held = {n: [n] for n in range(after + 1, commit.version + 1)}

    def load(reader: DataFrameReader, versions: list[int]) -> DataFrame:
        return reader.parquet(f"{path}/history").filter(F.col("table_version").isin(*versions))

    rows = _as_written(spark, path, with_version, held, load)
    if start is not None:
        gone = read_outdated(spark, path, schema, keys, start, 0, commit.version)
        if gone is not None:
            theirs = {c: f"_gone_{c}" for c in gone.columns}
            gone = gone.groupBy(*keys, start).agg(F.max("table_version").alias("table_version"))
            gone = gone.withColumnsRenamed(theirs)
            on = [F.col(c) == F.col(theirs[c]) for c in (*keys, start)]
            on.append(F.col("table_version") < F.col(theirs["table_version"]))
            rows = rows.join(gone, on, "left_anti")
    return rows.drop("table_version")


def read_outdated(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], start: str, after: int, up_to: int
) -> DataFrame | None:
    """Keys and starts of history rows that some versions have replaced, with ``table_version``; None if no
    batch has come late."""
    version = T.StructField("table_version", T.IntegerType())
    named = T.StructType([*[schema[k] for k in keys], T.StructField(start, T.DateType()), version])
    gone = load_optional(spark, f"{path}/outdated", named)
    return None if gone is None else gone.filter(F.col("table_version").between(after + 1, up_to))


def commit_version(
    spark: SparkSession,
    path: str,
    previous: Row | None,
    current: DataFrame,
    keys: Sequence[str],
    changed: Collection[int],
    ended: DataFrame,
    process_date: dt.date,
    last_key: int | None = None,
    rebuilt: bool = False,
    outdated: DataFrame | None = None,
    source: str | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Write the version after ``previous`` and make it the table's newest.

    ``current`` has all current rows of the ``changed`` buckets; the other buckets stay as they
    are, or become empty if the table is ``rebuilt``. ``outdated`` (keys and starts) are the history rows of
    earlier versions that this one replaces. ``finish`` adds columns to current rows once they lie in their buckets.
    """
    version = previous.version + 1 if previous else 1
    buckets = [0] * BUCKETS if rebuilt or not previous else list(previous.buckets)
    rows = current.withColumn("bucket", bucket_of(keys, None if rebuilt else previous))
    rows = rows.filter(F.col("bucket").isin(*changed))
    write_partitioned(rows, f"{path}/current/table_version={version}", ["bucket"], mode="overwrite", finish=finish)
    replace_folder(ended, f"{path}/history/table_version={version}")
    if outdated is not None:
        replace_folder(outdated, f"{path}/outdated/table_version={version}")
    for b in changed:
        buckets[b] = version
    now = dt.datetime.now(dt.timezone.utc)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in (finish(current) if finish else current).schema)
    row = (version, buckets, columns, last_key, process_date, now, source)
    append_row(spark, f"{path}/commits", COMMIT_SCHEMA, row)
    return version


def vacuum(spark: SparkSession, path: str, older_than: dt.datetime) -> list[int]:
    """Delete the snapshot folders that only versions replaced before a time need; returns
    their versions. Readers of such a version must be done. History is kept."""
    commits = read_log(spark, f"{path}/commits", COMMIT_SCHEMA).orderBy("version").collect()
    needed: set[int] = set()
    for commit, following in zip(commits, [*commits[1:], None]):
        if following is None or following.committed_at.astimezone(dt.timezone.utc) >= older_than:
            needed |= set(commit.buckets)
    gone = [c.version for c in commits if c.version not in needed]
    for version in gone:
        delete_folder(spark, f"{path}/current/table_version={version}")
    return gone
