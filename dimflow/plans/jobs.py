"""Whole jobs: ingest, quality, transform, dimension merges, and a batch run.

Layout under the base path of ``run_batch``::

    ingested/rows/batch=<date>/input=<id>/outcome=<valid|error>/<partition_by>=...
    ingested/log                               one JSON row per ingested input
    reports/quality/batch=<date>/input=<id>    reports, one dataset
    reports/quality_errors/...                 their error rows, one dataset
    transformed/batch=<date>/input=<id>/<partition_by>=...
    transformed_audit                          one JSON row per transform
    type2/<dimension>, type4/<dimension>
    watermark/type2, watermark/type4

A batch is one input on one process date; a date may have several inputs. A rerun of a batch
replaces that batch's folders and nothing else. Failures raise.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.functions.rules import broken_rules
from dimflow.operators import quality as q
from dimflow.operators.changes import digest_name, digest_of, of_one_type, with_digest, with_tracked, without_digests
from dimflow.operators.enrich import enrich_loans
from dimflow.operators.slices import latest_per_key
from dimflow.operators.splice import Splice, observations, splice
from dimflow.operators.surrogate import number_densely, place_in_order
from dimflow.operators.type2 import TYPE2_COLUMNS, merge_type2
from dimflow.operators.type4 import CURRENT_SCHEMA, HISTORY_SCHEMA, merge_type4
from dimflow.operators.validate import with_outcome
from dimflow.schemas import (
    DIMENSIONS,
    ERROR,
    FIRST_MARK,
    LOAN_COLUMNS,
    LOAN_SCHEMA,
    VALID,
    OPEN_END,
    DimSpec,
)
from dimflow.sources.loans_csv import read_loans_csv, with_source
from dimflow.sources.logs import append_row, one_row, read_log
from dimflow.sources.staging import delete_folder, free_shuffles, stage, staging_scope
from dimflow.sources.tables import input_stamp, replace_folder, write_partitioned
from dimflow.sources.versions import (
    bucket_of,
    commit_at,
    commit_version,
    holds_column,
    is_merged,
    last_commit,
    read_current,
    read_history,
    read_outdated,
)
from dimflow.streaming.incremental import (
    incremental_slice,
    read_mark,
    utc_from_micros,
    write_mark,
)

LANDED_SCHEMA = T.StructType(
    [
        *LOAN_SCHEMA.fields,
        T.StructField("ingestion_timestamp", T.TimestampType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("source_start", T.LongType()),  # of the file's split
        T.StructField("malformed", T.StringType()),  # the text of a row with a value that does not parse
        T.StructField("broken_rules", T.ArrayType(T.StringType())),
        T.StructField("batch", T.DateType()),
        T.StructField("input", T.StringType()),
        T.StructField("outcome", T.StringType()),
    ]
)
INGEST_LOG_SCHEMA = T.StructType(
    [
        T.StructField("batch", T.DateType()),
        T.StructField("input", T.StringType()),
        T.StructField("ingestion_timestamp", T.TimestampType()),
        T.StructField("total_records", T.LongType()),
        T.StructField("valid_records", T.LongType()),
        T.StructField("error_records", T.LongType()),
        T.StructField("stamp", T.StringType()),  # of the input's files
    ]
)
TRANSFORMED_SCHEMA = T.StructType(
    [
        *LOAN_SCHEMA.fields,
        T.StructField("ingestion_timestamp", T.TimestampType()),
        T.StructField("monthly_payment", T.DoubleType()),
        T.StructField("loan_category", T.StringType()),
        T.StructField("transformation_timestamp", T.TimestampType()),
        T.StructField("batch", T.DateType()),
        T.StructField("input", T.StringType()),
    ]
)
# The fields of an audit row.
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("transformation_timestamp", T.StringType()),
        T.StructField("input_path", T.StringType()),
        T.StructField("output_path", T.StringType()),
        T.StructField("record_count", T.LongType()),
    ]
)


# A column that has so many values at most in the first rows of an input is taken to have few.
FIRST_ROWS, FEW_VALUES = 1000, 16

# So many rows of a batch are looked at first, for whether it has keys of all buckets.
FIRST_KEYS = 10_000

# The columns of a Type 2 version's start and end.
TYPE2_DATES = ("effective_start_date", "effective_end_date")


class Batch(NamedTuple):
    """One input on one process date."""

    date: dt.date
    input: str

    def folder(self, path: str) -> str:
        return f"{path}/batch={self.date}/input={self.input}"


def batch_of(input_path: str, date: dt.date) -> Batch:
    """An input is known by its path: the same path on the same date is the same batch."""
    return Batch(date, hashlib.sha256(input_path.encode()).hexdigest()[:16])


# Ingest


def ingest(
    spark: SparkSession,
    input_path: str,
    landing_path: str,
    date: dt.date,
    partition_by: str = "application_date",
) -> Row | None:
    """CSV -> landed rows, valid and quarantined apart; returns the batch's log row.

    The CSV is parsed once: one write sends every row to its outcome's directory, and counts it. Rows are shuffled to gather the
    values of ``partition_by`` only if the first rows show many of them; that decides on the number of files, on nothing else. Each row keeps the file it
    came from, a row with values that do not parse its text, and a quarantined row the rules that it breaks. An empty
    input writes nothing and returns None. An input
    whose files are as they were when this batch was ingested is not read again.
    """
    batch, now = batch_of(input_path, date), dt.datetime.now(dt.timezone.utc)
    stamp, known = input_stamp(spark, input_path), _log_entry(spark, landing_path, batch)
    if known is not None and known.stamp == stamp:
        return known
    raw = with_source(read_loans_csv(spark, input_path, corrupt_column="malformed"))
    first = raw.select(partition_by).head(FIRST_ROWS)
    if not first:
        return None
    extra = {"ingestion_timestamp": F.lit(now), "broken_rules": broken_rules()}
    rows = with_outcome(raw).withColumns(extra)
    folder = batch.folder(f"{landing_path}/rows")
    counts = {outcome: F.count_if(F.col("outcome") == outcome) for outcome in (VALID, ERROR)}
    gather = len({row[0] for row in first}) > FEW_VALUES
    counted = write_partitioned(rows, folder, ["outcome", partition_by], mode="overwrite", counts=counts, gather=gather)
    valid, errors = counted[VALID], counted[ERROR]
    entry = (date, batch.input, now, valid + errors, valid, errors, stamp)
    append_row(spark, f"{landing_path}/log", INGEST_LOG_SCHEMA, entry)
    return Row(*INGEST_LOG_SCHEMA.names)(*entry)


def _batches_of(
    spark: SparkSession, path: str, schema: T.StructType, batches: Iterable[Batch | dt.date] | None
) -> DataFrame:
    """A table kept in folders of batches. Named batches (or whole dates) are opened directly, so
    a run does not list the folders of all batches before it."""
    reader = spark.read.schema(schema).option("basePath", path)
    folders = [path] if batches is None else [
        b.folder(path) if isinstance(b, Batch) else f"{path}/batch={b}" for b in batches
    ]
    return reader.parquet(*folders).select(*schema.names)


def read_ingested(
    spark: SparkSession, landing_path: str, batches: Iterable[Batch | dt.date] | None = None
) -> DataFrame:
    """Valid rows; quarantined ones are pruned as partitions."""
    rows = _batches_of(spark, f"{landing_path}/rows", LANDED_SCHEMA, batches)
    rows = rows.filter(F.col("outcome") == VALID)
    return rows.select(*LOAN_COLUMNS, "ingestion_timestamp", "batch", "input")


def read_quarantine(
    spark: SparkSession, landing_path: str, batches: Iterable[Batch | dt.date] | None = None
) -> DataFrame:
    """Rows that failed validation, with the time and the date they failed on, the rules that they break and where
    they come from."""
    rows = _batches_of(spark, f"{landing_path}/rows", LANDED_SCHEMA, batches)
    return rows.filter(F.col("outcome") == ERROR).select(
        *LOAN_COLUMNS,
        F.col("ingestion_timestamp").alias("error_timestamp"),
        F.col("batch").alias("error_date"),
        "input",
        "broken_rules",
        "source_file",
        "source_start",
        "malformed",
    )


def _log_entry(spark: SparkSession, landing_path: str, batch: Batch) -> Row | None:
    log = read_log(spark, f"{landing_path}/log", INGEST_LOG_SCHEMA)
    own = (F.col("batch") == F.lit(batch.date)) & (F.col("input") == F.lit(batch.input))
    return log.filter(own).orderBy(F.desc("ingestion_timestamp")).first()


class Pending(NamedTuple):
    """A batch to process, the mark to set after it, and its number of valid rows."""

    batch: Batch
    micros: int
    valid_records: int


def pending_batches(spark: SparkSession, landing_path: str, after: dt.datetime) -> list[Pending]:
    """Batches ingested after a mark, oldest first. The log has a row per run, so this is small."""
    log = read_log(spark, f"{landing_path}/log", INGEST_LOG_SCHEMA)
    newest = F.max(F.struct(F.unix_micros("ingestion_timestamp").alias("micros"), "valid_records"))
    rows = (
        incremental_slice(log, after)
        .groupBy("batch", "input")
        .agg(newest.alias("newest"))
        .orderBy("newest.micros", "batch", "input")
        .collect()
    )
    return [Pending(Batch(r.batch, r.input), r.newest.micros, r.newest.valid_records) for r in rows]


def latest_date(spark: SparkSession, landing_path: str, up_to: dt.datetime) -> dt.date:
    """The latest date of the batches that have arrived up to a time. The log has a row per run."""
    log = read_log(spark, f"{landing_path}/log", INGEST_LOG_SCHEMA)
    return log.filter(F.col("ingestion_timestamp") <= F.lit(up_to)).agg(F.max("batch")).first()[0]


# Quality


def errors_path(report_path: str) -> str:
    """Where the error rows of a report go: a dataset beside the dataset of reports."""
    dataset, batch, rest = report_path.partition("/batch=")
    return f"{dataset.removesuffix('.json')}_errors{batch}{rest}"


def check_quality(spark: SparkSession, rows: DataFrame, report_path: str) -> Row | None:
    """Report on any table with the loan columns; returns the totals."""
    return _write_report(spark, q.flag_rows(rows), None, report_path)


def check_batch_quality(
    spark: SparkSession,
    landing_path: str,
    batch: Batch,
    report_path: str,
    entry: Row | None = None,
) -> Row | None:
    """Report on all rows of a landed batch, valid and quarantined.

    A valid row raises no flag, because both come from one rule table. So only
    the quarantined rows are read; of the others their number, which the batch's
    ingest log row has, is enough.
    """
    entry = entry or _log_entry(spark, landing_path, batch)
    if entry is None:
        return None
    errors = read_quarantine(spark, landing_path, [batch])
    errors = q.flag_rows(errors.select(*LOAN_COLUMNS, "error_timestamp", "error_date"))
    return _write_report(spark, errors, entry.total_records, report_path)


def _write_report(
    spark: SparkSession, flagged: DataFrame, total: int | None, report_path: str
) -> Row | None:
    """The error rows are replaced also by none, so a clean rerun clears those of the run before.
    ``total``: the number of rows, where ``flagged`` has not all of them."""
    totals = q.quality_totals(flagged)
    if total is None:
        counted = totals.first()
        if counted.total_records == 0:
            return None
        replace_folder(q.error_rows(flagged), errors_path(report_path))
    else:
        # All flagged rows are error rows: they are counted in the tasks that write them, and not read again.
        observed = replace_folder(q.error_rows(flagged), errors_path(report_path), counts=q.totals())
        counted = Row(*totals.columns)(*[{**observed, "total_records": total}[c] for c in totals.columns])
    report = q.quality_report(one_row(spark, totals.schema, counted))
    report.coalesce(1).write.mode("overwrite").json(report_path)
    return counted


# Transform


def transform(
    spark: SparkSession,
    landing_path: str,
    output_path: str,
    batch: Batch,
    partition_by: str = "application_date",
    valid_records: int | None = None,
) -> int:
    """Enrich the valid rows of a landed batch and write an audit row; returns their number.

    The number is the ingest log's (``valid_records``, or looked up). The batch replaces its own folder.
    Landed files already hold one value of ``partition_by`` each, so the write needs no shuffle.
    """
    if valid_records is None:
        entry = _log_entry(spark, landing_path, batch)
        valid_records = entry.valid_records if entry else 0
    folder = batch.folder(output_path)
    if valid_records == 0:
        delete_folder(spark, folder)
        return 0
    replace_folder(_enriched(spark, landing_path, batch).drop("batch", "input"), folder, [partition_by])
    now = dt.datetime.now(dt.timezone.utc).isoformat()
    audit = (now, landing_path, output_path, valid_records)
    append_row(spark, f"{output_path}_audit", AUDIT_SCHEMA, audit)
    return valid_records


def _enriched(spark: SparkSession, landing_path: str, batch: Batch) -> DataFrame:
    """The rows of a batch as they are transformed, from the landed ones."""
    rows = enrich_loans(read_ingested(spark, landing_path, [batch]))
    return rows.withColumn("transformation_timestamp", F.current_timestamp())


def read_transformed(
    spark: SparkSession, path: str, batches: Iterable[Batch | dt.date] | None = None
) -> DataFrame:
    """Transformed rows, optionally of some batches only."""
    return _batches_of(spark, path, TRANSFORMED_SCHEMA, batches)


# Dimensions


def _for_each(specs: Iterable[DimSpec], merge: Callable[[DimSpec], None]) -> None:
    """Merge the dimensions side by side: each has tables of its own."""
    specs = tuple(specs)
    with ThreadPoolExecutor(max(1, len(specs))) as pool:
        list(pool.map(merge, specs))


def _touched(updates: DataFrame, spec: DimSpec, commit: Row | None) -> list[int]:
    """The buckets that a slice has keys of: a list no longer than there are buckets."""
    bucket = bucket_of(spec.keys, commit).alias("bucket")
    return [r.bucket for r in updates.select(bucket).distinct().collect()]


def _slice_to_merge(
    spark: SparkSession, path: str, commit: Row | None, rebuilt: bool, rows: DataFrame, spec: DimSpec
) -> tuple[DataFrame, DataFrame | None]:
    """(slice with digests, current rows), as they are compared. A batch whose first rows have keys of every bucket, as those of large
    ones do, is compared with all of them and not staged: the one join with the current rows takes the slice as the aggregate leaves it, by
    key, and what comes of the join is staged. Else the slice is, as its buckets are to be known, or all of it is new."""
    updates = with_digest(latest_per_key(rows, spec), spec)
    if rebuilt:
        return stage(updates), None
    touched = _touched(rows.dropna(subset=list(spec.keys)).limit(FIRST_KEYS), spec, commit)
    if len(touched) < len(commit.buckets) or not any(commit.buckets):
        updates = stage(updates)
        touched = _touched(updates, spec, commit)
    return _to_compare(spark, path, commit, touched, rebuilt, updates, spec)


def _current(
    spark: SparkSession, path: str, commit: Row, buckets: Iterable[int] | None = None
) -> DataFrame:
    """The current rows as readers see them, without the digests that merges keep beside them."""
    return without_digests(read_current(spark, path, commit, buckets))


def _to_compare(
    spark: SparkSession, path: str, commit: Row | None, buckets: list[int], rebuilt: bool, updates: DataFrame, spec: DimSpec
) -> tuple[DataFrame, DataFrame | None]:
    """(slice, current rows), of one type, the slice with digests: those it has, or others if its types are widened. Those stored with the current rows stay there if all files of the
    buckets have them by today's tracked columns and types; else they are left out, and the merge makes them from the attributes."""
    if rebuilt:
        return updates, None
    stored = read_current(spark, path, commit, buckets)
    updates, current = of_one_type(updates, without_digests(stored), spec)
    digest = digest_name(updates, spec)
    if digest != digest_of(updates):
        updates = with_digest(updates, spec)
    if digest in stored.columns and holds_column(spark, path, commit, digest, buckets):
        return updates, stored
    return updates, current


def _has(commit: Row | None, names: Iterable[str]) -> bool:
    """Whether a table's snapshot has the columns that its type adds. One that has not is built
    again: its history stays readable and its keys go on."""
    return commit is not None and set(names) <= set(T.StructType.fromDDL(commit.columns).names)


def _refuse_if_late(commit: Row | None, process_date: dt.date) -> None:
    """A batch must not end versions that began after it."""
    if commit is not None and process_date < commit.process_date:
        raise ValueError(f"{process_date} lies before {commit.process_date}: give `seen`, the rows of the batches since")


def scd2(
    spark: SparkSession,
    rows: DataFrame,
    dims_path: str,
    process_date: dt.date,
    specs: Iterable[DimSpec] = DIMENSIONS,
    seen: DataFrame | None = None,
    source: str | None = None,
) -> None:
    """Merge a batch into the Type 2 dimensions under ``dims_path``.

    Only buckets of keys in which something changes are written again. A tracked column that is
    new to a dimension is null in all versions before. A late batch, one with a date before that of a batch merged earlier, is
    spliced in: ``seen`` has the rows of all merged batches from its date on, its own among them, with ``batch`` and
    ``ingestion_timestamp``. Versions that stay keep their surrogate keys. A ``source`` is named in the commit row, and merged
    once: a dimension whose commits name it already is left as it is, without a look at the rows.
    """

    def merge_one(spec: DimSpec) -> None:
        with staging_scope(spark):
            path = f"{dims_path}/{spec.name}"
            if source is not None and is_merged(spark, path, source):
                return
            commit = last_commit(spark, path)
            rebuilt = not _has(commit, TYPE2_COLUMNS)
            if seen is not None and not rebuilt:
                _splice_type2(spark, path, commit, rows, seen, spec, process_date, source)
                return
            _refuse_if_late(commit, process_date)
            updates, current = _slice_to_merge(spark, path, commit, rebuilt, rows, spec)
            last = (commit.last_key if commit else 0) or 0
            last_used = one_row(spark, T.StructType([T.StructField("last_key", T.LongType())]), (last,))
            merge = merge_type2(updates, current, spec, process_date, last_used)
            _commit(spark, path, commit, merge, merge.expired, spec, process_date, last, rebuilt, source)

    _for_each(specs, merge_one)


def _commit(spark, path, commit, merge, ended, spec, process_date, last_key, rebuilt, source) -> None:
    """Write a merge, unless nothing has changed. Digests are made again where the rows are written: to shuffle them takes more."""
    bucket = bucket_of(spec.keys, None if rebuilt else commit).alias("bucket")
    changed = dict(merge.delta.groupBy(bucket).count().collect())
    if changed or commit is None:
        after = None if last_key is None else last_key + sum(changed.values())
        commit_version(
            spark, path, commit, without_digests(merge.current), spec.keys, changed, ended, process_date, after, rebuilt,
            source=source, finish=lambda rows: with_digest(rows, spec),
        )


def _spliced(
    spark: SparkSession, path: str, commit: Row, rows: DataFrame, seen: DataFrame, spec: DimSpec, since: dt.date,
    current: DataFrame, history: DataFrame, names: tuple[str, str], carried: tuple[str, ...] = (),
) -> tuple[Splice, DataFrame, list[int]]:
    """(splice, current rows of other keys in the touched buckets, touched buckets). ``names``: the columns of start and end."""
    touched = stage(latest_per_key(rows, spec).select(*spec.keys))
    buckets = _touched(touched, spec, commit)
    start, end = names
    inside = bucket_of(spec.keys, commit).isin(*buckets)
    renamed = {start: "valid_from", end: "valid_to"}
    seen, current = of_one_type(seen, current, spec)
    _, history = of_one_type(seen, history, spec)
    older = history.filter(inside).unionByName(current.filter(inside), allowMissingColumns=True)
    old = older.withColumnsRenamed(renamed).select(
        *[c for c in spec.columns if c in older.columns], "valid_from", "valid_to", *carried
    )
    made = splice(touched, old, observations(seen, spec, since), spec, since, carried)
    free_shuffles(spark)
    others = with_tracked(current, rows, spec).join(touched, list(spec.keys), "left_anti").filter(inside)
    return made, others, buckets


def _splice_type2(spark, path, commit, rows, seen, spec, since, source) -> None:
    current = _current(spark, path, commit)
    history = read_history(spark, path, current.schema, commit, spec.keys, TYPE2_DATES[0])
    made, others, buckets = _spliced(
        spark, path, commit, rows, seen, spec, since, current, history, TYPE2_DATES, ("surrogate_key",)
    )
    renamed = dict(zip(("valid_from", "valid_to", "_open"), (*TYPE2_DATES, "is_current")))
    versions = made.versions.withColumnsRenamed(renamed)
    columns = [*spec.columns, *TYPE2_COLUMNS]
    fresh = versions.filter("surrogate_key is null").drop("surrogate_key")
    last = commit.last_key or 0
    last_used = one_row(spark, T.StructType([T.StructField("last_key", T.LongType())]), (last,))
    placed = place_in_order(fresh, [F.col(TYPE2_DATES[0]), *map(F.col, spec.keys), F.col(TYPE2_DATES[1])])
    numbered = number_densely(placed, last_used).select(*columns)
    every = versions.filter("surrogate_key is not null").select(*columns).unionByName(numbered)
    after = last + placed.count()
    _commit_splice(spark, path, commit, made, every, "is_current", others.select(*columns), buckets, spec, since, after, source)


def _splice_type4(spark, path, commit, rows, seen, spec, since, source) -> None:
    current = _current(spark, path, commit)
    attributes = [f for f in current.schema if f.name not in CURRENT_SCHEMA.names]
    schema = T.StructType([*attributes, *HISTORY_SCHEMA.fields])
    start, end = HISTORY_SCHEMA.names[:2]
    history = read_history(spark, path, schema, commit, spec.keys, start)
    live = current.withColumn(end, F.lit(OPEN_END))
    made, others, buckets = _spliced(spark, path, commit, rows, seen, spec, since, live, history, (start, end))
    every = made.versions.withColumnsRenamed({"valid_from": start, "valid_to": end})
    every = every.withColumn("archived_at", F.current_timestamp())
    _commit_splice(spark, path, commit, made, every, "_open", others.drop(end), buckets, spec, since, None, source)


def _commit_splice(spark, path, commit, made, every, is_open, others, buckets, spec, since, last_key, source) -> None:
    """Write the touched buckets, the closed versions and what they replace as one version."""
    live = [c for c in others.columns]
    ended = every.filter(~F.col(is_open))
    ended = ended.drop(*[c for c in ("_open",) if c in ended.columns])
    current = others.unionByName(every.filter(is_open).select(*live))
    names = made.outdated.columns
    start = TYPE2_DATES[0] if TYPE2_DATES[0] in live else CURRENT_SCHEMA.names[0]
    outdated = made.outdated.withColumnRenamed(names[-1], start)
    commit_version(
        spark, path, commit, current, spec.keys, buckets, ended, max(since, commit.process_date), last_key,
        outdated=outdated, source=source, finish=lambda rows: with_digest(rows, spec),
    )


def _with_spec(rows: DataFrame, spec: DimSpec, more: Iterable[str]) -> DataFrame:
    """The columns of a table in their order; a tracked column that it does not have yet is left out."""
    return rows.select(*[c for c in (*spec.columns, *more) if c in rows.columns])


def _type2_current(spark: SparkSession, path: str, spec: DimSpec, commit: Row | None) -> DataFrame | None:
    if not _has(commit, TYPE2_COLUMNS):
        return None
    return _with_spec(read_current(spark, path, commit), spec, TYPE2_COLUMNS)


def read_type2(spark: SparkSession, dims_path: str, spec: DimSpec) -> DataFrame | None:
    """All versions of a Type 2 dimension; None before its first load."""
    path = f"{dims_path}/{spec.name}"
    commit = last_commit(spark, path)
    current = _type2_current(spark, path, spec, commit)
    if current is None:
        return None
    return read_history(spark, path, current.schema, commit, spec.keys, TYPE2_DATES[0]).unionByName(current)


def read_type2_current(spark: SparkSession, dims_path: str, spec: DimSpec) -> DataFrame | None:
    """The current versions of a Type 2 dimension, without touching older ones."""
    path = f"{dims_path}/{spec.name}"
    return _type2_current(spark, path, spec, last_commit(spark, path))


def type2_changes(
    spark: SparkSession, dims_path: str, spec: DimSpec, after: int, up_to: int | None = None
) -> DataFrame:
    """What versions of a table have changed in a Type 2 dimension, from one to another (the newest, by default).

    ``change`` is begun (rows that are new, as they stand at ``up_to``), ended (rows of ``after`` that have an end, or
    another one) or removed (rows of ``after`` that a late batch has replaced). Surrogate keys are dealt out in order, so what is
    new is known by its key: only the buckets and the history of the versions in between are read, and no snapshots compared.
    """
    path = f"{dims_path}/{spec.name}"
    old, new = commit_at(spark, path, after), commit_at(spark, path, up_to) if up_to else last_commit(spark, path)
    buckets = [b for b, version in enumerate(new.buckets) if version > after]
    current = _current(spark, path, new, buckets)
    schema = current.schema
    start = TYPE2_DATES[0]
    closed = read_history(spark, path, schema, new, spec.keys, start, after)
    began = F.col("surrogate_key") > F.lit(old.last_key or 0)
    rows = closed.unionByName(current.filter(began))
    change = F.when(began, "begun").otherwise("ended").alias("change")
    out = rows.select(change, *schema.names)
    gone = read_outdated(spark, path, schema, spec.keys, start, after, new.version)
    if gone is not None:
        # Few keys: those that late batches have touched.
        before = read_history(spark, path, schema, old, spec.keys, start).unionByName(
            with_tracked(_current(spark, path, old), current, spec)
        )
        stays = read_history(spark, path, schema, new, spec.keys, start).unionByName(_current(spark, path, new))
        named = gone.select(*spec.keys, start).distinct()
        removed = before.join(named, [*spec.keys, start], "left_semi").join(
            stays.join(named, [*spec.keys], "left_semi").select("surrogate_key"), "surrogate_key", "left_anti"
        )
        out = out.unionByName(removed.select(F.lit("removed").alias("change"), *schema.names))
    return out


def scd4(
    spark: SparkSession,
    rows: DataFrame,
    dims_path: str,
    process_date: dt.date,
    specs: Iterable[DimSpec] = DIMENSIONS,
    seen: DataFrame | None = None,
    source: str | None = None,
) -> None:
    """Merge a batch into the Type 4 dimensions under ``dims_path``, as `scd2` does."""

    def merge_one(spec: DimSpec) -> None:
        with staging_scope(spark):
            path = f"{dims_path}/{spec.name}"
            if source is not None and is_merged(spark, path, source):
                return
            commit = last_commit(spark, path)
            rebuilt = not _has(commit, CURRENT_SCHEMA.names)
            if seen is not None and not rebuilt:
                _splice_type4(spark, path, commit, rows, seen, spec, process_date, source)
                return
            _refuse_if_late(commit, process_date)
            updates, current = _slice_to_merge(spark, path, commit, rebuilt, rows, spec)
            merge = merge_type4(updates, current, spec, process_date)
            _commit(spark, path, commit, merge, merge.archived, spec, process_date, None, rebuilt, source)

    _for_each(specs, merge_one)


def read_type4(
    spark: SparkSession, dims_path: str, spec: DimSpec
) -> tuple[DataFrame, DataFrame] | None:
    """(current, history) of a Type 4 dimension; None before its first load."""
    path = f"{dims_path}/{spec.name}"
    commit = last_commit(spark, path)
    if not _has(commit, CURRENT_SCHEMA.names):
        return None
    current = _with_spec(read_current(spark, path, commit), spec, CURRENT_SCHEMA.names)
    attributes = [f for f in current.schema if f.name not in CURRENT_SCHEMA.names]
    schema = T.StructType([*attributes, *HISTORY_SCHEMA.fields])
    return current, read_history(spark, path, schema, commit, spec.keys, HISTORY_SCHEMA.names[0])


# The whole run


def run_batch(
    spark: SparkSession,
    input_path: str,
    base_path: str,
    process_date: dt.date,
    scd_type: int = 2,
    partition_by: str = "application_date",
    specs: Iterable[DimSpec] = DIMENSIONS,
) -> None:
    """Ingest a CSV, report on it, transform what is new and merge it into the dimensions.

    Batches that wait are processed one by one, oldest first, each with its own date, and the mark of
    the chosen type moves after each. So what a run that died has left is made up for by the next one
    as if it had not died, and nothing is changed twice. A batch with a date before that of one that arrived
    earlier is spliced into the dimensions, so they hold what they would if batches had come in the order of their dates.

    The report is made beside the rest, which has no use for it, and a batch that is not late is merged from the landed rows while they are
    transformed: small jobs and the last tasks of large ones do not keep the cluster waiting. A mark moves once
    both are done. A report that fails raises when the batches are merged, and is made again by the same run.
    """
    if scd_type not in (2, 4):
        raise ValueError(f"scd_type is 2 or 4, not {scd_type!r}")
    landing, transformed = f"{base_path}/ingested", f"{base_path}/transformed"
    marks = f"{base_path}/watermark/type{scd_type}"
    specs = tuple(specs)

    entry = ingest(spark, input_path, landing, process_date, partition_by)
    merge = scd2 if scd_type == 2 else scd4
    with ThreadPoolExecutor(2) as beside:
        report = None
        if entry is not None:
            batch = Batch(entry.batch, entry.input)
            folder = batch.folder(f"{base_path}/reports/quality")
            report = beside.submit(check_batch_quality, spark, landing, batch, folder, entry)
        for waiting in pending_batches(spark, landing, read_mark(spark, marks)):
            batch, valid = waiting.batch, waiting.valid_records
            transforming = beside.submit(transform, spark, landing, transformed, batch, partition_by, valid)
            if valid > 0:
                arrived, seen = utc_from_micros(waiting.micros), None
                if batch.date < latest_date(spark, landing, arrived):
                    transforming.result()
                    rows = read_transformed(spark, transformed, [batch])
                    seen = read_transformed(spark, transformed).filter(F.col("ingestion_timestamp") <= F.lit(arrived))
                else:
                    rows = _enriched(spark, landing, batch)
                merge(spark, rows, f"{base_path}/type{scd_type}", batch.date, specs, seen)
            transforming.result()
            write_mark(spark, marks, utc_from_micros(waiting.micros))
            free_shuffles(spark)
        if report is not None:
            report.result()
