"""The registered queries: each operator over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.operators import quality, serve
from dimflow.operators.changes import ABSENT, ACTION, WAS, classify
from dimflow.operators.enrich import enrich_loans
from dimflow.operators.slices import latest_per_key
from dimflow.operators.type2 import apply_type2
from dimflow.operators.type4 import merge_type4
from dimflow.operators.validate import split_valid, validity_counts
from dimflow.plans import jobs
from dimflow.plans.views import BATCHES, Batch, loans, updates
from dimflow.schemas import DIM_CUSTOMER, DIM_LOAN, LOAN_COLUMNS, DimSpec
from dimflow.sources.logs import read_log
from dimflow.sources.staging import delete_folder, filesystem_of, free_shuffles, new_folder, stage
from dimflow.sources.tables import unsorted
from dimflow.sources.versions import COMMIT_SCHEMA
from dimflow.streaming.follow import merge_arrived
from dimflow.streaming.incremental import MARK_SCHEMA, incremental_slice, next_mark, read_mark

Query = Callable[[SparkSession, str], DataFrame]


def valid_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_loans(split_valid(loans(spark, sf_dir))[0])


# What the rules and the enrichment read.
_RULED = ("customer_id", "loan_id", "loan_amount", "interest_rate", "term_months", "status")


def valid_updates(spark: SparkSession, sf_dir: str, spec: DimSpec | None = None) -> DataFrame:
    """The valid updates, enriched; with a ``spec`` only columns that its dimension, the rules and the enrichment read."""
    # Staged, as landed rows are: the rules would be inlined over the view's expressions, and what is generated
    # from both is more than the JVM compiles. Columns are chosen before, as none is left out once they are written.
    rows = updates(spark, sf_dir)
    if spec is not None:
        needed = {*_RULED, *spec.columns, *spec.order_by}
        rows = rows.select(*[c for c in rows.columns if c in needed])
    return enrich_loans(split_valid(stage(rows))[0])


def _rounded(df: DataFrame) -> DataFrame:
    # The last digit of pow differs between maths libraries.
    return df.withColumn("monthly_payment", F.round("monthly_payment", 8))


# Validation and quality


def validate_valid(spark, sf_dir):
    return split_valid(loans(spark, sf_dir))[0]


def validate_errors(spark, sf_dir):
    return split_valid(loans(spark, sf_dir))[1]


def validate_counts(spark, sf_dir):
    return validity_counts(loans(spark, sf_dir))


def quality_flags(spark, sf_dir):
    flagged = quality.flag_rows(loans(spark, sf_dir))
    return flagged.drop(*[c for c in LOAN_COLUMNS if c != "loan_id"])


def quality_errors(spark, sf_dir):
    return quality.run_quality_checks(loans(spark, sf_dir))[0]


def quality_metrics(spark, sf_dir):
    return quality.run_quality_checks(loans(spark, sf_dir))[1]


# Transformation


def monthly_payment(spark, sf_dir):
    return _rounded(enrich_loans(loans(spark, sf_dir))).select("loan_id", "monthly_payment")


def loan_category(spark, sf_dir):
    return enrich_loans(loans(spark, sf_dir)).select("loan_id", "loan_category")


def transform(spark, sf_dir):
    return _rounded(valid_loans(spark, sf_dir))


# Dimensions


def dim_customer_slice(spark, sf_dir):
    return latest_per_key(valid_updates(spark, sf_dir, DIM_CUSTOMER), DIM_CUSTOMER)


def dim_loan_slice(spark, sf_dir):
    return latest_per_key(valid_updates(spark, sf_dir, DIM_LOAN), DIM_LOAN)


def type2_after(
    spark: SparkSession,
    sf_dir: str,
    spec: DimSpec,
    batches: Sequence[Batch] = BATCHES,
) -> DataFrame:
    """The Type 2 dimension after some batches, staged between them as a table would be."""
    rows = valid_updates(spark, sf_dir, spec)
    dim = None
    for batch in batches:
        before = None if dim is None else stage(dim)
        changes = stage(latest_per_key(batch.of(rows), spec))
        dim = apply_type2(changes, before, spec, batch.process_date)
    return dim


def type4_after(
    spark: SparkSession, sf_dir: str, spec: DimSpec, batches: Sequence[Batch] = BATCHES
) -> tuple[DataFrame, DataFrame]:
    """(current, history) of the Type 4 dimension after some batches."""
    rows = valid_updates(spark, sf_dir, spec)
    current, archived = None, []
    for batch in batches:
        changes = stage(latest_per_key(batch.of(rows), spec))
        before = None if current is None else stage(current)
        merge = merge_type4(changes, before, spec, batch.process_date)
        archived.append(merge.archived)
        current = merge.current
    return current, reduce(DataFrame.unionByName, archived)


def scd2_bootstrap(spark, sf_dir):
    whole = Batch(None, None, BATCHES[-1].process_date)
    return type2_after(spark, sf_dir, DIM_CUSTOMER, [whole])


def scd2_changes(spark, sf_dir):
    first, second, _ = BATCHES
    current = serve.current_rows(type2_after(spark, sf_dir, DIM_CUSTOMER, [first]))
    rest = Batch(second.start, None, BATCHES[-1].process_date).of(valid_updates(spark, sf_dir, DIM_CUSTOMER))
    changes = stage(latest_per_key(rest, DIM_CUSTOMER))
    compared = classify(changes, current, DIM_CUSTOMER)
    return compared.filter(F.col(ACTION) != ABSENT).select(
        *DIM_CUSTOMER.columns,
        F.col(ACTION).alias("action"),
        F.col(WAS + "surrogate_key").alias("was_surrogate_key"),
        F.col(WAS + "employment_status").alias("was_employment_status"),
    )


def scd2_customer(spark, sf_dir):
    return type2_after(spark, sf_dir, DIM_CUSTOMER)


def scd2_loan(spark, sf_dir):
    return type2_after(spark, sf_dir, DIM_LOAN)


def scd2_current(spark, sf_dir):
    return serve.current_rows(type2_after(spark, sf_dir, DIM_CUSTOMER))


def scd4_current(spark, sf_dir):
    return type4_after(spark, sf_dir, DIM_CUSTOMER)[0]


def scd4_loan_current(spark, sf_dir):
    return type4_after(spark, sf_dir, DIM_LOAN)[0]


def scd4_loan_history(spark, sf_dir):
    return type4_after(spark, sf_dir, DIM_LOAN)[1].drop("archived_at")


def scd4_history(spark, sf_dir):
    return type4_after(spark, sf_dir, DIM_CUSTOMER)[1].drop("archived_at")


# Point in time

_FACTS = ("loan_id", "customer_id", "application_date", "loan_amount")
_ATTRIBUTES = ("dim_employment_status", "dim_annual_income", "dim_valid_from", "dim_valid_to")


def as_of_join(spark, sf_dir, **options):
    dim = stage(type2_after(spark, sf_dir, DIM_CUSTOMER))
    versions = serve.type2_versions(dim, DIM_CUSTOMER)
    facts = valid_loans(spark, sf_dir).select(*_FACTS)
    joined = serve.as_of_join(facts, versions, DIM_CUSTOMER.keys, "application_date", **options)
    return joined.select(*_FACTS, "dim_surrogate_key", *_ATTRIBUTES)


def as_of_join_large(spark, sf_dir):
    """The same join shuffled, as for versions too many to broadcast."""
    return as_of_join(spark, sf_dir, join_hint="merge")


def as_of_join_timeline(spark, sf_dir):
    """The same join by way of each key's timeline."""
    return as_of_join(spark, sf_dir, timeline=True)


def as_of_join_binned(spark, sf_dir):
    """The same join by bins of dates, for every key with more than one version."""
    return as_of_join(spark, sf_dir, binned=True, crowded=1)


def as_of_join_scd4(spark, sf_dir):
    current, history = map(stage, type4_after(spark, sf_dir, DIM_CUSTOMER))
    versions = serve.type4_versions(current, history, DIM_CUSTOMER)
    facts = valid_loans(spark, sf_dir).select(*_FACTS)
    joined = serve.as_of_join(facts, versions, DIM_CUSTOMER.keys, "application_date")
    return joined.select(*_FACTS, *_ATTRIBUTES)


# Incremental

_AFTER, _UP_TO = "1999-01-01 00:00:00", "1999-07-01 00:00:00"


def incremental(spark, sf_dir):
    after, up_to = (F.lit(text).cast("timestamp_ntz") for text in (_AFTER, _UP_TO))
    return incremental_slice(loans(spark, sf_dir), after, up_to, column="last_updated")


def next_watermark(spark, sf_dir):
    return next_mark(incremental(spark, sf_dir), column="last_updated")


# Whole jobs, from CSV files written from the loans or their updates. The generated data has a few
# loans a day over six years, so the tables are partitioned by status, not by day.

_PARTITION_BY = "status"


def _as_csv(df: DataFrame, name: str) -> str:
    path = new_folder(df.sparkSession, name)
    df.select(*LOAN_COLUMNS).write.option("header", True).csv(path)
    return path


def _naive(df: DataFrame) -> DataFrame:
    return df.withColumn("last_updated", F.col("last_updated").cast("timestamp_ntz"))


def _ingested(spark, sf_dir) -> tuple[str, jobs.Batch]:
    landing, csv = new_folder(spark, "landing"), _as_csv(loans(spark, sf_dir), "csv")
    entry = jobs.ingest(spark, csv, landing, BATCHES[-1].process_date, _PARTITION_BY)
    return landing, jobs.Batch(entry.batch, entry.input)


def ingest_valid(spark, sf_dir):
    return _naive(jobs.read_ingested(spark, _ingested(spark, sf_dir)[0]).select(*LOAN_COLUMNS))


def ingest_quarantine(spark, sf_dir):
    rows = jobs.read_quarantine(spark, _ingested(spark, sf_dir)[0])
    return _naive(rows.select(*LOAN_COLUMNS, "error_date"))


def quarantine_reasons(spark, sf_dir):
    """What each quarantined row breaks, and whether it names the file that it came from."""
    landing, csv = new_folder(spark, "landing"), _as_csv(loans(spark, sf_dir), "csv")
    jobs.ingest(spark, csv, landing, BATCHES[-1].process_date, _PARTITION_BY)
    rows = jobs.read_quarantine(spark, landing)
    known = F.col("source_file").contains(csv) & (F.col("source_start") >= 0) & F.col("malformed").isNull()
    return _naive(rows).select(
        "customer_id", "loan_id", "application_date", "last_updated",
        F.array_join("broken_rules", ",").alias("broken_rules"), known.alias("known_source"),
    )


def ingest_empty_sides(spark, sf_dir):
    """A file of valid rows only, one of broken rows only and an empty one: the rows that each leaves in each
    table, those of them without a time, and their times, which are one for each run."""
    # One folder for both, as the audit rows lie beside the transformed ones: it is deleted as a whole.
    base, date = new_folder(spark, "base"), BATCHES[-1].process_date
    landing, transformed = f"{base}/ingested", f"{base}/transformed"
    valid, broken = split_valid(loans(spark, sf_dir))
    side_of = []
    for side, rows in {"clean": valid, "broken": broken, "empty": valid.filter("false")}.items():
        csv = _as_csv(rows, "csv")
        batch = jobs.batch_of(csv, date)
        jobs.ingest(spark, csv, landing, date, _PARTITION_BY)
        jobs.transform(spark, landing, transformed, batch, _PARTITION_BY)
        side_of += [F.lit(batch.input), F.lit(side)]
    tables = {
        "ingested": (jobs.read_ingested(spark, landing), "ingestion_timestamp"),
        "quarantined": (jobs.read_quarantine(spark, landing), "error_timestamp"),
        "transformed": (jobs.read_transformed(spark, transformed), "transformation_timestamp"),
        "log": (read_log(spark, f"{landing}/log", jobs.INGEST_LOG_SCHEMA), "ingestion_timestamp"),
    }
    counted = [
        rows.groupBy(F.create_map(*side_of)[F.col("input")].alias("side"), F.lit(place).alias("place")).agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col(time).isNull()).alias("untimed"),
            F.count_distinct(time).alias("times"),
        )
        for place, (rows, time) in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def quality_report(spark, sf_dir):
    landing, batch = _ingested(spark, sf_dir)
    reports = f"{new_folder(spark, 'reports')}/quality"  # error rows lie beside it
    jobs.check_batch_quality(spark, landing, batch, batch.folder(reports))
    counts = "struct<error_count bigint, error_percentage double>"
    schema = f"total_records bigint, error_records bigint, metrics map<string, {counts}>"
    written = spark.read.schema(schema).json(reports)  # the dataset of all reports
    return written.select(
        "total_records", "error_records", F.explode("metrics").alias("check", "m")
    ).select("total_records", "error_records", "check", "m.error_count", "m.error_percentage")


def _csvs_of(spark: SparkSession, sf_dir: str, batches: Sequence[Batch]) -> list[str]:
    """The updates of each batch as an input of its own, also of one that is named twice or has no rows. All are written in one
    pass, as the tables are joined once for them."""
    path = new_folder(spark, "csv")
    rows = updates(spark, sf_dir)
    places = F.array(*[F.when(batch.holds(), F.lit(i)) for i, batch in enumerate(batches)])
    # Dates and times are made text by the query: the CSV writer's formatters take much longer.
    texts = {c: F.col(c).cast("string") for c, type_ in rows.dtypes if type_ in ("date", "timestamp_ntz")}
    placed = rows.select(*LOAN_COLUMNS, F.explode(places).alias("place")).filter("place is not null").withColumns(texts)
    # Compressed files are read by one task each, so they are kept small.
    options = {"header": True, "compression": "snappy", "maxRecordsPerFile": 200_000}
    with unsorted(spark):
        placed.write.partitionBy("place").options(**options).csv(path)
    free_shuffles(spark)
    csvs = [f"{path}/place={i}" for i in range(len(batches))]
    for csv in csvs:
        filesystem, folder = filesystem_of(spark, csv)
        filesystem.mkdirs(folder)
    return csvs


def run_batches(
    spark: SparkSession, sf_dir: str, scd_type: int, batches: Sequence[Batch] = BATCHES
) -> str:
    """Run batches from their CSVs, each of which is deleted once its run is over; returns the base path."""
    base = new_folder(spark, "base")
    for batch, path in zip(batches, _csvs_of(spark, sf_dir, batches)):
        jobs.run_batch(spark, path, base, batch.process_date, scd_type, _PARTITION_BY)
        delete_folder(spark, path)
    return base


def _versions4(spark: SparkSession, base: str, spec: DimSpec) -> DataFrame:
    return serve.type4_versions(*jobs.read_type4(spark, f"{base}/type4", spec), spec)


def run_type2(spark, sf_dir):
    return jobs.read_type2(spark, f"{run_batches(spark, sf_dir, 2)}/type2", DIM_CUSTOMER)


def run_type2_loan(spark, sf_dir):
    return jobs.read_type2(spark, f"{run_batches(spark, sf_dir, 2)}/type2", DIM_LOAN)


def run_type4(spark, sf_dir):
    return _versions4(spark, run_batches(spark, sf_dir, 4), DIM_CUSTOMER)


def run_type4_loan(spark, sf_dir):
    return _versions4(spark, run_batches(spark, sf_dir, 4), DIM_LOAN)


def run_type2_after_failure(spark, sf_dir):
    """The first two runs die after they have ingested; the third makes up for them."""
    base = new_folder(spark, "base")
    *dead, last = zip(BATCHES, _csvs_of(spark, sf_dir, BATCHES))
    for batch, csv in dead:
        jobs.ingest(spark, csv, f"{base}/ingested", batch.process_date, _PARTITION_BY)
    jobs.run_batch(spark, last[1], base, last[0].process_date, 2, _PARTITION_BY)
    return jobs.read_type2(spark, f"{base}/type2", DIM_LOAN)


def run_type4_after_type2(spark, sf_dir):
    """Type 2 runs, and then a run of Type 4: it has the versions that it would always have had."""
    base = new_folder(spark, "base")
    for batch, csv, scd_type in zip(BATCHES, _csvs_of(spark, sf_dir, BATCHES), (2, 2, 4)):
        jobs.run_batch(spark, csv, base, batch.process_date, scd_type, _PARTITION_BY)
    return _versions4(spark, base, DIM_CUSTOMER)


def _two_files(spark, sf_dir) -> str:
    """Two inputs of one date, and the first of them again."""
    base, date = new_folder(spark, "base"), BATCHES[-1].process_date
    halves = [Batch(None, BATCHES[0].end, date), Batch(BATCHES[0].end, None, date)]
    csvs = _csvs_of(spark, sf_dir, halves)
    for csv in [*csvs, csvs[0]]:
        jobs.run_batch(spark, csv, base, date, 2, _PARTITION_BY)
    return base


def run_two_files_one_day(spark, sf_dir):
    rows = jobs.read_transformed(spark, f"{_two_files(spark, sf_dir)}/transformed", [BATCHES[-1].process_date])
    return _naive(_rounded(rows).select(*LOAN_COLUMNS, "monthly_payment", "loan_category"))


def run_transformed(spark, sf_dir):
    """The transformed table as the runs have written it."""
    rows = jobs.read_transformed(spark, f"{run_batches(spark, sf_dir, 2)}/transformed")
    return _naive(_rounded(rows).select(*LOAN_COLUMNS, "monthly_payment", "loan_category", "batch"))


def run_audit(spark, sf_dir):
    """What the runs have noted: the audit rows, and how far the mark has come."""
    base = run_batches(spark, sf_dir, 2)
    audit = read_log(spark, f"{base}/transformed_audit", jobs.AUDIT_SCHEMA)
    mark = f"{base}/watermark/type2"
    waiting = jobs.pending_batches(spark, f"{base}/ingested", read_mark(spark, mark))
    marks = read_log(spark, mark, MARK_SCHEMA).agg(F.count_distinct("lastProcessedDate").alias("marks"))
    return audit.select("record_count", F.lit(len(waiting)).cast("bigint").alias("waiting")).crossJoin(
        F.broadcast(marks)  # one row
    )


def run_repeated(spark, sf_dir):
    """The last batch twice: the dimension's versions, and how many commits there are."""
    base = run_batches(spark, sf_dir, 2, [*BATCHES, BATCHES[-1]])
    commits = read_log(spark, f"{base}/type2/{DIM_CUSTOMER.name}/commits", COMMIT_SCHEMA).count()
    dim = jobs.read_type2(spark, f"{base}/type2", DIM_CUSTOMER)
    return dim.withColumn("commits", F.lit(commits).cast("bigint"))


def run_first_load(spark, sf_dir):
    """After one run of Type 4: the current rows, and an empty history."""
    base = run_batches(spark, sf_dir, 4, BATCHES[:1])
    current, history = jobs.read_type4(spark, f"{base}/type4", DIM_CUSTOMER)
    return current.withColumn("archived", F.lit(history.count()).cast("bigint"))


# The second batch arrives last, and the first after the third.
_OUT_OF_ORDER = (BATCHES[2], BATCHES[0], BATCHES[1])


def scd2_late_batch(spark, sf_dir):
    """Batches in another order than that of their dates: the versions are the same. Surrogate keys follow arrival."""
    dim = jobs.read_type2(spark, f"{run_batches(spark, sf_dir, 2, _OUT_OF_ORDER)}/type2", DIM_CUSTOMER)
    return dim.drop("surrogate_key")


def scd2_loan_late_batch(spark, sf_dir):
    order = (BATCHES[1], BATCHES[2], BATCHES[0])
    return jobs.read_type2(spark, f"{run_batches(spark, sf_dir, 2, order)}/type2", DIM_LOAN).drop("surrogate_key")


def scd4_late_batch(spark, sf_dir):
    return _versions4(spark, run_batches(spark, sf_dir, 4, _OUT_OF_ORDER), DIM_CUSTOMER)


def dim_changes_between(spark, sf_dir):
    """What the second and the third batch have changed."""
    return jobs.type2_changes(spark, f"{run_batches(spark, sf_dir, 2)}/type2", DIM_CUSTOMER, after=1)


def stream_type2(spark, sf_dir):
    """The batches as a file stream whose last micro-batch is replayed, as after a failure."""
    base = new_folder(spark, "base")
    landing, dims, checkpoint = f"{base}/ingested", f"{base}/type2", f"{base}/checkpoint"
    for batch, csv in zip(BATCHES, _csvs_of(spark, sf_dir, BATCHES)):
        jobs.ingest(spark, csv, landing, batch.process_date, _PARTITION_BY)
        merge_arrived(spark, landing, dims, checkpoint)
    delete_folder(spark, f"{checkpoint}/commits/{len(BATCHES) - 1}")
    merge_arrived(spark, landing, dims, checkpoint)
    commits = read_log(spark, f"{dims}/{DIM_CUSTOMER.name}/commits", COMMIT_SCHEMA).count()
    return jobs.read_type2(spark, dims, DIM_CUSTOMER).withColumn("commits", F.lit(commits).cast("bigint"))


def scd2_widened_type(spark, sf_dir):
    """A tracked column is an integer at first, then a long one, then a double."""
    dims, rows = new_folder(spark, "dims"), valid_updates(spark, sf_dir, DIM_LOAN)
    for batch, type_ in zip(BATCHES, ("int", "bigint", "double")):
        typed = batch.of(rows).withColumn("term_months", F.col("term_months").cast(type_))
        jobs.scd2(spark, typed, dims, batch.process_date, [DIM_LOAN])
    return jobs.read_type2(spark, dims, DIM_LOAN)


# A dimension that gets another tracked column after its first batch.
_NARROW = replace(DIM_CUSTOMER, tracked=DIM_CUSTOMER.tracked[:-1])


def _widened(spark: SparkSession, sf_dir: str, scd_type: int) -> str:
    base = new_folder(spark, "base")
    for batch, csv in zip(BATCHES, _csvs_of(spark, sf_dir, BATCHES)):
        specs = [_NARROW if batch is BATCHES[0] else DIM_CUSTOMER]
        jobs.run_batch(spark, csv, base, batch.process_date, scd_type, _PARTITION_BY, specs)
    return base


def scd2_new_column(spark, sf_dir):
    return jobs.read_type2(spark, f"{_widened(spark, sf_dir, 2)}/type2", DIM_CUSTOMER)


def scd4_new_column(spark, sf_dir):
    return _versions4(spark, _widened(spark, sf_dir, 4), DIM_CUSTOMER)


QUERIES: dict[str, Query] = {
    "validate_valid": validate_valid,
    "validate_errors": validate_errors,
    "validate_counts": validate_counts,
    "quality_flags": quality_flags,
    "quality_errors": quality_errors,
    "quality_metrics": quality_metrics,
    "monthly_payment": monthly_payment,
    "loan_category": loan_category,
    "transform": transform,
    "dim_customer_slice": dim_customer_slice,
    "dim_loan_slice": dim_loan_slice,
    "scd2_bootstrap": scd2_bootstrap,
    "scd2_changes": scd2_changes,
    "scd2_customer": scd2_customer,
    "scd2_loan": scd2_loan,
    "scd2_current": scd2_current,
    "scd4_current": scd4_current,
    "scd4_loan_current": scd4_loan_current,
    "scd4_history": scd4_history,
    "scd4_loan_history": scd4_loan_history,
    "scd2_new_column": scd2_new_column,
    "scd4_new_column": scd4_new_column,
    "as_of_join": as_of_join,
    "as_of_join_large": as_of_join_large,
    "as_of_join_timeline": as_of_join_timeline,
    "as_of_join_binned": as_of_join_binned,
    "as_of_join_scd4": as_of_join_scd4,
    "incremental_slice": incremental,
    "next_watermark": next_watermark,
    "ingest_valid": ingest_valid,
    "ingest_quarantine": ingest_quarantine,
    "quarantine_reasons": quarantine_reasons,
    "ingest_empty_sides": ingest_empty_sides,
    "quality_report": quality_report,
    "run_type2": run_type2,
    "run_type2_loan": run_type2_loan,
    "run_type4": run_type4,
    "run_type4_loan": run_type4_loan,
    "run_type2_after_failure": run_type2_after_failure,
    "run_type4_after_type2": run_type4_after_type2,
    "run_two_files_one_day": run_two_files_one_day,
    "run_transformed": run_transformed,
    "run_audit": run_audit,
    "run_repeated": run_repeated,
    "run_first_load": run_first_load,
    "scd2_late_batch": scd2_late_batch,
    "scd2_loan_late_batch": scd2_loan_late_batch,
    "scd4_late_batch": scd4_late_batch,
    "dim_changes_between": dim_changes_between,
    "stream_type2": stream_type2,
    "scd2_widened_type": scd2_widened_type,
}
