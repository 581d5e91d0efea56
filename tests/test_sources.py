import datetime as dt
import os
import time

import pyarrow.parquet as pq
import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from dimflow.schemas import FIRST_MARK, LOAN_COLUMNS, LOAN_SCHEMA
from dimflow.sources import staging, versions
from dimflow.sources.loans_csv import read_loans_csv
from dimflow.sources.logs import append_row, read_log
from dimflow.sources.tables import (
    OPEN_FILES,
    input_stamp,
    load_optional,
    replace_folder,
    unsorted,
    write_partitioned,
)
from dimflow.streaming.incremental import (
    MARK_SCHEMA,
    incremental_slice,
    next_mark,
    read_mark,
    write_mark,
)

HEADER = ",".join(LOAN_COLUMNS)
GOOD = "C1,L1,2021-11-03,7250.00,4.25,30,Approved,Mira Voss,1979-08-21,Employed,61300.00,2021-11-04 08:05:00"


def write_csv(path, *lines, header=HEADER):
    with open(path, "w") as file:
        file.write("\n".join([header, *lines]) + "\n")
    return path


# CSV


def test_csv_types_and_malformed_values(spark, folder):
    path = write_csv(
        folder("loans.csv"),
        GOOD,
        "C2,L2,2021-99-01,abc,3.5,x,Approved,Ivo Lund,1990-02-28,Employed,1,2021-11-04 08:05:00",
        "C3,L3",
        GOOD.replace("C1", "C4") + ",extra,fields",
        GOOD.replace("C1", ""),
    )
    df = read_loans_csv(spark, path)
    assert df.schema == LOAN_SCHEMA
    rows = {r.customer_id: r for r in df.collect()}
    assert rows["C1"].last_updated == dt.datetime(2021, 11, 4, 8, 5)
    assert (rows["C1"].application_date, rows["C1"].loan_amount) == (dt.date(2021, 11, 3), 7250.0)
    bad = rows["C2"]
    assert (bad.application_date, bad.loan_amount, bad.term_months, bad.status) == (None, None, None, "Approved")
    assert rows["C3"].loan_id == "L3" and rows["C3"].status is None
    assert rows["C4"].annual_income == 61300.0
    assert rows[None].loan_id == "L1"


def test_csv_binds_by_position(spark, folder):
    path = write_csv(folder("loans.csv"), GOOD, header=",".join(reversed(LOAN_COLUMNS)))
    assert read_loans_csv(spark, path).first().customer_id == "C1"


def test_csv_keeps_corrupt_rows_on_request(spark, folder):
    broken = GOOD.replace("7250.00", "abc")
    path = write_csv(folder("loans.csv"), GOOD, broken)
    df = read_loans_csv(spark, path, corrupt_column="corrupt")
    assert {r.corrupt for r in df.collect()} == {None, broken}


# Tables


def test_optional_load(spark, folder):
    path = folder("table")
    assert load_optional(spark, path) is None
    spark.range(3).write.parquet(path)
    assert load_optional(spark, path).count() == 3


def test_only_a_missing_path_counts_as_absent(spark, folder):
    os.makedirs(folder("broken"))
    with open(folder("broken", "part-0.parquet"), "w") as file:
        file.write("not parquet")
    with pytest.raises(Exception, match="not a Parquet file"):
        load_optional(spark, folder("broken")).count()


def test_partitioned_append(spark, folder):
    path = folder("table")
    df = spark.range(40).select("id", (F.col("id") % 4).cast("int").alias("part"))
    write_partitioned(df, path, ["part"])
    write_partitioned(df.filter("part = 1"), path, ["part"])
    back = spark.read.parquet(path)
    assert back.columns == ["id", "part"] and back.count() == 50
    assert "PartitionFilters: [isnotnull(part" in plan_of(back.filter("part = 1"))
    files = [f for f in os.listdir(os.path.join(path, "part=0")) if f.endswith(".parquet")]
    assert len(files) == 1


def test_replace_folder(spark, folder):
    replace_folder(spark.range(5), folder("t"))
    replace_folder(spark.range(2), folder("t"))
    assert spark.read.parquet(folder("t")).count() == 2


# Staging


def test_staged_tables_live_in_the_shared_folder_and_a_scope_deletes_them(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    with staging.staging_scope(spark):
        staged = staging.stage(spark.range(10))
        (file,) = {os.path.dirname(f.removeprefix("file://")) for f in staged.inputFiles()}
        assert file.startswith(f"{shared}/dimflow/")
        assert staged.count() == 10
    assert not os.path.exists(file)


class Session:
    """As much of a session as the shared folder is asked of."""

    def __init__(self, master):
        self.master, self.folder, self.sparkContext, self.conf = master, None, self, self

    def get(self, name, default):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


@pytest.mark.parametrize("master", ["spark://somewhere", "local-cluster[2,1,1024]", "local[2]"])
def test_a_session_without_a_shared_folder_raises(master):
    session = Session(master)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_folder(session)
    # An entry point may name one for a session that is one machine.
    staging.use_folder_if_unset(session, "/some/folder")
    assert session.folder == ("/some/folder" if master == "local[2]" else None)


def test_a_named_folder_is_kept():
    session = Session("local[2]")
    session.folder = "/named"
    staging.use_folder_if_unset(session, "/other")
    assert staging.shared_folder(session) == "/named"


def test_what_was_staged_on_the_way_is_deleted(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    staging.release()
    made = staging.stage_alone(spark, lambda: staging.stage(spark.range(5)).filter("id > 1"))
    assert rows_of(made) == [(2,), (3,), (4,)] and len(os.listdir(f"{shared}/dimflow")) == 1
    staging.release()
    assert os.listdir(f"{shared}/dimflow") == []


def _with_dictionary(path):
    """The columns of the files in a folder that are written by a dictionary."""
    found = set()
    for at, _, names in os.walk(path):
        for name in (n for n in names if n.endswith(".parquet")):
            group = pq.ParquetFile(f"{at}/{name}").metadata.row_group(0)
            columns = [group.column(i) for i in range(group.num_columns)]
            found |= {c.path_in_schema for c in columns if c.has_dictionary_page}
    return found


def test_columns_of_many_values_are_written_without_a_dictionary(spark, folder):
    # Equal values, so that the dictionaries of the other columns are kept.
    rows = spark.range(200).selectExpr(
        "'L1' AS loan_id", "'C1' AS customer_id", "1e0 AS monthly_payment", "'Repaid' AS status", "id % 2 AS half"
    )
    replace_folder(rows, folder("flat"))
    write_partitioned(rows, folder("parts"), ["half"], mode="overwrite")
    staged = staging.stage(rows)
    alone = staging.stage_alone(spark, lambda: rows)
    assert _with_dictionary(folder("flat")) == {"status", "half"}
    assert _with_dictionary(folder("parts")) == {"status"}
    for df in (staged, alone):
        (at,) = {os.path.dirname(f.removeprefix("file://")) for f in df.inputFiles()}
        assert _with_dictionary(at) == {"status", "half"}
        assert rows_of(df, "loan_id", "status", "half") == rows_of(rows, "loan_id", "status", "half")


def test_tables_are_written_compactly(spark, folder):
    rows = spark.range(1000).selectExpr("id", "id % 4 AS part")
    write_partitioned(rows, folder("parts"), ["part"], mode="overwrite")
    codecs = set()
    for at, _, names in os.walk(folder("parts")):
        for name in (n for n in names if n.endswith(".parquet")):
            codecs.add(pq.ParquetFile(f"{at}/{name}").metadata.row_group(0).column(0).compression)
    assert codecs == {"ZSTD"}
    assert rows_of(spark.read.parquet(folder("parts")), "id", "part") == rows_of(rows, "id", "part")


SETTING = "spark.sql.maxConcurrentOutputFileWriters"


def test_partitioned_writes_need_no_sort(spark, folder):
    """Writes inside keep files open; the setting is taken back by the last one out, and one that the session has stays. What
    has more values than files open is written whole."""
    with unsorted(spark):
        with unsorted(spark):
            assert spark.conf.get(SETTING) == str(OPEN_FILES)
        assert spark.conf.get(SETTING) == str(OPEN_FILES)
    assert spark.conf.get(SETTING) == "0"
    rows = spark.range(3000).selectExpr("id", f"id % {3 * OPEN_FILES} AS part")
    write_partitioned(rows, folder("many"), ["part"], mode="overwrite", gather=False)
    assert rows_of(spark.read.parquet(folder("many")), "id", "part") == rows_of(rows, "id", "part")
    spark.conf.set(SETTING, "5")
    try:
        with unsorted(spark):
            assert spark.conf.get(SETTING) == "5"
        assert spark.conf.get(SETTING) == "5"
    finally:
        spark.conf.unset(SETTING)


def test_shuffle_files_of_finished_queries_are_deleted(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def blocks():
        return {b for b in disk.getAllBlocks().mkString("\n").split("\n") if b.startswith("shuffle_")}

    before = blocks()
    spark.range(10_000).groupBy(F.col("id") % 7).count().write.format("noop").mode("overwrite").save()
    made = blocks() - before
    assert made
    for _ in range(50):
        staging.free_shuffles(spark)
        if not made & blocks():
            break
        time.sleep(0.2)
    assert not made & blocks()


def test_what_is_made_of_other_columns_is_not_shuffled(spark, folder):
    rows = spark.range(100).selectExpr("id", "id % 2 AS part")
    write_partitioned(rows, folder("made"), ["part"], mode="overwrite", finish=lambda df: df.withColumn("twice", F.col("id") * 2))
    assert rows_of(spark.read.parquet(folder("made")), "id", "twice") == [(i, 2 * i) for i in sorted(range(100), key=lambda i: repr((i, 2 * i)))]


def test_release_deletes_what_no_scope_owns(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    staging.release()
    staged = staging.stage(spark.range(3))
    assert staged.count() == 3 and len(os.listdir(f"{shared}/dimflow")) == 1
    staging.release()
    assert os.listdir(f"{shared}/dimflow") == []


# Logs and marks


def test_log_round_trip_keeps_microseconds(spark, folder):
    path = folder("marks")
    assert read_log(spark, path, MARK_SCHEMA).isEmpty()
    mark = dt.datetime(2024, 3, 1, 12, 0, 0, 123457, dt.timezone.utc)
    append_row(spark, path, MARK_SCHEMA, (mark,))
    assert read_mark(spark, path) == mark


def test_mark_starts_in_1900_and_never_goes_back(spark, folder):
    path = folder("marks")
    assert read_mark(spark, path) == FIRST_MARK
    late, early = (dt.datetime(2024, m, 1, tzinfo=dt.timezone.utc) for m in (5, 4))
    write_mark(spark, path, late)
    write_mark(spark, path, early)
    assert read_mark(spark, path) == late


def test_slices_tile_the_rows(spark, folder):
    base = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    marks = [base + dt.timedelta(hours=h) for h in range(10)]
    df = spark.createDataFrame([(m,) for m in marks], "ingestion_timestamp timestamp")
    first = incremental_slice(df, FIRST_MARK, marks[4])
    second = incremental_slice(df, marks[4])
    assert (first.count(), second.count()) == (5, 5)
    reached = next_mark(first).select(F.unix_micros("lastProcessedDate")).first()[0]
    assert reached == int(marks[4].timestamp() * 1e6)
    assert next_mark(df.limit(0)).first().lastProcessedDate is None
    df.write.parquet(folder("t"))
    plan = plan_of(incremental_slice(spark.read.parquet(folder("t")), marks[4], marks[6]))
    pushed = plan[plan.index("PushedFilters"):].splitlines()[0]
    assert "GreaterThan(ingestion_timestamp" in pushed
    assert "LessThanOrEqual(ingestion_timestamp" in pushed


def test_a_row_is_added_without_a_job_and_whole(spark, folder):
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    append_row(spark, folder("log"), MARK_SCHEMA, (dt.datetime.now(dt.timezone.utc),))
    assert len(tracker.getJobIdsForGroup(None)) == before
    assert [f for f in os.listdir(folder("log")) if not f.startswith(".")][0].startswith("part-")


def test_input_stamp_follows_the_files(spark, folder):
    path = write_csv(folder("in.csv"), GOOD)
    stamp = input_stamp(spark, path)
    assert input_stamp(spark, path) == stamp
    write_csv(path, GOOD, GOOD)
    assert input_stamp(spark, path) != stamp


# Versioned tables

DAY = dt.date(2024, 1, 1)
SCHEMA = "k string, v int"


def commit(spark, path, current, ended, schema=SCHEMA, **options):
    frames = [spark.createDataFrame(rows, schema) for rows in (current, ended)]
    last = versions.last_commit(spark, path)
    bucket = versions.bucket_of(["k"], last).alias("b")
    changed = {r.b for frame in frames for r in frame.select(bucket).collect()}
    return versions.commit_version(spark, path, last, frames[0], ["k"], changed, frames[1], DAY, **options)


def state(spark, path):
    last = versions.last_commit(spark, path)
    current = versions.read_current(spark, path, last)
    return rows_of(current), rows_of(versions.read_history(spark, path, current.schema, last))


def test_versions_accumulate_history_and_replace_current(spark, folder):
    path = folder("dim")
    assert versions.last_commit(spark, path) is None
    assert versions.read_current(spark, path, None) is None
    commit(spark, path, [("a", 1)], [])
    old = versions.read_current(spark, path, versions.last_commit(spark, path))
    commit(spark, path, [("a", 2)], [("a", 1)])
    commit(spark, path, [("a", 3)], [("a", 2)])
    assert state(spark, path) == ([("a", 3)], [("a", 1), ("a", 2)])
    assert rows_of(old) == [("a", 1)]  # a reader keeps the version it has


def test_only_changed_buckets_are_written(spark, folder):
    path = folder("dim")
    commit(spark, path, [(f"k{i}", i) for i in range(200)], [])
    commit(spark, path, [("new", -1)], [])
    first, second = (
        {f for f in os.listdir(f"{path}/current/table_version={v}") if f.startswith("bucket=")} for v in (1, 2)
    )
    assert len(first) == versions.BUCKETS and len(second) == 1
    last = versions.last_commit(spark, path)
    assert sorted(set(last.buckets)) == [1, 2] and last.buckets.count(2) == 1
    (touched,) = [b for b, v in enumerate(last.buckets) if v == 2]
    assert rows_of(versions.read_current(spark, path, last, [touched])) == [("new", -1)]
    assert versions.read_current(spark, path, last, []).isEmpty()


def test_vacuum_deletes_only_what_no_kept_version_needs(spark, folder):
    path = folder("dim")
    commit(spark, path, [(f"k{i}", i) for i in range(200)], [])
    commit(spark, path, [("a", 2)], [])
    commit(spark, path, [("a", 3)], [("a", 2)])
    now = dt.datetime.now(dt.timezone.utc)
    assert versions.vacuum(spark, path, dt.datetime(2000, 1, 1, tzinfo=dt.timezone.utc)) == []
    before = state(spark, path)
    assert versions.vacuum(spark, path, now) == [2]
    assert state(spark, path) == before


def test_a_run_that_dies_before_its_commit_leaves_the_table_as_it_was(spark, folder, monkeypatch):
    path = folder("dim")
    commit(spark, path, [("a", 1)], [])
    commit(spark, path, [("a", 2)], [("a", 1)])
    before = state(spark, path)
    for step in ("write_partitioned", "replace_folder", "append_row"):

        def die(*args, real=getattr(versions, step), step=step, **kwargs):
            if step != "append_row":
                real(*args, **kwargs)
            raise OSError("lost")

        with monkeypatch.context() as patch:
            patch.setattr(versions, step, die)
            with pytest.raises(OSError):
                commit(spark, path, [("a", 99)], [("a", 98), ("b", 98)])
        assert state(spark, path) == before
    commit(spark, path, [("a", 3)], [("a", 2)])
    assert state(spark, path) == ([("a", 3)], [("a", 1), ("a", 2)])


def test_a_new_column_is_null_in_older_files(spark, folder):
    path, wide = folder("dim"), SCHEMA + ", w double"
    commit(spark, path, [(f"k{i}", i) for i in range(60)], [("gone", 0)])
    commit(spark, path, [("a", 1, 2.0)], [("a", 0, 1.0)], wide)
    current, history = state(spark, path)
    assert ("a", 1, 2.0) in current and ("k1", 1, None) in current + [("k1", 1, None)]
    assert history == [("a", 0, 1.0), ("gone", 0, None)]


def test_a_rebuilt_table_keeps_its_history(spark, folder):
    path = folder("dim")
    commit(spark, path, [("a", 1), ("b", 1)], [], last_key=2)
    commit(spark, path, [("a", 2)], [("a", 1)], last_key=3)
    assert versions.last_commit(spark, path).last_key == 3
    commit(spark, path, [("z", 1)], [], rebuilt=True, last_key=4)
    assert state(spark, path) == ([("z", 1)], [("a", 1)])


def test_a_committed_snapshot_that_is_gone_raises(spark, folder):
    path = folder("dim")
    commit(spark, path, [("a", 1)], [])
    staging.delete_folder(spark, f"{path}/current/table_version=1")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        versions.read_current(spark, path, versions.last_commit(spark, path)).collect()
