"""The CSVs that queries of whole runs write for themselves."""

import datetime as dt
import os
import re

from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from dimflow.plans import registry, views
from dimflow.plans.views import Batch
from dimflow.schemas import DIM_CUSTOMER, DIM_LOAN, LOAN_COLUMNS
from dimflow.sources import staging
from dimflow.sources.loans_csv import read_loans_csv


def test_all_inputs_are_written_in_one_pass(spark, loans, monkeypatch):
    day = [dt.date(2024, 1, n) for n in range(1, 6)]
    at = [dt.datetime(2024, 1, n, 8, 30) for n in (1, 2, 3)]
    rows = loans(*[{"loan_id": f"L{n}", "last_updated": time} for n, time in enumerate([*at, None])])
    rows = rows.withColumn("last_updated", F.col("last_updated").cast("timestamp_ntz"))
    asked = []
    monkeypatch.setattr(registry, "updates", lambda *_: asked.append(1) or rows)
    first, rest, none = Batch(None, day[1], day[0]), Batch(day[1], None, day[1]), Batch(day[4], None, day[4])
    csvs = registry._csvs_of(spark, "", [first, rest, none, rest, Batch(None, None, day[0])])
    assert len(asked) == 1 and len(set(csvs)) == 5
    found = [[row.loan_id for row in read_loans_csv(spark, csv).orderBy("loan_id").collect()] for csv in csvs]
    assert found == [["L0"], ["L1", "L2"], [], ["L1", "L2"], ["L0", "L1", "L2", "L3"]]
    whole = read_loans_csv(spark, csvs[-1]).withColumn("last_updated", F.col("last_updated").cast("timestamp_ntz"))
    assert rows_of(whole, *LOAN_COLUMNS) == rows_of(rows, *LOAN_COLUMNS)


def test_inputs_are_deleted_once_their_runs_are_over(spark, folder, monkeypatch):
    csvs, there = [folder("first"), folder("second")], []
    for csv in csvs:
        os.mkdir(csv)
    monkeypatch.setattr(registry, "_csvs_of", lambda *_: csvs)
    monkeypatch.setattr(registry.jobs, "run_batch", lambda *_: there.append([os.path.exists(csv) for csv in csvs]))
    registry.run_batches(spark, "", 2, views.BATCHES[:2])
    assert there == [[True, True], [False, True]]
    assert not any(os.path.exists(csv) for csv in csvs)


def test_empty_sides_leave_nothing_behind(spark, loans, monkeypatch):
    rows = loans({}, {"loan_id": "L2", "loan_amount": -1.0})
    monkeypatch.setattr(registry, "loans", lambda *_: rows)
    staging.release()
    assert registry.ingest_empty_sides(spark, "").count() == 5
    staging.release()
    assert os.listdir(f"{spark.conf.get('spark.checkpoint.dir')}/dimflow") == []


def tables_in(spark, path):
    """Small tables that updates are made of, with null and repeated keys on every side."""
    at = "timestamp_ntz'1999-03-01 00:00:00'"
    n = "CASE WHEN id % 5 = 4 THEN NULL ELSE id % 5 END"
    made = {
        "customer": f"SELECT {n} c_custkey, concat('N', id) c_name, 1 c_nationkey, id * 1e0 c_acctbal, 'x' c_mktsegment FROM range(7)",
        "orders": f"SELECT CASE WHEN id = 5 THEN NULL ELSE id % 9 END o_orderkey, {n} o_custkey, 'F' o_orderstatus, id * 1e3 o_totalprice, {at} o_orderdate, 'x' o_orderpriority FROM range(12)",
        "lineitem": f"SELECT CASE WHEN id = 7 THEN NULL ELSE id % 10 END l_orderkey, CAST(id AS INT) l_linenumber, 0.1e0 l_discount, 'R' l_returnflag, {at} l_shipdate FROM range(30)",
    }
    for name, text in made.items():
        spark.sql(text).write.parquet(f"{path}/{name}.parquet")
    return path


def test_updates_are_joined_to_orders_that_have_their_customers(spark, folder, monkeypatch):
    sf_dir = tables_in(spark, folder("tables"))
    found = views.updates(spark, sf_dir)
    lineitem = spark.read.schema(views.LINEITEM_SCHEMA).parquet(f"{sf_dir}/lineitem.parquet")
    expected = spark.sql(
        views.UPDATES_SQL, lineitem=lineitem, orders=views._orders(spark, sf_dir), customer=views._customer(spark, sf_dir)
    )
    assert rows_of(found) == rows_of(expected) and found.count() > 30 and found.schema == expected.schema
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joins = re.findall(r"Left keys \[1\]: \[(\w+)#", plan_of(views.updates(spark, sf_dir)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert joins[-1] == "l_orderkey" and len(joins) == 2  # the last join is the upper one


def test_only_columns_of_the_dimension_are_staged(spark, folder):
    sf_dir = tables_in(spark, folder("tables"))
    every = registry.valid_updates(spark, sf_dir)
    for spec, other in ((DIM_LOAN, "customer_name"), (DIM_CUSTOMER, "application_date")):
        rows = registry.valid_updates(spark, sf_dir, spec)
        assert other not in rows.columns
        assert rows_of(rows, *spec.columns, *spec.order_by) == rows_of(every, *spec.columns, *spec.order_by) != []
