"""Every registered query against its SQL in DuckDB, and known totals."""

import glob
import math
import os

import duckdb
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from dimflow.operators.validate import split_valid
from dimflow.plans import oracles, registry
from dimflow.plans.views import BATCHES, loans as all_loans
from dimflow.schemas import DIM_CUSTOMER, DIM_LOAN

DATA = "/root/testdata"
SMALL = f"{DATA}/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def text(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return str(value)


def test_every_query_has_its_sql():
    assert set(registry.QUERIES) == set(oracles.ORACLES)
    assert set(registry.QUERIES) <= set(queries()) and set(oracles.ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = queries()[name](spark, SMALL)
    result = duck.execute(oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    found = sorted(tuple(map(text, row)) for row in df.select(*names).collect())
    assert found == sorted(tuple(map(text, row)) for row in result.fetchall())
    assert found


def test_entry(spark):
    assert entry(spark).count() == split_valid(all_loans(spark, SMALL))[0].count()


def test_the_tables_hold_every_case(spark):
    """The queries show little unless their data have violations, changes and nulls."""
    metrics = dict(rows_of(registry.quality_metrics(spark, SMALL), "check", "error_count"))
    assert len(metrics) == 6 and min(metrics.values()) > 0
    loans = registry.type2_after(spark, SMALL, DIM_LOAN, BATCHES)
    closed = loans.filter("NOT is_current").count()
    assert 0 < closed < loans.count()
    for spec in (DIM_CUSTOMER, DIM_LOAN):
        rows = registry.type2_after(spark, SMALL, spec, BATCHES)
        for column in spec.tracked:
            if column != "loan_category":
                assert 0 < rows.filter(F.col(column).isNull()).count() < rows.count()
        changed = rows.groupBy(*spec.keys).agg(*[F.count_distinct(c).alias(c) for c in spec.tracked])
        for column in spec.tracked:
            if column not in ("customer_dob", "annual_income"):  # these come and go
                assert changed.filter(F.col(column) > 1).count() > 0


def test_large_as_of_join_is_shuffled(spark):
    plan = queries()["as_of_join_large"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert any("SortMergeJoin" in line and "LeftOuter" in line for line in plan.split("\n"))
