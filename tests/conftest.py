import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dimflow.schemas import LOAN_COLUMNS, LOAN_SCHEMA  # noqa: E402

LOAN = {
    "customer_id": "C1",
    "loan_id": "L1",
    "application_date": dt.date(2021, 11, 3),
    "loan_amount": 7250.0,
    "interest_rate": 4.25,
    "term_months": 30,
    "status": "Approved",
    "customer_name": "Mira Voss",
    "customer_dob": dt.date(1979, 8, 21),
    "employment_status": "Employed",
    "annual_income": 61300.0,
    "last_updated": dt.datetime(2021, 11, 4, 8, 5),
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def loans(spark):
    """Builds loans from dicts that override the columns of one valid row."""

    def build(*rows):
        filled = [{**LOAN, **row} for row in rows]
        return spark.createDataFrame([tuple(r[c] for c in LOAN_COLUMNS) for r in filled], LOAN_SCHEMA)

    return build


@pytest.fixture()
def folder(tmp_path):
    """Paths below a new folder."""
    return lambda *parts: str(tmp_path.joinpath(*parts))


def rows_of(df, *columns):
    """Rows as a sorted list of tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def plan_of(df):
    mode = df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)
