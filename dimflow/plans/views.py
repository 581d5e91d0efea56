"""Loans derived from the given tables, with rule violations among them."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# One text for both engines; ``{orders}`` and ``{customer}`` name the tables.
LOANS_SQL = """
SELECT CASE WHEN o_orderkey % 101 = 0 THEN NULL
            ELSE concat('C', CAST(o_custkey AS STRING)) END AS customer_id,
       CASE WHEN o_orderkey % 103 = 0 THEN NULL
            ELSE concat('L', CAST(o_orderkey AS STRING)) END AS loan_id,
       CAST(o_orderdate AS DATE) AS application_date,
       CASE WHEN o_orderkey % 97 = 0 THEN -1e0 WHEN o_orderkey % 67 = 0 THEN NULL
            ELSE o_totalprice / 10e0 END AS loan_amount,
       CASE WHEN o_orderkey % 89 = 0 THEN 120e0 WHEN o_orderkey % 83 = 0 THEN NULL
            WHEN o_orderkey % 7 = 0 THEN 0e0 ELSE (o_orderkey % 200) / 10e0 END AS interest_rate,
       CAST(CASE WHEN o_orderkey % 79 = 0 THEN 0 WHEN o_orderkey % 61 = 0 THEN NULL
            ELSE 6 * (1 + o_orderkey % 10) END AS INT) AS term_months,
       CASE WHEN o_orderkey % 73 = 0 THEN 'Cancelled' WHEN o_orderkey % 71 = 0 THEN NULL
            WHEN o_orderstatus = 'F' THEN 'Repaid' WHEN o_orderstatus = 'O' THEN 'Disbursed'
            ELSE 'Applied' END AS status,
       c_name AS customer_name,
       DATE '1960-01-01' + CAST(c_custkey % 14000 AS INT) AS customer_dob,
       CASE WHEN o_orderkey % 3 = 0 THEN 'Self-Employed' ELSE 'Employed' END AS employment_status,
       c_acctbal * 10e0 AS annual_income,
       o_orderdate AS last_updated
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""

# Updates of the loans: a loan has one for each of its line items, on its shipping date. Values
# of both dimensions change, and are missing at times.
_UPDATES_SELECT = """
SELECT CASE WHEN o_orderkey % 101 = 0 THEN NULL
            ELSE concat('C', CAST(o_custkey AS STRING)) END AS customer_id,
       CASE WHEN (o_orderkey + l_linenumber) % 103 = 0 THEN NULL
            ELSE concat('L', CAST(o_orderkey AS STRING)) END AS loan_id,
       CAST(o_orderdate AS DATE) AS application_date,
       CASE WHEN (o_orderkey + l_linenumber) % 97 = 0 THEN -1e0
            WHEN (o_orderkey + l_linenumber) % 13 = 0 THEN o_totalprice / 20e0
            ELSE o_totalprice / 10e0 END AS loan_amount,
       CASE WHEN (o_orderkey + l_linenumber) % 89 = 0 THEN 120e0
            WHEN (o_orderkey + l_linenumber) % 17 = 0 THEN NULL
            WHEN l_linenumber % 3 = 0 THEN l_discount
            ELSE (o_orderkey % 200) / 10e0 END AS interest_rate,
       CAST(CASE WHEN (o_orderkey + l_linenumber) % 79 = 0 THEN 0
            WHEN (o_orderkey + l_linenumber) % 11 = 0 THEN NULL
            ELSE 6 * (1 + (o_orderkey + l_linenumber) % 10) END AS INT) AS term_months,
       CASE WHEN (o_orderkey + l_linenumber) % 73 = 0 THEN 'Cancelled'
            WHEN (o_orderkey + l_linenumber) % 7 = 0 THEN NULL
            WHEN l_returnflag = 'R' THEN 'Defaulted' WHEN l_returnflag = 'A' THEN 'Repaid'
            ELSE 'Disbursed' END AS status,
       CASE WHEN (o_orderkey + l_linenumber) % 29 = 0 THEN NULL
            WHEN (o_orderkey + l_linenumber) % 5 = 0 THEN concat(c_name, ' Jr')
            ELSE c_name END AS customer_name,
       CASE WHEN (o_orderkey + l_linenumber) % 31 = 0 THEN NULL
            ELSE DATE '1960-01-01' + CAST(c_custkey % 14000 AS INT) END AS customer_dob,
       CASE WHEN (o_orderkey + l_linenumber) % 9 = 0 THEN NULL
            WHEN o_orderkey % 3 = 0 THEN 'Self-Employed' ELSE 'Employed' END AS employment_status,
       CASE WHEN (o_orderkey + l_linenumber) % 10 = 0 THEN NULL
            ELSE c_acctbal * 10e0 END AS annual_income,
       l_shipdate AS last_updated
"""
UPDATES_SQL = f"""{_UPDATES_SELECT}\
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{customer}} ON o_custkey = c_custkey
"""
# The same rows, joined in another order: line items, of which there are most, are shuffled once, not again by customer.
_UPDATES_JOINED = f"""{_UPDATES_SELECT}\
FROM {{lineitem}} JOIN ({{orders}} JOIN {{customer}} ON o_custkey = c_custkey) ON l_orderkey = o_orderkey
"""


# Stated, so that no job runs to infer them.
LINEITEM_SCHEMA = """l_orderkey bigint, l_linenumber int, l_discount double, l_returnflag string,
 l_shipdate timestamp_ntz"""
ORDERS_SCHEMA = """o_orderkey bigint, o_custkey bigint, o_orderstatus string,
 o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"""
CUSTOMER_SCHEMA = """c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,
 c_mktsegment string"""


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All loans of a data directory, one row each."""
    return spark.sql(LOANS_SQL, orders=_orders(spark, sf_dir), customer=_customer(spark, sf_dir))


def updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All updates of the loans, several rows each."""
    lineitem = spark.read.schema(LINEITEM_SCHEMA).parquet(f"{sf_dir}/lineitem.parquet")
    orders, customer = _orders(spark, sf_dir), _customer(spark, sf_dir)
    return spark.sql(_UPDATES_JOINED, lineitem=lineitem, orders=orders, customer=customer)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(ORDERS_SCHEMA).parquet(f"{sf_dir}/orders.parquet")


def _customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(CUSTOMER_SCHEMA).parquet(f"{sf_dir}/customer.parquet")


@dataclass(frozen=True)
class Batch:
    """Updates with start <= date of last_updated < end, processed on a date."""

    start: dt.date | None
    end: dt.date | None
    process_date: dt.date

    def holds(self) -> Column:
        day, holds = F.col("last_updated").cast("date"), F.lit(True)
        if self.start:
            holds &= day >= F.lit(self.start)
        if self.end:
            holds &= day < F.lit(self.end)
        return holds

    def of(self, df: DataFrame) -> DataFrame:
        return df.filter(self.holds())


# Three batches that together hold every update.
BATCHES = (
    Batch(None, dt.date(1999, 1, 1), dt.date(1999, 1, 1)),
    Batch(dt.date(1999, 1, 1), dt.date(1999, 7, 1), dt.date(1999, 7, 1)),
    Batch(dt.date(1999, 7, 1), None, dt.date(2001, 9, 1)),
)
