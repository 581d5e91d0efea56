"""Schemas, fixed values and dimension specifications."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import types as T

# Column names, types, domains and limits that results depend on.
LOAN_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("loan_id", T.StringType()),
        T.StructField("application_date", T.DateType()),
        T.StructField("loan_amount", T.DoubleType()),
        T.StructField("interest_rate", T.DoubleType()),
        T.StructField("term_months", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("customer_dob", T.DateType()),
        T.StructField("employment_status", T.StringType()),
        T.StructField("annual_income", T.DoubleType()),
        T.StructField("last_updated", T.TimestampType()),
    ]
)
LOAN_COLUMNS = tuple(LOAN_SCHEMA.names)
LOAN_STATUSES = ("Applied", "Approved", "Disbursed", "Repaid", "Defaulted")
MIN_RATE, MAX_RATE = 0, 100
SMALL_BELOW, MEDIUM_UP_TO = 5000, 20000
OPEN_END = dt.date(9999, 12, 31)
FIRST_MARK = dt.datetime(1900, 1, 1, tzinfo=dt.timezone.utc)

VALID, ERROR = "valid", "error"

# Columns with so many values that a dictionary of them, which parquet makes of every column at first, is mostly given up again.
# Digests are not among them: few values of tracked columns give few digests.
MANY_VALUES = (
    "customer_id", "loan_id", "loan_amount", "monthly_payment", "customer_name", "annual_income", "surrogate_key",
)


@dataclass(frozen=True)
class DimSpec:
    """One dimension: its business keys, the attributes whose changes make a new
    version, and the columns that decide which of several rows is the latest."""

    name: str
    keys: tuple[str, ...]
    tracked: tuple[str, ...]
    order_by: tuple[str, ...] = ("last_updated", "loan_id")

    @property
    def columns(self) -> tuple[str, ...]:
        return self.keys + self.tracked


DIM_CUSTOMER = DimSpec(
    name="dim_customer",
    keys=("customer_id",),
    tracked=("customer_name", "customer_dob", "employment_status", "annual_income"),
)
DIM_LOAN = DimSpec(
    name="dim_loan",
    keys=("loan_id",),
    tracked=("status", "interest_rate", "term_months", "loan_category"),
)
DIMENSIONS = (DIM_CUSTOMER, DIM_LOAN)
