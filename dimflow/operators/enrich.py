"""Derived loan columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.functions.loans import loan_category, monthly_payment


def enrich_loans(df: DataFrame) -> DataFrame:
    """Add ``monthly_payment`` and ``loan_category``."""
    return df.withColumns(
        {
            "monthly_payment": monthly_payment(
                F.col("loan_amount"), F.col("interest_rate"), F.col("term_months")
            ),
            "loan_category": loan_category(F.col("loan_amount")),
        }
    )
