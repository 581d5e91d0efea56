"""Loan data and dimension history on Spark.

Operators take DataFrames and return DataFrames; Catalyst plans them. Reads and
writes live in ``sources``, whole jobs in ``plans``, incremental runs in
``streaming``.
"""
