"""Scalar functions as Spark columns: texts, dates, JSON and markup."""
