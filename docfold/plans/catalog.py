"""The single registry of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docfold.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
OPERATORS: dict[str, str] = {}


def query(operators: str, sql: str | None = None):
    """Registers a function of the tables under its name, with the operators that it shows and its SQL."""

    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        OPERATORS[f.__name__] = operators
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


from docfold.plans import changes, composite, documents, relational, storage, streams, texts, workflows  # noqa: E402, F401
