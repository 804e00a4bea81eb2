"""Queries over the driver's tables, each with the SQL that must agree."""

from docfold.plans.catalog import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
