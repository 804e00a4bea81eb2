"""Dates that come as text in several formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_first(x: Column) -> Column:
    """A tolerant parse of day/month/year; null if it is none."""
    return F.try_to_timestamp(x, F.lit("d/M/yyyy")).cast("date")


def month_name(x: Column) -> Column:
    """``1 December 2024`` or ``1 Dec 2024``."""
    return F.coalesce(F.try_to_timestamp(x, F.lit("d MMMM yyyy")), F.try_to_timestamp(x, F.lit("d MMM yyyy"))).cast("date")


def unmarked(x: Column) -> Column:
    """Without direction marks and no-break spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(x, "[\\u200E\\u200F]", ""), "\\u00A0", " "))


def date_in_cell(x: Column) -> Column:
    """The first date of a table cell."""
    cell = unmarked(x)
    return F.coalesce(day_first(F.regexp_extract(cell, r"\d{1,2}/\d{1,2}/\d{4}", 0)), month_name(F.regexp_extract(cell, r"(?i)\d{1,2}\s+[a-z]{3,9}\s+\d{4}", 0)))


def validate_date(x: Column) -> Column:
    """DD/MM/YYYY stays, a Hijri date of the years 1300 to 1599 (YYYY/MM/DD) stays, ISO becomes DD/MM/YYYY, anything else is null."""
    t = F.trim(x)
    iso = F.concat_ws("/", F.substring(t, 9, 2), F.substring(t, 6, 2), F.substring(t, 1, 4))
    return F.when(t.rlike(r"^\d{2}/\d{2}/\d{4}$"), t).when(t.rlike(r"^1[3-5]\d{2}/\d{2}/\d{2}$"), t).when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), iso)


def extract_year(x: Column) -> Column:
    """A year 19xx or 20xx, else the last of exactly three parts between slashes, if it has four characters."""
    found = F.nullif(F.regexp_extract(x, r"\b(?:19|20)\d{2}\b", 0), F.lit(""))
    parts = F.split(x, "/")
    return F.coalesce(found, F.when((F.size(parts) == 3) & (F.length(F.get(parts, F.lit(2))) == 4), F.get(parts, F.lit(2))))


def year_start(year: Column) -> Column:
    return F.make_date(year.try_cast("int"), F.lit(1), F.lit(1))


def dated_the(x: Column) -> Column:
    """The date in ``dated the 3rd May, 2019``."""
    return F.nullif(F.trim(F.regexp_extract(x, r"(?i)dated\s+(?:the\s+)?(\d{1,2}(?:st|nd|rd|th)?\s+[A-Za-z]+,?\s+\d{4})", 1)), F.lit(""))
