"""Small helpers for expressions over whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What separates words, as a regular expression that Java and RE2 read alike.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text; none if it is null."""
    return F.coalesce(F.array_remove(F.split(text, BLANK + "+"), ""), F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` has not."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def uniform(key: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on ``key`` and ``seed`` only: 52 bits of an MD5."""
    digest = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null")))), 1, 13)
    return F.conv(digest, 16, 10).cast("long") / F.lit(float(1 << 52))


def id_hash(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a missing id has none."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def row_key(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """A long that tells rows apart: the id where ids are unique, else a hash of id and text (equal rows share it)."""
    ids = docs.select(F.col(id_col).cast("long").alias("id"))
    if ids.groupBy("id").count().where("count > 1 or id is null").isEmpty():
        return F.col(id_col).cast("long")
    return F.xxhash64(id_col, text_col)
