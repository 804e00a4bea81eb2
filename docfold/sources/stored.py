"""Tables as folders: batches that count once all their tables are written, buckets that are rewritten one by one, days that are skipped unread."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docfold.operators import mutations


class Folder:
    """A folder in any file system that Spark reads."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _at(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, name: str = "") -> list[str]:
        path, fs = self._at(name)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def mark(self, name: str) -> None:
        path, fs = self._at(name)
        fs.create(path, True).close()

    def delete(self, name: str) -> None:
        path, fs = self._at(name)
        fs.delete(path, True)


class Batches(Folder):
    """Several append-only tables that are written in batches: ``root/table/batch=N``.

    A batch counts from the moment that ``root/_commits/N`` is there, which is made when all its tables are written; readers see the tables of
    whole batches only.  A batch that was stopped is run again and overwrites what it had written; one that counts is never run again.
    """

    def committed(self) -> list[int]:
        return sorted(int(n) for n in self.names("_commits") if n.isdigit())

    def read(self, table: str, schema: str, before: int | None = None) -> DataFrame:
        """A table with the number of each row's batch, of all batches that count, or of those before one."""
        there = set(self.names(table))
        batches = [b for b in self.committed() if (before is None or b < before) and f"batch={b}" in there]
        kinds = StructType.fromDDL(f"{schema}, batch int")
        if not batches:
            return self.spark.createDataFrame([], kinds)
        return self.spark.read.schema(kinds).option("basePath", f"{self.root}/{table}").parquet(*(f"{self.root}/{table}/batch={b}" for b in batches))

    def put(self, table: str, batch: int, rows: DataFrame) -> DataFrame:
        """Writes a batch's rows of a table and reads them again, so that what follows is made of what was stored."""
        path = f"{self.root}/{table}/batch={batch}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def run(self, batch: int, work: Callable[[Batches, int], None]) -> bool:
        """Does a batch's work and lets it count, unless it does already."""
        if batch in self.committed():
            return False
        work(self, batch)
        self.mark(f"_commits/{batch}")
        return True


class Buckets(Folder):
    """A table in folders by the hash of its keys; a change reads and rewrites the buckets that its keys fall in, and no others.

    A change that was stopped can be run again: what it has replaced it replaces once more.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str, keys: list[str], buckets: int = 64):
        super().__init__(spark, root)
        self.kinds, self.keys, self.buckets = StructType.fromDDL(schema), keys, buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def read(self) -> DataFrame:
        return self._of([int(n[7:]) for n in self.names() if n.startswith("bucket=")])

    def _of(self, buckets: list[int]) -> DataFrame:
        there = set(self.names())
        paths = [f"{self.root}/bucket={b}" for b in buckets if f"bucket={b}" in there]
        return self.spark.read.schema(self.kinds).parquet(*paths) if paths else self.spark.createDataFrame([], self.kinds)

    def _change(self, keys: DataFrame, change: Callable[[DataFrame], DataFrame]) -> list[int]:
        """Rewrites the buckets that ``keys`` fall in; their numbers."""
        hit = sorted(r[0] for r in keys.select(self._bucket().alias("b")).distinct().collect())  # at most as many as there are buckets
        if hit:
            rows = change(self._of(hit)).select(*self.kinds.names).withColumn("bucket", self._bucket())
            rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.root)
        return hit

    def upsert(self, changes: DataFrame) -> list[int]:
        """Rows of the keys in ``changes`` are replaced, new ones added."""
        return self._change(changes, lambda base: mutations.upsert(base, changes.select(*self.kinds.names), self.keys))

    def replace(self, new: DataFrame, by: list[str]) -> list[int]:
        """All rows that agree with ``new`` in ``by`` are replaced by its rows; ``by`` holds all keys, so these rows are in the buckets of ``new``."""
        if not set(self.keys) <= set(by):
            raise ValueError(f"{by} does not hold the keys {self.keys}")
        return self._change(new, lambda base: mutations.replace_rows(base, new.select(*self.kinds.names), by))

    def remove(self, keys: DataFrame) -> list[int]:
        """Rows of the keys go; a bucket of which nothing is left goes too."""
        keys = keys.select(*self.keys).distinct()
        hit = [r[0] for r in keys.select(self._bucket().alias("b")).distinct().collect()]
        left = {r[0] for r in mutations.delete(self._of(hit), keys, self.keys).select(self._bucket().alias("b")).distinct().collect()}
        self._change(keys.where(self._bucket().isin(list(left))), lambda base: mutations.delete(base, keys, self.keys))
        for b in set(hit) - left:
            self.delete(f"bucket={b}")
        return sorted(hit)


def write_days(rows: DataFrame, root: str, at: str, mode: str = "overwrite") -> None:
    """A table in a folder for each day of ``at``; with ``mode`` append new rows go to the folders of their days."""
    rows.withColumn("day", F.to_date(at)).repartition("day").write.mode(mode).partitionBy("day").parquet(root)


def since_mark(spark: SparkSession, root: str, schema: str, days_back: int = 1, default: str | None = None) -> DataFrame:
    """Rows from the high-water mark on: the newest day that there is, less ``days_back``; where there is none, from ``default`` on.

    The mark comes from the folders' names, and folders of days before it are neither listed nor read.
    """
    names = [m[1] for n in Folder(spark, root).names() if (m := re.fullmatch(r"day=(\d{4}-\d{2}-\d{2})", n))]
    kinds = StructType.fromDDL(f"{schema}, day date")
    first = str(spark.sql("SELECT date_sub(to_date(:last), :back)", args={"last": max(names), "back": days_back}).first()[0]) if names else default
    wanted = [f"{root}/day={d}" for d in sorted(names) if first is None or d >= first]
    if not wanted:
        return spark.createDataFrame([], kinds)
    rows = spark.read.schema(kinds).option("basePath", root).parquet(*wanted)
    return rows.where(F.col("day") >= F.lit(first).cast("date")) if first else rows
