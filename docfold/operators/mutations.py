"""Changes to tables as whole new tables: copy on write, as Parquet has no update."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docfold.functions import structured


def with_keys(new: DataFrame, key: str, last: int | Column, *order: Column) -> DataFrame:
    """Rows to append, numbered on from the largest key.  Numbers come from counts of hash buckets, so no task sorts all rows."""
    buckets = new.withColumn("__b", F.pmod(F.xxhash64(*new.columns), F.lit(1024)))
    counts = buckets.groupBy("__b").count()
    start = counts.withColumn("__start", F.sum("count").over(Window.orderBy("__b")) - F.col("count")).drop("count")
    n = F.row_number().over(Window.partitionBy("__b").orderBy(*order))
    return buckets.withColumn("__n", n).join(F.broadcast(start), "__b").withColumn(key, (F.col("__start") + F.col("__n") + last).cast("long")).drop("__b", "__n", "__start")


def patch(base: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Fields of ``changes`` that are not null replace those of the row with the key."""
    new = changes.select(F.col(key).alias("__k"), *(F.col(c).alias(f"__{c}") for c in changes.columns if c != key))
    fields = [F.coalesce(f"__{c}", c).alias(c) if c in changes.columns and c != key else F.col(c) for c in base.columns]
    return base.join(new, base[key] == F.col("__k"), "left").select(*fields)


def upsert(base: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with a key in ``changes`` are replaced, others stay, new ones are added."""
    return base.join(changes.select(*keys), keys, "left_anti").select(base.columns).unionByName(changes)


def replace_rows(base: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of the keys that ``new`` has are replaced by its rows, of which a key may have several."""
    return base.join(new.select(*keys).distinct(), keys, "left_anti").select(base.columns).unionByName(new)


def delete(base: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return base.join(keys, on, "left_anti").select(base.columns)


def delete_counted(tables: dict[str, DataFrame], keys: DataFrame, on: list[str]) -> tuple[dict[str, DataFrame], DataFrame]:
    """What stays of each table, and how many rows each lost."""
    rest = {name: delete(df, keys, on) for name, df in tables.items()}
    lost = None
    for name, df in tables.items():
        one = df.join(keys, on, "left_semi").agg(F.lit(name).alias("table"), F.count("*").alias("deleted"))
        lost = one if lost is None else lost.unionByName(one)
    return rest, lost


def mark(base: DataFrame, ids: DataFrame, key: str, column: str) -> DataFrame:
    """1 in ``column`` for the rows whose key is listed, whatever it was elsewhere."""
    listed = ids.select(F.col(key).alias("__k")).distinct().withColumn("__hit", F.lit(1))
    old = F.col(column) if column in base.columns else F.lit(0)
    out = base.join(listed, base[key] == F.col("__k"), "left").withColumn(column, F.coalesce("__hit", old))
    return out.drop("__k", "__hit")


def set_status(base: DataFrame, target: Column, old: str, new: str, column: str = "status") -> DataFrame:
    """``new`` for the targets that are ``old``."""
    return base.withColumn(column, F.when(target & (F.col(column) == old), new).otherwise(F.col(column)))


def set_status_counted(base: DataFrame, target: Column, old: str, new: str, column: str = "status") -> tuple[DataFrame, DataFrame]:
    """``set_status`` and the number of rows it changes; none means that the target was not found."""
    return set_status(base, target, old, new, column), base.where(target & (F.col(column) == old)).agg(F.count("*").alias("rows_affected"))


def insert_documents(docs: DataFrame, last: int, *order: Column) -> DataFrame:
    """Documents as they are stored: with keys after ``last``, paths and extra fields as JSON, and the local address out of the extra fields."""
    local = F.coalesce("extra_meta.urdu_url", F.lit(None).cast("string"))
    rows = docs.withColumn("urdu_url", local).withColumn("doc_path_json", structured.encoded(F.col("doc_path"))).withColumn("extra_meta_json", F.to_json(structured.without(F.col("extra_meta"), "urdu_url")))
    return with_keys(rows.drop("doc_path", "extra_meta", "id"), "id", last, *order)


def append_log(log: DataFrame, path: str) -> None:
    """Adds rows of a run (regulation_id, step, status, message, details) to the log; details become JSON."""
    log.withColumn("details", structured.encoded(F.col("details"))).write.mode("append").parquet(path)


def archived(base: DataFrame, current: Column) -> tuple[DataFrame, DataFrame]:
    """(head, history): current rows go to the history and leave the head."""
    return base.where(~current), base.where(current)


def category_prefixes(paths: Column) -> Column:
    """All prefixes of a path, from the root down."""
    return F.transform(F.sequence(F.lit(1), F.size(paths)), lambda n: F.slice(paths, 1, n))


def missing_categories(docs: DataFrame, path: str, existing: DataFrame) -> DataFrame:
    """Path prefixes that no category has yet: path, title and depth of each, folders before what they hold."""
    wanted = docs.where(F.size(path) > 0).select(F.explode(category_prefixes(F.col(path))).alias("path")).distinct()
    new = wanted.join(existing.select("path"), "path", "left_anti")
    return new.select("path", F.element_at("path", -1).alias("title"), F.size("path").alias("depth"))


def replace_partition(new: DataFrame, path: str, by: list[str]) -> None:
    """Overwrites just the partitions that ``new`` has rows for."""
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
