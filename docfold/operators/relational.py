"""Joins, dedup, rollups and paging with the orders and defaults that the domain asks for."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_of(x: Column, order: tuple[str, ...]) -> Column:
    """0 for the most important value; unknown and missing values rank with the last."""
    out = F.lit(len(order) - 1)
    for i, v in reversed(list(enumerate(order))):
        out = F.when(x == v, F.lit(i)).otherwise(out)
    return out


def value_of(rank: Column, order: tuple[str, ...]) -> Column:
    return F.get(F.array(*map(F.lit, order)), F.coalesce(rank, F.lit(len(order) - 1)).cast("int"))


def dominant(x: Column, order: tuple[str, ...]) -> Column:
    """An aggregate: the most important value of a group; the last of the order if there is none."""
    return value_of(F.min(rank_of(x, order)), order)


def worst_status(x: Column) -> Column:
    """An aggregate: any ``new`` makes new, else any ``partially_matched`` makes partial, else fully matched, for no rows too."""
    return (
        F.when(F.coalesce(F.bool_or(x == "new"), F.lit(False)), "new")
        .when(F.coalesce(F.bool_or(x == "partially_matched"), F.lit(False)), "partially_matched")
        .otherwise("fully_matched")
    )


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys))


def existing(new: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    return new.join(stored, null_safe(new, stored, keys), "left_semi")


def missing(new: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    return new.join(stored, null_safe(new, stored, keys), "left_anti")


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each group; the order must tell all rows apart."""
    n = "__n"
    return df.withColumn(n, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(n) == 1).drop(n)


def lookup_last(df: DataFrame, right: DataFrame, key: str, position: str) -> DataFrame:
    """Left join to the last of the rows on the right with a key."""
    return df.join(first_by(right, [key], F.col(position).desc()).drop(position), key, "left")


def union_first(sources: list[DataFrame], keys: list[str], *order: Column, deal: tuple = ()) -> DataFrame:
    """A union in which, for each key, the row of the earliest source stays; ``deal`` is a number of partitions, and the keys that deal rows to them."""
    tagged = [df.withColumn("__source", F.lit(i)) for i, df in enumerate(sources)]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return first_by(whole.repartition(*deal) if deal else whole, keys, F.col("__source"), *order).drop("__source")


def union_sources(sources: dict[str, DataFrame], tag: str = "source_system") -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (df.withColumn(tag, F.lit(name)) for name, df in sources.items()))


def carry_forward(x: Column, header: Column, keys: list[str], *order: Column) -> Column:
    """The value of the last header row so far."""
    return F.last(F.when(header, x), ignorenulls=True).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def gap_sessions(df: DataFrame, keys: list[str], at: Column, gap: Column, *tie: Column) -> DataFrame:
    """Rows with a running number that grows where the step from the row before is over the gap."""
    w = Window.partitionBy(*keys).orderBy(at, *tie)
    new = F.when(at - F.lag(at).over(w) > gap, 1).otherwise(0)
    return df.withColumn("__new", new).withColumn("session_no", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def page_of(df: DataFrame, order: list[Column], limit: int = 100, offset: int = 0) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(min(limit, 1000))


def paging(total: Column, limit: int, offset: int) -> list[Column]:
    return [
        (F.lit(offset + limit) < total).alias("has_more"),
        F.lit(offset // limit + 1).cast("long").alias("current_page"),
        F.ceil(total / limit).cast("long").alias("total_pages"),
    ]


def optional_filters(df: DataFrame, **values) -> DataFrame:
    """A conjunct for each value that is given."""
    for column, v in values.items():
        if v is not None:
            df = df.where(F.col(column) == v)
    return df


def counts_of(x: Column, values: tuple[str, ...]) -> list[Column]:
    """Aggregates: one count per value, zero where there is none."""
    return [F.count_if(F.coalesce(x == v, F.lit(False))).alias(v.lower()) for v in values]


def top_children(nodes: DataFrame, key: str, parent: str, title: str) -> DataFrame:
    """Of each node its children in order of title: their number and titles."""
    kids = nodes.groupBy(F.col(parent).alias(key)).agg(F.count("*").alias("n_children"), F.array_join(F.sort_array(F.collect_list(title)), ", ").alias("children"))
    return nodes.join(kids, key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))


def tree_paths(spark, view: str, key: str, parent: str, title: str) -> DataFrame:
    """Level and path of each node of an adjacency table, from the roots down.

    Spark stops a recursion at the level and row limits of the session (``spark.sql.cteRecursionLevelLimit`` and ``cteRecursionRowLimit``) with an
    error, so a cycle or a deeper tree than these allow is no silent loss.
    """
    return spark.sql(
        f"""WITH RECURSIVE t (id, parent_id, lvl, path) AS (
              SELECT {key}, {parent}, 0, {title} FROM {view} WHERE {parent} IS NULL
              UNION ALL
              SELECT c.{key}, c.{parent}, t.lvl + 1, t.path || ' > ' || c.{title} FROM {view} c JOIN t ON c.{parent} = t.id)
            SELECT * FROM t"""
    )
