"""Trees of any depth: paths from the roots by doubling, and whole trees as nested JSON without recursion."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docfold.scratch import Scratch


def paths(nodes: DataFrame, key: str, parent: str, title: str) -> DataFrame:
    """(``key``, path) of each node that hangs on a root: titles and keys from the root down.

    A node's path reaches up to some ancestor; each round appends it to that ancestor's, so its length doubles: the number of rounds is the logarithm of
    the depth.  A root has no parent, or one that is not in the table.  Nodes of a cycle, and those below, hang on no root and are left out.
    """
    scratch = Scratch(nodes.sparkSession, "paths")
    step = F.array(F.struct(F.col(title).alias("title"), F.col(key).alias("key")))
    known = nodes.select(F.col(key).alias(parent)).distinct().withColumn("__known", F.lit(True))
    now = nodes.join(known, parent, "left").select(F.col(key), F.when(F.col("__known"), F.col(parent)).alias("up"), step.alias("path"))
    now, n = scratch.write(now, "steps"), None
    for _ in range(64):
        if now.where("up is not null").isEmpty():
            return now.select(key, "path")
        n = now.count() if n is None else n
        above = now.select(F.col(key).alias("up"), F.col("up").alias("next"), F.col("path").alias("head"))
        new = scratch.write(now.join(above, "up", "left").select(key, F.col("next").alias("up"), F.when(F.col("head").isNull(), F.col("path")).otherwise(F.concat("head", "path")).alias("path")), "steps")
        scratch.drop(now)
        now, left = new, new.where("up is not null")
        # a path longer than all nodes goes round
        if left.where(F.size("path") <= n).isEmpty():
            return now.where("up is null").select(key, "path")
    raise RuntimeError("a path of more than 2**64 steps")


def nested_json(nodes: DataFrame, key: str, parent: str, title: str) -> DataFrame:
    """(``key``, tree) of each root: its tree as JSON, every node with all its columns but ``parent`` and an array ``children`` by title and key.

    Nodes are put in order of their paths; each opens itself and closes as many as end with it, which the depth of the next tells.
    A tree is one value, so a root's must fit in a row.
    """
    placed = paths(nodes, key, parent, title).select(F.col(key), F.col("path"), F.size("path").alias("__depth"))
    own = F.to_json(F.struct(*(c for c in nodes.columns if c != parent)), {"ignoreNullFields": "false"})
    rows = nodes.withColumn("__own", own).join(placed, key)
    w = Window.partitionBy(F.col("path")[0]["key"]).orderBy("path")
    before, after = F.lag("__depth").over(w), F.coalesce(F.lead("__depth").over(w), F.lit(1))
    comma = F.when(before >= F.col("__depth"), ",").otherwise("")
    opened = F.concat(F.substring("__own", F.lit(1), F.length("__own") - 1), F.lit(',"children":['))
    closed = F.repeat(F.lit("]}"), F.greatest(F.col("__depth") - after + 1, F.lit(0)))
    tokens = rows.select(F.col("path")[0]["key"].alias(key), "path", F.concat(comma, opened, closed).alias("token"))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("path", "token"))), lambda x: x["token"])
    return tokens.groupBy(key).agg(F.array_join(parts, "").alias("tree"))
