"""Tables written in the shared checkpoint folder, to cut lineage where an executor may be lost.

The folder is the session's ``spark.checkpoint.dir``.  Where it is unset and the master is local, as in tests, a
temporary folder is taken; on a cluster an unset folder is an error, as no local folder is seen by all executors.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _OWN:
        _OWN.append("file://" + tempfile.mkdtemp(prefix="docfold-"))
    return _OWN[0]


class Scratch:
    """Writes tables below one new folder; ``drop`` deletes those that nothing reads any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/docfold/{name}-{uuid.uuid4().hex}"
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` as a Parquet table that was written just now; its true size is then known to the planner."""
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._docfold_path = path  # noqa: SLF001
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(table._docfold_path)  # noqa: SLF001
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
