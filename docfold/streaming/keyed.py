"""Streams that keep a value for each key in the state store: versions of documents, and runs that must give signs of life.

State lies in the RocksDB store below the stream's checkpoint, so a batch reads what it knows of the keys that it holds, and nothing
else of the history.  Rows of a key and batch are put in order in memory; ``maxFilesPerTrigger`` of the source bounds them.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from docfold.streaming.jobs import VERSIONS

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: A run is given up after so many milliseconds without a beat: three beats of 300 s.
SILENCE = 3 * 300_000


def _with_rocksdb(df: DataFrame) -> None:
    """Typed state asks for the RocksDB store; one that the session names already stays."""
    spark = df.sparkSession
    if "RocksDB" not in (spark.conf.get(PROVIDER, None) or ""):
        spark.conf.set(PROVIDER, ROCKSDB)


class Versions(StatefulProcessor):
    """One value a document: number and hash of the version that is active, and when its text was seen."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.active = handle.getValueState("active", "version_no long, content_hash string, seen timestamp")

    def handleInitialState(self, key: tuple, initialState: Row, timerValues) -> None:
        self.active.update((initialState.version_no, initialState.content_hash, initialState.created_at))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        number, known, since = self.active.get() or (0, None, None)
        since = None if since is None else since.replace(tzinfo=None)
        last = None
        for row in rows:
            text, seen = row.text, row.seen.replace(tzinfo=None)
            # the row seen last decides, of several the smallest text
            if last is None or seen > last[1] or seen == last[1] and text < last[0]:
                last = (text, seen)
        text, seen = last
        digest = md5(text.encode()).hexdigest()
        if since is not None and seen < since:
            return  # late: a newer text is active
        if digest != known:
            yield Row(regulation_id=key[0], version_no=number + 1, content_text=text, content_hash=digest, status="active", change_summary="Content changed" if number else "Initial crawl", created_at=seen)
            number += 1
        self.active.update((number, digest, seen))

    def close(self) -> None:
        pass


def versions_by_state(docs: DataFrame, root: str, checkpoint: str, stored: DataFrame | None = None) -> StreamingQuery:
    """Keeps one active version a document: a stream of (id, text, seen) adds to the versions below ``root``.

    ``stored``, a version table, is where a new stream starts from; a stream that goes on from its checkpoint does not read it again.  A text
    seen before the active one changes nothing, however late it comes.  Rows without an id, text or time are left out.  What a batch
    adds goes to a folder of its own, so a batch that is run again writes the same; ``jobs.versions_at`` reads the table.
    """
    _with_rocksdb(docs)
    sound = docs.where("id is not null and text is not null and seen is not null").select(F.col("id").cast("long").alias("id"), "text", F.col("seen").cast("timestamp").alias("seen"))
    start = None
    if stored is not None:
        path = docs.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/until=-1/_SUCCESS")
        if not path.getFileSystem(docs.sparkSession.sparkContext._jsc.hadoopConfiguration()).exists(path):
            stored.write.mode("overwrite").parquet(f"{root}/until=-1")
        kept = docs.sparkSession.read.schema(VERSIONS).parquet(f"{root}/until=-1")
        newest = F.max(F.struct("version_no", "content_hash", "created_at")).alias("x")
        start = kept.groupBy(F.col("regulation_id").alias("id")).agg(newest).select("id", "x.*").groupBy("id")
    added = sound.groupBy("id").transformWithState(Versions(), VERSIONS, "append", "none", start)
    write = lambda batch, number: batch.write.mode("overwrite").parquet(f"{root}/batch={number}")
    return added.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class Heartbeats(StatefulProcessor):
    """One value a run: when it began and gave its last sign, and how many it gave; a timer stands where it would be given up."""

    def __init__(self, silence: int):
        self.silence = silence

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "started long, last long, beats long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        run = tuple(self.run.get()) if self.run.exists() else None
        if run:
            self.handle.deleteTimer(run[1] + self.silence)
        ended = []
        for at, done in pd.concat(list(rows)).sort_values(["at", "done"])[["at", "done"]].itertuples(index=False):
            at, over = int(at), None if run is None else run[1] + self.silence
            if run and at >= over:
                ended.append((*run, over, "FAILED"))
                run = None
            run = (at, at, 1) if run is None else (run[0], at, run[2] + 1)
            if done:
                ended.append((*run, at, "DONE"))
                run = None
        if run:
            self.run.update(run)
            self.handle.registerTimer(run[1] + self.silence)
        elif self.run.exists():
            self.run.clear()
        if ended:
            yield self._rows(key, ended)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.run.exists():
            run = tuple(self.run.get())
            self.run.clear()
            yield self._rows(key, [(*run, run[1] + self.silence, "FAILED")])

    @staticmethod
    def _rows(key: tuple, ended: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame([(key[0], *x) for x in ended], columns=["run", "started", "last", "beats", "ended", "status"])

    def close(self) -> None:
        pass


def run_outcomes(beats: DataFrame, silence: int = SILENCE, late: str = "0 seconds") -> DataFrame:
    """A stream of (run, ts, done) as the runs that have ended: DONE with their last beat, FAILED ``silence`` milliseconds after it.

    started, last and ended are milliseconds since 1970.  A run that is silent is given up when the watermark, ``late`` behind the newest beat of any
    run, has passed its timer, without a further beat of its own; a beat after that begins a new run.  State of ended runs is gone.
    """
    _with_rocksdb(beats)
    marked = beats.where("run is not null and ts is not null").withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    rows = marked.select("run", "ts", F.unix_millis("ts").alias("at"), F.coalesce("done", F.lit(False)).alias("done"))
    return rows.groupBy("run").transformWithStateInPandas(Heartbeats(silence), "run long, started long, last long, beats long, ended long, status string", "append", "eventTime")
