"""Streams with keyed state: restarts, late rows, timers, and the same outcome as a batch over all rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docfold.operators.versioning import change_detect, next_versions
from docfold.streaming import jobs, keyed

T0 = datetime(2024, 1, 1)
DOC = "id long, text string, seen timestamp"


@pytest.fixture
def folder(spark, tmp_path):
    """Writes rows as one more file of a table that is read as a stream."""

    def add(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        return spark.readStream.schema(schema).parquet(str(tmp_path / name))

    return add


def test_versions_over_restarts(spark, folder, tmp_path):
    """Each batch is a new start of the stream, from its checkpoint; the versions are those of batches over the whole table."""
    root, check, r = str(tmp_path / "versions"), str(tmp_path / "check"), random.Random(2)
    at = lambda k: T0 + timedelta(hours=k)
    stored = [(i, v, None, f"h{i}.{v}", "active" if v == 2 else "inactive", "Initial crawl", at(-10 + v)) for i in range(3) for v in (1, 2)]
    stored = spark.createDataFrame(stored, jobs.VERSIONS)
    want = stored
    for k in range(3):
        rows = [(i, f"text {r.randint(0, 2)}", at(k)) for i in range(8)] + [(9, "a", at(k)), (9, "b", at(k))]
        docs = folder("docs", rows, DOC)
        keyed.versions_by_state(docs, root, check, stored).awaitTermination()
        last = spark.createDataFrame([x for x in rows if x[1] != "b"], DOC).withColumn("content_hash", F.md5("text"))
        newest = want.groupBy("regulation_id").agg(F.max_by("content_hash", "version_no").alias("content_hash")).withColumnRenamed("regulation_id", "id")
        changed = change_detect(last, newest).select(F.col("id").alias("regulation_id"), F.col("text").alias("content_text"), "content_hash", "monitoring_status")
        want = spark.createDataFrame(next_versions(changed, want, at(k)).collect(), jobs.VERSIONS)
        got = jobs.versions_at(spark, root, 1 << 31)
        assert sorted(map(tuple, got.select(want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    active = got.where("status = 'active'").groupBy("regulation_id").count()
    assert active.where("count <> 1").isEmpty() and active.count() == 9


def test_late_and_odd_rows_of_versions(spark, folder, tmp_path):
    """A text seen before the active one changes nothing; rows without id, text or time are left out; equal texts make no version."""
    root, check = str(tmp_path / "versions"), str(tmp_path / "check")
    at = lambda k: T0 + timedelta(hours=k)
    for rows in (
        [(1, "new", at(5)), (1, "old", at(1)), (None, "x", at(1)), (2, None, at(1)), (3, "x", None), (4, "", at(0))],
        [(1, "late", at(3)), (1, "new", at(6)), (4, "", at(2))],
        [(1, "newer", at(7)), (1, "late", at(5)), (4, "full", at(1))],
    ):
        keyed.versions_by_state(folder("docs", rows, DOC), root, check).awaitTermination()
    got = [(x.regulation_id, x.version_no, x.content_text, x.status, x.created_at) for x in jobs.versions_at(spark, root, 1 << 31).collect()]
    assert sorted(got) == [(1, 1, "new", "inactive", at(5)), (1, 2, "newer", "active", at(7)), (4, 1, "", "active", at(0))]


def test_gathered_versions_after_a_start_from_stored_ones(spark, folder, tmp_path):
    root = str(tmp_path / "versions")
    stored = spark.createDataFrame([(1, 4, None, "h", "active", "Initial crawl", T0)], jobs.VERSIONS)
    keyed.versions_by_state(folder("docs", [(1, "x", T0), (2, "y", T0)], DOC), root, str(tmp_path / "check"), stored).awaitTermination()
    before = sorted(map(str, jobs.versions_at(spark, root, 1 << 31).collect()))
    jobs.gather_versions(spark, root)
    assert sorted(map(str, jobs.versions_at(spark, root, 1 << 31).collect())) == before and len(before) == 3


BEAT = "run long, ts timestamp, done boolean"


def ended(rows, silence):
    """Runs that ended, written out."""
    out, newest = [], max(t for _, t, _ in rows)
    for run in {x for x, _, _ in rows}:
        now = None
        for t, done in sorted((t, done) for x, t, done in rows if x == run):
            if now and t >= now[1] + silence:
                out.append((run, *now, now[1] + silence, "FAILED"))
                now = None
            now = (now[0], t, now[2] + 1) if now else (t, t, 1)
            if done:
                out.append((run, *now, t, "DONE"))
                now = None
        if now and now[1] + silence <= newest:
            out.append((run, *now, now[1] + silence, "FAILED"))
    return sorted(out)


def test_heartbeats_over_restarts(spark, folder, tmp_path):
    """Files in order of time, each with a restart of the stream: timers fire between them, and state goes on."""
    r, rows, check, path = random.Random(3), [], str(tmp_path / "check"), str(tmp_path / "out")
    for k in range(3):
        new = [(r.randint(1, 6), T0 + timedelta(minutes=r.uniform(k * 60, k * 60 + 60)), r.random() < 0.15) for _ in range(40)]
        rows += new
        out = keyed.run_outcomes(folder("beats", new, BEAT))
        out.writeStream.format("parquet").option("path", path).option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination()
    ms = [(x, int((t - datetime(1970, 1, 1)).total_seconds() * 1000 // 1), d) for x, t, d in rows]
    got = sorted(map(tuple, spark.read.parquet(path).select("run", "started", "last", "beats", "ended", "status").collect()))
    assert got == ended(ms, keyed.SILENCE) and {x[5] for x in got} == {"DONE", "FAILED"}


def test_late_beats(spark, folder, tmp_path):
    """A beat behind the watermark revives nothing; rows without run or time are left out."""
    check, path = str(tmp_path / "check"), str(tmp_path / "out")
    at = lambda m: T0 + timedelta(minutes=m)
    for new in ([(1, at(0), False), (2, at(100), False), (None, at(1), True), (3, None, True)], [(1, at(5), False), (2, at(101), True)]):
        out = keyed.run_outcomes(folder("beats", new, BEAT), late="1 minute")
        out.writeStream.format("parquet").option("path", path).option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination()
    assert sorted((x.run, x.beats, x.status) for x in spark.read.parquet(path).collect()) == [(1, 1, "FAILED"), (2, 2, "DONE")]


def test_versions_take_rows_not_frames():
    """Keys are told from rows: a frame a key costs more than all else.  The last seen decides, of several the smallest text; late rows change nothing."""
    import datetime

    from pyspark.sql import Row

    from docfold.streaming.keyed import Versions

    class Value:
        kept = None
        get = lambda self: self.kept

        def update(self, x):
            self.kept = x

    day = lambda n: datetime.datetime(2024, 1, n)
    v = Versions()
    v.active = Value()
    v.handleInitialState((1,), Row(version_no=2, content_hash="h", created_at=day(1)), None)
    told = lambda *rows: [(r.version_no, r.content_text) for r in v.handleInputRows((1,), iter([Row(text=t, seen=day(d)) for t, d in rows]), None)]
    assert told(("a", 2), ("c", 3), ("b", 3)) == [(3, "b")] and told(("b", 4)) == [] and told(("x", 3)) == [] and told(("y", 5)) == [(4, "y")]
