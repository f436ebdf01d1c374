"""Streams with state: breakers by run, and tables that a stream merges into."""

import pytest
from pyspark.sql import functions as F

from glossmill.operators import batching
from glossmill.operators.quality import Violation
from glossmill.streaming import breaker, tables

EVENT = "run string, seq long, ok boolean"


def runs(out, cp, spark, folder, limit=3, keep=None):
    stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).json(str(folder))
    told = breaker.broken_runs(stream, "run", "seq", limit)
    writer = told.writeStream.trigger(availableNow=True).option("checkpointLocation", str(cp))
    query = writer.foreachBatch(keep).start() if keep else writer.format("parquet").option("path", str(out)).start()
    query.awaitTermination(180)
    return query


def add(spark, folder, run, oks, start):
    spark.createDataFrame([(run, start + i, ok) for i, ok in enumerate(oks)], EVENT).coalesce(1).write.mode("append").json(str(folder))


def test_runs_break_apart_and_go_on_after_a_restart(spark, tmp_path):
    folder, out, cp = tmp_path / "in", tmp_path / "out", tmp_path / "cp"
    add(spark, folder, "a", [True, False, False], 0)
    add(spark, folder, "b", [False, True, False], 0)
    runs(out, cp, spark, folder)
    add(spark, folder, "a", [False, True], 3)  # the third failure in a row lies in another run of the stream
    add(spark, folder, "b", [True, False, False], 3)
    runs(out, cp, spark, folder)
    got = {(r["run"], r["seq"]): (r["failures"], r["open"]) for r in spark.read.parquet(str(out)).collect()}
    rows = spark.read.schema(EVENT).json(str(folder))
    want = {(r["run"], r["seq"]): (r["failures"], r["open"]) for r in batching.failure_runs(rows, "run", "seq", F.col("ok"), 3).collect()}
    assert got == want and got[("a", 3)] == (3, True) and got[("a", 4)] == (0, True) and got[("b", 5)] == (2, False)


def test_a_stream_stops_when_every_run_has_broken(spark, tmp_path):
    folder, kept = tmp_path / "in", str(tmp_path / "kept")
    add(spark, folder, "a", [False] * 4, 0)
    keep = breaker.halting(lambda batch, number: batch.write.mode("append").parquet(kept), "run")
    with pytest.raises(Exception, match="stopped"):
        runs(None, tmp_path / "cp", spark, folder, keep=keep)
    assert spark.read.parquet(kept).count() == 4  # what was in flight is recorded


ROW = "key string, t string, at long"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), ROW)


def test_a_batch_touches_its_own_buckets_alone(spark, tmp_path):
    table = tables.Table(spark, str(tmp_path / "t"), "key", ROW, buckets=8)
    assert table.read().count() == 0
    assert len(table.merge(frame(spark, *((f"k{i}", "x", i) for i in range(200))), 0)) == 8
    before = table.pointer()["folders"]
    touched = table.merge(frame(spark, ("k1", "y", 1), ("new", "z", 2), ("new", "zz", 3)), 1, order="at")
    after = table.pointer()["folders"]
    assert {int(b) for b in after if after[b] != before[b]} == set(touched) and len(touched) <= 2
    rows = {r["key"]: r["t"] for r in table.read().collect()}
    assert len(rows) == 201 and rows["k1"] == "x" and rows["new"] == "z"
    assert table.merge(frame(spark, ("k1", "other", 1)), 1) == [] and table.pointer()["version"] == 1  # run again
    table.merge(frame(spark, ("k1", "later", 1), ("k1", "last", 2)), 2, later_wins=True, order="at")
    assert {r["key"]: r["t"] for r in table.read().collect()}["k1"] == "last"
    assert table.merge(frame(spark), 3) == [] and table.read().count() == 201
    gone = table.release(keep=1)
    assert gone >= len(touched) and table.read().count() == 201 and table.release(keep=1) == 0


def test_a_second_writer_is_told(spark, tmp_path):
    one, two = (tables.Table(spark, str(tmp_path / "t"), "key", ROW, buckets=2) for _ in range(2))
    one.merge(frame(spark, ("a", "x", 0)), 0)
    stale = two.pointer()
    one.merge(frame(spark, ("b", "x", 0)), 1)
    two.pointer = lambda number=None: stale
    with pytest.raises(Violation):
        two.merge(frame(spark, ("c", "x", 0)), 1)
    assert {r["key"] for r in one.read().collect()} == {"a", "b"}


def test_a_stream_merges_into_a_table(spark, tmp_path):
    table = tables.Table(spark, str(tmp_path / "t"), "key", ROW, buckets=4)
    for n in range(3):
        frame(spark, ("a", f"a{n}", n), (f"k{n}", "x", n)).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    stream = spark.readStream.schema(ROW).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    query = stream.writeStream.foreachBatch(table.sink(later_wins=True, order="at")).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    query.awaitTermination(180)
    assert {r["key"] for r in table.read().collect()} == {"a", "k0", "k1", "k2"}
