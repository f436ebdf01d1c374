"""Greedy batches against the plain fold, with blocks small enough that groups span several levels."""

import random

import pytest
from pyspark.sql import functions as F

from glossmill.operators import batching, folds


def plain(sizes, max_rows, max_size):
    out, batch, n, total = [], 0, 0, 0
    for size in sizes:
        if n and (n >= max_rows or total + size > max_size):
            batch, n, total = batch + 1, 0, 0
        n, total = n + 1, total + size
        out.append(batch)
    return out


@pytest.mark.parametrize("block, long", [(6, 10**6), (16, 50)])
def test_batches_as_the_plain_fold_gives_them(spark, monkeypatch, block, long):
    monkeypatch.setattr(folds, "BLOCK", block)
    monkeypatch.setattr(folds, "LONG", long)
    rng = random.Random(block)
    groups = {"a": 200, "b": 1, None: 9, "c": 33}
    rows = [(g, i, rng.choice([0, 1, 5, 40, 90, 130]), f"x{i}") for g, n in groups.items() for i in range(n)]
    given = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "g string, at int, size int, batch_name string")
    for max_rows, max_size in ((5, 120),):
        got = batching.greedy_batches(given, "g", "at", "size", max_rows, max_size)
        assert got.columns == ["g", "at", "size", "batch_name", "batch"]
        found = got.collect()
        for g in groups:
            own = sorted((r["at"], r["size"], r["batch"]) for r in found if r["g"] == g)
            assert [b for *_, b in own] == plain([s for _, s, _ in own], max_rows, max_size), (g, max_rows)


def test_equal_rows_and_null_sizes(spark):
    given = spark.createDataFrame([("a", 1, None)] * 5 + [("a", 2, 7)] * 3, "g string, at int, size int")
    got = sorted(r["batch"] for r in batching.greedy_batches(given, "g", "at", "size", 2, 10).collect())
    assert got == [0, 0, 1, 1, 2, 3, 4, 5] or got == plain([0, 0, 0, 0, 0, 7, 7, 7], 2, 10)
    assert batching.greedy_batches(given.limit(0), "g", "at", "size", 2, 10).count() == 0


def test_a_group_of_many_rows_is_folded_in_many_tasks_without_python(spark):
    rows = spark.range(0, 200_000, 1, 8).select(F.lit("hot").alias("g"), F.col("id").alias("at"), (F.col("id") * 7919 % 300).alias("size"))
    got = batching.greedy_batches(rows, "g", "at", "size", 12, 1600)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    want = plain([i * 7919 % 300 for i in range(200_000)], 12, 1600)
    ends = got.groupBy("batch").agg(F.min("at").alias("a"), F.count("at").alias("n")).toPandas().sort_values("batch")
    assert len(ends) == want[-1] + 1 and ends["n"].sum() == len(want)
    assert all(want[a] == b and (a == 0 or want[a - 1] == b - 1) for a, b in zip(ends["a"], ends["batch"]))


def test_chunks_of_long_groups_are_those_of_short_ones(spark, monkeypatch):
    rows = spark.range(600).select((F.col("id") % 7 == 0).alias("g"), F.col("id").alias("at"))
    want = sorted(tuple(r) for r in batching.fixed_chunks(rows, "g", "at", 12).collect())
    monkeypatch.setattr(folds, "LONG", 100)
    assert sorted(tuple(r) for r in batching.fixed_chunks(rows, "g", "at", 12).collect()) == want
    assert sorted(r["place"] for r in batching.ranked(rows, ["at"], "place").collect()) == list(range(1, 601))
