"""Operators 3 and 7 against brute force."""

import numpy as np
import pytest

from glossmill.llm import forest, neighbours

NAN = float("nan")


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((40, 16))
    rows = {i: (centres[rng.integers(40)] + 0.25 * rng.standard_normal(16)).astype(np.float32) for i in range(500)}
    for i in range(500, 560):
        rows[i] = rows[7]
    return rows


@pytest.fixture(scope="module")
def frame(spark, vectors):
    odd = [(900, None), (901, [0.0] * 16), (902, [1.0] * 15 + [NAN]), (903, [1.0] * 15 + [None]), (904, [float("inf")] + [1.0] * 15), (905, [1.0, 2.0])]  # the last has a length of its own
    rows = [(i, [float(x) for x in v], i % 3) for i, v in vectors.items()] + [(i, v, 0) for i, v in odd]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, rep int")


def test_near_duplicates(frame, vectors):
    ids = np.array(sorted(vectors))
    unit = np.array([vectors[i] for i in ids], np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root, np.where(near, root[None, :], len(ids)).min(axis=1))
        if (low == root).all():
            break
        root = low
    got = {r["vec_id"]: r for r in forest.near_duplicates(frame, leaf=80).collect()}
    assert len(got) == len(ids) + 6
    for k, i in enumerate(ids):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (near[k].sum(), ids[root[k]], root[k] == k)
    for i in range(900, 906):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)


def test_leaves_are_grown_level_by_level(spark):
    rng = np.random.default_rng(12)
    unit = rng.standard_normal((4000, 24))
    unit[2000:] = unit[:2000] + 0.2 * rng.standard_normal((2000, 24))  # pairs
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(unit)], "vec_id long, embedding array<double>")
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    got = {r["vec_id"]: r["n_links"] for r in forest.near_duplicates(table, leaf=60, sample_rows=200, most_rows=150).collect()}
    found, true = sum(got.values()), int(near.sum())
    assert all(got[i] <= near[i].sum() for i in got) and found >= 0.95 * true > 3000


@pytest.mark.parametrize("close", [0.99, 0.93])
def test_near_duplicates_in_one_large_group(spark, close):
    rng = np.random.default_rng(4)
    unit = rng.standard_normal((3000, 64))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    unit[:1000] = np.sqrt(close) * unit[0] + np.sqrt(1 - close) * unit[:1000]
    unit = unit.astype(np.float32)
    table = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(unit)], "vec_id long, embedding array<float>")
    unit = unit.astype(np.float64) / np.linalg.norm(unit.astype(np.float64), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    got = {r["vec_id"]: r for r in forest.near_duplicates(table, leaf=60).collect()}
    assert [got[i]["n_links"] for i in range(len(unit))] == near.sum(axis=1).tolist()
    assert {got[i]["component_id"] for i in range(1000)} == {0}


def test_nearest(frame, vectors):
    ids = np.array(sorted(vectors))
    all_ = np.array([vectors[i] for i in ids], np.float64)
    got: dict = {}
    for r in neighbours.nearest(frame, frame.where("vec_id % 20 = 0"), shard_rows=150, query_rows=10).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {i for i in ids if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [rank for rank, _, _ in found] == list(range(1, 21))
        scores = np.cumsum(all_ * vectors[q].astype(np.float64), axis=1)[:, -1]
        by_id = dict(zip(ids.tolist(), scores.tolist()))
        assert all(s == by_id[v] and v != q for _, v, s in found)
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        best = [ids[k] for k in np.lexsort((ids, -scores)) if ids[k] != q][:20]
        hits += len(set(best) & {v for _, v, _ in found})
    assert hits >= 0.97 * 20 * len(got)


def test_nearest_breaks_ties_by_id(spark):
    rows = spark.createDataFrame([(i, [float(i == j) for j in range(300)]) for i in range(300)], "vec_id long, embedding array<float>")
    for q in (0, 100):
        got = [r["vec_id"] for r in neighbours.nearest(rows, rows.where(f"vec_id = {q}")).orderBy("rank").collect()]
        assert got == list(range(1, 21)) if q == 0 else got == list(range(20))


def test_nearest_stops_before_it_has_seen_all(spark):
    rng = np.random.default_rng(9)
    every = rng.standard_normal((60, 32))[rng.integers(0, 60, 6000)] + 0.3 * rng.standard_normal((6000, 32))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(every)], "vec_id long, embedding array<double>")
    got = neighbours.nearest(rows, rows.where("vec_id % 150 = 0"), report=True).collect()
    assert np.mean([r["verified"] for r in got if r["rank"] == 1]) < 0.5 * len(every)
    hits = 0
    for q in range(0, 6000, 150):
        scores = every @ every[q]
        scores[q] = -np.inf
        hits += len(set(np.argsort(-scores)[:20].tolist()) & {r["vec_id"] for r in got if r["query_id"] == q})
    assert hits >= 0.95 * 20 * 40


def test_vectors_of_several_lengths_and_repeated_ids(spark):
    short = [(i, [1.0, 0.01 * i]) for i in range(6)]
    rows = [*short, (6, [1.0, 0.0, 0.0]), (7, [1.0, 0.0, 0.1]), (8, [2.0] * 9), (2, short[2][1]), (2, short[2][1]), (None, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in forest.near_duplicates(frame).collect()}
    assert got == {**{i: (7, 0, i == 0) for i in range(6)}, 6: (1, 6, True), 7: (1, 6, False), 8: (0, 8, True)}
    found = neighbours.nearest(frame, frame.where("vec_id IN (2, 6, 8)")).collect()
    assert {(r["query_id"], r["vec_id"]) for r in found} == {(2, i) for i in (0, 1, 3, 4, 5)} | {(6, 7)}


def test_double_precision(spark):
    edge = float(np.tan(np.arccos(0.9)))
    near, far = edge * (1 - 1e-9), edge * (1 + 1e-9)
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, near]), (2, [1.0, -far])], "vec_id long, embedding array<double>")
    assert {r["vec_id"]: r["n_links"] for r in forest.near_duplicates(frame).collect()} == {0: 1, 1: 1, 2: 0}


def test_fewer_candidates_than_wanted(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0])], "vec_id long, embedding array<float>")
    got = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in neighbours.nearest(rows, rows.where("vec_id = 0")).collect()}
    assert got == {(0, 1, 1, 1.0), (0, 2, 2, 0.0)}


def test_chi_square():
    assert neighbours.chi_square(np.array([15.507]), 8)[0] == pytest.approx(0.95, abs=1e-4)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert forest.near_duplicates(empty).isEmpty()
    assert neighbours.nearest(empty, empty).isEmpty()


def test_rows_of_one_id_with_different_vectors_are_candidates_each(spark):
    rows = [(20, [1.0, 0.0]), (1, [0.2, 0.0]), (1, [0.9, 0.1]), (1, [0.9, 0.1]), (3, [0.5, 0.0]), (20, [0.4, 0.4])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(frame, frame.where("vec_id = 20 AND embedding[0] = 1")).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in got] == [(1, 1, 0.9), (2, 3, 0.5), (3, 20, 0.4), (4, 1, 0.2)]
    both = neighbours.nearest(frame, frame.where("vec_id = 20"), k=2).collect()
    assert sorted((r["rank"], r["vec_id"]) for r in both) == [(1, 1), (1, 1), (2, 3), (2, 20)]
