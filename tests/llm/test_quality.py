"""Operator 13: held-out accuracy, the fit against plain gradient descent, and awkward rows."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from glossmill.llm import quality

DOCS, LABELS = "doc_id long, text string", "doc_id long, quality int"
GOOD = "The words of a plain text follow one another, and here is number {}. It ends well."
BAD = "a{}### b*** c%%% | d$$$ | e&&& | X!! Y!! Z!! ###"


def rows(n, odd=()):
    """Three good texts for each bad one."""
    texts = [(i, (BAD if i % 4 == 0 else GOOD).format(i) * (1 + i % 3)) for i in range(n)]
    return [*texts, *odd], [(i, int(i % 4 != 0)) for i in range(n)]


def test_held_out_labels_of_the_test_data(spark):
    folder = "/root/testdata/sf0.01"
    got = quality.query(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").toPandas()
    out = got[got.held_out]
    assert len(out) > 50 and (out.predicted == out.quality).mean() >= 0.97
    assert ((got.predicted == 1) == (got.score >= 0.3)).all() and got.score.between(0, 1).all()


def test_one_row_a_document_whatever_the_rows(spark):
    odd = [(None, "no id"), (900, None), (901, ""), (902, "   \n\t"), (903, "word " * 200_000), (904, "x" * 300_000), (4, BAD.format(4)), (4, BAD.format(4))]
    texts, labels = rows(200, odd)
    labels += [(8, 1), (12, None), (13, 7), (None, 0), (10**6, 1), (16, 0)]  # 8 is told both ways, 16 twice the same
    docs = spark.createDataFrame([(i, t, "x", 5) for i, t in texts], f"{DOCS}, score string, block int")
    marks = spark.createDataFrame(labels, LABELS)
    got = quality.rank(docs, marks, carry=("score", "block"))
    assert got.columns == ["doc_id", "block", "held_out", "score", "predicted"]
    found = got.collect()
    assert len(found) == len(texts) and all(r["block"] == 5 and 0 <= r["score"] <= 1 for r in found)
    assert {r["held_out"] for r in found if r["doc_id"] is None} == {False}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found if r["doc_id"] is not None)
    right = [r["predicted"] == int(r["doc_id"] % 4 != 0) for r in found if r["doc_id"] is not None and r["doc_id"] < 200]
    assert np.mean(right) == 1.0
    assert len({r["score"] for r in found if r["doc_id"] == 4 and r["predicted"] == 0}) >= 1
    empty = {r["score"] for r in found if r["doc_id"] in (900, 901)}
    assert len(empty) == 1  # a null text is an empty one


@pytest.mark.parametrize("labels, share", [([(1, 1), (2, 1)], 1.0), ([(1, 0)], 0.0), ([], 0.5)])
def test_labels_of_one_kind_give_one_score(spark, labels, share):
    docs = spark.createDataFrame([(i, GOOD.format(i)) for i in range(5)], DOCS)
    got = quality.rank(docs, spark.createDataFrame(labels, LABELS), folds=10**9).collect()
    assert {round(r["score"], 5) for r in got} == {share} and {r["predicted"] for r in got} == {int(share >= 0.3)}


def test_nothing(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, 1), (2, 0)], LABELS)
    assert quality.rank(docs, labels).isEmpty()


def test_the_fit_is_that_of_plain_descent(spark):
    rng = np.random.default_rng(0)
    words = ["the", "of", "word###", "X!!", "and,", "text", "|", "12"]
    texts = [(i, " ".join(rng.choice(words, 30, p=None if i % 3 else [0.05, 0.05, 0.2, 0.2, 0.05, 0.05, 0.2, 0.2]))) for i in range(240)]
    labels = [(i, int(i % 3 != 0) if i % 10 else int(i % 20 == 0)) for i in range(240)]  # some of them wrong
    docs, marks = spark.createDataFrame(texts, DOCS), spark.createDataFrame(labels, "doc_id long, label int")
    w, threshold, level = quality.fitted(docs, marks)
    train = [(t, dict(labels)[i]) for i, t in sorted(texts) if zlib.crc32(str(i).encode()) % 5]
    x, y = quality.features(pa.array([t for t, _ in train])), np.array([label for _, label in train])
    spread = x.std(axis=0)
    scale = np.where(spread > 1e-9, 1 / np.maximum(spread, 1e-9), 0)
    a, b = quality._pairs(y)
    d, plain = (x[a] - x[b]) * scale, np.zeros(quality.WIDTH)
    for _ in range(20_000):
        lost = 1 / (1 + np.exp(d @ plain))
        plain -= 0.05 * (-(lost @ d) / len(d) + 1e-3 * plain)
    assert np.corrcoef(x @ w, x @ (plain * scale))[0, 1] > 0.999
    s = x @ w
    errors = lambda t: int(((s >= t) != (y == 1)).sum())
    assert errors(threshold) == min(errors(t) for t in [*s, s.max() + 1])
    assert level == pytest.approx(np.log(0.3 / 0.7))


def test_pairs_meet_the_other_label_and_every_row_of_the_larger():
    for y in ([1, 0], [1] * 9 + [0] * 4, [0] * 30 + [1] * 7, [1, 0, 1, 0, 0]):
        y = np.array(y)
        a, b = quality._pairs(y)
        assert (y[a] == 1).all() and (y[b] == 0).all() and len(set(zip(a.tolist(), b.tolist()))) == len(a)
        assert set(a if (y == 1).sum() >= (y == 0).sum() else b) == set(np.flatnonzero(y == int((y == 1).sum() >= (y == 0).sum())))
    assert len(quality._pairs(np.ones(4))[0]) == 0


def test_features_see_repeated_words_and_lines():
    x = quality.features(pa.array(["a b c\nd e f", "a a a\na a a\na a a", None, "A1! |"]))
    assert x[0, 5] == 1 and x[1, 5] == pytest.approx(1 / 9) and x[1, 6] == 1 and x[1, 7] == pytest.approx(1 / 3) and x[0, 7] == 1
    assert (x[2] == 0).all() and x[3, 10:19].tolist() == pytest.approx([0, 0.2, 0.2, 0.2, 0, 0, 0.2, 0.2, 0])
    alone = quality.features(pa.array(["A1! |"]))
    assert np.array_equal(alone[0], x[3])  # whatever stands beside it


def test_every_labelled_row_is_learned_from(spark):
    n, wide = 51_000, 1_000_000
    # All rows of label 0 stand where a sample of 50,000 rows by a hash of the id would not look.
    ids = spark.range(n).selectExpr("id AS doc_id", f"pmod(xxhash64(id), {wide}) < {int(wide * 50_000 / n)} AS good")
    docs = ids.selectExpr("doc_id", f"CASE WHEN good THEN '{GOOD.format(1)}' ELSE '{BAD.format(1)}' END AS text")
    labels = ids.selectExpr("doc_id", "CAST(good AS int) AS quality")
    got = quality.rank(docs, labels, folds=10**9).join(labels, "doc_id").groupBy("quality", "predicted").count().collect()
    assert {(r["quality"], r["predicted"]) for r in got} == {(0, 0), (1, 1)} and sum(r["count"] for r in got) == n


@pytest.mark.parametrize("run", [10**6, 40])
def test_the_threshold_has_the_fewest_errors_of_all_scores(spark, run):
    rng = np.random.default_rng(3)
    for labels in (lambda s: s + rng.normal(0, 1, len(s)) > 0.4, lambda s: s > 9, lambda s: s < 9, lambda s: s < 0):
        s = np.round(rng.normal(0, 1, 700), 2)
        y = labels(s).astype(int)
        got = quality._threshold(spark.createDataFrame(list(zip(s.tolist(), y.tolist())), "s double, y int"), run)
        places = [s.min() - 1, *((a + b) / 2 for a, b in zip(np.unique(s), np.unique(s)[1:])), s.max() + 1]
        found = [(int(((s >= t) != (y == 1)).sum()), abs(int((s < t).sum()) - int((y == 0).sum())), int((s < t).sum()), t) for t in places]
        assert got == pytest.approx(min(found)[3], abs=1e-12)
