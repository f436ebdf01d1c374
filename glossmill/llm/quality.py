"""Operator 13: document quality by Bradley-Terry ranking of pairs.

A labelled document of label 1 is preferred to one of label 0. Each labelled row meets
``OPPONENTS`` rows of the other label, and weights are fitted so that the logistic loss on the pairs'
feature differences is least: Newton's method, each step one job whose tasks add up gradient and
curvature over their blocks of rows, of which the driver gets sums of fixed size. A document's score
is what the weights make of its features. The threshold is the quantile of all labelled rows' scores that
parts the labels with the fewest errors; scores go through a logistic curve that puts it at ``AT``.

Features come from the whole text alone: its length, kinds of characters, words that are short, repeat, or
stand out, lines that repeat, and hashed shapes of words (which kinds of characters a word is made of).

All labelled training rows are learned from, however many; all rows are scored. Labels find their documents through a Bloom filter, so that no text is shuffled.

Edge cases: null and empty texts have all features zero and get their score like any other. Rows
without doc_id, and rows of the held-out fold, are not learned from; neither are labels that are null or
neither 0 nor 1, and documents whose labels differ. With labels of one kind only, or none, there are no pairs, and all
scores are alike: the share of label 1, or a half. Repeated rows get the same score. A carried
column that is named like a result gives way to it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossmill.llm import bytewords
from glossmill.llm.bytewords import Block, mix, slices
from glossmill.llm.frames import IdFilter, crc_mod, pieces, written

BLOCK = 1024  # rows whose labels meet
OPPONENTS = 4
PARTS = 64  # rows of sums that the driver gets at most
RUN = 100_000  # scores that are put in order in one task, about
ROUNDS = 15
AT = 0.3
FOLDS = 5
_RIDGE = 1e-3
_SHAPES = 64
RESULTS = ("held_out", "score", "predicted")

#: Kinds of bytes: small, capital, digit, blank, line feed, marks of a sentence, "!", other signs, beyond ASCII.
_KINDS = 9
_KIND = np.full(256, 7, np.uint8)
for _k, _bytes in enumerate((range(97, 123), range(65, 91), range(48, 58), b" \t\x0b\x0c\r", b"\n", b".,;:?'\"()-", b"!")):
    _KIND[list(_bytes)] = _k
_KIND[128:] = 8
WIDTH = 10 + _KINDS + _SHAPES


def features(texts: pa.Array) -> np.ndarray:
    """(documents, WIDTH): nothing but the texts goes in."""
    block = Block.of(texts)
    data, bounds, n = block.data, block.bounds, block.n_docs
    out = np.zeros((n, WIDTH))
    kind = _KIND[data]
    length = np.diff(bounds)
    doc_of_byte = np.repeat(np.arange(n) * _KINDS, length)
    out[:, 10 : 10 + _KINDS] = np.bincount(doc_of_byte + kind, minlength=n * _KINDS).reshape(n, _KINDS) / np.maximum(length, 1)[:, None]
    doc, size, hashes = block.doc_of_word(), block.ends - block.starts, block.hashes()
    words = np.maximum(block.n_words, 1)
    per_doc = lambda of, weights=None: np.bincount(of, weights=weights, minlength=n)
    out[:, 0], out[:, 1] = np.log1p(length), np.log1p(block.n_words)
    out[:, 2] = per_doc(doc, size) / words
    out[:, 3] = per_doc(doc[size <= 3]) / words
    if len(doc):
        again = np.r_[False, (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])]
        out[:, 4] = per_doc(doc[again]) / words
        order = np.lexsort((hashes, doc))
        first = np.flatnonzero(np.r_[True, (hashes[order][1:] != hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1])])
        times, of = np.diff(np.r_[first, len(doc)]), doc[order][first]
        out[:, 5] = per_doc(of) / words
        top = np.zeros(n)
        np.maximum.at(top, of, times)
        out[:, 6] = top / words
        bits = np.bitwise_or.reduceat(np.left_shift(1, kind.astype(np.int64)) * ((kind != 3) & (kind != 4)), block.starts)
        shape = mix((bits << 8 | kind[block.starts].astype(np.int64) << 4 | kind[block.ends - 1]).astype(np.uint64)) % np.uint64(_SHAPES)
        out[:, 10 + _KINDS :] = np.bincount(doc * _SHAPES + shape.astype(np.int64), minlength=n * _SHAPES).reshape(n, _SHAPES) / words[:, None]
    breaks = np.flatnonzero(kind == 4)
    starts, ends = np.sort(np.r_[bounds[:-1], breaks + 1]), np.sort(np.r_[breaks, bounds[1:]])
    held = ends > starts
    starts, ends = starts[held], ends[held]
    line_doc = np.searchsorted(bounds, starts, side="right") - 1
    up, down = bytewords._powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    line = mix((sums[ends] - sums[starts]) * down[starts])
    order = np.lexsort((line, line_doc))
    lines = per_doc(line_doc)
    if len(line):
        new = np.r_[True, (line[order][1:] != line[order][:-1]) | (line_doc[order][1:] != line_doc[order][:-1])]
        out[:, 7] = per_doc(line_doc[order][new]) / np.maximum(lines, 1)
    out[:, 8] = np.log1p(lines)
    out[:, 9] = np.log1p(block.n_words / np.maximum(lines, 1))
    return out


def _learned(docs: DataFrame, labels: DataFrame, folds: int) -> DataFrame:
    """(block, label, x): the labelled rows, all of which are learned from. ``labels``: doc_id, label."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (crc_mod(F.col("doc_id"), folds) != 0))
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("high")).where("label = high").drop("high")
    n = known.count()
    texts = IdFilter(known, "doc_id").passing(docs)

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1):
                x = features(part.column(1))
                offsets = np.arange(0, x.size + 1, WIDTH, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.ravel()))], ["doc_id", "x"])

    rows = texts.mapInArrow(run, "doc_id long, x array<double>").join(known, "doc_id")
    n_blocks = max(1, n // BLOCK)
    return rows.select(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(n_blocks)).cast("int").alias("block"), "doc_id", F.col("label").cast("int").alias("label"), "x")


def _blocks(learned: DataFrame) -> DataFrame:
    """One row per block, (labels, xs): features as one list. Written once, as every round reads it."""

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("doc_id")
        x = rows["x"].combine_chunks().flatten()
        return pa.table({"labels": pa.array([rows["label"].to_numpy()], pa.list_(pa.int32())), "xs": pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)})

    return written(learned.groupBy("block").applyInArrow(pack, "labels array<int>, xs array<double>"), "quality")


def _of(batch: pa.RecordBatch):
    """Labels and features of each block of a batch."""
    for i in range(batch.num_rows):
        y = batch.column(0)[i].values.to_numpy(zero_copy_only=False)
        yield y, batch.column(1)[i].values.to_numpy(zero_copy_only=False).reshape(len(y), WIDTH)


def _pairs(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Preferred and other row of each pair: every row of the larger label meets OPPONENTS of the smaller."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return good[:0], bad[:0]
    n, small = max(len(good), len(bad)), min(len(good), len(bad))
    at = np.arange(n)
    turns = range(min(OPPONENTS, small))
    large, few = np.tile(at, len(turns)), np.concatenate([(at + at // small + t * max(1, small // len(turns))) % small for t in turns])
    return (good[large], bad[few]) if len(good) == n else (good[few], bad[large])


def _collected(blocks: DataFrame, run, n_values: int) -> np.ndarray:
    """Sums of fixed size over all blocks: ``run`` gives a vector for each."""

    def add(batches):
        total = np.zeros(n_values)
        for batch in batches:
            for y, x in _of(batch):
                total += run(y, x)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    def merge(rows: pa.Table) -> pa.Table:
        return pa.table({"sums": pa.array([_summed(rows["sums"].to_pylist(), n_values).tobytes()], pa.binary())})

    parts = blocks.mapInArrow(add, "sums binary")  # one row a task
    if blocks.rdd.getNumPartitions() > PARTS:
        parts = parts.groupBy(F.pmod(F.xxhash64("sums"), F.lit(PARTS)).alias("part")).applyInArrow(merge, "sums binary")
    return _summed([bytes(r["sums"]) for r in parts.collect()], n_values)


def _summed(sums: list[bytes], n_values: int) -> np.ndarray:
    """The sum in one order, whichever task came first."""
    return np.sum([np.frombuffer(p) for p in sorted(sums)], axis=0) if sums else np.zeros(n_values)


def fitted(docs: DataFrame, labels: DataFrame, folds: int = FOLDS) -> tuple[np.ndarray, float, float]:
    """Weights, threshold and level: a document's score is the logistic curve of weights . features -
    threshold + level. ``docs``: doc_id, text; ``labels``: doc_id, label."""
    blocks = _blocks(_learned(docs, labels, folds))
    moments = _collected(blocks, lambda y, x: np.r_[len(y), (y == 1).sum(), x.sum(axis=0), (x * x).sum(axis=0)], 2 + 2 * WIDTH)
    n, good = moments[:2]
    if not 0 < good < n:
        share = 0.5 if n == 0 else good / n
        return np.zeros(WIDTH), 0.0, float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    mean = moments[2 : 2 + WIDTH] / n
    spread = np.sqrt(np.maximum(moments[2 + WIDTH :] / n - mean * mean, 0))
    scale = np.where(spread > 1e-9, 1 / np.maximum(spread, 1e-9), 0.0)
    w = np.zeros(WIDTH)
    for _ in range(ROUNDS):

        def slope(y, x, w=w):
            a, b = _pairs(y)
            d = (x[a] - x[b]) * scale
            lost = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))
            return np.r_[len(a), -(lost @ d), ((d * (lost * (1 - lost))[:, None]).T @ d).ravel()]

        sums = _collected(blocks, slope, 1 + WIDTH + WIDTH * WIDTH)
        pairs = max(1.0, sums[0])
        gradient = sums[1 : 1 + WIDTH] / pairs + _RIDGE * w
        step = np.linalg.solve(sums[1 + WIDTH :].reshape(WIDTH, WIDTH) / pairs + _RIDGE * np.eye(WIDTH), gradient)
        w = w - step * min(1.0, 5 / max(1e-12, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-4:
            break
    w = w * scale

    def scored(batches):
        for batch in batches:
            for y, x in _of(batch):
                yield pa.RecordBatch.from_arrays([pa.array(x @ w), pa.array(y, pa.int32())], ["s", "y"])

    return w, _threshold(blocks.mapInArrow(scored, "s double, y int")), float(np.log(AT / (1 - AT)))


def _threshold(scores: DataFrame, run: int = RUN) -> float:
    """The quantile of the scores (s, y) that parts the labels with the fewest errors; of several
    that do, the one nearest to the share of label 0.

    Distinct scores are counted and dealt to ranges, within which they are put in order; what stands
    before a range is a sum. The bounds of the ranges are approximate, the counts are not.
    """
    each = written(scores.groupBy("s").agg(F.sum("y").alias("good"), F.count(F.lit(1)).alias("n")), "quality-scores")
    m, low, high, n, good = each.agg(F.count("s"), F.min("s"), F.max("s"), F.sum("n"), F.sum("good")).first()
    bad = n - good
    k = pieces(m, run)
    bounds = sorted(set(each.approxQuantile("s", [i / k for i in range(1, k)], 1 / (4 * k)))) if k > 1 else []
    part = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda bound: bound <= F.col("s"))) if bounds else F.lit(0)
    each = each.withColumn("part", part)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = each.groupBy("part").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))  # a row a range
    sums = sums.select("part", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("n", "good")))
    upto = Window.partitionBy("part").orderBy("s")
    below = each.join(F.broadcast(sums), "part").select("s", *((F.sum(c).over(upto) + F.col(f"{c}_before")).alias(c) for c in ("n", "good")))
    # Errors if the rows up to s are taken for 0.
    errors = F.col("good") + F.lit(bad) - (F.col("n") - F.col("good"))
    best = below.agg(F.min(F.struct(errors.alias("errors"), F.abs(F.col("n") - F.lit(bad)).alias("off"), "n", "s")).alias("best")).first()["best"]
    if (bad, bad, 0) <= (best["errors"], best["off"], best["n"]):  # none is taken for 0
        return float(low - 1)
    if best["n"] == n:
        return float(high + 1)
    return float((best["s"] + each.where(F.col("s") > F.lit(best["s"])).agg(F.min("s")).first()[0]) / 2)


def rank(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", carry: tuple[str, ...] = (), folds: int = FOLDS
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, and the columns of ``carry``. ``labels`` holds
    doc_id and the label by name."""
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    marks = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    model = docs.sparkSession.sparkContext.broadcast(fitted(named, marks, folds))  # WIDTH + 2 numbers
    kinds = dict(docs.dtypes)
    carry = tuple(c for c in carry if c.lower() not in (*RESULTS, "doc_id"))

    def run(batches):
        w, threshold, level = model.value
        for batch in batches:
            for part in slices(batch, 1):
                score = 1 / (1 + np.exp(-np.clip(features(part.column(1)) @ w - threshold + level, -500, 500)))
                columns = [part.column(0), *part.columns[2:], pa.array(score), pa.array((score >= AT).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *carry, "score", "predicted"])

    schema = ", ".join(["doc_id long", *(f"`{c}` {kinds[c]}" for c in carry), "score double", "predicted int"])
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), *(F.col(c) for c in carry))
    held_out = F.coalesce(crc_mod(F.col("doc_id"), folds) == 0, F.lit(False))
    return rows.mapInArrow(run, schema).select("doc_id", *carry, held_out.alias("held_out"), "score", "predicted")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return rank(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")).select("doc_id", "held_out", "score", "predicted")
