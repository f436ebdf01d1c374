"""Operator 8: language identification by a linear-chain conditional random field.

Each word of a text is a place of the chain and gets a language. Its score for a language is a sum
of learned weights of affixes (up to three bytes at either end), n-grams (two and three bytes) and
a lexicon entry (the whole word); neighbours are tied by learned transitions. Forward-backward
gives each word's marginals, so a text that switches language is labelled span by span, and the
text's language is the one with the largest mean marginal over words that hold a letter.

The weights are fitted on at most ``per_language`` whole training rows of each language (a
documented parameter), dealt to ``SHARDS`` tasks: in each round every task fits its rows from the
weights of the round before, and the weights are averaged. Spans of different languages are laid end
to end in training, so that transitions are learned from switches too. Prediction reads every whole
text and nothing but the text.

Edge cases: text null, empty or without a letter (Unicode category L): ``und`` with score 0. With no
labelled row, or a single language, that is all there is to predict. Rows without lang are not
learned from; rows without doc_id count as neither held out nor training rows. Repeated rows get the
same result; equal scores go to the language that sorts first. Carried columns that are named like a
result give way to it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossmill.llm.bytewords import Block, mix, slices, word_hashes
from glossmill.llm.frames import crc_mod, cut

BUCKETS = 1 << 16
UNKNOWN = "und"
PER_LANGUAGE = 200
SHARDS, ROUNDS, EPOCHS = 8, 3, 2
_SEGMENT = 512
RESULTS = ("lang_pred", "score", "n_switches")
_LETTER = regex.compile(r"\p{L}")
_FIXED = 7
_LETTERISH = np.zeros(256, bool)
_LETTERISH[128:] = True
_LETTERISH[[*range(65, 91), *range(97, 123)]] = True


def _features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weight rows of each word: (words, 7) for affixes and lexicon, (bytes, 2) for n-grams, and
    where each word's bytes begin. Row BUCKETS stands for nothing."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    n = ends - starts

    def row(kind: int, value: np.ndarray) -> np.ndarray:
        return (mix(value ^ np.uint64(kind << 56)) % np.uint64(BUCKETS)).astype(np.int32)

    fixed = np.empty((len(starts), _FIXED), np.int32)
    for k in (1, 2, 3):
        mask = np.uint64((1 << 8 * k) - 1)
        for side, at in enumerate((starts, ends - k)):
            value = row(2 * k + side, eights[np.maximum(at, 0)] & mask)
            fixed[:, 2 * (k - 1) + side] = np.where(n >= k, value, BUCKETS)
    fixed[:, 6] = (word_hashes(data, starts, ends) % np.uint64(BUCKETS)).astype(np.int32)
    begin = np.cumsum(n) - n
    within = np.arange(int(n.sum())) - np.repeat(begin, n)
    flat, left = np.repeat(starts, n) + within, np.repeat(n, n) - within
    grams = np.empty((len(flat), 2), np.int32)
    for j, k in enumerate((2, 3)):
        grams[:, j] = np.where(left >= k, row(8 + k, eights[flat] & np.uint64((1 << 8 * k) - 1)), BUCKETS)
    return fixed, grams, begin


def plain(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which words hold a letter of A-Z or a-z."""
    held = np.r_[0, np.cumsum(_LETTERISH[data] & (data < 128))]
    return held[ends] > held[starts]


def _emissions(weights: np.ndarray, fixed: np.ndarray, grams: np.ndarray, begin: np.ndarray) -> np.ndarray:
    if not len(fixed):
        return np.zeros((0, weights.shape[1]), np.float32)
    out = np.zeros((len(fixed), weights.shape[1]), np.float32)
    for j in range(_FIXED):
        out += weights[fixed[:, j]]
    return out + np.add.reduceat(weights[grams[:, 0]] + weights[grams[:, 1]], begin, axis=0)


def _marginals(scores: np.ndarray, moves: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of every place, for many chains at once, and the expected moves summed.

    Chains are cut into segments, which go side by side, longest first; each step of the recursion
    takes all that still run. What enters a segment from either side comes from the products of the
    segments' own matrices, so a long chain takes no more steps than a segment.
    """
    p = np.exp(scores - scores.max(axis=1, keepdims=True)) if len(scores) else scores
    step = np.exp(moves - moves.max())
    ahead, back = np.empty_like(p), np.empty_like(p)
    lengths = np.diff(bounds)
    parts = -(-lengths // _SEGMENT)
    chain = np.repeat(np.arange(len(lengths)), parts)
    nth = np.arange(len(chain)) - np.repeat(np.cumsum(parts) - parts, parts)
    first = bounds[chain] + nth * _SEGMENT
    sizes = np.minimum(_SEGMENT, bounds[chain + 1] - first)
    order = np.argsort(-sizes, kind="stable")
    longest = int(sizes.max(initial=0))
    running = np.searchsorted(-sizes[order], -np.arange(longest + 1), side="left")  # segments longer than t
    enter, leave = np.ones((len(chain), p.shape[1]), p.dtype), np.ones((len(chain), p.shape[1]), p.dtype)
    several = order[parts[chain[order]] > 1]
    if len(several):
        whole = np.empty((len(chain), p.shape[1], p.shape[1]), p.dtype)
        counts = np.searchsorted(-sizes[several], -np.arange(longest), side="left")
        product = np.zeros((len(several), p.shape[1], p.shape[1]), p.dtype)
        for t in range(longest):
            now = p[first[several[: counts[t]]] + t][:, None, :]
            if t == 0:
                product = np.where((nth[several] == 0)[:, None, None], np.eye(p.shape[1], dtype=p.dtype), step) * now
            else:
                product[: counts[t]] = (product[: counts[t]] @ step) * now
            product[: counts[t]] /= product[: counts[t]].sum(axis=(1, 2), keepdims=True)
        whole[several] = product
        by_nth = [np.flatnonzero(nth == i) for i in range(1, int(parts.max()))]
        for at in by_nth:
            value = np.einsum("si,sij->sj", enter[at - 1], whole[at - 1])
            enter[at] = value / value.sum(axis=1, keepdims=True)
        for at in reversed(by_nth):
            value = np.einsum("sij,sj->si", whole[at], leave[at])
            leave[at - 1] = value / value.sum(axis=1, keepdims=True)
    for t in range(longest):
        own = order[: running[t]]
        at = first[own] + t
        now = p[at] * (np.where((nth[own] == 0)[:, None], 1.0, enter[own] @ step) if t == 0 else ahead[at - 1] @ step)
        ahead[at] = now / now.sum(axis=1, keepdims=True)
    for t in range(longest - 1, -1, -1):
        ends = order[running[t + 1] : running[t]]
        back[first[ends] + t] = leave[ends]
        at = first[order[: running[t + 1]]] + t
        value = (p[at + 1] * back[at + 1]) @ step.T
        back[at] = value / value.sum(axis=1, keepdims=True)
    followed = np.ones(len(p), bool)
    followed[bounds[1:][lengths > 0] - 1] = False
    at = np.flatnonzero(followed)
    beyond = p[at + 1] * back[at + 1]
    weight = ((ahead[at] @ step) * beyond).sum(axis=1, keepdims=True)
    total = step * (ahead[at].T @ (beyond / np.maximum(weight, 1e-30)))
    both = ahead * back
    return both / np.maximum(both.sum(axis=1, keepdims=True), 1e-30), total


def _start(n_langs: int) -> list[np.ndarray]:
    """Weights (BUCKETS + 1, languages), moves (languages, languages), and AdaGrad's sums for both."""
    weights, moves = np.zeros((BUCKETS + 1, n_langs), np.float32), np.zeros((n_langs, n_langs), np.float32)
    return [weights, moves, np.full_like(weights, 1e-3), np.full_like(moves, 1e-3)]


def _fit(model: list[np.ndarray], texts: pa.Array, labels: np.ndarray, epochs: int, seed: int, rate: float = 0.3) -> list[np.ndarray]:
    """The model after some epochs over these texts, by AdaGrad."""
    rng = np.random.default_rng(seed)
    block = Block.of(texts, lower=True)
    spans = []
    for d in range(block.n_docs):
        a, end = block.word_bounds[d], block.word_bounds[d + 1]
        while a < end:
            b = min(end, a + int(rng.integers(5, 80)))
            spans.append((a, b, labels[d]))
            a = b
    weights, moves, seen, seen_moves = (x.copy() for x in model)
    n_langs = len(moves)
    for _ in range(epochs):
        order = rng.permutation(len(spans))
        for i in range(0, len(order), 192):
            chosen = [spans[j] for j in order[i : i + 192]]
            words = np.concatenate([np.arange(a, b) for a, b, _ in chosen])
            gold = np.concatenate([np.full(b - a, y) for a, b, y in chosen])
            cuts = np.cumsum([0, *(b - a for a, b, _ in chosen)])[[*range(0, len(chosen), 3), len(chosen)]]
            fixed, grams, begin = _features(block.data, block.starts[words], block.ends[words])
            marginals, expected = _marginals(_emissions(weights, fixed, grams, begin), moves, cuts)
            off = marginals.astype(np.float32)
            off[np.arange(len(gold)), gold] -= 1
            inner = np.ones(len(gold), bool)
            inner[cuts[:-1]] = False
            real = np.zeros_like(moves)
            at = np.flatnonzero(inner)
            np.add.at(real, (gold[at - 1], gold[at]), 1)
            n = len(gold)
            each = np.repeat(np.arange(n), np.diff(np.r_[begin, len(grams)]))
            rows = np.concatenate([fixed.ravel(), grams.ravel()])
            owner = np.concatenate([np.repeat(np.arange(n), _FIXED), np.repeat(each, 2)])
            for y in range(n_langs):
                g = np.bincount(rows, weights=off[owner, y], minlength=BUCKETS + 1).astype(np.float32) / 192
                seen[:, y] += g * g
                weights[:, y] -= rate * g / np.sqrt(seen[:, y])
            weights[BUCKETS] = 0
            g = ((expected - real) / 192).astype(np.float32)
            seen_moves += g * g
            moves -= rate * g / np.sqrt(seen_moves)
    return [weights, moves, seen, seen_moves]


def _sample(docs: DataFrame, per_language: int, folds: int) -> tuple[DataFrame, list[str]]:
    """(shard, at, lang, text) of at most ``per_language`` training rows of each language, spread by
    a hash of the row; and the languages in order."""
    train = docs.where((crc_mod(F.col("doc_id"), folds) != 0) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    wide = 1_000_000
    wanted = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, min(wide, math.ceil(1.3 * wide * per_language / n) + 1)))) if counts else F.create_map().cast("map<string,int>")
    rows = train.withColumn("at", F.xxhash64("doc_id", "text")).where(F.pmod("at", F.lit(wide)) < wanted[F.col("lang")])
    first = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("at", F.lit(wide)), "at", "text"))
    taken = rows.withColumn("nth", first).where(F.col("nth") <= per_language)
    return taken.select(F.pmod("nth", F.lit(SHARDS)).cast("int").alias("shard"), "at", "lang", "text"), sorted(counts)


def fitted(docs: DataFrame, per_language: int, folds: int) -> tuple[list[str], np.ndarray | None, np.ndarray | None]:
    """Languages, weights and moves. ``docs``: doc_id, text, lang."""
    sample, names = _sample(docs, per_language, folds)
    if len(names) < 2:
        return names, None, None
    sample, model = cut(sample), _start(len(names))
    shapes = [x.shape for x in model]
    for turn in range(ROUNDS):
        given = docs.sparkSession.sparkContext.broadcast(model)  # languages x 131,074 numbers

        def fit(group: pa.Table) -> pa.Table:
            group = group.sort_by([("at", "ascending"), ("lang", "ascending"), ("text", "ascending")])
            labels = np.array([names.index(x) for x in group["lang"].to_pylist()])
            new = _fit(given.value, group["text"], labels, EPOCHS, SHARDS * turn + group["shard"][0].as_py())
            return pa.table({f"x{i}": pa.array([x.tobytes()], pa.binary()) for i, x in enumerate(new)})

        dealt = sample.repartition(2 * SHARDS, "shard")  # so many on purpose: small partitions would be put into one task
        rows = dealt.groupBy("shard").applyInArrow(fit, "x0 binary, x1 binary, x2 binary, x3 binary").collect()  # at most SHARDS
        rows = sorted(rows)  # so that sums don't depend on which came first
        model = [np.mean([np.frombuffer(r[i], np.float32).reshape(shape) for r in rows], axis=0, dtype=np.float64).astype(np.float32) for i, shape in enumerate(shapes)]
        given.destroy()
    return names, model[0], model[1]


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", carry: tuple[str, ...] = (), per_language: int = PER_LANGUAGE, folds: int = 5) -> DataFrame:
    """One row per document: doc_id, lang_pred, score, n_switches, and the columns of ``carry``.

    n_switches: neighbouring words of different languages, by their likeliest labels.
    """
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    carry = tuple(c for c in carry if c.lower() not in RESULTS)
    model = docs.sparkSession.sparkContext.broadcast(fitted(named, per_language, folds))  # languages x 65,537 numbers

    def predict(part: pa.RecordBatch) -> tuple[list, np.ndarray, np.ndarray]:
        names, weights, moves = model.value
        texts = part.column(1)
        letters = np.array([t is not None and _LETTER.search(t) is not None for t in texts.to_pylist()])
        if weights is None:
            pred = [names[0] if names and ok else UNKNOWN for ok in letters]
            return pred, np.where(letters & bool(names), 1.0, 0.0), np.zeros(len(letters), np.int64)
        block = Block.of(texts, lower=True)
        kinds, at, which = np.unique(block.hashes(), return_index=True, return_inverse=True)
        score = _emissions(weights, *_features(block.data, block.starts[at], block.ends[at]))
        spelled = np.r_[0, np.cumsum(_LETTERISH[block.data])]
        spelled = spelled[block.ends[at]] > spelled[block.starts[at]]
        for i in np.flatnonzero(spelled & ~plain(block.data, block.starts[at], block.ends[at])).tolist():
            spelled[i] = _LETTER.search(block.data[block.starts[at[i]] : block.ends[at[i]]].tobytes().decode()) is not None
        score[~spelled] = 0
        marginals, _ = _marginals(score[which], moves, block.word_bounds)
        counted = spelled[which]
        sums = np.zeros((block.n_docs, len(names)))
        doc = block.doc_of_word()
        for y in range(len(names)):
            sums[:, y] = np.bincount(doc, weights=marginals[:, y] * counted, minlength=block.n_docs)
        mean = sums / np.maximum(np.bincount(doc, weights=counted, minlength=block.n_docs), 1)[:, None]
        best = mean.argmax(axis=1)
        label = marginals.argmax(axis=1)
        change = np.r_[False, (label[1:] != label[:-1]) & (doc[1:] == doc[:-1])] if len(label) else np.zeros(0)
        switches = np.bincount(doc, weights=change, minlength=block.n_docs).astype(np.int64)
        pred = [names[b] if ok else UNKNOWN for b, ok in zip(best, letters)]
        return pred, np.where(letters, np.clip(mean[np.arange(len(best)), best], 0, 1), 0.0), switches

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1, 3 << 20):
                pred, score, switches = predict(part)
                added = [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(switches, pa.int64())]
                yield pa.RecordBatch.from_arrays([part.column(0), *(part.columns[1:] if keep_text else part.columns[2:]), *added], out_names)

    keep_text = "text" in carry
    carry = tuple(c for c in carry if c != "text")
    kinds = dict(docs.select(*carry).dtypes)
    out_names = ["doc_id", *(["text"] if keep_text else []), *carry, "lang_pred", "score", "n_switches"]
    schema = ", ".join(["doc_id long", *(["text string"] if keep_text else []), *(f"`{c}` {kinds[c]}" for c in carry), "lang_pred string", "score double", "n_switches long"])
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), *(F.col(c) for c in carry))
    return rows.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score", "n_switches")
