"""Operator 12: how far the sources of a language diverge in their terms, by chunk factorization.

White-space chunks are counted for each document where it is read, and the counts of a few million
words summed by language, source and chunk before anything is shuffled. Chunks are dealt to buckets
by their hash; there every distinct chunk is split into its terms once, whatever the number of
documents that hold it, and the terms are joined back to the chunk's counts. Terms are summed within
the bucket and dealt anew, by their own hash, to the tasks that decide which are kept.

Of the documents that hold a chunk or a term, only what decides "in at least ten of its language's
documents" travels: the documents themselves while they are fewer than ten, and from then on a
mark. Sets of up to nine united give the exact set or the mark, so the decision is exact while a chunk that
stands everywhere costs a row for each stretch of text, not one for each document.

The kept terms of a language are dealt to shards of bounded size, which meet the language's groups in a
cogroup and give sums for each pair of groups, and their ten best terms of each group, in whole numbers.

Edge cases: null text, lang and source are ''. Every row is a document: repeated rows, and null or
repeated ids, count as often as they stand. Groups without a term, and languages that keep none, have
their pairs all the same. Texts of any length are taken whole; an empty table gives no rows; other
columns are not looked at.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossmill.llm.bytewords import SPACES, Block, buffers, slices, word_hashes
from glossmill.llm.frames import pieces, text_bytes, written

LEAST = 10  # documents of its language that a kept term stands in
TOP = 10
SCALE = 1_000_000_000
SLICE = 2 << 20
_HELD = 700_000  # counts that a task gathers before it sums them
_SHARD = 20_000  # kept terms
_FEW = 10_000  # languages of which the number of shards is broadcast
MANY = -1  # stands for LEAST documents or more

_SOLID = np.ones(256, bool)
_SOLID[list(SPACES)] = False
# [^\x00-\x40\x5B-\x60\x7B-\x7F]
_TERM = np.zeros(256, bool)
_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class Names(dict):
    """Names of languages or sources to numbers, in the order in which a task meets them."""

    def numbers(self, names: pa.Array) -> np.ndarray:
        coded = names.dictionary_encode()
        own = np.array([self.setdefault(x, len(self)) for x in coded.dictionary.to_pylist()], np.int64)
        return own[coded.indices.to_numpy()]


class Tally(NamedTuple):
    """Counts of chunks or terms. ``at``: which unit; ``d_*``: its documents by language."""

    units: pa.StringArray
    at: np.ndarray
    lang: np.ndarray
    source: np.ndarray
    n: np.ndarray
    d_at: np.ndarray
    d_lang: np.ndarray
    doc: np.ndarray

    def size(self) -> int:
        return len(self.at) + len(self.d_at)


def _summed(units: pa.StringArray, at, lang, source, n, d_at, d_lang, doc) -> Tally:
    """Equal (unit, language, source) summed, documents made distinct, LEAST of them a mark."""
    order = np.lexsort((source, lang, at))
    at, lang, source, n = at[order], lang[order], source[order], n[order]
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (lang[1:] != lang[:-1]) | (source[1:] != source[:-1])][: len(at)])
    n = np.add.reduceat(n, new) if len(new) else n
    at, lang, source = at[new], lang[new], source[new]
    order = np.lexsort((doc, d_lang, d_at))
    d_at, d_lang, doc = d_at[order], d_lang[order], doc[order]
    other = np.r_[True, (d_at[1:] != d_at[:-1]) | (d_lang[1:] != d_lang[:-1])][: len(doc)]
    distinct = np.flatnonzero(other | np.r_[True, doc[1:] != doc[:-1]][: len(doc)])
    d_at, d_lang, doc, other = d_at[distinct], d_lang[distinct], doc[distinct], other[distinct]
    first = np.flatnonzero(other)
    held = np.diff(np.r_[first, len(doc)])
    many = (held >= LEAST) | (doc[first] == MANY)  # the mark sorts first
    doc[first[many]] = MANY
    keep = np.repeat(~many, held)
    keep[first] = True
    return Tally(units, at, lang, source, n, d_at[keep], d_lang[keep], doc[keep])


def _merged(parts: list[Tally]) -> Tally:
    coded = pa.concat_arrays([p.units for p in parts]).dictionary_encode() if parts else pa.array([], pa.string()).dictionary_encode()
    index = coded.indices.to_numpy().astype(np.int64)
    base = np.cumsum([0, *(len(p.units) for p in parts)])

    def all_of(name: str) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.int64), *(getattr(p, name) for p in parts)])

    def moved(name: str) -> np.ndarray:
        return index[np.concatenate([np.zeros(0, np.int64), *(getattr(p, name) + b for p, b in zip(parts, base))])]

    return _summed(coded.dictionary, moved("at"), all_of("lang"), all_of("source"), all_of("n"), moved("d_at"), all_of("d_lang"), all_of("doc"))


class Gathered:
    """Tallies summed whenever they have doubled, so that a task holds little more than their sum."""

    def __init__(self) -> None:
        self.parts: list[Tally] = []
        self.held, self.most = 0, _HELD

    def add(self, part: Tally) -> None:
        self.parts.append(part)
        self.held += part.size()
        if self.held > self.most:
            self.parts = [_merged(self.parts)]
            self.held = self.parts[0].size()
            self.most = max(_HELD, 2 * self.held)

    def take(self) -> Tally:
        out, self.parts, self.held = _merged(self.parts), [], 0
        return out


def _chunks(part: pa.RecordBatch, langs: Names, sources: Names, first: int) -> Tally:
    """(lang, source, text) rows: the chunks of each document, counted and summed. Documents are numbered from ``first``."""
    block = Block.of(part.column(2), lower=True)
    widths = block.ends - block.starts
    words = pa.StringArray.from_buffers(len(widths), pa.py_buffer(np.r_[0, np.cumsum(widths)].astype(np.int32)), pa.py_buffer(block.data[_SOLID[block.data]].tobytes()))
    coded = words.dictionary_encode()
    n_units = max(1, len(coded.dictionary))
    held, n = np.unique(block.doc_of_word() * n_units + coded.indices.to_numpy(), return_counts=True)
    doc, at = held // n_units, held % n_units
    lang, source = langs.numbers(part.column(0))[doc], sources.numbers(part.column(1))[doc]
    return _summed(coded.dictionary, at, lang, source, n.astype(np.int64), at, lang, doc + first)


def _terms(chunks: Tally) -> Tally:
    """The counts of the terms that the chunks hold: each chunk is split once."""
    data, bounds = buffers(chunks.units)
    inside = _TERM[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    starts[bounds[:-1]] = inside[bounds[:-1]]  # no chunk is empty
    ends[bounds[1:] - 1] = inside[bounds[1:] - 1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    words = pa.StringArray.from_buffers(len(start), pa.py_buffer(np.r_[0, np.cumsum(end - start)].astype(np.int32)), pa.py_buffer(data[inside].tobytes()))
    coded = words.dictionary_encode()
    term = coded.indices.to_numpy().astype(np.int64)
    first = np.searchsorted(start, bounds)  # of each chunk, among all terms

    def joined(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For rows of chunks: one row for each term of the chunk; which row, and its term."""
        held = first[at + 1] - first[at]
        row = np.repeat(np.arange(len(at)), held)
        return row, term[np.repeat(first[at], held) + np.arange(len(row)) - np.repeat(np.cumsum(held) - held, held)]

    row, of = joined(chunks.at)
    d_row, d_of = joined(chunks.d_at)
    return _summed(coded.dictionary, of, chunks.lang[row], chunks.source[row], chunks.n[row], d_of, chunks.d_lang[d_row], chunks.doc[d_row])


_PACKED = "bucket int, units array<string>, langs array<string>, sources array<string>, at array<int>, lang array<int>, source array<int>, n array<long>, d_at array<int>, d_lang array<int>, doc array<long>"
_FIELDS = [x.split()[0] for x in _PACKED.split(", ")]


def _packed(tally: Tally, langs: Names, sources: Names, n_buckets: int) -> pa.RecordBatch:
    """A row for each bucket: its units, and their counts as lists. Names are numbered within the row."""
    data, bounds = buffers(tally.units)
    bucket = (word_hashes(data, bounds[:-1], bounds[1:]) % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    rows, first = np.unique(bucket[order], return_index=True)
    row = np.searchsorted(rows, bucket)  # of each unit
    local = np.empty(len(order), np.int64)
    local[order] = np.arange(len(order)) - first[row[order]]

    def lists(values, of_row: np.ndarray) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(of_row, np.arange(len(rows) + 1)).astype(np.int32)), values)

    def numbered(of_row: np.ndarray, numbers: np.ndarray, more_rows: np.ndarray, more: np.ndarray, names: Names) -> tuple[pa.ListArray, np.ndarray, np.ndarray]:
        wide = max(1, len(names))
        held, inverse = np.unique(np.r_[of_row * wide + numbers, more_rows * wide + more], return_inverse=True)
        own = inverse - np.searchsorted(held // wide, np.r_[of_row, more_rows])
        texts = pa.array(list(names), pa.string()).take(pa.array(held % wide))
        return lists(texts, held // wide), own[: len(of_row)], own[len(of_row) :]

    by = np.argsort(row[tally.at], kind="stable")
    d_by = np.argsort(row[tally.d_at], kind="stable")
    of, d_of = row[tally.at][by], row[tally.d_at][d_by]
    lang_names, lang, d_lang = numbered(of, tally.lang[by], d_of, tally.d_lang[d_by], langs)
    source_names, source, _ = numbered(of, tally.source[by], d_of[:0], d_of[:0], sources)
    small = lambda x: pa.array(x.astype(np.int32))
    columns = [
        small(rows), lists(tally.units.take(pa.array(order)), row[order]), lang_names, source_names, lists(small(local[tally.at][by]), of),
        lists(small(lang), of), lists(small(source), of), lists(pa.array(tally.n[by]), of), lists(small(local[tally.d_at][d_by]), d_of), lists(small(d_lang), d_of), lists(pa.array(tally.doc[d_by]), d_of),
    ]
    return pa.RecordBatch.from_arrays(columns, _FIELDS)


def _unpacked(batch: pa.RecordBatch, langs: Names, sources: Names) -> Tally:
    def flat(name: str) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Values, their rows, and where each row's values begin."""
        lists = batch.column(name)
        parent = pc.list_parent_indices(lists).to_numpy()
        return lists.flatten(), parent, np.searchsorted(parent, np.arange(batch.num_rows))

    units, _, unit_first = flat("units")

    def numbers(name: str, first: np.ndarray | None = None, of: np.ndarray | None = None) -> np.ndarray:
        values, parent, _ = flat(name)
        values = values.to_numpy().astype(np.int64)
        return values if first is None else (values + first[parent] if of is None else of[values + first[parent]])

    names, _, lang_first = flat("langs")
    lang_of = langs.numbers(names)
    names, _, source_first = flat("sources")
    source_of = sources.numbers(names)
    return Tally(
        units, numbers("at", unit_first), numbers("lang", lang_first, lang_of), numbers("source", source_first, source_of), numbers("n"),
        numbers("d_at", unit_first), numbers("d_lang", lang_first, lang_of), numbers("doc"),
    )


def kept_counts(docs: DataFrame, text: Column, lang: Column, source: Column, n_buckets: int) -> DataFrame:
    """lang, term, sources, counts: every kept term with its occurrences in each source that has it."""

    def count(batches):
        langs, sources, gathered = Names(), Names(), Gathered()
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, 2, SLICE):
                gathered.add(_chunks(part, langs, sources, number))
                number += part.num_rows
                if gathered.held > _HELD:
                    yield _packed(gathered.take(), langs, sources, n_buckets)
        if gathered.held:
            yield _packed(gathered.take(), langs, sources, n_buckets)

    def split(batches):
        langs, sources, gathered = Names(), Names(), Gathered()
        for batch in batches:
            gathered.add(_unpacked(batch, langs, sources))
        if gathered.held:
            yield _packed(_terms(gathered.take()), langs, sources, n_buckets)

    def decide(batches):
        langs, sources, gathered = Names(), Names(), Gathered()
        for batch in batches:
            gathered.add(_unpacked(batch, langs, sources))
        got = gathered.take()
        wide = max(1, len(langs))
        kept = np.unique((got.d_at * wide + got.d_lang)[got.doc == MANY])
        key = got.at * wide + got.lang
        of = np.flatnonzero(np.isin(key, kept))
        first = np.searchsorted(key[of], kept)
        offsets = pa.array(np.r_[first, len(of)].astype(np.int32))
        named = lambda names, at: pa.array(list(names), pa.string()).take(pa.array(at))
        columns = [named(langs, kept % wide), got.units.take(pa.array(kept // wide)), pa.ListArray.from_arrays(offsets, named(sources, got.source[of])), pa.ListArray.from_arrays(offsets, pa.array(got.n[of]))]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "term", "sources", "counts"])

    rows = docs.select(lang.alias("lang"), source.alias("source"), text.alias("text"))
    n_tasks = pieces(n_buckets, 8)
    chunks = rows.mapInArrow(count, _PACKED).repartition(n_tasks, "bucket").mapInArrow(split, _PACKED)
    return chunks.repartition(n_tasks, "bucket").mapInArrow(decide, "lang string, term string, sources array<string>, counts array<long>")


def _share(counts: np.ndarray, total: np.ndarray | int, n_terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (total + 2 * n_terms)), three digits at a time so that no product overflows."""
    below = np.asarray(total, np.int64) + 2 * n_terms
    value, rest = np.divmod(counts + 2, below)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, below)
        value = value * 1000 + more
    return value + 1


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _compared(key: tuple, terms: pa.Table, groups: pa.Table) -> pa.Table:
    """Sums over these terms for each pair of the language's groups, and the best of them in each group."""
    lang, sources, totals = key[0].as_py(), groups["sources"][0].as_py(), np.array(groups["totals"][0].as_py(), np.int64)
    n_terms, whole, n = groups["n_terms"][0].as_py(), int(totals.sum()), len(sources)
    place = {x: i for i, x in enumerate(sources)}
    sums, best = np.zeros((n, n), np.int64), [[] for _ in sources]
    step = max(1, 4_000_000 // n)
    for a in range(0, terms.num_rows, step):
        part = terms.slice(a, step).combine_chunks()
        held = part["sources"].combine_chunks()
        counts = np.zeros((part.num_rows, n), np.int64)
        coded = held.flatten().dictionary_encode()
        columns = np.array([place[x] for x in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.int64)
        counts[pc.list_parent_indices(held).to_numpy(), columns] = part["counts"].combine_chunks().flatten().to_numpy()
        p, q = _share(counts, totals, n_terms), _share(counts.sum(axis=1), whole, n_terms)
        for i in range(n):
            sums[i] += _apart(p[:, i : i + 1], p).sum(axis=0)
            over = np.flatnonzero((counts[:, i] > 0) & (p[:, i] > q))
            value = _apart(p[over, i], q[over])
            if len(over) > TOP:  # all that reach the tenth best value
                reach = value >= np.partition(value, -TOP)[-TOP]
                over, value = over[reach], value[reach]
            names = part["term"].take(pa.array(over)).to_pylist()
            best[i] = sorted([*best[i], *((-int(v), x.encode(), x) for v, x in zip(value, names))])[:TOP]
    rows = [(lang, sources[i], "pair", sources[j], int(sums[i, j])) for i in range(n) for j in range(n) if i != j]
    rows += [(lang, sources[i], "term", x, -v) for i in range(n) for v, _, x in best[i]]
    return pa.table({c: pa.array([r[k] for r in rows], kind) for k, (c, kind) in enumerate((("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())))})


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", bucket_bytes: int = 1 << 20) -> DataFrame:
    """lang, source, part, item, value, rank: how far each (lang, source) is from the language's other sources
    (``pair``), and the terms that it has more of than the language (``term``, the first ``TOP``)."""
    named = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(to) for c, to in ((text, "text"), (lang, "lang"), (source, "source"))))
    n_buckets = pieces(text_bytes(named, "text"), bucket_bytes, 64)
    kept = written(kept_counts(named, F.col("text"), F.col("lang"), F.col("source"), n_buckets), "divergence")
    each = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x")).groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.counts").alias("total"))
    groups = named.select("lang", "source").distinct().join(each, ["lang", "source"], "left").select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"))
    own = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "total"))).alias("g"))  # as long as a group's own result
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"))
    n_terms = F.coalesce("n_terms", F.lit(0))
    shards = F.greatest(F.lit(1), F.ceil(n_terms / _SHARD)).cast("int")
    languages = own.join(sizes, "lang", "left").select("lang", F.col("g.source").alias("sources"), F.col("g.total").alias("totals"), n_terms.alias("n_terms"), shards.alias("shards"))
    told = languages.select("lang", "shards")
    told = F.broadcast(told) if told.count() <= _FEW else told
    spread = kept.join(told, "lang").withColumn("shard", F.pmod(F.xxhash64("term"), "shards").cast("int")).select("lang", "shard", "term", "sources", "counts")
    met = languages.select("lang", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "sources", "totals", "n_terms")
    found = spread.groupBy("lang", "shard").cogroup(met.groupBy("lang", "shard")).applyInArrow(_compared, "lang string, source string, part string, item string, value long")
    summed = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return summed.withColumn("rank", rank).where((F.col("part") == "pair") | (F.col("rank") <= TOP))


def query(spark, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang", "source"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
w AS (SELECT k, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= 10),
c AS (SELECT w.lang, w.source, w.term, count(*) AS c FROM w JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
v AS (SELECT l.lang, count(kept.term) AS v FROM (SELECT DISTINCT lang FROM d) l LEFT JOIN kept USING (lang) GROUP BY 1),
g AS (
  SELECT g.lang, g.source, coalesce(sum(c.c), 0) AS n, any_value(v.v) AS v
  FROM (SELECT DISTINCT lang, source FROM d) g JOIN v USING (lang) LEFT JOIN c USING (lang, source) GROUP BY 1, 2),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.c, 0) AS c, 1 + (1000000000 * (coalesce(c.c, 0) + 2)) // (g.n + 2 * g.v) AS p
  FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
l AS (SELECT lang, sum(n) AS n, any_value(v) AS v FROM g GROUP BY 1),
q AS (SELECT p.lang, p.term, 1 + (1000000000 * (sum(p.c) + 2)) // (any_value(l.n) + 2 * any_value(l.v)) AS q FROM p JOIN l USING (lang) GROUP BY 1, 2),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
rows_of AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, ((p.p - q.q) * (p.p - q.q)) // (p.p + q.q) FROM p JOIN q USING (lang, term) WHERE p.c > 0 AND p.p > q.q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows_of)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""
