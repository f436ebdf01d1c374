"""Operator 1: substring dedup by fixed-block anchors.

A repeat of at least ``window`` words contains a whole block of (window + 1) // 2 words wherever
blocks of that size are laid end to end. So only non-overlapping blocks of each document are
indexed, and every rolling block-sized window of every document probes them:

1. anchors: documents are dealt to chunks; each chunk sends its probes, some flagged as indexed
   blocks, to buckets of the hash space. A bucket answers two bits per probe: an earlier document
   has this block indexed; (for blocks) a later document asks for it.
2. extension: the same chunks widen their hits to all windows that hold one, as do the wanted
   blocks, and send those windows with a 64-bit hash on top of the bucket's. A bucket answers one
   bit: the window also starts in a document with a smaller id. The windows that do, laid over
   one another, are the maximal exact repeats.
3. the words under such windows go.

Between steps only fingerprints and bits move, in packed rows of one chunk and bucket: never
pairs of places. A chunk sends a hash at most twice in the first step and once in the second, however
often it holds it, so passages that all documents share stay small. The text itself is dealt once,
and that exchange is used three times.

Edge cases: a null or empty text has no words and kept text ''; a row without an id neither
removes nor loses words; repeated rows of one id are the same document, so never repeats of each
other; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmill.llm.bytewords import Block, mix, window_hashes
from glossmill.llm.frames import dealt, pieces, text_bytes

_ASK = "chunk int, bucket int, size int, docs binary, counts binary, prints binary, flags binary"
_TELL = "chunk int, bucket int, bits binary"
_NO_ID = np.iinfo(np.int64).max
_RESULTS = ("doc_id", "kept_text", "n_words", "n_removed")


def _ordered(table: pa.Table) -> pa.Table:
    """Rows of a chunk in one order, whichever way they came."""
    lengths = pc.fill_null(pc.binary_length(table["text"]), 0)
    keyed = table.append_column("__n", lengths)
    if pc.count_distinct(table["doc_id"]).as_py() < table.num_rows or table["doc_id"].null_count:
        return keyed.sort_by([("doc_id", "ascending"), ("__n", "ascending"), ("text", "ascending")])
    return keyed.sort_by("doc_id")


def _ids(table: pa.Table) -> np.ndarray:
    return table["doc_id"].fill_null(_NO_ID).to_numpy()


def _pack(chunk: int, owner: np.ndarray, hashes: np.ndarray, n_buckets: int, width: type, flags: np.ndarray) -> dict[str, list]:
    """One row for each bucket that gets a hash: prints in order, owners as runs, flags as bits."""
    bucket = ((hashes >> np.uint64(33)) % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    prints = mix(hashes)[order].astype(width)
    owner, flags = owner[order], flags[order]
    rows: dict[str, list] = {name: [] for name in ("chunk", "bucket", "size", "docs", "counts", "prints", "flags")}
    for b in np.flatnonzero(np.diff(cuts)):
        i, j = cuts[b], cuts[b + 1]
        turns = np.flatnonzero(np.r_[True, owner[i + 1 : j] != owner[i : j - 1]])
        for name, value in zip(rows, (chunk, int(b), int(j - i), owner[i:j][turns].tobytes(), np.diff(np.r_[turns, j - i]).astype(np.int32).tobytes(), prints[i:j].tobytes(), np.packbits(flags[i:j]).tobytes())):
            rows[name].append(value)
    return rows


def _asked(rows: dict[str, list]) -> pa.Table:
    return pa.table({name: pa.array(rows[name], pa.int32() if name in ("chunk", "bucket", "size") else pa.binary()) for name in rows})


def _unpack_bits(answers: pa.Table, hashes: np.ndarray, n_buckets: int, planes: int) -> np.ndarray:
    """The answers of all buckets back in the order of the hashes; no answer is a 0."""
    bucket = ((hashes >> np.uint64(33)) % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    out = np.zeros((planes, len(hashes)), bool)
    for b, bits in zip(answers["bucket"].to_pylist(), answers["bits"].to_pylist()):
        if 0 <= b < n_buckets:
            n = cuts[b + 1] - cuts[b]
            got = np.unpackbits(np.frombuffer(bits, np.uint8).reshape(planes, -1), axis=1, count=n)
            out[:, order[cuts[b] : cuts[b + 1]]] = got
    return out


def _probes(table: pa.Table, window: int) -> tuple[Block, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Block-sized windows of the documents long enough to hold a whole window."""
    block = Block.of(table["text"])
    size = (window + 1) // 2
    at, hashes = block.windows(size)
    doc = np.repeat(np.arange(block.n_docs), block.n_words)[at]
    use = (block.n_words[doc] >= window) & (_ids(table)[doc] != _NO_ID)
    at, hashes, doc = at[use], hashes[use], doc[use]
    indexed = (at - block.word_bounds[doc]) % size == 0
    return block, at, hashes, doc, indexed


def _groups(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in order of their hash, where each hash begins in that order, and the number of the
    hash at each place."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    new = np.r_[True, ordered[1:] != ordered[:-1]] if len(order) else np.zeros(0, bool)
    kind = np.empty(len(order), np.int32)
    kind[order] = np.cumsum(new, dtype=np.int32) - 1
    return order, np.flatnonzero(new), kind


def _sent_probes(hashes: np.ndarray, owner: np.ndarray, indexed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places to send of each hash: the first indexed one and the last, as owners come in order.
    Also which hashes are hit by what the chunk itself holds, and each place's hash."""
    order, begins, kind = _groups(hashes)
    if not len(order):
        return order, np.zeros(0, bool), kind
    none = len(order)
    last = np.maximum.reduceat(order, begins)
    first = np.minimum.reduceat(np.where(indexed[order], order, none), begins)
    held = first < none
    inside = held.copy()
    inside[held] = owner[last[held]] > owner[first[held]]
    sent = np.zeros(none, bool)
    sent[first[held]] = True
    sent[last] = True
    return np.flatnonzero(sent), inside, kind


def _sent_windows(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first place of each hash, which places have a larger owner than that, each's hash."""
    order, begins, kind = _groups(hashes)
    if not len(order):
        return order, np.zeros(0, bool), kind
    first = np.minimum.reduceat(order, begins)
    return first, owner > owner[first][kind], kind


def _read(table: pa.Table, width: type) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Prints, owners and flags of a bucket's rows, and where each row begins."""
    sizes = table["size"].to_numpy()
    prints = np.frombuffer(b"".join(table["prints"].to_pylist()), width)
    docs = np.frombuffer(b"".join(table["docs"].to_pylist()), np.int64)
    owner = np.repeat(docs, np.frombuffer(b"".join(table["counts"].to_pylist()), np.int32))
    flags = [np.unpackbits(np.frombuffer(f, np.uint8), count=n) for f, n in zip(table["flags"].to_pylist(), sizes)]
    return prints, owner, np.concatenate(flags).astype(bool), np.r_[0, np.cumsum(sizes)]


def _told(table: pa.Table, cuts: np.ndarray, *planes: np.ndarray) -> pa.Table:
    keep, bits = [], []
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if any(p[a:b].any() for p in planes):
            keep.append(i)
            bits.append(b"".join(np.packbits(p[a:b]).tobytes() for p in planes))
    rows = table.take(keep) if keep else table.slice(0, 0)
    return pa.table({"chunk": rows["chunk"], "bucket": rows["bucket"], "bits": pa.array(bits, pa.binary())})


def _answer_anchors(table: pa.Table) -> pa.Table:
    prints, owner, indexed, cuts = _read(table, np.uint32)
    kinds, which = np.unique(prints, return_inverse=True)
    first = np.full(len(kinds), _NO_ID, np.int64)
    np.minimum.at(first, which[indexed], owner[indexed])
    last = np.full(len(kinds), np.iinfo(np.int64).min, np.int64)
    np.maximum.at(last, which, owner)
    return _told(table, cuts, first[which] < owner, indexed & (last[which] > owner))


def _answer_windows(table: pa.Table) -> pa.Table:
    through = pc.less(table["bucket"], 0)
    masks = table.filter(through)
    passed = pa.table({"chunk": masks["chunk"], "bucket": masks["bucket"], "bits": masks["prints"]})
    table = table.filter(pc.invert(through))
    if not table.num_rows:
        return passed
    prints, owner, _, cuts = _read(table, np.uint64)
    kinds, which = np.unique(prints, return_inverse=True)
    first = np.full(len(kinds), _NO_ID, np.int64)
    np.minimum.at(first, which, owner)
    return pa.concat_tables([passed, _told(table, cuts, first[which] < owner)]).combine_chunks()


def substring_dedup(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = 13,
    carry: tuple[str, ...] = (),
    chunk_bytes: int = 2 << 20,
    bucket_bytes: int = 16 << 20,
) -> DataFrame:
    """Remove every word under a window that also starts in a document with a smaller id.

    Returns one row per document: doc_id, kept_text (kept words joined by one space), n_words,
    n_removed, and the columns named in ``carry``; of those, what is named like a result gives way.
    """
    carry = tuple(c for c in carry if c.lower() not in _RESULTS)
    if window < 1:
        raise ValueError("a window has at least one word")
    total = text_bytes(docs, text)
    n_buckets = pieces(total, bucket_bytes, 48)
    dealt_as = {text: "text", doc_id: "doc_id"}
    inside = {c: f"carried_{i}" for i, c in enumerate(carry) if c not in dealt_as}  # clashes with nothing
    chunks = dealt(docs.withColumnsRenamed(inside), doc_id, text, pieces(total, chunk_bytes), tuple(inside.values()))
    size = (window + 1) // 2

    def ask_anchors(table: pa.Table) -> pa.Table:
        table = _ordered(table)
        _, _, hashes, doc, indexed = _probes(table, window)
        owner = _ids(table)[doc]
        sent, _, _ = _sent_probes(hashes, owner, indexed)
        return _asked(_pack(table["chunk"][0].as_py(), owner[sent], hashes[sent], n_buckets, np.uint32, indexed[sent]))

    def ask_windows(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _asked({name: [] for name in ("chunk", "bucket", "size", "docs", "counts", "prints", "flags")})
        table = _ordered(table)
        block, at, hashes, doc, indexed = _probes(table, window)
        sent, of_hash, kind = _sent_probes(hashes, _ids(table)[doc], indexed)
        told = _unpack_bits(answers, hashes[sent], n_buckets, 2).any(axis=0)
        np.logical_or.at(of_hash, kind[sent], told)
        hit = of_hash[kind]
        # A window starting at w holds the probes at w .. w + window - size.
        marks = np.zeros(len(block.starts) + 1, np.int64)
        marks[at[hit] + 1] = 1
        marks = np.cumsum(marks)
        end = np.repeat(block.word_bounds[1:], block.n_words)
        where = np.arange(len(block.starts))
        whole = where[where + window <= end]
        whole = whole[marks[whole + window - size + 1] > marks[whole]]
        chunk, ids = table["chunk"][0].as_py(), _ids(table)
        owner = ids[np.repeat(np.arange(block.n_docs), block.n_words)[whole]]
        whole, owner = whole[owner != _NO_ID], owner[owner != _NO_ID]
        hashes = window_hashes(block.hashes(), whole, window)
        first, _, _ = _sent_windows(hashes, owner)
        rows = _pack(chunk, owner[first], hashes[first], n_buckets, np.uint64, np.zeros(len(first), bool))
        mask = np.zeros(len(block.starts), bool)
        mask[whole] = True
        # The chunk's own note of which windows it asked about passes through a bucket untouched.
        for name, value in zip(rows, (chunk, -1 - chunk, 0, b"", b"", np.packbits(mask).tobytes(), b"")):
            rows[name].append(value)
        return _asked(rows)

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        table = _ordered(table)
        block = Block.of(table["text"])
        gone = np.zeros(len(block.starts) + 1, np.int64)
        if answers.num_rows:
            note = answers.filter(pc.less(answers["bucket"], 0))["bits"][0].as_py()
            at = np.flatnonzero(np.unpackbits(np.frombuffer(note, np.uint8), count=len(block.starts)))
            hashes, owner = window_hashes(block.hashes(), at, window), _ids(table)[np.repeat(np.arange(block.n_docs), block.n_words)[at]]
            first, later, kind = _sent_windows(hashes, owner)
            bad = at[later | _unpack_bits(answers, hashes[first], n_buckets, 1)[0][kind]]
            gone[bad] += 1
            np.subtract.at(gone, bad + window, 1)
        keep = np.cumsum(gone[:-1]) == 0
        kept = []
        for i in range(block.n_docs):
            words, own = block.words(i), keep[block.word_bounds[i] : block.word_bounds[i + 1]]
            kept.append(b" ".join(words if own.all() else compress(words, own.tolist())))
        removed = block.n_words - np.add.reduceat(np.r_[keep, 0].astype(np.int64), np.minimum(block.word_bounds[:-1], len(keep))) * (block.n_words > 0)
        out = {"doc_id": table["doc_id"], "kept_text": pa.array(kept, pa.binary()).cast(pa.string()), "n_words": pa.array(block.n_words, pa.int64()), "n_removed": pa.array(removed, pa.int64())}
        return pa.table(out | {c: table[dealt_as.get(c, inside.get(c))] for c in carry})

    kinds = dict(docs.select(*carry).dtypes)
    schema = "doc_id long, kept_text string, n_words long, n_removed long" + "".join(f", `{c}` {kinds[c]}" for c in carry)
    anchors = chunks.groupBy("chunk").applyInArrow(ask_anchors, _ASK).groupBy("bucket").applyInArrow(_answer_anchors, _TELL)
    windows = chunks.groupBy("chunk").cogroup(anchors.groupBy("chunk")).applyInArrow(ask_windows, _ASK)
    answers = windows.groupBy("bucket").applyInArrow(_answer_windows, _TELL)
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(remove, schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = substring_dedup(docs, window=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS seq
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w)
), firsts AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY seq) AS first_doc FROM win
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM firsts WHERE first_doc < doc_id
), each AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS j FROM w
), kept AS (
  SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.j) AS kept_text, count(*) AS n
  FROM each e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.j = g.j GROUP BY e.doc_id
)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words,
       CAST(len(w.words) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept_text, '')) AS kept_sha256
FROM w LEFT JOIN kept k ON k.doc_id = w.doc_id
"""
