"""Operator 11: two tokenizers' tokens of the same texts aligned by their bytes.

Every text is encoded by a byte-level BPE (A, given a space and the text) and by a SentencePiece
model (B, which puts that space itself). From there all is Arrow, a slice of documents at a time:
lists of ids are flattened with their parent indices, segmented cumulative sums give the byte at
which each token ends in its document, and an Acero hash join on (document, end) keys brings
the ends of both sides together. Where both end, a group ends; every row of the full outer join is
one stretch of bytes under one token of either side, hence one link, and each overlapping pair of
occurrences has exactly one such stretch. ``Table.group_by`` counts the id pairs of each
document and of each slice.

The slices' partial counts are merged by Spark; each slice then gets back the merged counts of the
pairs it holds, one row for each, and adds up its documents. A pair that stands in every document is
thus one row a slice in every shuffle, texts never travel, and nothing is broadcast or collected. The
documents' counts are written once, as a table in the shared folder, so that no text is encoded twice.

Encoding: texts are cut before a single space after anything that surely isn't white space. Both
encoders end a token there and neither looks across, so each distinct stretch is encoded once a task.

Edge cases: texts that are null, empty, or whose joined bytes of A or B differ from space and text (a
text with U+2581 does) have no tokens: zeros and ''. Special tokens' strings are plain text. A null doc_id
is kept; repeated rows give repeated rows and count as often; texts of any length are aligned whole; an
empty table gives no rows; other columns of the table are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmill.llm.bytewords import buffers, slices
from glossmill.llm.frames import written
from glossmill.llm.packing import default_ranks
from glossmill.llm.piececoding import MARK, default_model

SLICE = 2 << 20
CACHED = 250_000
_COUNTS = "n_a long, n_b long, n_groups long, n_links long"
#: After these bytes a space begins a stretch of its own: visible ASCII, and last bytes of characters of
#: which none is white space.
_FIRM = np.zeros(256, bool)
_FIRM[0x21:0x7F] = True
_FIRM[0x80:] = True
_FIRM[[0x85, 0x9F, 0xA0, 0xA8, 0xA9, 0xAF, *range(0x80, 0x8B)]] = False
#: What follows an id in the text of the groups.
_MARKS = (",", "|", ";", "")


class Side:
    """One tokenizer: how it encodes a stretch that begins with a space, and its entries' bytes."""

    def __init__(self, encode, surface: list[bytes]) -> None:
        self.encode = encode
        self.surface = pa.array(surface, pa.binary())
        self.width = np.array([len(x) for x in surface], np.int64)


class Pair:
    """Both tokenizers, with the stretches that a task met lately."""

    def __init__(self, ranks: str, model: str) -> None:
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(ranks, "rb") as lines:
            known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        plain = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={}).encode_ordinary
        surface = [b""] * (max(known.values()) + 1)
        for token, rank in known.items():
            surface[rank] = token
        self.a = Side(lambda texts: [plain(x) for x in texts], surface)
        pieces = sentencepiece.SentencePieceProcessor(model_file=model)
        alone = pieces.piece_to_id(MARK)
        surface = [bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace(MARK, " ").encode() for i, p in ((i, pieces.id_to_piece(i)) for i in range(len(pieces)))]
        # The library puts the first space itself; a space alone would be nothing to it.
        self.b = Side(lambda texts: [x or [alone] for x in pieces.encode([x[1:] for x in texts], num_threads=1)], surface)
        self.cache: dict[str, tuple[bytes, bytes]] = {}
        n = max(len(self.a.width), len(self.b.width))
        self.decimal = pa.array([f"{i}{mark}" for i in range(n) for mark in _MARKS])

    def encoded(self, texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        new = [x for x in texts if x not in self.cache]
        if len(self.cache) + len(new) > CACHED:
            self.cache.clear()
            new = texts
        for x, a, b in zip(new, self.a.encode(new), self.b.encode(new)):
            self.cache[x] = array("i", a).tobytes(), array("i", b).tobytes()
        return tuple(_lists([x[k] for x in map(self.cache.__getitem__, texts)]) for k in (0, 1))


def _lists(each: list[bytes]) -> pa.ListArray:
    offsets = np.zeros(len(each) + 1, np.int32)
    np.cumsum([len(x) // 4 for x in each], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(each), np.int32)))


@lru_cache(maxsize=2)
def _pair(ranks: str, model: str) -> Pair:
    return Pair(ranks, model)


def _stretches(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The stretches of all texts in order, as a dictionary array, and the document of each. A text
    that is there and not empty gets its space."""
    with_space = pc.if_else(pc.equal(pc.fill_null(pc.binary_length(texts), 0), 0), "", pc.binary_join_element_wise(" ", pc.fill_null(texts, ""), ""))
    data, bounds = buffers(with_space)
    cut = np.zeros(len(data), bool)
    cut[1:] = (data[1:] == 32) & _FIRM[data[:-1]]
    cut[bounds[:-1][np.diff(bounds) > 0]] = True
    at = np.flatnonzero(cut)
    parts = pa.StringArray.from_buffers(len(at), pa.py_buffer(np.r_[at, len(data)].astype(np.int32)), pa.py_buffer(data.tobytes()))
    return parts.dictionary_encode(), np.searchsorted(bounds, at, side="right") - 1


def _same_bytes(side: Side, ids: pa.ListArray, texts: pa.StringArray) -> np.ndarray:
    """Which lists of ids spell exactly their text."""
    parent = pc.list_parent_indices(ids).to_numpy()
    flat = ids.flatten()
    length = np.asarray(pc.binary_length(texts), np.int64)
    good = np.bincount(parent, weights=side.width[flat.to_numpy()], minlength=len(texts)) == length
    held = pa.array(good)
    spelled, _ = buffers(side.surface.take(flat.filter(pa.array(good[parent]))).cast(pa.large_binary()).cast(pa.large_string(), safe=False))
    meant, bounds = buffers(texts.filter(held))
    off = np.flatnonzero(spelled != meant)
    good[np.flatnonzero(good)[np.searchsorted(bounds, off, side="right") - 1]] = False
    return good


def _ends(side: Side, lists: pa.ListArray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, document and end in its document of every token. ``first``: per document, its first list;
    with one more entry for what follows."""
    ids = lists.flatten().to_numpy()
    doc = np.searchsorted(first, pc.list_parent_indices(lists).to_numpy(), side="right") - 1
    total = np.cumsum(side.width[ids])
    begins = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, np.int64)
    before = total[begins] - side.width[ids[begins]]
    return ids, doc, total - np.repeat(before, np.diff(np.r_[begins, len(ids)]))


def _joined(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Every stretch of bytes in order: its document, its token of A and of B, and whether both end there."""
    key = lambda doc, end: (doc.astype(np.int64) << 40) | end
    left = pa.table({"end": key(a[1], a[2]), "i": np.arange(len(a[0]), dtype=np.int64)})
    right = pa.table({"end": key(b[1], b[2]), "j": np.arange(len(b[0]), dtype=np.int64)})
    rows = left.join(right, "end", join_type="full outer", use_threads=False).sort_by("end")
    both = pc.and_(rows["i"].is_valid(), rows["j"].is_valid()).to_numpy()
    i, j = (pc.fill_null_backward(rows[c]).to_numpy() for c in "ij")  # the last end of a document is both sides'
    return rows["end"].to_numpy() >> 40, i, j, both


def _group_texts(pair: Pair, a: tuple, b: tuple, i: np.ndarray, j: np.ndarray, both: np.ndarray, n_docs: int) -> pa.StringArray:
    """``a1,a2|b1;a3|b2,b3`` of each document."""
    last_a, last_b = i[both], j[both]  # last token of each group on either side
    group_a = np.searchsorted(last_a, np.arange(len(a[0])))
    group_b = np.searchsorted(last_b, np.arange(len(b[0])))
    place_a = np.arange(len(a[0])) + np.r_[0, last_b + 1][group_a]
    place_b = np.arange(len(b[0])) + (last_a + 1)[group_b]
    code = np.empty(len(a[0]) + len(b[0]), np.int64)
    code[place_a] = 4 * a[0].astype(np.int64) + (np.arange(len(a[0])) == last_a[group_a])
    ends = np.arange(len(b[0])) == last_b[group_b]
    closes = np.r_[b[1][1:] != b[1][:-1], True] if len(b[1]) else np.zeros(0, bool)
    code[place_b] = 4 * b[0].astype(np.int64) + np.where(closes, 3, 2 * ends)
    texts = pair.decimal.take(pa.array(code))
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[: len(texts) + 1].astype(np.int64)
    held = np.bincount(a[1], minlength=n_docs) + np.bincount(b[1], minlength=n_docs)
    at = bounds[np.r_[0, np.cumsum(held)]]
    return pa.LargeStringArray.from_buffers(n_docs, pa.py_buffer(at), texts.buffers()[2])


def _counted(part: pa.RecordBatch, pair: Pair, number: int, keep_groups: bool) -> list[dict]:
    """Columns of the documents of a slice, and of the slice's own row of partial counts."""
    n_docs = part.num_rows
    parts, doc = _stretches(part.column(1))
    a_lists, b_lists = pair.encoded(parts.dictionary.to_pylist())
    good = _same_bytes(pair.a, a_lists, parts.dictionary) & _same_bytes(pair.b, b_lists, parts.dictionary)
    index = parts.indices.to_numpy()
    spoilt = np.zeros(n_docs, bool)
    spoilt[doc[~good[index]]] = True
    kept = ~spoilt[doc]
    index, doc = pa.array(index[kept]), doc[kept]
    first = np.searchsorted(doc, np.arange(n_docs + 1))
    a = _ends(pair.a, a_lists.take(index), first[:-1])
    b = _ends(pair.b, b_lists.take(index), first[:-1])
    where, i, j, both = _joined(a, b)
    texts = _group_texts(pair, a, b, i, j, both, n_docs)
    data, bounds = buffers(texts)
    view = memoryview(data)
    digests = [hashlib.sha256(view[x:y]).hexdigest() if y > x else "" for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    links = pa.table({"doc": where, "pair": a[0][i].astype(np.int64) * len(pair.b.width) + b[0][j]})
    of_docs = links.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
    of_slice = of_docs.group_by("pair", use_threads=False).aggregate([("count_all", "sum")]).sort_by("pair")
    pairs = of_slice["pair"].to_numpy()
    order = np.argsort(of_docs["doc"].to_numpy(), kind="stable")
    held = np.searchsorted(of_docs["doc"].to_numpy()[order], np.arange(n_docs + 1)).astype(np.int32)
    at = np.searchsorted(pairs, of_docs["pair"].to_numpy()[order]).astype(np.int64)
    times = of_docs["count_all"].to_numpy()[order]
    count = lambda x: pa.array(np.bincount(x, minlength=n_docs).astype(np.int64))
    own = {
        "slice": pa.array(np.full(n_docs, number)), "own": pa.array(np.zeros(n_docs, bool)), "doc_id": part.column(0),
        "n_a": count(a[1]), "n_b": count(b[1]), "n_groups": count(where[both]), "n_links": count(where),
        "groups_sha256": pa.array(digests, pa.string()), "groups": pa.array(texts.to_pylist(), pa.string()) if keep_groups else pa.nulls(n_docs, pa.string()),
        "at": pa.ListArray.from_arrays(pa.array(held), pa.array(at)), "times": pa.ListArray.from_arrays(pa.array(held), pa.array(times)),
    }
    whole = np.array([0, len(pairs)], np.int32)
    lists = {"at": of_slice["pair"], "times": of_slice["count_all_sum"]}
    partial = {"slice": pa.array([number]), "own": pa.array([True])} | {c: pa.ListArray.from_arrays(pa.array(whole), x.combine_chunks()) for c, x in lists.items()}
    nothing = {c: pa.nulls(1, x.type) for c, x in own.items() if c not in partial}
    return [own, nothing | partial]


def counted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranks: str | None = None, model: str | None = None, keep_groups: bool = False) -> DataFrame:
    """Documents aligned, before their links are told the corpus' counts: a row per document, with its
    pairs (``at``: places in its slice's list; ``times``), and a row per slice (``own``) with that list."""
    ranks, model = ranks or default_ranks(), model or default_model()
    schema = f"slice long, own boolean, doc_id long, {_COUNTS}, groups_sha256 string, groups string, at array<long>, times array<long>"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        pair = _pair(ranks, model)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, 1, SLICE):
                for columns in _counted(part, pair, number, keep_groups):
                    yield pa.RecordBatch.from_arrays([columns[c] for c in names], names)
                number += 1
        pair.cache.clear()  # the worker may live on for stages of another kind

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def pair_counts(parts: DataFrame, n_b: int) -> DataFrame:
    """pair, count, best: the partial counts of all slices merged, and whether no pair of the same
    B id has more."""
    merged = parts.groupBy("pair").agg(F.sum("n").alias("count"))
    highest = merged.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("count").alias("highest"))
    return merged.join(highest, F.col("pair") % n_b == F.col("b")).select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def align(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranks: str | None = None, model: str | None = None, keep_groups: bool = False) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256,
    and with ``keep_groups`` the groups themselves, as ``groups``."""
    model = model or default_model()
    table = written(counted(docs, doc_id, text, ranks, model, keep_groups), "alignment")
    parts = table.where("own").select("slice", F.explode(F.arrays_zip("at", "times")).alias("x")).select("slice", F.col("x.at").alias("pair"), F.col("x.times").alias("n"))
    import sentencepiece

    n_b = len(sentencepiece.SentencePieceProcessor(model_file=model))
    told = parts.join(pair_counts(parts, n_b), "pair").select(F.col("slice").alias("of_slice"), "pair", "count", "best")
    columns = ["doc_id", *(x.split()[0] for x in _COUNTS.split(", ")), "groups_sha256", *(["groups"] if keep_groups else [])]
    schema = f"doc_id long, {_COUNTS}, groups_sha256 string, " + ("groups string, " if keep_groups else "") + "n_best long, count_sum long"

    def finish(rows: pa.Table, counts: pa.Table) -> pa.Table:
        counts = counts.sort_by("pair")  # the order of the slice's list
        lists, times = rows["at"].combine_chunks(), rows["times"].combine_chunks()
        doc, at, n = pc.list_parent_indices(lists).to_numpy(), lists.flatten().to_numpy(), times.flatten().to_numpy()
        each = {"n_best": n * counts["best"].to_numpy()[at], "count_sum": n * counts["count"].to_numpy()[at]}
        out = rows.select(columns)
        for name, value in each.items():
            sums = np.zeros(rows.num_rows, np.int64)
            np.add.at(sums, doc, value)
            out = out.append_column(name, pa.array(sums))
        return out

    own = table.where("not own").select("slice", "at", "times", *columns)
    return own.groupBy("slice").cogroup(told.groupBy("of_slice")).applyInArrow(finish, schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return align(docs).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
