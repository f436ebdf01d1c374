"""Operator 10: packing by best-fit decreasing.

Texts are tokenized where they are read; only the length and checksum of each piece travel on.
Documents longer than a window are first cut into full windows, which need no partner. What is
left of each document is dealt to shards by a hash, and each shard places its pieces longest
first, each into the open window with the least room that still holds it: a segment tree over the
room left (one leaf per value) finds it. A shard's windows are numbered within the shard.

Edge cases: a null text is empty and takes one id, the end id; a null doc_id is kept; repeated rows
are packed as often as they occur; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmill.llm.bytewords import slices
from glossmill.llm.frames import pieces, text_bytes

END_ID = 0
WINDOW = 1024
CACHED = 300_000
SPECIAL = "<|endoftext|>"
_SPECIAL_ID = 50256
# A run of white space and the word after it: pre-tokens never cross from a word to white space.
_SEGMENT = re.compile(r"\s*\S+|\s+")
_UNSURE = re.compile("[\x1c-\x1f]")  # white space to Python alone


def default_ranks() -> str:
    """The ranks of byte_bpe_50k.json in the form that encodes short pieces fastest."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder(dict):
    """Segment to its ids as bytes of unsigned 32-bit numbers; forgets all when full."""

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken

        super().__init__()
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __missing__(self, segment: str) -> bytes:
        if len(self) >= CACHED:
            self.clear()
        ids = self[segment] = np.array(self.plain(segment), np.uint32).tobytes()
        return ids

    def ids(self, text: str) -> bytes:
        if SPECIAL in text:
            return np.uint32(_SPECIAL_ID).tobytes().join(map(self.ids, text.split(SPECIAL)))
        if _UNSURE.search(text):
            return np.array(self.plain(text), np.uint32).tobytes()
        return b"".join(map(self.__getitem__, _SEGMENT.findall(text)))


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


class Room:
    """Open windows by room left, under a segment tree that tells which rooms are taken."""

    def __init__(self, window: int) -> None:
        self.size = 1 << window.bit_length()
        self.any = bytearray(2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(self.size)]

    def add(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        node = room + self.size
        while node and not self.any[node]:
            self.any[node] = 1
            node >>= 1

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Room and number of the window with the least room of at least ``need``, taken out."""
        node = need + self.size
        if not self.any[node]:
            while node and (node & 1 or not self.any[node + 1]):  # up, until a taken subtree lies right
                node >>= 1
            if not node:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.any[2 * node] else 2 * node + 1
        room = node - self.size
        sequence = self.open[room].pop()
        if not self.open[room]:
            while node:
                self.any[node] = 0
                node >>= 1
                if node and (self.any[2 * node] or self.any[2 * node + 1]):
                    break
        return room, sequence


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int], int]:
    """Sequence and offset of each length, given longest first; and how many sequences."""
    room, sequences, offsets, n = Room(window), [], [], 0
    for length in lengths:
        got = room.tightest(length) if length < window else None
        if got is None:
            got = (window, n)
            n += 1
        left, sequence = got
        sequences.append(sequence)
        offsets.append(window - left)
        if left > length:
            room.add(left - length, sequence)
    return sequences, offsets, n


def tokenized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, ranks: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens; all but a last are full."""
    path = ranks or default_ranks()
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"

    def run(batches):
        encoder = _encoder(path)
        end = np.uint32(END_ID).tobytes()
        for batch in batches:
            for part in slices(batch, 1):
                rows: list[tuple] = []
                for key, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = encoder.ids(value or "") + end
                    n = len(ids) // 4
                    rows += [(key, a, min(window, n - a), zlib.crc32(ids[4 * a : 4 * (a + window)]), n) for a in range(0, n, window)]
                columns = list(zip(*rows)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        encoder.clear()  # the worker may live on for stages of another kind

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, ranks: str | None = None, shard_bytes: int = 4 << 20) -> DataFrame:
    """Every piece with its sequence_id and offset in it; no sequence is longer than the window."""
    n_shards = pieces(text_bytes(docs, text), shard_bytes)
    # A third of all rows may be one row: copies are counted, then numbered and dealt apart.
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    counted = tokenized(docs, doc_id, text, window, ranks).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    copies = counted.select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy"))
    shard = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "copy"), F.lit(n_shards)).cast("int")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        sequences, offsets, _ = best_fit(table["length"].to_pylist(), window)
        base = table["shard"][0].as_py() << 40
        added = table.drop_columns("shard").append_column("sequence_id", pa.array(np.array(sequences, np.int64) + base))
        return added.append_column("offset", pa.array(offsets, pa.int64()))

    return copies.select(*columns, shard.alias("shard")).groupBy("shard").applyInArrow(place, schema)


def query(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
