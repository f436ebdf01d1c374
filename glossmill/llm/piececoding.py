"""Operator 6: SentencePiece (BPE) encoding and decoding by a merge-type prefix table.

For every prefix of a text there is exactly one last token of its encoding. A piece that ends at
a place is that token if it starts the text, or if the encoder leaves it and the last token of the
prefix before it as two tokens when given just both (merges inside either side run in the same
order whatever stands around, so the first merge across a border would show in the pair alone).
An Aho-Corasick automaton gives the pieces that end at each place, pair tests choose, and the ids
are read from the last prefix backwards.

No piece holds a word mark after another character, and characters outside the vocabulary never
merge, so a text falls into segments (a run of marks and what follows, or one line feed) whose
encodings don't depend on each other; each task keeps the short segments it met lately.

Edge cases: a null text is empty, and encodes to the end id alone; a null array of ids decodes
to ''. Characters that the vocabulary lacks become byte pieces; bytes that don't form UTF-8
decode to U+FFFD each. Texts of any length are taken whole.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmill.llm.bytewords import slices

MARK = "▁"
_SEGMENT = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")
CACHED, LONGEST = 300_000, 64  # segments of at most so many characters: some 50 MB of a Python worker
PAIRS = 400_000

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Segments(dict):
    """Segment to its ids, as the bytes of 32-bit numbers; forgets all when full, and keeps no long one.

    head: what stands before every key of this table.
    """

    def __init__(self, table: PieceTable, head: str = "") -> None:
        super().__init__()
        self.table, self.head = table, head

    def __missing__(self, segment: str) -> bytes:
        ids = np.array(self.table.encode_segment(self.head + segment), np.int32).tobytes()
        if len(segment) <= LONGEST:
            if len(self) >= CACHED:
                self.clear()
            self[segment] = ids
        return ids


class PieceTable:
    """Pieces of one model with their automaton and pair tests."""

    def __init__(self, path: str) -> None:
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.normalize("ﬁ  ①") != f"{MARK}ﬁ{MARK}{MARK}①":
            raise ValueError("only models that keep characters and put a mark first are supported")
        n = model.get_piece_size()
        self.end_id = model.eos_id()
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
        is_byte = [model.is_byte(i) for i in range(n)]
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.normal = {p: i for i, p in enumerate(self.pieces) if not special[i] and not is_byte[i]}
        if any(re.search(f"[^{MARK}]{MARK}|\n", p) for p in self.normal):
            raise ValueError("a piece crosses a word mark or line feed; segments would not be independent")
        self.scores = [model.get_score(i) for i in range(n)]
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.normal.items():
            if self._merged(piece) == [piece]:  # else the encoder never makes it
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        surface = [b"" if special[i] else p.replace(MARK, " ").encode() for i, p in enumerate(self.pieces)]
        for b, i in enumerate(self.byte_ids):
            surface[i] = bytes([b])
        surface[model.unk_id()] = " ⁇ ".encode()
        self.surface = surface
        self.numerals = [str(i) for i in range(n)]
        self._splits: dict[int, bool] = {}
        self.segments, self.marked = Segments(self), Segments(self, MARK)

    def _merged(self, text: str) -> list[str]:
        """What merging best-scored neighbours first, leftmost of equals, leaves of a short text."""
        parts = list(text)
        while len(parts) > 1:
            best, where = None, -1
            for k in range(len(parts) - 1):
                i = self.normal.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.scores[i] > best):
                    best, where = self.scores[i], k
            if best is None:
                break
            parts[where : where + 2] = [parts[where] + parts[where + 1]]
        return parts

    def splits(self, left: int, right: int) -> bool:
        """Whether the two tokens stay two; a character outside the vocabulary (< 0) never merges."""
        if left < 0 or right < 0:
            return True
        key = left << 32 | right
        known = self._splits.get(key)
        if known is None:
            if len(self._splits) >= PAIRS:
                self._splits.clear()
            a, b = self.pieces[left], self.pieces[right]
            known = self._splits[key] = self._merged(a + b) == [a, b]
        return known

    def encode_segment(self, text: str) -> list[int]:
        n = len(text)
        last = [0] * n  # last token of the prefix that ends here; -1 - code point outside the vocabulary
        width = [0] * n
        for end, (piece, size) in self.automaton.iter(text):
            if width[end]:
                continue
            start = end - size
            if start < 0:
                last[end], width[end] = piece, size
            else:
                if not width[start]:
                    self._outside(text, start, last, width)
                if self.splits(last[start], piece):
                    last[end], width[end] = piece, size
        out: list[int] = []
        at = n - 1
        while at >= 0:
            if not width[at]:
                self._outside(text, at, last, width)
            token = last[at]
            if token < 0:
                out.extend(self.byte_ids[b] for b in reversed(chr(-1 - token).encode()))
            else:
                out.append(token)
            at -= width[at]
        return out[::-1]

    @staticmethod
    def _outside(text: str, at: int, last: list[int], width: list[int]) -> None:
        last[at], width[at] = -1 - ord(text[at]), 1

    def encode(self, text: str) -> bytes:
        """The ids of a whole text with the end id, as bytes of 32-bit numbers."""
        end = self.end_id.to_bytes(4, "little")
        if not text:
            return end
        if text[0] == " " or "  " in text or MARK in text:  # runs of marks
            return b"".join(map(self.segments.__getitem__, _SEGMENT.findall(MARK + text.replace(" ", MARK)))) + end
        out: list[bytes] = []
        for i, line in enumerate(text.split("\n")):
            words = line.split(" ")
            if i:  # no mark before the first word of a further line
                out.append(self.segments["\n"])
                first = words.pop(0)
                if first:
                    out.append(self.segments[first])
            out += map(self.marked.__getitem__, words)
        return b"".join(out) + end

    def decode(self, ids: list[int]) -> str:
        whole = b"".join(map(self.surface.__getitem__, ids))
        first = next((s for s in map(self.surface.__getitem__, ids) if s), b"")
        return (whole[1:] if first[:1] == b" " else whole).decode("utf-8", "each_byte")


@lru_cache(maxsize=2)
def _table(path: str) -> PieceTable:
    return PieceTable(path)


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: str | None = None, and_decode: bool = False, digests: bool = False) -> DataFrame:
    """doc_id, ids array<int>: every whole text with the end id after it.

    ``and_decode`` adds ``decoded``, the text that the ids give, without another pass. ``digests`` gives, of
    both, n_tokens, ids_sha256 and decoded_sha256 instead: neither leaves the Python worker.
    """
    path = model or default_model()
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["doc_id", "ids", *["decoded"][: int(and_decode)]]
    sha = lambda value: hashlib.sha256(value.encode()).hexdigest()

    def digested(table, each):
        lists = (np.frombuffer(x, np.int32).tolist() for x in each)
        rows = [(len(ids), sha(" ".join(map(table.numerals.__getitem__, ids))), sha(table.decode(ids))) for ids in lists]
        return [pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.int64(), pa.string(), pa.string()))]

    def listed(table, each):
        offsets = np.cumsum([0, *(len(x) // 4 for x in each)], dtype=np.int32)
        columns = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(each), np.int32)))]
        if and_decode:
            columns.append(pa.array([table.decode(np.frombuffer(x, np.int32).tolist()) for x in each], pa.string()))
        return columns

    def run(batches):
        table = _table(path)
        for batch in batches:
            for part in slices(batch, 1):
                each = [table.encode(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), *(digested if digests else listed)(table, each)], names)
        table.segments.clear()  # the worker may live on for stages of another kind
        table.marked.clear()

    kinds = {"doc_id": "long", "n_tokens": "long", "ids": "array<int>"}
    schema = ", ".join(f"{n} {kinds.get(n, 'string')}" for n in names)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, ids: str = "ids", model: str | None = None) -> DataFrame:
    """The frame with the column ``decoded`` for its ids; a column of that name is replaced."""
    path = model or default_model()
    rows = encoded.drop("decoded")
    at = rows.columns.index(ids)
    schema = ", ".join(f"`{c}` {kind}" for c, kind in rows.dtypes) + ", decoded string"

    def run(batches):
        table = _table(path)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                texts = [table.decode(x or []) for x in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "decoded"])

    return rows.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode(docs, digests=True)
