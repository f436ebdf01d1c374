"""Words of many documents as numpy arrays over one byte buffer.

Everything here works on a *block*: the UTF-8 bytes of some documents laid end to end, with the
offsets at which each begins. Window hashes are polynomial, taken from prefix sums modulo 2**64,
so a block costs a handful of array passes whatever the length of its texts or windows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = b" \t\n\x0b\x0c\r"  # [\x20\x09-\x0D]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
LOWER_AZ = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_LOWER = np.frombuffer(LOWER_AZ, np.uint8)

_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, so that every bit of a hash depends on every bit of x."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i modulo 2**64 for i < n, kept up to a million."""
    if _POWERS and len(_POWERS[0][0]) >= n:
        return _POWERS[0]
    size = max(n, 1 << 16)
    out = []
    for b in (_BASE, np.uint64(pow(int(_BASE), -1, 1 << 64))):
        p = np.full(size, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    if size <= 1 << 20:
        _POWERS[:] = [(out[0], out[1])]
    return out[0], out[1]


def window_hashes(hashes: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Hash of hashes[i:i + k] for each i of ``at``."""
    up, down = _powers(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return mix((sums[at + k] - sums[at]) * down[at])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[starts[i]:ends[i]] for each i, eight bytes at a time."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    lengths = ends - starts
    out = mix(lengths.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    rest, at, left = np.arange(len(starts)), starts, lengths
    while len(rest):
        keep = np.minimum(left, 8).astype(np.uint64) * np.uint64(8)
        value = eights[at] & (~np.uint64(0) >> (np.uint64(64) - keep))
        out[rest] = mix(out[rest] ^ value) if len(rest) < len(out) else mix(out ^ value)
        more = left > 8
        rest, at, left = rest[more], at[more] + 8, left[more] - 8
    return out


class Block:
    """Texts of one block. ``data``: bytes; ``bounds``: n + 1 offsets; a null text is empty."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, lower: bool = False) -> None:
        self.bounds = bounds
        self.data = _LOWER[data] if lower else data
        self.n_docs = len(bounds) - 1
        solid = ~_IS_SPACE[self.data]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        last = solid.copy()
        last[:-1] &= ~solid[1:]
        inner = bounds[:-1][bounds[:-1] < len(data)]
        first[inner] = solid[inner]
        inner = bounds[1:][bounds[1:] > 0] - 1
        last[inner] = solid[inner]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        #: Index of the first word of each document, and one past the last.
        self.word_bounds = np.searchsorted(self.starts, bounds)
        self.n_words = np.diff(self.word_bounds)
        self._hashes: np.ndarray | None = None

    @classmethod
    def of(cls, texts: pa.Array | pa.ChunkedArray, lower: bool = False) -> Block:
        data, bounds = buffers(texts)
        return cls(data, bounds, lower)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), self.n_words)

    def hashes(self) -> np.ndarray:
        """One 64-bit hash for each word."""
        if self._hashes is None:
            self._hashes = word_hashes(self.data, self.starts, self.ends)
        return self._hashes

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Start words of all windows of k words inside one document, and their hashes."""
        left = np.repeat(self.word_bounds[1:], self.n_words) - np.arange(len(self.starts))
        at = np.flatnonzero(left >= k)
        return at, window_hashes(self.hashes(), at, k)

    def words(self, doc: int) -> list[bytes]:
        return self.data[self.bounds[doc] : self.bounds[doc + 1]].tobytes().split()


def buffers(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and its offsets from 0; nulls are empty texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    if texts.null_count:
        texts = texts.fill_null("")
    wide = texts.cast(pa.large_string())
    _, offsets, data = wide.buffers()
    bounds = np.frombuffer(offsets, np.int64)[wide.offset : wide.offset + len(wide) + 1] if len(wide) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(batch: pa.RecordBatch, text: int, limit: int = 4 << 20):
    """Pieces of a batch with about ``limit`` bytes of text each, or one longer document."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), np.int64) if batch.num_rows else np.zeros(0, np.int64)
    part = np.cumsum(lengths) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)
