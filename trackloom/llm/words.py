"""Words and their hashes, for whole Arrow batches at a time.

A word is a maximal run of bytes other than space and 0x09-0x0D. Hashes are 64-bit sums over bytes, so that all words
of a batch are hashed by a handful of NumPy passes instead of one call a word.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts are worked on in slices of about so many bytes; a longer text is a slice of its own.
SLICE_BYTES = 2_000_000
#: Stands for a null doc_id: it sorts first.
NULL_KEY = -(2**63)

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_WORD_BASE = np.uint64(0xD6E8FEB86659FD93)
_WORD_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 2**64))


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: spreads the bits of each 64-bit number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(fold: bool) -> np.ndarray:
    values = mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)
    if fold:
        values[65:91] = values[97:123]
    return values


_BYTES = {fold: _byte_values(fold) for fold in (False, True)}


@functools.lru_cache(maxsize=8)
def _powers_up_to(size: int, base: int) -> np.ndarray:
    out = np.full(size, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(n: int, base: np.uint64) -> np.ndarray:
    """base**0 ... base**(n-1), modulo 2**64."""
    size = 1 << max(16, int(n - 1).bit_length())
    if size > 1 << 22:
        return _powers_up_to.__wrapped__(n, int(base))
    return _powers_up_to(size, int(base))[:n]


class Words:
    """The words of some texts: byte ``starts`` and ``ends``, number of the text (``doc``), and ``hashes``."""

    def __init__(self, texts: pa.Array, fold: bool = False, separators: np.ndarray = _SEPARATOR):
        """fold: A-Z count as a-z. separators: which of the 256 bytes stand between words. A null text has no words."""
        texts = texts.cast(pa.large_string())
        if texts.null_count:
            texts = pc.fill_null(texts, "")
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
        raw = texts.buffers()[2] if n else None
        data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
        self.data, self.offsets = data, offsets - offsets[0]
        inside = np.zeros(len(data) + 2, dtype=bool)
        inside[1:-1] = ~separators[data]
        opens, closes = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        first = self.offsets[:-1][self.offsets[:-1] < self.offsets[1:]]
        if len(first):  # texts follow each other without a gap
            opens[first] = inside[1:-1][first]
            last = first[1:] - 1
            closes[last] = inside[1:-1][last]
        self.starts, self.ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.per_doc = np.diff(np.searchsorted(self.starts, self.offsets))
        self.doc = np.repeat(np.arange(n), self.per_doc)
        self.first = np.concatenate(([0], np.cumsum(self.per_doc)))
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[fold][data] * powers(max(len(data), 1), _BASE)[: len(data)], dtype=np.uint64, out=sums[1:])
        raw_hash = (sums[self.ends] - sums[self.starts]) * powers(max(len(data), 1), _INVERSE)[self.starts] if len(self.starts) else np.zeros(0, np.uint64)
        self.hashes = mixed(raw_hash + (self.ends - self.starts).astype(np.uint64) * _WORD_BASE)

    def __len__(self) -> int:
        return len(self.starts)

    def texts(self) -> list[bytes]:
        """The words themselves."""
        raw = self.data.tobytes()
        return [raw[a:b] for a, b in zip(self.starts.tolist(), self.ends.tolist(), strict=True)]

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the n words from each word on, and whether they are of one text (one entry a word, less n - 1)."""
        return gram_hashes(self.hashes, n), self.doc[: max(len(self) - n + 1, 0)] == self.doc[n - 1 :]


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash of each n consecutive hashes."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * powers(len(hashes), _WORD_BASE), dtype=np.uint64, out=sums[1:])
    return mixed((sums[n:] - sums[:-n]) * powers(len(hashes), _WORD_INVERSE)[:m])


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most`` bytes of ``column``: small batches are joined, large ones are cut."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        begin = 0
        for i, length in enumerate(lengths.tolist()):
            if size and size + length > most:
                held.append(batch.slice(begin, i - begin))
                yield from joined(held)
                held, size, begin = [], 0, i
            size += length
        held.append(batch.slice(begin))
    yield from joined(held)


def joined(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One batch of several, none if they have no rows."""
    batches = [b for b in batches if b.num_rows]
    if batches:
        yield pa.concat_batches(batches) if len(batches) > 1 else batches[0]


def key_of(doc_id: str = "doc_id") -> Column:
    """The doc_id as a number that is never null."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_KEY))


def blobs(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary column: row i holds the bytes of values[bounds[i]:bounds[i + 1]]."""
    width = values.dtype.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * width).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(values))])


def unblobs(column: pa.Array, dtype: np.dtype | str) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows of a binary column end to end, and how many each row has."""
    column = column.cast(pa.large_binary())
    n, width = len(column), np.dtype(dtype).itemsize
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return np.frombuffer(data.tobytes(), dtype=dtype), np.diff(offsets) // width
