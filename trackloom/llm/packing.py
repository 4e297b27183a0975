"""Best-fit packing of token sequences by the sum-of-squares rule.

A document becomes pieces of at most ``capacity`` tokens; only its first piece can be shorter. Full pieces are
sequences of their own, numbered where they are: they are not shuffled, so long documents load no task. The short ones, at
most one a document, are dealt over tasks, and each task places its pieces, longest first, where the squared counts of open
bins per residual gap become smallest. Tasks get about ``PIECES_PER_TASK`` short pieces, which bounds their memory and makes
the few bins that each leaves open a fixed small share at every input size.
"""

from __future__ import annotations

import base64
import math
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.tables import written
from trackloom.llm.words import slices

CAPACITY = 2048
#: Short pieces that one task packs. A bin holds two or more of them on average.
PIECES_PER_TASK = 20_000
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, kind long"
_PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class Encoder:
    """Ids of a public byte-level BPE vocabulary, given as ranks; the same as those of its ``tokenizers`` file.

    special: strings that stand for an id of their own wherever they occur, as in that file.
    """

    def __init__(self, path: str, pattern: str, special: dict[str, int]):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, without special tokens around them."""
        return self.encoding.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)


def _documents(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def token_pieces(docs: DataFrame, tokenizer: tuple, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (of the piece's ids) and kind (of the whole document's).

    tokenizer: what ``Encoder`` is made with: path of the ranks, pattern, special tokens.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*tokenizer)
        end = np.array([end_id], dtype="<u4")
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                raw = np.concatenate((encoder.encode(text.as_py()), end)).tobytes()
                n = len(raw) // 4
                kind = zlib.crc32(raw)
                first = n % capacity or capacity
                bounds = [0, *range(first, n + 1, capacity)]
                rows += [(doc_id, i, a, b - a, zlib.crc32(raw[4 * a : 4 * b]), kind) for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), *[pa.int64()] * 4), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "kind"])

    return _documents(docs).mapInArrow(cut, _PIECES)


def place(lengths: list[int], capacity: int = CAPACITY) -> tuple[list[int], list[int]]:
    """The bin and the offset of each length, in the order given, by the sum-of-squares rule.

    Putting length s into an open bin of gap g changes the sum of squares by 2 * (N[g - s] - N[g]) + 2, or by 1 - 2 * N[s]
    if that fills the bin. The smallest change wins; of equals, the smallest gap. A new bin is opened only if s fits in none.
    """
    counts = np.zeros(capacity + 1, dtype=np.int64)
    open_bins: dict[int, list[int]] = defaultdict(list)
    bins, offsets, n_bins = [], [], 0
    huge = np.iinfo(np.int64).max
    for s in lengths:
        gaps = counts[s:capacity]
        gap = capacity
        if len(gaps):
            changes = 2 * (counts[: capacity - s] - gaps) + 2
            changes[0] = 1 - 2 * gaps[0]
            changes[gaps == 0] = huge
            at = int(changes.argmin())
            if changes[at] != huge:
                gap = s + at
        if gap == capacity:
            number, n_bins = n_bins, n_bins + 1
        else:
            number = open_bins[gap].pop()
            counts[gap] -= 1
        if gap > s:
            counts[gap - s] += 1
            open_bins[gap - s].append(number)
        bins.append(number)
        offsets.append(capacity - gap)
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY, tasks: int = 1) -> DataFrame:
    """The pieces with sequence_id and offset. A sequence never has more than ``capacity`` tokens and has no gaps.

    ``tasks`` share the short pieces. Sequences of one full piece have negative numbers, the others don't.
    """
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if table is None:
            return
        # the order does not depend on how the rows arrived, so a task that is run again gives the same
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("kind", "ascending"), ("piece", "ascending")])
        lengths = table.column("length").to_pylist()
        bins, offsets = place(lengths, capacity)
        first = TaskContext.get().partitionId() << 40
        table = table.drop_columns(["kind"]).append_column("sequence_id", pa.array([first + b for b in bins], pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))
        yield from table.to_batches()

    alone = pieces.where(F.col("length") >= capacity).drop("kind").withColumns(
        {"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")}
    )
    short = pieces.where(F.col("length") < capacity)
    return short.repartition(tasks, "doc_id", "kind", "piece").mapInArrow(packed, _PLACED).unionByName(alone)


def pack_documents(docs: DataFrame, tokenizer: tuple, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Packs all documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset, one row per piece.

    A null or empty text is just the end id. Repeated rows and repeated or null doc_ids are documents of their own.
    Columns other than doc_id and text are left out, whatever their names. No documents, no rows.
    """
    # the pieces are read three times below, the texts once
    pieces = written(token_pieces(docs, tokenizer, end_id, capacity), "pieces")
    tasks = max(1, math.ceil(pieces.where(F.col("length") < capacity).count() / PIECES_PER_TASK))
    return pack(pieces, capacity, tasks)
