"""One huge JSON document, read by many tasks.

A document without line breaks between its elements can't be split by a text reader, since what a byte means depends on
whether a string is open there and how deep it stands. Both are sums over the bytes before: unescaped quotes modulo two,
and brackets that open less brackets that close, outside strings. So each byte range is summed up on its own, once for
either parity (escapes need only the run of backslashes right before the range), the sums of the ranges before give each
range its true start, and then every task cuts its range at the commas of the wanted depth. An element belongs to the range
it starts in, whose task reads on to its end.

The driver holds four numbers a range and the top-level members, nothing else of the document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from trackloom.session import ship_package
from trackloom.sources.files import locate, read_range

SPLIT_BYTES = 16_000_000
QUOTE, BACKSLASH, COMMA = b'"'[0], b"\\"[0], b","[0]
_STEP = np.zeros(256, np.int8)
_STEP[[ord(c) for c in "[{"]] = 1
_STEP[[ord(c) for c in "]}"]] = -1


def backslashes_before(path: str, at: int) -> int:
    """How many backslashes stand right before a place."""
    count, size = 0, 64
    while count < at:
        size = min(size, at - count)
        held = read_range(path, at - count - size, size)
        run = len(held) - len(held.rstrip(b"\\"))
        count += run
        if run < len(held):
            break
        size *= 4
    return count


class Structure:
    """What the bytes of a range mean, given how many backslashes stand before it and whether a string is open."""

    def __init__(self, data: bytes, before: int, inside: bool, depth: int = 0):
        raw = np.frombuffer(data, np.uint8)
        quotes = np.flatnonzero(raw == QUOTE)
        if len(quotes):
            place = np.arange(len(raw))
            other = np.maximum.accumulate(np.where(raw != BACKSLASH, place, -1))  # last byte that is no backslash
            last = np.where(quotes > 0, other[quotes - 1], -1)
            run = quotes - 1 - last + np.where(last < 0, before, 0)
            quotes = quotes[run % 2 == 0]
        self.parity = len(quotes) & 1
        marks = np.zeros(len(raw), np.int8)
        marks[quotes] = 1
        open_string = (np.cumsum(marks, dtype=np.int64) + int(inside)) & 1
        step = np.where(open_string == 0, _STEP[raw], 0)
        self.after = depth + np.cumsum(step, dtype=np.int64)  # depth after each byte
        self.step, self.commas = step, (raw == COMMA) & (open_string == 0)

    def total(self) -> int:
        """Depth at the end."""
        return int(self.after[-1]) if len(self.after) else 0

    def opened(self, depth: int) -> np.ndarray:
        """Brackets that open something at this depth."""
        return np.flatnonzero((self.step > 0) & (self.after == depth + 1))

    def closed(self, depth: int) -> np.ndarray:
        """Brackets that close it."""
        return np.flatnonzero((self.step < 0) & (self.after == depth))

    def separators(self, depth: int) -> np.ndarray:
        return np.flatnonzero(self.commas & (self.after == depth))


def _key_before(path: str, at: int) -> str:
    """The name of the member whose value starts at a place; empty for a value without a name."""
    size = 256
    while True:
        held = read_range(path, max(0, at - size), min(size, at))
        head = held.rstrip()
        if head.endswith(b":"):
            head = head[:-1].rstrip()
            end = len(head) - 1
            begin = head.rfind(b'"', 0, max(end, 0))
            while begin > 0 and (begin - len(head[:begin].rstrip(b"\\"))) % 2:
                begin = head.rfind(b'"', 0, begin)
            if begin >= 0 and (begin > 0 or len(held) < size or at <= size):
                return head[begin + 1 : end].decode(errors="replace")
        elif head:
            return ""
        if size >= at:
            return ""
        size *= 8


def _ranges(spark: SparkSession, path: str, size: int, split_bytes: int) -> DataFrame:
    n = -(-size // split_bytes)
    return spark.range(0, n, 1, n).select(F.col("id").alias("split"))


def _starts(spark: SparkSession, path: str, size: int, split_bytes: int) -> np.ndarray:
    """For each range, whether a string is open where it begins, and the depth there."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for split in batch.column(0).to_pylist():
                begin = split * split_bytes
                data, before = read_range(path, begin, split_bytes), backslashes_before(path, begin)
                outside, inside = Structure(data, before, False), Structure(data, before, True)
                rows.append((split, outside.parity, outside.total(), inside.total()))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["split", "parity", "outside", "inside"])

    found = _ranges(spark, path, size, split_bytes).mapInArrow(sums, "split long, parity long, outside long, inside long").toPandas()
    starts, open_string, depth = np.zeros((len(found), 2), np.int64), 0, 0
    for i, (_, parity, outside, inside) in enumerate(found.sort_values("split").to_numpy().tolist()):
        starts[i] = open_string, depth
        depth += inside if open_string else outside
        open_string ^= parity
    if open_string or depth:
        raise ValueError(f"{path} is not a whole JSON document")
    return starts


class Document:
    """A JSON document as byte ranges: ``members`` are the containers of its top level, as name, begin and end."""

    def __init__(self, spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES):
        store, name = locate(path)
        self.spark, self.path, self.split_bytes = spark, path, split_bytes
        self.size = store.get_file_info(name).size
        ship_package(spark)
        self.starts = _starts(spark, path, self.size, split_bytes)
        first = read_range(path, 0, 1_000).lstrip()
        #: an array stands at depth 0 itself, an object's members at depth 1
        self.level = 0 if first.startswith(b"[") else 1
        self.members = self._members()

    def _each(self, work, schema: str) -> DataFrame:
        """``work(begin, structure, data)`` gives the rows of each range."""
        path, size, starts = self.path, self.split_bytes, self.starts
        names = [part.split()[0] for part in schema.split(", ")]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for split in batch.column(0).to_pylist():
                    begin = split * size
                    data = read_range(path, begin, size)
                    inside, depth = starts[split].tolist()
                    found = Structure(data, backslashes_before(path, begin), bool(inside), depth)
                    for columns in work(begin, found, data):
                        yield pa.RecordBatch.from_arrays(columns, names)

        return _ranges(self.spark, path, self.size, size).mapInArrow(run, schema)

    def _members(self) -> list[tuple[str, int, int]]:
        level, path = self.level, self.path

        def work(begin: int, found: Structure, data: bytes) -> Iterator[list[pa.Array]]:
            opened, closed = found.opened(level).tolist(), found.closed(level).tolist()
            if opened or closed:
                names = [_key_before(path, begin + i) for i in opened]
                yield [pa.array([begin + i for i in opened + closed], pa.int64()), pa.array([True] * len(opened) + [False] * len(closed)), pa.array(names + [None] * len(closed), pa.string())]

        rows = sorted(tuple(r) for r in self._each(work, "place long, opens boolean, name string").collect())
        return [(a[2] or "", a[0], b[0]) for a, b in zip(rows[::2], rows[1::2], strict=True)]

    def text(self, name: str) -> str | None:
        """A member as it stands in the document, None if there is none."""
        for member, begin, end in reversed(self.members):
            if member == name:
                return read_range(self.path, begin, end - begin + 1).decode(errors="replace")
        return None

    def elements(self, name: str = "") -> DataFrame:
        """place and text of the elements of an array member, or of the document that is an array."""
        begin, end = next(((b, e) for member, b, e in reversed(self.members) if member == name), (0, -1))
        level, path, size, step, starts = self.level + 1, self.path, self.size, self.split_bytes, self.starts

        def work(offset: int, found: Structure, data: bytes) -> Iterator[list[pa.Array]]:
            cuts = offset + found.separators(level)
            cuts = cuts[(cuts > begin) & (cuts < end)].tolist()
            if offset <= begin < offset + len(data) and begin < end:
                cuts.insert(0, begin)
            if not cuts:
                return
            last, held = end, [data]
            if offset + len(data) <= end:  # the last element may go on in the next ranges
                here, at, depth = None, offset + len(data), found.total()
                inside = (found.parity + int(starts[offset // step][0])) & 1
                while here is None and at < min(end, size):
                    more = read_range(path, at, step)
                    rest = Structure(more, backslashes_before(path, at), bool(inside), depth)
                    nexts = rest.separators(level)
                    nexts = nexts[at + nexts < end]
                    here = at + int(nexts[0]) if len(nexts) else None
                    held.append(more)
                    at, inside, depth = at + len(more), (inside + rest.parity) & 1, rest.total() if len(more) else depth
                last = here if here is not None else end
            whole = b"".join(held)
            bounds = [*cuts, last]
            for k in range(0, len(cuts), 10_000):
                part = [(a + 1, whole[a + 1 - offset : b - offset].strip()) for a, b in zip(cuts[k : k + 10_000], bounds[k + 1 : k + 10_001], strict=True)]
                part = [x for x in part if x[1]]
                if part:
                    yield [pa.array([a for a, _ in part], pa.int64()), pa.array([t.decode(errors="replace") for _, t in part], pa.string())]

        return self._each(work, "place long, text string")
