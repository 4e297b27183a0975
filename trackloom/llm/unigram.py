"""Unigram encoding and decoding over the pieces of a SentencePiece vocabulary.

Pieces stand in a double-array trie over bytes, in which the whitespace marker is the byte of the space. The best
segmentation is found by Viterbi over log scores. A character that no piece covers is an unknown step ten below the lowest
score and comes out as byte pieces. No piece goes on after a marker that follows other characters, so the best path of a text is
that of its stretches, each a run of spaces with what follows it; a task works each distinct stretch out once. All
stretches of a batch walk the trie and the lattice side by side.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.words import slices

MARKER = "▁"
#: Distinct stretches that a task remembers, and bytes of the longest that it does.
REMEMBERED, LONGEST = 300_000, 64
_STRETCH = re.compile(rb" *[^ ]+| +$")


class Trie:
    """Double-array trie: the child of node s by byte c is base[s] + c if check there is s. value: id of the piece, or -1."""

    def __init__(self, pieces: list[tuple[bytes, int]]):
        children: list[dict[int, int]] = [{}]
        value = [-1]
        for piece, number in pieces:
            node = 0
            for c in piece:
                nxt = children[node].get(c)
                if nxt is None:
                    nxt = children[node][c] = len(children)
                    children.append({})
                    value.append(-1)
                node = nxt
            value[node] = number
        size = 4 * len(children) + 4096
        base, check, ids = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        used = np.zeros(size, bool)
        used[0] = True
        place = [0] * len(children)
        free = 1  # below it, few slots are free
        for node, keys in enumerate(map(sorted, children)):  # parents come before their children
            at = place[node]
            ids[at] = value[node]
            if not keys:
                continue
            begin = free
            while True:
                slots = np.flatnonzero(~used[begin : begin + 2048]) + begin
                slots = slots[slots > keys[0]]
                fits = np.ones(len(slots), bool)
                for c in keys[1:]:
                    fits &= ~used[slots + (c - keys[0])]
                if fits.any():
                    break
                begin += 2048
            if len(slots) < 64 and begin == free:
                free += 2048
            base[at] = first = int(slots[fits.argmax()]) - keys[0]
            for c in keys:
                used[first + c] = True
                check[first + c] = at
                place[children[node][c]] = first + c
        self.base, self.check, self.value = base, check, ids

    def walk(self, nodes: np.ndarray, bytes_: np.ndarray) -> np.ndarray:
        """The children of nodes by bytes, -1 where there is none."""
        at = self.base[nodes] + bytes_
        return np.where((self.check[at] == nodes) & (self.base[nodes] > 0), at, -1)


class Vocabulary:
    """Pieces with log scores. Scores are those of Zipf's law for a piece's rank, as the file's own only rank the pieces."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.text = [b""] * n
        self.byte = np.full(256, -1, np.int64)
        ranked = []
        for i in range(n):
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[3:-1], 16)
                self.byte[value], self.text[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.text[i] = model.id_to_piece(i).replace(MARKER, " ").encode()
                ranked.append((-model.get_score(i), i))
        self.is_byte = np.zeros(n, bool)
        self.is_byte[self.byte[self.byte >= 0]] = True
        ranked.sort()
        self.score = np.zeros(n)
        order = np.array([i for _, i in ranked])
        self.score[order] = -np.log(np.arange(2, len(order) + 2)) - np.log(np.sum(1 / np.arange(2, len(order) + 2)))
        self.unknown = float(self.score[order].min()) - 10.0
        if any(b" " in t.lstrip(b" ") for t in self.text):
            raise ValueError("a piece has a marker after other characters")
        if (self.byte < 0).any():
            raise ValueError("the vocabulary lacks byte pieces")
        self.sizes = np.array([len(t) for t in self.text])
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(self.text), np.uint8)
        self.longest = max(len(self.text[i]) for i in order.tolist())
        self.trie = Trie([(self.text[i], i) for i in order.tolist()])

    def segment(self, stretches: list[bytes]) -> list[tuple[np.ndarray, float]]:
        """Ids and log score of each stretch."""
        sizes = np.array([len(s) for s in stretches])
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        data = np.frombuffer(b"".join([stretches[i] for i in order.tolist()]), np.uint8)
        first = np.cumsum(sizes) - sizes
        end = np.repeat(first + sizes, sizes)
        # ids of the pieces that start at each byte, by length
        nodes, live = np.zeros(len(data), np.int64), np.arange(len(data))
        starts_at = (data & 0xC0) != 0x80
        live = live[starts_at]
        nodes = nodes[starts_at]
        steps = []
        for length in range(1, self.longest + 1):
            inside = live + length <= end[live]
            live, nodes = live[inside], nodes[inside]
            nodes = self.trie.walk(nodes, data[live + length - 1].astype(np.int64))
            live, nodes = live[nodes >= 0], nodes[nodes >= 0]
            if not len(live):
                break
            hit = self.trie.value[nodes]
            match = np.full(len(data), -1, np.int32)
            match[live[hit >= 0]] = hit[hit >= 0]
            steps.append(match)
        width = np.where(data < 0x80, 1, np.where(data < 0xE0, 2, np.where(data < 0xF0, 3, 4)))
        best = np.full(len(data) + len(sizes), -np.inf)  # a cell per byte, and one for the end of each stretch
        cell = first + np.arange(len(sizes))
        best[cell] = 0.0
        came, piece = np.zeros(len(best), np.int32), np.full(len(best), -1, np.int32)
        n_live = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), side="left")
        for t, n in enumerate(n_live.tolist()):
            here, at = best[cell[:n] + t], first[:n] + t
            open_ = np.flatnonzero(np.isfinite(here))
            single = np.zeros(len(open_), bool)
            for length, match in enumerate(steps, 1):
                ids = match[at[open_]]
                some = np.flatnonzero(ids >= 0)
                if len(some):
                    rows = open_[some]
                    single[some] |= length == width[at[rows]]
                    self._relax(best, came, piece, cell[rows] + t + length, here[rows] + self.score[ids[some]], length, ids[some])
            rows = open_[~single]
            if len(rows):
                w = width[at[rows]]
                self._relax(best, came, piece, cell[rows] + t + w, here[rows] + self.unknown, w, np.full(len(rows), -1))
        out: list = [None] * len(sizes)
        came_list, piece_list = came.tolist(), piece.tolist()
        for j, i in enumerate(order.tolist()):
            at, ids = int(sizes[j]), []
            base = int(cell[j])
            while at > 0:
                step, p = came_list[base + at], piece_list[base + at]
                if p < 0:
                    ids += self.byte[data[first[j] + at - step : first[j] + at]][::-1].tolist()
                else:
                    ids.append(p)
                at -= step
            out[i] = (np.array(ids[::-1], "<u4"), float(best[base + sizes[j]]))
        return out

    @staticmethod
    def _relax(best, came, piece, to, score, length, ids) -> None:
        better = score > best[to]
        to = to[better]
        best[to] = score[better]
        came[to] = length[better] if isinstance(length, np.ndarray) else length
        piece[to] = ids[better]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: markers become spaces, byte pieces bytes, and the marker in front goes. Broken bytes become U+FFFD."""
        sizes = self.sizes[ids]
        at = np.arange(int(sizes.sum())) + np.repeat(self.begins[ids] - (np.cumsum(sizes) - sizes), sizes)
        raw = self.bytes[at].tobytes()
        return raw[1:].decode(errors="replace") if raw[:1] == b" " else raw.decode(errors="replace")


class Encoder:
    """Encodes whole texts; stretches are worked out once and remembered, as many as ``REMEMBERED``."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.sizes, self.scores = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0)

    def _learn(self, stretches: list[bytes]) -> None:
        found = self.vocabulary.segment(stretches)
        self.known |= zip(stretches, range(len(self.sizes), len(self.sizes) + len(found)), strict=True)
        self.ids = np.concatenate((self.ids, *[x[0] for x in found]))
        self.sizes = np.concatenate((self.sizes, [len(x[0]) for x in found])).astype(np.int64)
        self.scores = np.concatenate((self.scores, [x[1] for x in found]))

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, float]]:
        """Ids and log score of each text. Like the library, puts a marker in front of a text that is not empty."""
        parts = [_STRETCH.findall(b" " + t.replace(MARKER, " ").encode()) if t else [] for t in texts]
        every = [p for part in parts for p in part]
        if len(self.known) > REMEMBERED:
            self._forget()
        new = list(set(every).difference(self.known))
        if new:
            self._learn(new)
        at = np.array(list(map(self.known.__getitem__, every)), np.int64)
        sizes, begins = self.sizes[at], (np.cumsum(self.sizes) - self.sizes)[at]
        ids = self.ids[np.arange(int(sizes.sum())) + np.repeat(begins - (np.cumsum(sizes) - sizes), sizes)]
        ends = np.cumsum([0] + [len(part) for part in parts])
        cuts = np.concatenate(([0], np.cumsum(sizes)))[ends]
        out = []
        for i in range(len(texts)):
            out.append((ids[cuts[i] : cuts[i + 1]], float(self.scores[at[ends[i] : ends[i + 1]]].sum())))
        if any(len(p) > LONGEST for p in new):
            self.known = {p: i for p, i in self.known.items() if len(p) <= LONGEST}
        return out


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, score: one row per input row; a null or empty text has no ids. Other columns are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in slices(batches):
            ids, scores = zip(*encoder.encode(batch.column("text").to_pylist()), strict=True)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())), pa.array(scores, pa.float64())], ["doc_id", "ids", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>, score double")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows with ``ids``; null ids give a null text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(path)
        for batch in batches:
            texts = [None if x is None else vocabulary.decode(np.array(x, np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def round_trips(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_ids, n_byte_ids, ids_sha256 (little-endian, 32 bits each), score, decoded_sha256 and same: whether decoding gives the text.

    One row per input row, repeated rows and ids too. A null or empty text has no ids and decodes to the empty text. A text
    that has the marker itself decodes to spaces there. Columns besides doc_id and text are left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        v = encoder.vocabulary
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            rows = []
            for text, (ids, score) in zip(texts, encoder.encode(texts), strict=True):
                back = v.decode(ids)
                rows.append((len(ids), int(v.is_byte[ids].sum()), hashlib.sha256(ids.tobytes()).hexdigest(), float(score), hashlib.sha256(back.encode()).hexdigest(), back == (text or "")))
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.string(), pa.bool_()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_ids", "n_byte_ids", "ids_sha256", "score", "decoded_sha256", "same"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_ids long, n_byte_ids long, ids_sha256 string, score double, decoded_sha256 string, same boolean")
