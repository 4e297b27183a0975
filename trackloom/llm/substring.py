"""Substring dedup by Relative Lempel-Ziv parsing.

Documents come in blocks of about ``words.SLICE_BYTES``. Every block is a reference for all that follows it in
(doc_id, position) order, and every document is factored against all of them:

1. Inside its block a document is parsed against the block itself (one index of the block's windows).
2. What is new in its block is filed under anchors. The anchor of a window is the smallest hash of the short grams in
   it; equal windows have equal anchors, so the task that holds an anchor holds every block's index entries that can
   match, and no block pair is visited that shares no anchor. Each window there is looked up in the entries of all
   earlier documents.
3. A window's source is the earliest place that has it. Pieces from 1 and 2 that go on in the same source, word by word,
   become one factor. So a factor ends where the earliest source of the next window is another one, and is not always
   the longest match over all sources. The words that factors cover are the same either way: windows that straddle the
   end of a factor were looked up like all others, so a repeat that no single factor covers is not lost.

A block sends each distinct window once, so a passage in a third of all documents arrives once per block. One shuffle
carries the windows (7 bytes a word and one row per run of about 9 words), one carries the texts to their factors.
Two windows count as equal if 56 bits of their hashes and the 64-bit hashes of their anchors agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.words import Words, blobs, gram_hashes, joined, key_of, slices, unblobs

#: Words in a window.
WINDOW = 20
#: Words in an anchor gram. Shorter grams give fewer, longer runs.
ANCHOR = 5
#: Bytes that are sent of a window's hash.
HASH_BYTES = 7
_RUNS = "anchor long, key long, kind int, start int, n int, source long, source_start int, windows binary"
_FACTORS = "key long, kind int, start int, n int, source long, source_start int"


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Smallest of each n consecutive values."""
    width = 1
    while width * 2 <= n:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    rest = n - width
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def _pieces(start, n_more, source, source_start):
    """First index of each stretch in which start and source go on word by word."""
    new = np.ones(len(start), dtype=bool)
    new[1:] = ~(n_more[1:] & (source[1:] == source[:-1]) & (start[1:] == start[:-1] + 1) & (source_start[1:] == source_start[:-1] + 1))
    return np.flatnonzero(new)


def _block_runs(batch: pa.RecordBatch, window: int) -> Iterator[pa.RecordBatch]:
    """Parses a block against itself; what is new in it goes out under its anchors."""
    key, kind = (batch.column(c).to_numpy() for c in ("key", "kind"))
    order = np.lexsort((kind, key))
    same = np.zeros(len(order), dtype=bool)
    same[1:] = (key[order][1:] == key[order][:-1]) & (kind[order][1:] == kind[order][:-1])
    batch = batch.take(pa.array(order[~same]))  # a repeated row is the same document
    key, kind = (batch.column(c).to_numpy() for c in ("key", "kind"))
    w = Words(batch.column("text"))
    hashes, whole = w.grams(window)
    at = np.flatnonzero(whole)
    if not len(at):
        return
    grams = gram_hashes(w.hashes, ANCHOR if window > ANCHOR else 1)
    anchors = sliding_min(grams, window - (ANCHOR if window > ANCHOR else 1) + 1)[at]
    hashes, doc = hashes[at], w.doc[at]
    start = (at - w.first[doc]).astype(np.int32)
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    source = first[which]
    fresh = source == np.arange(len(at))

    new = np.flatnonzero(fresh)
    breaks = np.ones(len(new), dtype=bool)
    breaks[1:] = (anchors[new][1:] != anchors[new][:-1]) | (doc[new][1:] != doc[new][:-1]) | (at[new][1:] != at[new][:-1] + 1)
    head = np.flatnonzero(breaks)
    bounds = np.append(head, len(new))
    top = new[head]
    none = pa.nulls(len(top), pa.int64())
    yield _batch(_RUNS, [anchors[top].view(np.int64), key[doc[top]], kind[doc[top]], start[top], np.diff(bounds).astype(np.int32), none, none.cast(pa.int32()), blobs(hashes[new].view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES], bounds * HASH_BYTES)])

    old = np.flatnonzero(~fresh)
    if len(old):
        src = source[old]
        head = _pieces(start[old], doc[old] == np.roll(doc[old], 1), doc[src], start[src])
        top, src = old[head], src[head]
        n = np.diff(np.append(head, len(old))).astype(np.int32)
        # these only pass through: dealt by document, not by anchor
        yield _batch(_RUNS, [(key[doc[top]] * 31 + kind[doc[top]]), key[doc[top]], kind[doc[top]], start[top], n, key[doc[src]], start[src], pa.nulls(len(top), pa.large_binary())])


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.strip().split(" ") for f in schema.split(",")]
    return pa.RecordBatch.from_arrays([(c if isinstance(c, pa.Array) else pa.array(c)).cast(kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def _match(rows: pa.RecordBatch, seen: tuple) -> tuple[pa.RecordBatch, tuple]:
    """Looks up each window among those of the same anchor that start earlier.

    seen: anchor, and for its windows so far the sorted hashes with key, kind and start of the earliest.
    """
    anchor, key, kind, start = (rows.column(c).to_numpy() for c in ("anchor", "key", "kind", "start"))
    raw, n = unblobs(rows.column("windows"), np.uint8)
    n = n // HASH_BYTES
    hashes = np.zeros((len(raw) // HASH_BYTES, 8), np.uint8)
    hashes[:, :HASH_BYTES] = raw.reshape(-1, HASH_BYTES)
    hashes = hashes.view(np.uint64).ravel()
    row = np.repeat(np.arange(rows.num_rows), n)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    a, k, d, s = anchor[row], key[row], kind[row], start[row] + at.astype(np.int32)
    old = np.zeros(len(row), dtype=bool)
    last, held, held_key, held_kind, held_start = seen
    offset = 0
    if len(held) and last is not None:
        offset = len(held)
        a, hashes = np.concatenate((np.full(offset, last), a)), np.concatenate((held, hashes))
        k, d, s = np.concatenate((held_key, k)), np.concatenate((held_kind, d)), np.concatenate((held_start, s))
    order = np.lexsort((s, d, k, hashes, a))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    lead = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    source = np.empty(len(order), dtype=np.int64)
    source[order] = lead
    end = anchor[-1]
    keep = np.flatnonzero((a == end) & (source == np.arange(len(a))))
    seen = (end, hashes[keep], k[keep], d[keep], s[keep])
    old = (k != k[source]) | (d != d[source]) | (s != s[source])
    old[:offset] = False
    hit = np.flatnonzero(old)
    src = source[hit]
    together = np.zeros(len(hit), dtype=bool)
    together[1:] = (row[hit[1:] - offset] == row[hit[:-1] - offset]) & (d[src][1:] == d[src][:-1])
    head = _pieces(s[hit], together, k[src], s[src])
    top, src, length = hit[head], src[head], np.diff(np.append(head, len(hit)))
    return _batch(_FACTORS, [k[top], d[top], s[top], length, k[src], s[src]]), seen


def _factors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by (anchor, key, kind, start): earlier documents come first, so one pass is enough."""
    empty = np.zeros(0, np.int64)
    seen: tuple = (None, empty.astype(np.uint64), empty, empty.astype(np.int32), empty.astype(np.int32))
    for batch in batches:
        through = batch.filter(pa.compute.is_valid(batch.column("source")))
        if through.num_rows:
            yield through.select(["key", "kind", "start", "n", "source", "source_start"])
        batch = batch.filter(pa.compute.is_null(batch.column("source")))
        if batch.num_rows:
            out, seen = _match(batch, seen)
            yield out


def _kind(text: Column) -> Column:
    return F.hash(F.coalesce(text, F.lit("")))


def documents_in(docs: DataFrame) -> DataFrame:
    """key, kind, text: kind tells rows apart that share a doc_id."""
    text = F.col("text").cast("string")
    return docs.select(key_of().alias("key"), _kind(text).alias("kind"), text.alias("text"))


def factor_pieces(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """key, kind, start, n, source, source_start: n windows from start on repeat those from source_start on in source.

    Each window that starts earlier elsewhere is in exactly one piece.
    """
    def runs(batches):
        for block in slices(batches):
            yield from _block_runs(block, window)

    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        documents_in(docs).mapInArrow(runs, _RUNS)
        .repartition(parts, "anchor").sortWithinPartitions("anchor", "key", "kind", "start")
        .mapInArrow(_factors, _FACTORS)
    )


def parse(pieces: list, n_words: int, window: int) -> list[tuple[int, int, int, int]]:
    """Factors (start, length in words, source, source_start) of a document from its pieces, from the left.

    Each piece names its earliest source. A piece that goes on where the factor before it stands in its source makes that factor longer.
    """
    out: list[list[int]] = []
    for start, n, source, source_start in sorted(pieces):
        if out:
            o = out[-1]
            if o[2] == source and start == o[0] + o[1] - window + 1 and source_start - start == o[3] - o[0]:
                o[1] += n
                continue
        out.append([start, n + window - 1, source, source_start])
    return [tuple(o) for o in out]


def with_factors(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with a column ``factors`` of their factors, an array of (start, length, source, source_start).

    A document without repeats has null.
    """
    pieces = factor_pieces(docs, window).groupBy("key", "kind").agg(F.collect_list(F.struct("start", "n", "source", "source_start")).alias("pieces"))
    rows = docs.withColumns({"__key": key_of(), "__kind": _kind(F.col("text").cast("string"))})
    return rows.join(pieces.withColumnsRenamed({"key": "__key", "kind": "__kind", "pieces": "__pieces"}), ["__key", "__kind"], "left").drop("__key", "__kind")


def repeats(pieces: pa.Array, n: int, window: int) -> np.ndarray:
    """Whether each of n words lies in a factor."""
    gone = np.zeros(n + 1, dtype=np.int32)
    for start, length, _, _ in parse([tuple(p.values()) for p in pieces.as_py() or []], n, window):
        gone[start] += 1
        gone[start + length] -= 1
    return np.cumsum(gone[:-1]) > 0


def dedup_digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the factors' spans in words, one row per input row.

    Null and empty texts have no words and keep the hash of the empty text. Rows with the same doc_id and text are one
    document; rows with the same doc_id and different texts are taken in the order of a hash of the text. A null doc_id
    comes before all others and stays null. Other columns are left out, whatever their names.
    """
    def digest(batches):
        for batch in slices(batches):
            w, out = Words(batch.column("text")), []
            for i in range(batch.num_rows):
                a, b = w.first[i], w.first[i + 1]
                gone = repeats(batch.column("__pieces")[i], b - a, window)
                out.append((int(b - a), int(gone.sum()), hashlib.sha256(kept_words(w, a, b, gone)).hexdigest(), spans_text(gone)))
            n, removed, sha, spans = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha), pa.array(spans)], ["doc_id", "n_words", "n_removed", "kept_sha256", "removed_spans"])

    rows = with_factors(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), window)
    return rows.mapInArrow(digest, "doc_id long, n_words long, n_removed long, kept_sha256 string, removed_spans string")


def kept_words(w: Words, a: int, b: int, gone: np.ndarray) -> bytes:
    """The words a..b that are not gone, joined by one space."""
    keep = np.flatnonzero(~gone) + a
    raw = w.data
    return b" ".join([raw[s:e].tobytes() for s, e in zip(w.starts[keep].tolist(), w.ends[keep].tolist(), strict=True)])


def spans_text(gone: np.ndarray) -> str:
    """The removed stretches as start-end, in words, comma-joined."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
    return ",".join(f"{a}-{b}" for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with all their columns, and texts without the repeated words.

    A text from which nothing is removed stays as it is, white space included. What is left of others keeps its line
    ends and single characters between kept words: only the removed words go, each with the white space before it.
    Nulls, repeated rows and repeated doc_ids: as in ``dedup_digests``. ``n_chars`` follows the text if there is one.
    """
    kinds = docs.schema
    def cut(batches):
        for batch in slices(batches):
            w, out = Words(batch.column("text")), []
            texts = batch.column("text")
            for i in range(batch.num_rows):
                a, b = w.first[i], w.first[i + 1]
                gone = repeats(batch.column("__pieces")[i], b - a, window)
                if not gone.any():
                    out.append(texts[i].as_py())
                    continue
                keep, begin = [], int(w.offsets[i])
                for j in range(a, b):
                    if not gone[j - a]:
                        keep.append(w.data[begin : w.ends[j]].tobytes())
                    begin = int(w.ends[j])
                keep.append(w.data[begin : int(w.offsets[i + 1])].tobytes())
                out.append(b"".join(keep).decode())
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", pa.array(out, texts.type)).drop_columns(["__pieces"])

    out = with_factors(docs, window).select(*docs.columns, "__pieces").mapInArrow(cut, kinds)
    return out.withColumn("n_chars", F.char_length("text").cast(kinds["n_chars"].dataType)) if "n_chars" in docs.columns else out
