"""Language-model scores by online logistic context mixing.

A text is its tokens: words with A-Z in lower case, then one end. Each token is coded as the path to its leaf in a binary
tree, and each turn of the path is a bit to predict. The tree is a Huffman tree over 2**16 classes of words (by hash) and
one class for words that training has not seen twice, so common words need few bits. A word's share in its class comes
from its own count.

Each bit is predicted in four contexts: none, the last common word, the last word, the last two words. Contexts are words,
not classes. Their log-odds are mixed by weights that a gate picks from the evidence which the two longer contexts have.
The weights, and a table that corrects the mixture, are adapted online after every bit. They start anew in every stretch of
``LANE`` tokens, so all stretches advance side by side, one bit of each at a time.

Corpus counts come from all training documents and have no fixed size. Every block of documents sends its different words,
and later its different (context, class) pairs, to the task of their range. That task has all counts of its contexts and
answers each block with what the block's own paths need: how often training took the turns that a path does not take, most
of which are 0. Ranges, and then blocks, take turns, so that not all messages are on disk at once. Only the tree, of fixed
size, is sent to all tasks.
"""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.tables import partitions, written
from trackloom.llm.words import Words, blobs, key_of, mixed, slices, unblobs

CLASSES = 1 << 16
#: Class of words that training lacks or has once; takes the place of the last hash class.
RARE = CLASSES - 1
#: Bits of a class in the key of a (context, class) pair; the rest of its 64 tells the context.
CLASS_BITS = 16
#: A word counts as common if its path has at most so many bits.
COMMON_BITS = 9
#: Tokens that share one set of adaptive weights.
LANE = 256
#: Size of a step of the weights, and of the corrections.
RATE, CORRECTION_RATE = 0.02, 0.02
#: Tokens, and bits of paths, that are worked on at a time.
TOKENS, PATH_BITS = 100_000, 500_000
#: Pairs whose answers are read at a time.
PAIRS = 50_000
#: Rounds in which ranges of pairs are asked about, and then blocks are scored: what moves in one is gone from disk before the next.
ASK_ROUNDS, SCORE_ROUNDS = 2, 4
#: Weight of a rare word that training has, against 1 for each further occurrence.
ONCE = 0.5
#: Counts from which on a context has some evidence, and much.
SOME, MUCH = 1, 7
#: A word in a context: 32 bits of its hash. All rare words are one; the others are what stands before a text's first words.
_RARE_WORD, _BEGIN, _SECOND, _NO_TOPIC = (np.uint64((1 << 32) - 1 + i) for i in range(4))
#: Where the keys of each context's bits begin in ``Coder.slots``.
_OFFSETS = np.array([0, CLASSES, CLASSES + (1 << 60), CLASSES + 2 * (1 << 60), CLASSES + 3 * (1 << 60)])
_END = np.uint64(0xE7D0E7D0E7D0E7D1)


def _block_tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of the texts end to end, and where each text's tokens begin."""
    some = [_slice_tokens(part.column(0)) for part in slices(iter([pa.record_batch([texts], ["text"])]))]
    sizes = np.concatenate([np.diff(first) for _, first in some]) if some else np.zeros(0, np.int64)
    return np.concatenate([np.zeros(0, np.uint64), *[tokens for tokens, _ in some]]), np.concatenate(([0], np.cumsum(sizes)))


def _slice_tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    w = Words(texts, fold=True)
    n = w.per_doc + 1
    first = np.concatenate(([0], np.cumsum(n)))
    tokens = np.full(first[-1], _END, np.uint64)
    inside = np.ones(len(tokens), bool)
    inside[first[1:] - 1] = False
    tokens[inside] = w.hashes
    return tokens, first


def _text(table: pa.Table) -> pa.Array:
    column = table.column("text").combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def _sorted_block(table: pa.Table) -> pa.Table:
    return table.sort_by([("key", "ascending"), ("kind", "ascending")]).combine_chunks()


def _send(bits: int):
    """Each block's distinct tokens with their count in its training documents, by token range."""
    def send(table: pa.Table) -> pa.Table:
        table = _sorted_block(table)
        tokens, first = _block_tokens(_text(table))
        train = ~np.asarray(table.column("held_out").combine_chunks().to_numpy(zero_copy_only=False), bool)
        distinct, at = np.unique(tokens, return_inverse=True)
        counts = np.bincount(at, weights=np.repeat(train, np.diff(first)), minlength=len(distinct)).astype("<u4")
        edges = np.searchsorted(distinct, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
        bounds = np.concatenate(([0], edges, [len(distinct)]))
        block = table.column("block")[0].as_py() if table.num_rows else 0
        return pa.Table.from_arrays([pa.array(np.arange(1 << bits, dtype=np.int32)), pa.array(np.full(1 << bits, block, np.int32)), blobs(distinct, bounds).cast(pa.binary()), blobs(counts, bounds).cast(pa.binary())], ["bucket", "block", "tokens", "counts"])

    return send


def _total(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
    batch = pa.concat_batches(rows)
    tokens, n = unblobs(batch.column("tokens"), np.uint64)
    counts, _ = unblobs(batch.column("counts"), "<u4")
    distinct, at = np.unique(tokens, return_inverse=True)
    total = np.bincount(at, weights=counts, minlength=len(distinct)).astype(np.int64)
    seen = total > 0
    known, all_tokens = int(seen.sum()), int(total.sum())
    # the totals of the range go along with its first answer
    first = np.zeros(batch.num_rows, bool)
    first[0] = True
    zero = np.zeros(batch.num_rows, np.int64)
    return pa.RecordBatch.from_arrays([batch.column("block"), batch.column("bucket"), pa.array([_packed(_bytes(x)) for x in np.split(total[at], np.cumsum(n)[:-1])], pa.binary()), pa.array(np.where(first, known, zero)), pa.array(np.where(first, all_tokens, zero))], ["block", "bucket", "totals", "known", "all_tokens"])


def _by_bucket(make):
    """make for all rows of a bucket at a time; rows come sorted by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        bucket = None
        for batch in batches:
            values = batch.column("bucket").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b > a:
                    if held and values[a] != bucket:
                        yield make(held)
                        held = []
                    bucket = values[a]
                    held.append(batch.slice(a, b - a))
        if held:
            yield make(held)

    return run


def _coded(docs: pa.Table, replies: pa.Table) -> pa.Table:
    """A block's documents as the words of their tokens, with what depends on the tokens' own counts: one row."""
    docs = _sorted_block(docs)
    tokens, first = _block_tokens(_text(docs))
    replies = replies.sort_by("bucket").combine_chunks()
    totals = np.concatenate([np.zeros(0, np.int64), *[_numbers(*_unpacked(x)) for x in replies.column("totals").to_pylist()]])
    _, at = np.unique(tokens, return_inverse=True)
    count = totals[at]
    train = ~np.asarray(docs.column("held_out").combine_chunks().to_numpy(zero_copy_only=False), bool)
    rare = count < 2
    known = count > 0
    # a known word's share in its class: its count, over the class's sum; rare ones that training has share the rare class
    share = np.where(known & ~rare, np.log10(np.maximum(count, 1)), 0.0)
    sums = lambda x: np.add.reduceat(x, first[:-1]) if len(first) > 1 else np.zeros(0)
    words = np.where(rare, _RARE_WORD, np.minimum(tokens >> np.uint64(32), _RARE_WORD - np.uint64(1))).astype("<u4")
    held = (count > 0).astype(np.int64)
    columns = [docs.column("doc_id").combine_chunks(), docs.column("held_out").combine_chunks(), pa.array(np.diff(first)), pa.array(sums(held).astype(np.int64)), pa.array(sums(np.log10(count + 1.0))), pa.array(sums(share)), pa.array(sums((rare & known).astype(np.int64))), docs.column("bytes").combine_chunks()]
    batch = pa.Table.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "log_counts", "log_shares", "n_once", "bytes"]).combine_chunks().to_batches()[0]
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(batch)
    # a word is its rank in the block, most are small numbers then; of equally frequent ones the dictionary has small steps
    distinct, at, n = np.unique(words, return_inverse=True, return_counts=True)
    order = np.argsort(-n, kind="stable")
    rank = np.empty(len(order), "<u4")
    rank[order] = np.arange(len(order))
    packed = _packed([_plane(np.diff(distinct[order], prepend=np.uint32(0)).astype("<u4")), _plane(rank[at])])
    return pa.Table.from_arrays([docs.column("block").combine_chunks()[:1], pa.array([sink.getvalue().to_pybytes()], pa.binary()), pa.array([packed], pa.binary())], ["block", "docs", "words"])


_CODED = "block int, docs binary, words binary"


def _opened(docs: bytes, words: bytes) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
    """A block's documents, their words end to end, and where each document's begin."""
    batch = pa.ipc.open_stream(docs).read_next_batch()
    steps, rank = (_unplaned(x, "<u4") for x in _unpacked(words))
    return batch, np.cumsum(steps, dtype=np.uint32)[rank], np.concatenate(([0], np.cumsum(batch.column("n_tokens").to_numpy())))


def classes_of(words: np.ndarray) -> np.ndarray:
    return np.where(words == _RARE_WORD, RARE, (words >> 16) % RARE).astype(np.int64)


def huffman(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each class the bits of its path; then all paths end to end: the inner nodes, and the turn at each."""
    n = len(counts)
    heap = [(float(c), i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    parent = np.zeros(2 * n - 1, np.int64)
    turn = np.zeros(2 * n - 1, np.int8)
    for node in range(n, 2 * n - 1):
        (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
        parent[x] = parent[y] = node
        turn[y] = 1
        heapq.heappush(heap, (a + b, node))
    length = np.zeros(2 * n - 1, np.int64)
    for node in range(2 * n - 3, -1, -1):
        length[node] = length[parent[node]] + 1
    length = length[:n]
    first = np.concatenate(([0], np.cumsum(length)))
    nodes, bits = np.zeros(first[-1], np.int32), np.zeros(first[-1], np.int8)
    at, left = np.arange(n), length.copy()
    while (left > 0).any():
        live = left > 0
        where = first[:-1][live] + left[live] - 1
        bits[where] = turn[at[live]]
        at[live] = parent[at[live]]
        nodes[where] = 2 * n - 2 - at[live]
        left[live] -= 1
    return length, nodes, bits


class Coder:
    """Turns classes into the bits of their paths. Leaves are numbered from left to right, so all below a node are a range.

    For each bit of each path (from ``first``): ``nodes``, ``bits``, and the range ``low`` to ``high`` of leaves after it.
    """

    def __init__(self, counts: np.ndarray):
        self.length, self.nodes, self.bits = huffman(counts)
        self.first = np.concatenate(([0], np.cumsum(self.length)))
        right = np.bincount(self.nodes, weights=self.bits).astype(np.int64)
        left = np.bincount(self.nodes) - right
        jumps = np.concatenate(([0], np.cumsum(np.where(self.bits > 0, left[self.nodes], 0))))
        self.low = (jumps[1:] - np.repeat(jumps[self.first[:-1]], self.length)).astype(np.int32)
        self.high = (self.low + np.where(self.bits > 0, right[self.nodes], left[self.nodes])).astype(np.int32)
        self.leaf = self.low[self.first[1:] - 1]
        self.code = np.argsort(self.leaf)
        #: leaves by the length of their paths, and the place of each among them: common classes come first
        self.by_length = np.argsort(self.length[self.code], kind="stable").astype("<u2")
        self.rank = np.argsort(self.by_length).astype("<u2")
        #: the first 64 turns of the path to each leaf, from the highest bit on
        step = np.arange(len(self.bits)) - np.repeat(self.first[:-1], self.length)
        turns = np.where((self.bits > 0) & (step < 64), np.uint64(1) << (np.uint64(63) - np.minimum(step, 63).astype(np.uint64)), np.uint64(0))
        self.turns = np.bitwise_or.reduceat(turns, self.first[:-1])[self.code]
        sums = np.concatenate(([0.0], np.cumsum(counts[self.code])))
        after = sums[self.high] - sums[self.low]
        whole = np.concatenate(([0.0], after[:-1]))
        whole[self.first[:-1]] = sums[-1]
        #: log-odds of the turn that is taken, without a context
        self.alone = np.log(np.maximum(after, 1e-9) / np.maximum(whole - after, 1e-9)).astype(np.float32)

    def paths(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each bit of the codes its place in the table of all paths and its place in its own path; where each code's bits end."""
        sizes = self.length[codes]
        ends = np.cumsum(sizes)
        step = np.arange(int(ends[-1]) if len(codes) else 0, dtype=np.int32) - np.repeat((ends - sizes).astype(np.int32), sizes)
        return np.repeat(self.first[codes].astype(np.int32), sizes) + step, step, ends

    def contexts(self, words: np.ndarray, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Hashes of the last common word, the last word and the last two words before each token; a row each."""
        words, n = words.astype(np.uint64), len(words)
        at = np.arange(n)
        start = np.repeat(first[:-1], np.diff(first))
        last = np.where(at == start, _BEGIN, np.roll(words, 1))
        before = np.where(at - start < 2, _SECOND, np.roll(words, 2))
        common = np.where(self.length[codes] <= COMMON_BITS, at, -1)
        seen = np.concatenate(([-1], np.maximum.accumulate(common)[:-1])) if n else common
        topic = np.where(seen >= start, words[np.maximum(seen, 0)], _NO_TOPIC) if n else words
        return np.stack([mixed(x + np.uint64(i + 1 << 40)) for i, x in enumerate((topic, last, mixed(last) + before))])

    def pairs(self, words: np.ndarray, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Keys of each token's class in each context (a row each): the context, then the leaf."""
        low = np.uint64((1 << CLASS_BITS) - 1)
        return self.contexts(words, codes, first) & ~low | self.leaf[codes].astype(np.uint64)

    def shared(self, keys: np.ndarray, some: np.ndarray) -> np.ndarray:
        """For sorted different pairs: on how many bits with evidence (at most ``some``) the path is that of the pair before, in its context."""
        if not len(keys):
            return np.zeros(0, np.int64)
        turns = self.turns[(keys & np.uint64((1 << CLASS_BITS) - 1)).astype(np.int64)]
        context = keys >> np.uint64(CLASS_BITS)
        apart = turns[1:] ^ turns[:-1]
        same = np.zeros(len(apart), np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            more = apart < np.uint64(1) << np.uint64(64 - width)
            same[more] += width
            apart[more] <<= np.uint64(width)
        same[context[1:] != context[:-1]] = 0
        return np.minimum(np.concatenate(([0], same)), some)

    def slots(self, codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bits, the key of each bit's counts in every context (a row each; words are taken for their classes), where each token's bits end.

        This is what ``answers`` holds, written out bit by bit.
        """
        codes = codes.astype(np.int64)
        where, _, ends = self.paths(codes)
        salt = mixed(self.nodes[where].astype(np.uint64) + np.uint64(1))
        out = [self.nodes[where].astype(np.int64)]
        for i, h in enumerate(self.contexts(codes, codes, first)):
            out.append((mixed(np.repeat(h, self.length[codes]) ^ salt) >> np.uint64(4)).astype(np.int64) + _OFFSETS[i + 1])
        return self.bits[where], np.stack(out), ends


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with about TOKENS tokens together."""
    for batch in batches:
        n = batch.column("n_tokens").to_numpy()
        part = (np.cumsum(n) - n) // TOKENS
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(n)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield batch.slice(a, b - a)


def _plane(values: np.ndarray) -> bytes:
    """Byte place by byte place, which compresses better."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _unplaned(blob: bytes, dtype: np.dtype | str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def _packed(parts: list[bytes]) -> bytes:
    """Each part compressed on its own, after the sizes of all."""
    codec = pa.Codec("zstd")
    small = [codec.compress(x, asbytes=True) if x else x for x in parts]
    return bytes([len(parts)]) + np.array([[len(x) for x in parts], [len(x) for x in small]], "<u4").tobytes() + b"".join(small)


def _unpacked(blob: bytes) -> list[bytes]:
    codec, n = pa.Codec("zstd"), blob[0]
    sizes, small = np.frombuffer(blob, "<u4", 2 * n, 1).reshape(2, n).tolist()
    begin, out = 1 + 8 * n, []
    for size, length in zip(sizes, small, strict=True):
        out.append(codec.decompress(blob[begin : begin + length], size, asbytes=True) if size else b"")
        begin += length
    return out


def _bytes(values: np.ndarray) -> list[bytes]:
    """Numbers that are small for the most part: a byte each, and those from 255 on."""
    return [np.minimum(values, 255).astype(np.uint8).tobytes(), _plane(values[values >= 255].astype("<i8"))]


def _numbers(low: bytes, high: bytes) -> np.ndarray:
    values = np.frombuffer(low, np.uint8).astype(np.int64)
    if high:
        values[values == 255] = _unplaned(high, "<i8")
    return values


def _heads(keys: np.ndarray) -> np.ndarray:
    """Whether each of the sorted pairs is the first of its context."""
    context = keys >> np.uint64(CLASS_BITS)
    return np.concatenate((np.ones(min(len(keys), 1), bool), context[1:] != context[:-1]))


def packed_pairs(coder: Coder, keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted different pairs and their counts: the contexts as steps, for each how many pairs, the rank of its first leaf, steps to the others."""
    heads = _heads(keys)
    leaf = (keys & np.uint64((1 << CLASS_BITS) - 1)).astype(np.int64)
    context = keys[heads] >> np.uint64(CLASS_BITS)
    members = np.diff(np.append(np.flatnonzero(heads), len(keys)))
    steps = np.diff(leaf, prepend=0)[~heads].astype("<u2")
    return _packed([_plane(np.diff(context, prepend=np.uint64(0))), *_bytes(members), _plane(coder.rank[leaf[heads]]), _plane(steps), *_bytes(counts)])


def unpacked_pairs(coder: Coder, blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, low, high, ranks, others, *counts = _unpacked(blob)
    members = _numbers(low, high)
    context = np.cumsum(_unplaned(steps, "<u8"), dtype=np.uint64)
    first = np.cumsum(members) - members
    leaf = np.zeros(int(members.sum()), np.int64)
    heads = np.zeros(len(leaf), bool)
    heads[first] = True
    leaf[~heads] = _unplaned(others, "<u2")
    leaf = np.cumsum(leaf)
    leaf += np.repeat(coder.by_length[_unplaned(ranks, "<u2")] - leaf[first], members)
    return np.repeat(context << np.uint64(CLASS_BITS), members) | leaf.astype(np.uint64), _numbers(*counts)


def _places(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begin[i], begin[i] + 1 ... of sizes[i] places each, end to end."""
    return np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def completed(sent: np.ndarray, some: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """The log-odds of all pairs, ``some`` each, of those that are sent: all but the first ``shared`` of each, which the pair before has too."""
    begin = np.cumsum(some, dtype=np.int64) - some
    out = np.zeros(int(some.sum(dtype=np.int64)), sent.dtype)
    out[_places(begin + shared, some - shared)] = sent
    at = np.arange(len(some))
    for step in range(int(shared.max(initial=0))):
        copies = np.flatnonzero(shared > step)
        source = np.maximum.accumulate(np.where(shared > step, 0, at))[copies]
        out[begin[copies] + step] = out[begin[source] + step]
    return out


def _send_pairs(coder, bits: int, turn: int):
    """Each block's different (context, class) pairs with their count in its training documents, by key range: the ranges of one round."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, *row in zip(*(batch.column(c).to_pylist() for c in ("block", "docs", "words")), strict=True):
                docs, words, first = _opened(*row)
                keys, _, counts = _block_pairs(coder.value, docs, words, first)
                bounds = _range_bounds(keys, 1 << bits)
                ranges = np.arange(turn, 1 << bits, ASK_ROUNDS, dtype=np.int32)
                pairs = [packed_pairs(coder.value, keys[a:b], counts[a:b]) for a, b in zip(bounds[ranges].tolist(), bounds[ranges + 1].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(ranges), pa.array(np.full(len(ranges), block, np.int32)), pa.array(pairs, pa.binary())], ["bucket", "block", "pairs"])

    return send


def _range_bounds(keys: np.ndarray, n: int) -> np.ndarray:
    """Where the sorted keys of each of n ranges begin, and the end; n is a power of two."""
    edges = np.searchsorted(keys, np.arange(1, n, dtype=np.uint64) << np.uint64(65 - n.bit_length()))
    return np.concatenate(([0], edges, [len(keys)])).astype(np.int64)


def _block_pairs(coder: Coder, docs: pa.RecordBatch, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted different pairs, each token's pairs among them (a row per context), and the pairs' counts in training documents."""
    held_out = np.asarray(docs.column("held_out").to_numpy(zero_copy_only=False), bool)
    train = np.repeat(~held_out, np.diff(first))
    # a context at a time, which takes less memory than all at once
    keys, at, counts = [], [], []
    for row in coder.pairs(words, classes_of(words), first):
        some, places = np.unique(row, return_inverse=True)
        keys.append(some)
        at.append(places.astype(np.int32))
        counts.append(np.bincount(places, weights=train, minlength=len(some)))
    begin = np.cumsum([0, *map(len, keys)])
    keys, to = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.bincount(to, weights=np.concatenate(counts), minlength=len(keys)).astype(np.int64)
    return keys, np.stack([to[a + places].astype(np.int32) for a, places in zip(begin[:-1].tolist(), at, strict=True)]), counts


def evidence(coder: Coder, keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sorted different pairs: on how many bits of its path each has some evidence; its context's count; on these bits, the count of the turn that is not taken.

    keys have every pair of their contexts that training has. A node's count never exceeds that of the node above it, so
    evidence ends somewhere on the path.
    """
    n = len(keys)
    heads = np.flatnonzero(_heads(keys))
    members = np.diff(np.append(heads, n))
    sums = np.concatenate(([0], np.cumsum(counts.astype(np.int64))))
    whole = np.repeat(sums[heads + members] - sums[heads], members)
    alone = np.repeat(members, members) == 1
    codes = coder.code[(keys & np.uint64((1 << CLASS_BITS) - 1)).astype(np.int64)]
    kind = np.dtype("<u4" if sums[-1] < 1 << 32 else "<u8")
    some, beside = np.zeros(n, np.uint8), [np.zeros(0, kind)]
    part = (np.cumsum(coder.length[codes]) - 1) // PATH_BITS
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), n]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b == a:
            continue
        where, step, ends = coder.paths(codes[a:b])
        pair = np.repeat(np.arange(a, b), coder.length[codes[a:b]])
        # a context's only pair has all its counts on its path
        after = whole[pair]
        ask = np.flatnonzero(~alone[pair])
        base = keys[pair[ask]] & ~np.uint64((1 << CLASS_BITS) - 1)
        to = np.searchsorted(keys, base + (coder.high[where[ask]] - 1).astype(np.uint64), side="right")
        since = np.searchsorted(keys, base + coder.low[where[ask]].astype(np.uint64), side="left")
        after[ask] = sums[to] - sums[since]
        at = np.concatenate(([0], after[:-1]))
        begin = step == 0
        at[begin] = whole[a:b]
        some[a:b] = np.minimum(np.add.reduceat(at >= SOME, np.concatenate(([0], ends[:-1])), dtype=np.int64), 255)
        keep = step < some[pair]
        beside.append((at[keep] - after[keep]).astype(kind))
    return some, whole, np.concatenate(beside)


def _own(some: np.ndarray, shared: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """From which bit on a pair's counts are sent. Where it leaves the path of the pair before, its count is the other's turn not taken."""
    return np.where(heads, 0, np.minimum(shared + 1, some))


def read_odds(sent: np.ndarray, wholes: np.ndarray, some: np.ndarray, shared: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted different pairs: on how many bits each has much evidence; log-odds of the turns taken on the ``some`` bits with any.

    sent: counts of the turns not taken, from the bit of ``_own`` on; wholes: counts of the contexts. heads: first pairs of
    a context, which share nothing.
    """
    n = len(some)
    skip = _own(some, shared, heads)
    size = some - skip
    begin = np.cumsum(size) - size
    # the pair that a path leaves at its first bit of its own: the last one before that shares less
    source = np.arange(n) - 1
    source[heads] = np.flatnonzero(heads)
    while len(late := np.flatnonzero(shared[source] > shared)):
        source[late] = source[source[late]]
    leaves = np.flatnonzero(~heads & (shared < some))
    there = begin[source[leaves]] + shared[leaves] - skip[source[leaves]]
    start = np.zeros(n, np.int64)
    start[heads] = wholes
    start[leaves] = sent[there]
    sums = np.concatenate(([0], np.cumsum(sent)))
    after = np.repeat(start + sums[begin], size) - sums[1:]
    much_sums = np.concatenate(([0], np.cumsum(after + sent >= MUCH)))
    count = much_sums[begin + size] - much_sums[begin]
    count[leaves] += start[leaves] + after[there] >= MUCH
    much = (shared + count)[np.maximum.accumulate(np.where(heads | (count > 0), np.arange(n), 0))]
    odds = np.empty(int((some - shared).sum()), "<f2")
    place = np.cumsum(some - shared) - (some - shared)
    odds[place[leaves]] = np.log((start[leaves] + 0.4) / (after[there] + 0.4))
    odds[_places(place + skip - shared, size)] = np.log((after + 0.4) / (sent + 0.4))
    return much, completed(odds, some, shared)


def answers(coder: Coder, keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``read_odds`` gives for all pairs of some contexts: bits with some evidence, and with much; log-odds on the former."""
    some, whole, beside = evidence(coder, keys, counts)
    much, odds = read_odds(beside.astype(np.int64), whole, some.astype(np.int64), np.zeros(len(keys), np.int64), np.ones(len(keys), bool))
    return some, much, odds


def packed_answer(coder: Coder, keys: np.ndarray, own: np.ndarray, some: np.ndarray, whole: np.ndarray, beside: np.ndarray, begin: np.ndarray) -> bytes:
    """What a block with these pairs and counts of its own lacks. beside has the ``some`` values of each pair from ``begin`` on.

    Most turns not taken have no count: the others go as the steps to them, and their values.
    """
    heads = _heads(keys)
    skip = _own(some, coder.shared(keys, some), heads)
    sent = beside[_places(begin + skip, some - skip)]
    seen = np.flatnonzero(sent)
    first = np.flatnonzero(heads)
    others = whole[first] - (np.add.reduceat(own, first) if len(first) else 0)
    return _packed([*_bytes(_lengths(coder, keys) - some), *_bytes(others), *_bytes(np.diff(seen, prepend=-1)), *_bytes(sent[seen])])


def _lengths(coder: Coder, keys: np.ndarray) -> np.ndarray:
    return coder.length[coder.code[(keys & np.uint64((1 << CLASS_BITS) - 1)).astype(np.int64)]]


def unpacked_answers(coder: Coder, keys: np.ndarray, own: np.ndarray, bounds: np.ndarray, messages: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bits with some evidence, with much, and log-odds of a block's pairs, then 0; a message has the pairs from one of the bounds to the next."""
    parts = [_unpacked(x) for x in messages]
    some = (_lengths(coder, keys) - np.concatenate([_numbers(*x[:2]) for x in parts])).astype(np.uint8)
    much, odds = np.zeros(len(keys), np.uint8), np.zeros(int(some.sum(dtype=np.int64)) + 1, "<f2")
    done = 0
    group = (bounds[1:] - 1) // PAIRS
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(messages)]
    for since, to in zip(cuts[:-1], cuts[1:], strict=True):
        mine = slice(bounds[since], bounds[to])
        if mine.stop == mine.start:
            continue
        others, steps, values = ([_numbers(*x[k : k + 2]) for x in parts[since:to]] for k in (2, 4, 6))
        heads, evident = _heads(keys[mine]), some[mine].astype(np.int64)
        shared = coder.shared(keys[mine], evident)
        ends = np.concatenate(([0], np.cumsum(evident - _own(evident, shared, heads))))[bounds[since : to + 1] - mine.start]
        sent = np.zeros(ends[-1], np.int64)
        for a, step, value in zip(ends[:-1].tolist(), steps, values, strict=True):
            sent[a - 1 + np.cumsum(step)] = value
        wholes = np.concatenate(others) + np.add.reduceat(own[mine], np.flatnonzero(heads))
        much[mine], got = read_odds(sent, wholes, evident, shared, heads)
        odds[done : done + len(got)] = got
        done += len(got)
    return some, much, odds


def _answer(coder):
    """What the blocks' pairs of a range need, from the counts of all blocks."""
    def answer(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        batch = pa.concat_batches(rows)
        asked = [unpacked_pairs(coder.value, x) for x in batch.column("pairs").to_pylist()]
        keys, at = np.unique(np.concatenate([k for k, _ in asked]), return_inverse=True)
        some, whole, beside = evidence(coder.value, keys, np.bincount(at, weights=np.concatenate([c for _, c in asked]), minlength=len(keys)))
        some = some.astype(np.int64)
        begin = np.cumsum(some) - some
        sent, done = [], 0
        for pairs, own in asked:
            mine = at[done : done + len(pairs)]
            done += len(pairs)
            sent.append(packed_answer(coder.value, pairs, own, some[mine], whole[mine], beside, begin[mine]))
        return pa.RecordBatch.from_arrays([batch.column("block"), batch.column("bucket"), pa.array(sent, pa.binary())], ["block", "bucket", "counts"])

    return answer


_BINS = 24


def side_by_side(lane_first: np.ndarray, lane_size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the bits in which lanes advance together, and how many lanes are still going at each step.

    The longest lanes come first, so that those still going are always in front.
    """
    order = np.argsort(-lane_size, kind="stable")
    first, size = lane_first[order], lane_size[order]
    steps = int(size[0]) if len(size) else 0
    live = np.searchsorted(-size, -np.arange(steps), side="left")
    lane = np.arange(int(live.sum()), dtype=np.int32) - np.repeat((np.cumsum(live) - live).astype(np.int32), live)
    return first.astype(np.int32)[lane] + np.repeat(np.arange(steps, dtype=np.int32), live), live


#: First weights of the contexts for each gate: the longer contexts count as much as they have been seen.
_GATES = 9
_FIRST = np.array([[0.25, 0.6, 0.1 + 0.1 * (g // 3), 0.1 + 0.3 * (g % 3)] for g in range(_GATES)], np.float32)


def mix(bits: np.ndarray, odds: np.ndarray, live: np.ndarray, gate: np.ndarray | None = None) -> np.ndarray:
    """Probability of every bit, for bits in the order of ``side_by_side``.

    odds: a row of log-odds per context. gate: which of its ``_GATES`` weight vectors a bit is mixed by. Each lane starts
    with the first weights of each gate and an identical correction, and adapts both after each of its bits. Without gate a
    lane has one vector, of weights 1.
    """
    out = np.empty(len(bits), np.float32)
    n_lanes = int(live[0]) if len(live) else 0
    first = np.ones((1, 4), np.float32) if gate is None else _FIRST
    weights = np.tile(first, (n_lanes, 1))
    rows = np.arange(n_lanes) * len(first)
    centre = ((np.arange(_BINS) + 0.5) / _BINS * 24 - 12).astype(np.float32)
    fix = np.tile(1 / (1 + np.exp(-centre)), (n_lanes, 1)).astype(np.float32).ravel()
    bins = np.arange(n_lanes, dtype=np.int32) * _BINS
    begin = 0
    for n in live.tolist():
        x, bit = odds[:, begin : begin + n], bits[begin : begin + n]
        which = rows[:n] if gate is None else rows[:n] + gate[begin : begin + n]
        w = weights[which]
        dot = np.einsum("ji,ij->i", x, w)
        np.clip(dot, -11.5, 11.5, out=dot)
        p = np.exp(-dot)
        p += np.float32(1)
        np.reciprocal(p, out=p)
        dot += np.float32(12)
        dot *= np.float32(_BINS / 24)
        cell = dot.astype(np.int32)
        cell += bins[:n]
        q = fix[cell]
        out[begin : begin + n] = np.float32(0.75) * p + np.float32(0.25) * q
        q += np.float32(CORRECTION_RATE) * (bit - q)
        fix[cell] = q
        np.subtract(bit, p, out=p)
        p *= np.float32(RATE)
        w += (x * p).T
        weights[which] = w
        begin += n
    return np.where(bits > 0, out, 1 - out)


def _score(coder, model):
    def score(docs: pa.Table, replies: pa.Table) -> pa.Table:
        log_class, log_once, known, all_tokens = model.value
        batch, words, doc_first = _opened(docs.column("docs")[0].as_py(), docs.column("words")[0].as_py())
        pairs, at, own = _block_pairs(coder.value, batch, words, doc_first)
        replies = replies.sort_by("bucket")
        some, much, table = unpacked_answers(coder.value, pairs, own, _range_bounds(pairs, replies.num_rows), replies.column("counts").to_pylist())
        del pairs, own
        begin = np.cumsum(some, dtype=np.int64) - some
        codes = classes_of(words)
        out, done = [], 0
        for batch in _chunks(iter([batch])):
            n = batch.column("n_tokens").to_numpy()
            first = np.concatenate(([0], np.cumsum(n)))
            mine = slice(done, done + int(first[-1]))
            done = mine.stop
            part = codes[mine]
            sizes = coder.value.length[part]
            where, step, ends = coder.value.paths(part)
            bits = coder.value.bits[where]
            # a lane is at most LANE tokens of one document
            within = np.arange(len(part)) - np.repeat(first[:-1], n)
            heads = np.flatnonzero(within % LANE == 0)
            starts = np.concatenate(([0], ends))
            lane_first = starts[heads]
            lane_size = np.diff(np.append(lane_first, len(bits)))
            order, live = side_by_side(lane_first, lane_size)
            sign = np.where(bits > 0, np.float32(1), np.float32(-1))
            x, gate = np.empty((4, len(bits)), np.float32), np.zeros(len(bits), np.int8)
            x[0] = (coder.value.alone[where] * sign)[order]
            for i in range(3):
                pair = at[i, mine]
                has = step < np.repeat(some[pair], sizes)
                x[i + 1] = (table[np.where(has, np.repeat(begin[pair], sizes) + step, len(table) - 1)] * sign)[order]
                if i:
                    gate = np.int8(3) * gate + has + (step < np.repeat(much[pair], sizes))
            logs = np.empty(len(bits))
            logs[order] = np.log10(mix(bits[order].astype(np.float32), x, live, gate[order]))
            sums = np.concatenate(([0.0], np.cumsum(logs)))
            by_doc = sums[starts[first[1:]]] - sums[starts[first[:-1]]]
            share = np.concatenate(([0.0], np.cumsum(log_class[part])))
            share = share[first[1:]] - share[first[:-1]]
            count = lambda c: batch.column(c).to_numpy()  # noqa: E731,B023
            # in the rare class: a word that training has once, or one that it lacks
            once = count("n_once") * log_once[0] + (count("n_tokens") - count("n_known")) * log_once[1]
            score = by_doc + count("log_shares") - share + once
            base = count("log_counts") - count("n_tokens") * np.log10(all_tokens + known + 1.0)
            # one end a document is coded beside its bytes
            rate = -score * np.log2(10) / np.maximum(count("bytes"), 1)
            out.append(pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), batch.column("n_tokens"), batch.column("n_known"), pa.array(np.full(batch.num_rows, all_tokens, np.int64)), pa.array(base), pa.array(score), pa.array(rate)], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]))
        return pa.Table.from_batches(out)

    return score


def lm_scores(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte, one row per input row.

    held_out: condition on docs; the rows for which it is not true are learned from. Both scores are log10 probabilities of
    the token sequence, in which, as in the base, all words that training lacks are one event. A null or empty text is its
    end token. Repeated rows count as often as they come. Null or repeated doc_ids are kept as they are. Without a training
    document everything is unknown. Columns besides doc_id and text, of whatever name, are left out.
    """
    spark = docs.sparkSession
    parts = partitions(spark)
    bits = max(4, (parts - 1).bit_length())
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key_of().alias("key"), F.hash(text).alias("kind"), text.alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.octet_length(text).cast("long").alias("bytes"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("key", "kind"), F.lit(2 * parts)).cast("int"))
    sent = rows.groupBy("block").applyInArrow(_send(bits), "bucket int, block int, tokens binary, counts binary")
    replies = sent.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_by_bucket(_total), "block int, bucket int, totals binary, known long, all_tokens long")
    known_counts = written(replies, "counts")
    known, all_tokens = known_counts.agg(F.coalesce(F.sum("known"), F.lit(0)), F.coalesce(F.sum("all_tokens"), F.lit(0))).first()
    coded = written(rows.groupBy("block").cogroup(known_counts.select("block", "bucket", "totals").groupBy("block")).applyInArrow(_coded, _CODED), "coded")

    counts = np.zeros(CLASSES)
    for row in coded.mapInArrow(_class_counts, "class int, n long").groupBy("class").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[row["class"]] = row["n"]
    coder = spark.sparkContext.broadcast(Coder(counts + 0.3))
    odds = []
    for turn in range(ASK_ROUNDS):
        pairs = coded.mapInArrow(_send_pairs(coder, bits + 3, turn), "bucket int, block int, pairs binary")
        odds.append(written(pairs.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_by_bucket(_answer(coder)), "block int, bucket int, counts binary"), "answers"))
    odds = functools.reduce(DataFrame.union, odds)
    # in the rare class, a word of training shares the class's mass with its like; the rest is for words that it lacks
    n_once = float(counts[RARE])
    log_class = np.log10(np.maximum(counts, 1.0))
    log_class[RARE] = 0.0
    once = (np.log10(ONCE / max(n_once, 1.0)), np.log10(1 - ONCE) if n_once else 0.0)
    model = spark.sparkContext.broadcast((log_class, once, known, all_tokens))
    scores = []
    for turn in range(SCORE_ROUNDS):
        docs, counts = (x.where(F.col("block") % SCORE_ROUNDS == turn).groupBy("block") for x in (coded, odds))
        scores.append(written(docs.cogroup(counts).applyInArrow(_score(coder, model), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"), "scores"))
    return functools.reduce(DataFrame.union, scores)


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CLASSES, np.int64)
    for batch in batches:
        for row in zip(batch.column("docs").to_pylist(), batch.column("words").to_pylist(), strict=True):
            docs, words, first = _opened(*row)
            train = ~np.asarray(docs.column("held_out").to_numpy(zero_copy_only=False), bool)
            total += np.bincount(classes_of(words[np.repeat(train, np.diff(first))]), minlength=CLASSES)
    some = np.flatnonzero(total)
    if len(some):
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["class", "n"])
