"""N-gram Jaccard join with prefix filters under several global token orders.

Two sets with a Jaccard similarity of t or more share a token among the first n - ceil(t * n) + 1 of each, whatever
global order the tokens are put in. All orders here ask rare tokens first (by the logarithm of their document count) and
break ties by different hashes. Rare first is what keeps lists short: a passage in a third of all documents stands last
in each of them, and a document with enough tokens of its own makes no candidate at all.

1. Documents are dealt into blocks. A block sends each distinct token once, packed by token range; the owner of a range adds
   up and answers with one byte a token. That byte is the token's rank class.
2. Blocks write signature, size and, for a document that has a shared token in its first prefix, its set. Equal sets are
   one class from here on.
3. Round one links every document of a prefix list with the list's smallest one. Round two links every document outside a
   list's largest component with the nearest document of another component, again and again until it finds no link; each
   time at most half of the components that it links are left. Round three takes all pairs of a list that are
   not connected yet. Pairs that pass the length and position bounds, and whose parity bitmaps do not differ in more bits
   than linked sets differ in tokens, must also share prefix tokens under the other
   orders; only then the sets are intersected. One and each of two make at most as many pairs as there are list entries. Near
   copies that are not like the smallest are joined to their group by round two, so round three has pairs only where
   similarity is in doubt.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.components import components
from trackloom.llm.tables import partitions, written
from trackloom.llm.words import Words, blobs, key_of, mixed, slices, unblobs

#: Words in a shingle, and the similarity in hundredths from which documents are linked.
SHINGLE, PERCENT = 5, 75
#: Seeds of the hashes that break ties: one global order each.
ORDERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
#: Bytes of a token that a set keeps, and that are sent to be counted.
SET_BYTES, COUNT_BYTES = 6, 4
#: Bits that tell how many tokens of a set, odd or even, fall on each.
PARITY_BITS = 512
_SETS = "key long, kind int, n long, sig1 long, sig2 long, tokens binary, flags binary, prefix binary, places binary, parity binary"


def _text_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of the text and hash of each distinct shingle, sorted."""
    w = Words(texts, fold=True)
    grams, whole = w.grams(n)
    at = np.flatnonzero(whole)
    doc, tokens = w.doc[at], grams[at]
    short = np.flatnonzero((w.per_doc > 0) & (w.per_doc < n))
    if len(short):
        # fewer words: the sequence as one token
        single = []
        for i in short.tolist():
            h = w.hashes[w.first[i] : w.first[i + 1]].tolist()
            single.append((sum(x * pow(31, j + 1, 2**64) for j, x in enumerate(h)) + len(h)) % 2**64)
        doc, tokens = np.concatenate((doc, short)), np.concatenate((tokens, mixed(np.array(single, np.uint64))))
    order = np.lexsort((tokens, doc))
    doc, tokens = doc[order], tokens[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tokens[1:] != tokens[:-1])
    return doc[new], tokens[new]


class Block:
    """The shingle sets of some texts, end to end: ``tokens`` (sorted within a document), ``doc``, ``sizes``."""

    def __init__(self, texts: pa.Array, n: int = SHINGLE):
        docs, sets, begin = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
        for part in slices(iter([pa.record_batch([texts], ["text"])])):
            doc, tokens = _text_sets(part.column(0), n)
            docs.append(doc + begin)
            sets.append(tokens)
            begin += part.num_rows
        self.doc, self.tokens = np.concatenate(docs), np.concatenate(sets)
        self.sizes = np.bincount(self.doc, minlength=len(texts))
        self.first = np.concatenate(([0], np.cumsum(self.sizes)))
        sums = np.zeros((2, len(self.tokens) + 1), np.uint64)
        np.cumsum(mixed(self.tokens), out=sums[0, 1:])
        np.cumsum(mixed(self.tokens ^ np.uint64(0x5851F42D4C957F2D)), out=sums[1, 1:])
        self.sigs = (sums[:, self.first[1:]] - sums[:, self.first[:-1]]).view(np.int64)
        pairs = np.stack((self.sigs[0], self.sigs[1], self.sizes), axis=1)
        _, at = np.unique(pairs, axis=0, return_index=True)
        self.fresh = np.zeros(len(texts), bool)  # the first of equal sets
        self.fresh[at] = True
        self.fresh &= self.sizes > 0

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct tokens, sorted; how many different sets have each; and where each token of a different set stands."""
        mine = self.fresh[self.doc]
        return np.unique(self.tokens[mine], return_inverse=True, return_counts=True)


def _sorted_block(table: pa.Table) -> pa.Table:
    return table.sort_by([("key", "ascending"), ("kind", "ascending")]).combine_chunks()


def _text(table: pa.Table) -> pa.Array:
    column = table.column("text").combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def _low_bytes(values: np.ndarray, n: int) -> np.ndarray:
    return values.view(np.uint8).reshape(-1, 8)[:, :n]


def _send_tokens(bits: int):
    def send(table: pa.Table) -> pa.Table:
        table = _sorted_block(table)
        tokens, _, counts = Block(_text(table)).distinct()
        edges = np.searchsorted(tokens, (np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)))
        bounds = np.concatenate(([0], edges, [len(tokens)]))
        low = (tokens << np.uint64(bits)) >> np.uint64(64 - 8 * COUNT_BYTES)
        columns = [pa.array(np.arange(1 << bits, dtype=np.int32)), pa.array(np.full(1 << bits, table.column("block")[0].as_py() if table.num_rows else 0, np.int32)), blobs(_low_bytes(low, COUNT_BYTES), bounds * COUNT_BYTES).cast(pa.binary()), blobs(np.minimum(counts, 255).astype(np.uint8), bounds).cast(pa.binary())]
        return pa.Table.from_arrays(columns, ["bucket", "block", "tokens", "counts"])

    return send


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block and token range, the rank class of every token sent. Rows come sorted by bucket."""
    def classes(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        batch = pa.concat_batches(rows)
        tokens, n = unblobs(batch.column("tokens"), f"<u{COUNT_BYTES}")
        counts, _ = unblobs(batch.column("counts"), np.uint8)
        _, at = np.unique(tokens, return_inverse=True)
        total = np.bincount(at, weights=counts)[at] if len(at) else np.zeros(0)
        rank = np.minimum(np.log2(np.maximum(total, 1)).astype(np.uint8), 255)
        return pa.RecordBatch.from_arrays([batch.column("block"), batch.column("bucket"), blobs(rank, np.concatenate(([0], np.cumsum(n)))).cast(pa.binary())], ["block", "bucket", "ranks"])

    held: list[pa.RecordBatch] = []
    bucket = None
    for batch in batches:
        values = batch.column("bucket").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                if held and values[a] != bucket:
                    yield classes(held)
                    held = []
                bucket = values[a]
                held.append(batch.slice(a, b - a))
    if held:
        yield classes(held)


def prefix_size(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    return n + (-percent * n) // 100 + 1


def parities(doc: np.ndarray, tokens: np.ndarray, n: int) -> np.ndarray:
    """For each of n sets a bitmap of PARITY_BITS bits, as 64-bit words: whether an odd number of its tokens falls on a bit."""
    out = np.zeros((n, PARITY_BITS // 8), np.uint8)
    for begin in range(0, n, 4096):
        a, b = np.searchsorted(doc, (begin, begin + 4096))
        rows = min(4096, n - begin)
        at = (doc[a:b] - begin) * PARITY_BITS + (mixed(tokens[a:b]) % np.uint64(PARITY_BITS)).astype(np.int64)
        odd = np.bincount(at, minlength=rows * PARITY_BITS).reshape(rows, PARITY_BITS) & 1
        out[begin : begin + rows] = np.packbits(odd.astype(np.uint8), axis=1)
    return out.view(np.uint64)


def may_share(n: np.ndarray, m: np.ndarray, differing: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Whether sets of n and m tokens whose parities differ at so many bits can be similar enough.

    Every token that only one of them has flips one bit, so that they differ in as many tokens at least.
    """
    need = -((-percent * (n + m)) // (100 + percent))
    return differing <= n + m - 2 * need


def _sets(percent: int):
    def make(docs: pa.Table, replies: pa.Table) -> pa.Table:
        docs = _sorted_block(docs)
        block = Block(_text(docs))
        tokens, at, _ = block.distinct()
        replies = replies.sort_by("bucket").combine_chunks()
        ranks = unblobs(replies.column("ranks").combine_chunks(), np.uint8)[0] if replies.num_rows else np.zeros(0, np.uint8)
        mine = block.fresh[block.doc]
        doc, token, rank = block.doc[mine], block.tokens[mine], ranks[at].astype(np.int64)
        sizes = block.sizes * block.fresh
        first = np.concatenate(([0], np.cumsum(sizes)))
        prefix = prefix_size(sizes, percent)
        flags = np.zeros(len(token), np.uint8)
        place = np.zeros(len(token), np.int32)
        for i, seed in enumerate(ORDERS):
            order = np.lexsort((mixed(token ^ np.uint64(seed)), rank, doc))
            where = np.empty(len(token), np.int32)
            where[order] = np.arange(len(token)) - first[doc]
            flags |= ((where < prefix[doc]) << i).astype(np.uint8)
            if not i:
                place = where
        # a token of one set only can't be shared, so it takes its place in the order but is not listed
        listed = ((flags & 1) > 0) & (rank > 0)
        any_listed = np.bincount(doc[listed], minlength=docs.num_rows) > 0
        n_kept = np.where(any_listed, sizes, 0)
        kept = any_listed[doc]
        bounds = np.concatenate(([0], np.cumsum(n_kept)))
        listed_bounds = np.concatenate(([0], np.cumsum(np.bincount(doc[listed], minlength=docs.num_rows))))
        columns = [docs.column("key").combine_chunks(), docs.column("kind").combine_chunks(), pa.array(block.sizes.astype(np.int64)), pa.array(block.sigs[0]), pa.array(block.sigs[1]),
                   blobs(_low_bytes(token[kept] >> np.uint64(64 - 8 * SET_BYTES), SET_BYTES), bounds * SET_BYTES).cast(pa.binary()), blobs(flags[kept], bounds).cast(pa.binary()),
                   blobs(token[listed], listed_bounds).cast(pa.binary()), blobs(place[listed], listed_bounds).cast(pa.binary()),
                   blobs(parities(doc[kept], token[kept], docs.num_rows).ravel(), np.arange(docs.num_rows + 1) * (PARITY_BITS // 64)).cast(pa.binary())]
        return pa.Table.from_arrays(columns, ["key", "kind", "n", "sig1", "sig2", "tokens", "flags", "prefix", "places", "parity"])

    return make


def shingle_sets(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """key, kind, n, signature, and for sets that may have a partner the tokens and the prefix, one row per document."""
    spark = docs.sparkSession
    parts = partitions(spark)
    bits = max(4, (parts - 1).bit_length())
    text = F.col("text").cast("string")
    rows = docs.select(key_of().alias("key"), F.hash(F.coalesce(text, F.lit(""))).alias("kind"), text.alias("text"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("key", "kind"), F.lit(2 * parts)).cast("int"))
    sent = rows.groupBy("block").applyInArrow(_send_tokens(bits), "bucket int, block int, tokens binary, counts binary")
    replies = sent.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_answer, "block int, bucket int, ranks binary")
    return written(rows.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(_sets(percent), _SETS), "sets")


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The prefixes, a row a token."""
    for batch in batches:
        tokens, n = unblobs(batch.column("prefix"), np.int64)
        places, _ = unblobs(batch.column("places"), np.int32)
        row = np.repeat(np.arange(batch.num_rows), n)
        for i in range(0, len(row), 100_000):
            some = pa.array(row[i : i + 100_000])
            yield pa.RecordBatch.from_arrays([pa.array(tokens[i : i + 100_000]), batch.column("key").take(some), batch.column("n").cast(pa.int32()).take(some), pa.array(places[i : i + 100_000]), batch.column("component").take(some), batch.column("parity").take(some)], ["token", "key", "n", "place", "component", "parity"])


def may_reach(n: np.ndarray, place: np.ndarray, m: np.ndarray, other: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Whether sets of n and m tokens whose first shared token stands at these places can be similar enough."""
    need = -((-percent * (n + m)) // (100 + percent))
    fits = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    return fits & (1 + np.minimum(n - 1 - place, m - 1 - other) >= need)


#: How the pairs of a list are taken.
SMALLEST, NEAREST, ALL = range(3)


def _candidates(percent: int, which: int):
    """Pairs (a, b), a < b, from the entries, which come sorted by token and key."""
    def apart(i, others, n, place, parity):
        """Those of others that may be linked with entry i, and in how many bits they differ."""
        j = others[may_reach(n[others], place[others], n[i], place[i], percent)]
        differing = np.bitwise_count(parity[j] ^ parity[i]).sum(axis=1).astype(np.int64)
        ok = may_share(n[j], n[i], differing, percent)
        return j[ok], differing[ok]

    def one_list(key, n, place, component, parity):
        if which == SMALLEST:
            j = np.flatnonzero(may_reach(n, place, n[0], place[0], percent) & (key != key[0]))
            if len(j):
                yield np.full(len(j), key[0]), key[j]
        elif which == NEAREST:
            _, at, sizes = np.unique(component, return_inverse=True, return_counts=True)
            for i in np.flatnonzero(at != sizes.argmax()):
                j, differing = apart(i, np.flatnonzero(at != at[i]), n, place, parity)
                if len(j):
                    near = key[j[np.argmin(differing / (n[j] + n[i]))]]
                    yield np.minimum(key[i : i + 1], near), np.maximum(key[i : i + 1], near)
        else:
            for i in range(len(key) - 1):
                others = np.flatnonzero((component[i + 1 :] != component[i]) & (key[i + 1 :] != key[i])) + i + 1
                if len(others):
                    j, _ = apart(i, others, n, place, parity)
                    if len(j):
                        yield np.full(len(j), key[i]), key[j]

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush():
            nonlocal held, size
            both = np.unique(np.stack([np.concatenate(x) for x in zip(*held, strict=True)], axis=1), axis=0)
            held, size = [], 0
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

        def lists():
            names = ("token", "key", "n", "place", "component")
            rest = None
            for batch in batches:
                columns = [batch.column(c).to_numpy().astype(np.int64) for c in names]
                columns.append(unblobs(batch.column("parity"), np.uint64)[0].reshape(-1, PARITY_BITS // 64) if which != SMALLEST else columns[0][:, None])
                if rest is not None:
                    columns = [np.concatenate(x) for x in zip(rest, columns, strict=True)]
                cuts = np.flatnonzero(np.diff(columns[0])) + 1
                last = cuts[-1] if len(cuts) else 0
                starts = [0, *cuts.tolist()]
                for a, b in zip(starts[:-1], starts[1:], strict=True):
                    if b - a > 1:
                        yield [c[a:b] for c in columns[1:]]
                rest = [c[last:] for c in columns]
            if rest is not None and len(rest[0]) > 1:
                yield [c[:] for c in rest[1:]]

        for entries in lists():
            if which != SMALLEST and (entries[3] == entries[3][0]).all():
                continue
            for pair in one_list(*entries):
                held.append(pair)
                size += len(pair[0])
                if size > 500_000:
                    yield flush()
        if held:
            yield flush()

    return pairs


def _verified(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            sets = {s: unblobs(batch.column(f"tokens_{s}"), np.uint8) for s in "ab"}
            flags = {s: unblobs(batch.column(f"flags_{s}"), np.uint8)[0] for s in "ab"}
            wide, ends = {}, {}
            for s, (raw, n) in sets.items():
                padded = np.zeros((len(raw) // SET_BYTES, 8), np.uint8)
                padded[:, :SET_BYTES] = raw.reshape(-1, SET_BYTES)
                wide[s], ends[s] = padded.view(np.uint64).ravel(), np.concatenate(([0], np.cumsum(n // SET_BYTES)))
            for i in range(batch.num_rows):
                a, b = (slice(ends[s][i], ends[s][i + 1]) for s in "ab")
                x, y, fx, fy = wide["a"][a], wide["b"][b], flags["a"][a], flags["b"][b]
                if all(len(np.intersect1d(x[fx & bit > 0], y[fy & bit > 0], assume_unique=True)) for bit in (1 << o for o in range(1, len(ORDERS)))):
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    if 100 * shared >= percent * (len(x) + len(y) - shared):
                        out.append(i)
            yield batch.select(["a", "b"]).take(pa.array(out, pa.int64()))

    return verify


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("key").alias("a"), F.col("tokens").alias("tokens_a"), F.col("flags").alias("flags_a"))
    right = sets.select(F.col("key").alias("b"), F.col("tokens").alias("tokens_b"), F.col("flags").alias("flags_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "tokens_a", "flags_a", "tokens_b", "flags_b")
    return both.mapInArrow(_verified(percent), "a long, b long")


def jaccard_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id and class_size, one row per input row.

    class_id is the smallest doc_id with the same set, class_size how many rows have it. component_id is the smallest
    doc_id that is reached over links. Null, empty and blank texts have no shingles, are linked with nothing and a class of
    their own. Rows that share a doc_id are one node: what one links with, both do. Rows without a doc_id are one such
    node, which comes first; their ids stay null. Other columns are left out, whatever their names.
    """
    sets = shingle_sets(docs, percent)
    spark, parts = docs.sparkSession, partitions(docs.sparkSession)
    some = sets.where("n > 0")
    classes = written(some.groupBy("sig1", "sig2", "n").agg(F.min(F.struct("key", "kind")).alias("rep"), F.count("*").alias("class_size")), "classes")
    # of equal sets the first stands for all
    heads = some.where(F.octet_length("prefix") > 0).join(classes.select("sig1", "sig2", F.col("rep.key").alias("key"), F.col("rep.kind").alias("kind")), ["sig1", "sig2", "key", "kind"], "left_semi").dropDuplicates(["key", "kind"])
    heads = written(heads.select("key", "n", "tokens", "flags", "prefix", "places", "parity"), "heads")

    def candidates(entries: DataFrame, which: int) -> DataFrame:
        rows = entries.mapInArrow(_entries, "token long, key long, n int, place int, component long, parity binary")
        lists = rows.repartition(parts, "token").sortWithinPartitions("token", "key")
        return lists.mapInArrow(_candidates(percent, which), "a long, b long").distinct()

    entries = heads.select("key", "n", "prefix", "places", "parity")
    # round one has a pair an entry and needs no parities
    alone = entries.withColumn("component", F.col("key")).withColumn("parity", F.lit(None).cast("binary"))
    first = written(_links(candidates(alone, SMALLEST), heads, percent), "links")
    of_class = classes.select("sig1", "sig2", F.col("rep.key").alias("class_key"), "class_size")
    members = some.select("key", "n", "sig1", "sig2").join(of_class, ["sig1", "sig2"])
    copies = members.where("key <> class_key").select(F.col("key").alias("a"), F.col("class_key").alias("b"))
    found = components(first.union(copies))
    def linked(found: DataFrame, which: int) -> DataFrame | None:
        """The components with the links that are found between them; None if there are none."""
        known = entries.join(found.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
        more = written(_links(candidates(known, which), heads, percent), "links")
        return components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)) if more.take(1) else None

    while (nearer := linked(found, NEAREST)) is not None:
        found = nearer
    # what is left is in doubt, and taken pair by pair
    if (rest := linked(found, ALL)) is not None:
        found = rest

    blank = sets.where("n = 0").select("key", "n", F.col("key").alias("class_key"), F.lit(1).cast("long").alias("class_size"))
    members = members.select("key", "n", "class_key", "class_size").union(blank)
    members = members.join(found.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.when(F.col("n") > 0, F.coalesce("component", "key")).otherwise(F.col("key")))
    back = lambda c: F.when(F.col(c) != F.lit(-(2**63)), F.col(c))
    return members.select(back("key").alias("doc_id"), F.col("n").alias("n_shingles"), back("component").alias("component_id"), back("class_key").alias("class_id"), "class_size")
