"""Near duplicates by MinHash bands and odd sketches.

A set is the distinct three-word shingles of a text. SAMPLES MinHash samples of it do two things: in bands of ROWS they
make candidates, and folded into a bitmap of SKETCH bits, where each (sample, value) flips one bit, they become an odd sketch.
Two sketches differ at a bit only if the sets differ at some sample, so the population count of their XOR is at most twice
the number of unequal samples; high similarities show as few bits, and ``likeness`` turns the count into an estimate.

1. Every text becomes a set, a signature, its band keys and its sketch. Equal sets are one class, of which one row goes on.
2. In each band list, every set is paired with the list's first one and its last one. Pairs whose sketches differ in more
   bits than a pair at the threshold can (but for one in a billion) go; the rest are confirmed on the full sets.
3. Lists whose members are then all of one component are done. Sets of the others are joined exactly: pairs of unlike
   components must share a token among the rarest of each (a similarity of t leaves no way around it), fit in size and place
   and have close sketches, before they are confirmed. Hence no cap on lists, and no list is taken pair by pair where its
   members have rare shingles of their own, as texts that share one passage have.

With 32 bands of 5 rows, a pair at a similarity of 0.85 shares a band but for 7 cases in a billion, and more similar pairs
miss less. Sets hold 48 bits of a shingle's hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.components import components
from trackloom.llm.jaccard import Block
from trackloom.llm.tables import written
from trackloom.llm.words import NULL_KEY, blobs, key_of, mixed, slices, unblobs

#: Words in a shingle, and the similarity in hundredths from which documents are linked.
SHINGLE, PERCENT = 3, 85
#: Bands, samples in a band, bits of a sketch, bytes of a token in a set.
BANDS, ROWS, SKETCH, TOKEN = 32, 5, 512, 6
SAMPLES = BANDS * ROWS
#: Chance that a pair at the threshold fails the sketch test.
MISS = 1e-9
#: Counters for the order of tokens, as a power of two.
ORDER_BITS = 18

_SEEDS = mixed(np.arange(1, 2 * SAMPLES + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_XOR, _FACTOR = _SEEDS[:SAMPLES], _SEEDS[SAMPLES:] | np.uint64(1)
_LANES = [f"s{i}" for i in range(SKETCH // 64)]
_SETS = "key long, kind int, n long, sig1 long, sig2 long, bands array<long>, tokens binary, " + ", ".join(f"{s} long" for s in _LANES)


def samples(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The SAMPLES smallest hashes of each set (a row a sample). bounds: where sets begin in tokens, then the end."""
    sets = np.flatnonzero(np.diff(bounds) > 0)
    out = np.zeros((SAMPLES, len(bounds) - 1), np.uint64)
    if len(sets):
        for i in range(SAMPLES):
            out[i, sets] = np.minimum.reduceat((tokens ^ _XOR[i]) * _FACTOR[i], bounds[sets])
    return out


def band_keys(found: np.ndarray) -> np.ndarray:
    """One key for each set (row) and band."""
    out = np.empty((found.shape[1], BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(found.shape[1], band, np.uint64)
        for row in found[band * ROWS : (band + 1) * ROWS]:
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + row)
        out[:, band] = key
    return out


def odd_sketches(found: np.ndarray) -> np.ndarray:
    """The samples of each set folded into SKETCH bits: a bit says whether an odd number of samples fell on it."""
    n = found.shape[1]
    bit = (mixed(found + np.arange(1, SAMPLES + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(SKETCH)).astype(np.int64)
    flips = np.bincount((np.arange(n) * SKETCH + bit).ravel(), minlength=n * SKETCH).reshape(n, SKETCH)
    return np.packbits((flips & 1).astype(np.uint8), axis=1, bitorder="little").view(np.uint64)


def likeness(differing: int) -> float:
    """Similarity estimated from the number of bits at which two sketches differ."""
    return 1 + SKETCH / (4 * SAMPLES) * math.log(max(1 - 2 * differing / SKETCH, 1e-9))


def most_differing(percent: int) -> int:
    """Bits at which the sketches of a pair at the threshold differ, but for a chance of MISS."""
    p, tail, k = 1 - percent / 100, 1.0, 0
    while k < SAMPLES and tail > MISS:  # chance of more than k unequal samples
        tail -= math.comb(SAMPLES, k) * p**k * (1 - p) ** (SAMPLES - k)
        k += 1
    return min(SKETCH, 2 * k)


def prefix_size(n: np.ndarray, percent: int) -> np.ndarray:
    """Of two sets linked at ``percent`` each has a shared token among so many first ones, under any order."""
    return n + (-percent * n) // 100 + 1


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        block = Block(batch.column("text"), SHINGLE)
        found = samples(block.tokens, block.first)
        lanes = odd_sketches(found)
        keys = np.where((block.sizes > 0)[:, None], band_keys(found), np.uint64(0))
        bands = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel().view(np.int64)), BANDS).cast(pa.list_(pa.int64()))
        low = (block.tokens >> np.uint64(64 - 8 * TOKEN)).view(np.uint8).reshape(-1, 8)[:, :TOKEN]
        columns = [batch.column("key"), batch.column("kind"), pa.array(block.sizes.astype(np.int64)), pa.array(block.sigs[0]), pa.array(block.sigs[1]), bands, blobs(low, block.first * TOKEN).cast(pa.binary()), *(pa.array(np.ascontiguousarray(c).view(np.int64)) for c in lanes.T)]
        whole = pa.RecordBatch.from_arrays(columns, ["key", "kind", "n", "sig1", "sig2", "bands", "tokens", *_LANES])
        for k in range(0, whole.num_rows, 500):
            yield whole.slice(k, 500)


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of sets end to end, and where each begins."""
    raw, n = unblobs(column, np.uint8)
    wide = np.zeros((len(raw) // TOKEN, 8), np.uint8)
    wide[:, :TOKEN] = raw.reshape(-1, TOKEN)
    return wide.view(np.uint64).ravel(), np.concatenate(([0], np.cumsum(n // TOKEN)))


def _confirmed(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (x, i), (y, j) = _tokens(batch.column("tokens_a")), _tokens(batch.column("tokens_b"))
            ok = []
            for k in range(batch.num_rows):
                a, b = x[i[k] : i[k + 1]], y[j[k] : j[k + 1]]
                shared = len(np.intersect1d(a, b, assume_unique=True))
                ok.append(100 * shared >= percent * (len(a) + len(b) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return confirm


def _differing(left: str, right: str) -> Column:
    return sum((F.bit_count(F.col(f"{left}.{s}").bitwiseXOR(F.col(f"{right}.{s}"))) for s in _LANES), F.lit(0))


def _fits(left: str, right: str, percent: int) -> Column:
    """Whether sets of these sizes can be similar enough."""
    a, b = F.col(f"{left}.n"), F.col(f"{right}.n")
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _linked(pairs: DataFrame, heads: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sketches are close and whose full sets are similar enough."""
    sketches = heads.select("key", "n", *_LANES)
    left, right = sketches.withColumnRenamed("key", "a").alias("x"), sketches.withColumnRenamed("key", "b").alias("y")
    close = pairs.join(left, "a").join(right, "b").where(_fits("x", "y", percent) & (_differing("x", "y") <= most_differing(percent))).select("a", "b")
    of = lambda s: heads.select(F.col("key").alias(s), F.col("tokens").alias(f"tokens_{s}"))
    return close.join(of("a"), "a").join(of("b"), "b").select("a", "b", "tokens_a", "tokens_b").mapInArrow(_confirmed(percent), "a long, b long")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often tokens fall on each of the counters, in chunks of 1024."""
    counts = np.zeros(1 << ORDER_BITS, np.int64)
    for batch in batches:
        counts += np.bincount((_tokens(batch.column("tokens"))[0] >> np.uint64(8 * TOKEN - ORDER_BITS)).astype(np.int64), minlength=len(counts))
    chunks = counts.reshape(-1, 1024)
    some = np.flatnonzero(chunks.any(axis=1))
    if len(some):
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), blobs(chunks[some].ravel(), np.arange(len(some) + 1) * 1024).cast(pa.binary())], ["chunk", "counts"])


def _summed(rows: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(c, np.int64) for c in rows.column("counts").to_pylist()], axis=0)
    return pa.Table.from_arrays([pa.array([rows.column("chunk")[0].as_py()], pa.int32()), pa.array([np.log2(np.maximum(total, 1)).astype(np.uint8).tobytes()], pa.binary())], ["chunk", "classes"])


def _prefixes(classes, percent: int):
    """A row for each of the rarest tokens of a set, with its place in the global order."""
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, first = _tokens(batch.column("tokens"))
            sizes = np.diff(first)
            doc = np.repeat(np.arange(batch.num_rows), sizes)
            rank = classes.value[(tokens >> np.uint64(8 * TOKEN - ORDER_BITS)).astype(np.int64)]
            order = np.lexsort((mixed(tokens), rank, doc))
            place = np.arange(len(order)) - first[doc]
            at = np.flatnonzero(place < prefix_size(sizes, percent)[doc])
            for k in range(0, len(at), 100_000):
                some = at[k : k + 100_000]
                rows = pa.array(doc[some])
                yield pa.RecordBatch.from_arrays([pa.array(tokens[order[some]].view(np.int64)), pa.array(place[some].astype(np.int32)), *(batch.column(c).take(rows) for c in ("key", "component", "n", *_LANES))], ["token", "place", "key", "component", "n", *_LANES])

    return listed


def _rest(heads: DataFrame, found: DataFrame, entries: DataFrame, percent: int) -> DataFrame:
    """Pairs of unlike components that may be similar enough, from all sets in a band list with two components."""
    spark = heads.sparkSession
    known = entries.join(found.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    mixed_lists = known.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("band")
    open_sets = known.join(mixed_lists, "band", "left_semi").select("key", "component").distinct()
    open_sets = written(heads.select("key", "n", "tokens", *_LANES).join(open_sets, "key"), "open")
    counts = open_sets.select("tokens").mapInArrow(_counted, "chunk int, counts binary").groupBy("chunk").applyInArrow(_summed, "chunk int, classes binary")
    classes = np.zeros(1 << ORDER_BITS, np.uint8)
    for chunk, raw in counts.collect():
        classes[chunk * 1024 : (chunk + 1) * 1024] = np.frombuffer(raw, np.uint8)
    schema = "token long, place int, key long, component long, n long, " + ", ".join(f"{s} long" for s in _LANES)
    listed = open_sets.mapInArrow(_prefixes(spark.sparkContext.broadcast(classes), percent), schema)
    listed = written(listed, "prefixes")
    shared = listed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("token")
    listed = listed.join(shared, "token", "left_semi")
    names = listed.columns
    x, y = listed.alias("x"), listed.select(*[F.col(c).alias(c) for c in names]).alias("y")
    need = F.ceil(percent * (F.col("x.n") + F.col("y.n")) / (100 + percent))
    left = 1 + F.least(F.col("x.n") - 1 - F.col("x.place"), F.col("y.n") - 1 - F.col("y.place"))
    may = (F.col("x.token") == F.col("y.token")) & (F.col("x.key") < F.col("y.key")) & (F.col("x.component") != F.col("y.component")) & _fits("x", "y", percent)
    # the first shared token of a linked pair leaves room for all the others after it
    may &= (_differing("x", "y") <= most_differing(percent)) & (left >= need - 1)
    return x.join(y, may).select(F.col("x.key").alias("a"), F.col("y.key").alias("b")).distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, class_id and class_size, one row per input row.

    component_id is the smallest doc_id that is reached over links, kept whether it is the row's own. class_id is the smallest
    doc_id with the same set, class_size how many rows have it. Null, empty and blank texts have no shingles, are linked with
    nothing and a class of their own. Rows that share a doc_id are one node: what one links with, both do, and both are kept
    or not. Rows without a doc_id are one such node, which comes before all others: its component_id is null, it is kept, and
    so are no rows that link with it. An empty table has an empty result; other columns are left out whatever their names.
    """
    text = F.col("text").cast("string")
    rows = docs.select(key_of().alias("key"), F.hash(F.coalesce(text, F.lit(""))).alias("kind"), text.alias("text"))
    sets = written(rows.mapInArrow(_sets, _SETS), "sketches")
    some = sets.where("n > 0")
    classes = written(some.groupBy("sig1", "sig2", "n").agg(F.min(F.struct("key", "kind")).alias("rep"), F.count("*").alias("class_size")), "classes")
    # of equal sets the first stands for all
    reps = classes.select("sig1", "sig2", F.col("rep.key").alias("key"), F.col("rep.kind").alias("kind"))
    keys = some.select("sig1", "sig2", "key", "kind", "bands").join(reps, ["sig1", "sig2", "key", "kind"], "left_semi").dropDuplicates(["key", "kind"])
    entries = keys.select("key", F.explode("bands").alias("band"))
    lists = entries.groupBy("band").agg(F.min("key").alias("first"), F.max("key").alias("last")).where("first <> last")
    entries = written(entries.join(lists, "band"), "entries")
    pairs = entries.select("first", "last", "key").select(F.explode(F.array(F.struct(F.col("first").alias("a"), F.col("key").alias("b")), F.struct(F.col("key").alias("a"), F.col("last").alias("b")))).alias("p")).select("p.*").where("a <> b").distinct()
    listed = entries.select("key").distinct()
    heads = written(some.select("key", "kind", "sig1", "sig2", "n", "tokens", *_LANES).join(listed, "key", "left_semi").join(reps, ["sig1", "sig2", "key", "kind"], "left_semi").dropDuplicates(["key", "kind"]).drop("sig1", "sig2", "kind"), "heads")
    links = written(_linked(pairs, heads, percent), "links")

    of_class = classes.select("sig1", "sig2", F.col("rep.key").alias("class_key"), "class_size")
    members = some.select("key", "n", "sig1", "sig2").join(of_class, ["sig1", "sig2"])
    copies = members.where("key <> class_key").select(F.col("key").alias("a"), F.col("class_key").alias("b"))
    found = components(links.union(copies))
    more = written(_linked(_rest(heads, found, entries.select("key", "band"), percent), heads, percent), "links")
    if more.take(1):
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))

    blank = sets.where("n = 0").select("key", "n", F.col("key").alias("class_key"), F.lit(1).cast("long").alias("class_size"))
    members = members.select("key", "n", "class_key", "class_size").union(blank)
    members = members.join(found.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.when(F.col("n") > 0, F.coalesce("component", "key")).otherwise(F.col("key")))
    back = lambda c: F.when(F.col(c) != NULL_KEY, F.col(c))
    return members.select(back("key").alias("doc_id"), F.col("n").alias("n_shingles"), back("component").alias("component_id"), (F.col("key") == F.col("component")).alias("kept"), back("class_key").alias("class_id"), "class_size")
