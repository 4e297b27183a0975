"""Phrases of two to four words that occur more often than their parts, mined with stripes.

A stripe is an associative counter of the words that follow a prefix: prefix -> {next word: count}. Tasks fill the stripes
of prefixes of one to three words, stripes of one prefix are merged elementwise, and everything is read off the merged
stripes: an entry is the count of a phrase (an extension), the total of a prefix is its entry in the stripe of the prefix
one word shorter, and the largest entry is the most that any one-word extension keeps of the phrase.

Three passes over the texts, so that only stripes travel that can hold a frequent phrase:

1. words (the stripe of the empty prefix): exact counts per language.
2. pairs of frequent words, as hashes with one-byte counts, are added up by hash range. A sum is never below the count of
   a pair. The ranges answer with a bitmap of fixed size.
3. windows of words whose neighbouring pairs all pass the bitmap fill the stripes. Their entries hold whole word ids, so
   that counts are exact whatever the bitmap lets through.

Bitmaps are all that is broadcast: at most 2**25 and 2**26 bits, whatever the size of the corpus. Where they fill up they
let more through, and more stripes travel; no count depends on it. A stripe is cut in 64 by its next words, and tasks add
up before they send, so that no prefix is one task's. Words are told apart by 64-bit hashes of language and bytes.

A null or empty text has no words. A null language is ``und``, as one with that name. Repeated rows count each time, ids
play no part. Ties in score are ordered by count, then phrase. An empty table has an empty result, and other columns are
left out whatever their names. Very long texts are slices of their own.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.llm.tables import written
from trackloom.llm.words import Words, blobs, mixed, slices, unblobs

#: Words in the longest phrase.
LONGEST = 4
#: Bits of the two bitmaps at most; tokens for each range of hashes; entries that a task holds before it sends.
WORD_BITS, PAIR_BITS, RANGE, HELD = 25, 26, 500_000, 1_000_000
#: Parts of a stripe, as a power of two; bytes of text worked on at a time (a worker takes some 50 bytes for each).
PART_BITS, SLICE = 6, 1_000_000

_BREAK = np.zeros(256, dtype=bool)
_BREAK[[ord(c) for c in ".,;:!?"]] = True
_BREAK[10:14] = True
_SEPARATORS = _BREAK.copy()
_SEPARATORS[[9, 32]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


class Tokens:
    """The words of some texts: ``ids`` (never 0), and whether each is followed by the next within its piece."""

    def __init__(self, batch: pa.RecordBatch):
        langs = pc.fill_null(batch.column("lang").cast(pa.string()), "und").dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        self.words = w = Words(batch.column("text"), fold=True, separators=_SEPARATORS)
        salt = np.array([int.from_bytes(hashlib.sha256(x.encode()).digest()[:8], "little") for x in self.langs] or [0], np.uint64)
        self.lang = langs.indices.to_numpy()[w.doc] if len(w) else np.zeros(0, np.int64)
        self.ids = np.maximum(mixed(w.hashes ^ salt[self.lang]) if len(w) else w.hashes, np.uint64(1))
        piece = np.cumsum(_BREAK[w.data])[w.starts] if len(w) else np.zeros(0, np.int64)
        self.joined = np.zeros(len(w), bool)
        self.joined[:-1] = (piece[1:] == piece[:-1]) & (w.doc[1:] == w.doc[:-1])

    def spelled(self, at: np.ndarray) -> pa.Array:
        """Some words in lower case."""
        w = self.words
        bounds = np.empty(2 * len(w) + 1, np.int64)
        bounds[0:-1:2], bounds[1:-1:2], bounds[-1] = w.starts, w.ends, len(w.data)
        whole = pa.LargeStringArray.from_buffers(2 * len(w), pa.py_buffer(bounds), pa.py_buffer(_FOLD[w.data]))
        return whole.take(pa.array(2 * at)).cast(pa.string())


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, most=SLICE):
        tokens = Tokens(batch)
        if not len(tokens.ids):
            continue
        ids, first, counts = np.unique(tokens.ids, return_index=True, return_counts=True)
        lang = pa.DictionaryArray.from_arrays(pa.array(tokens.lang[first].astype(np.int32)), pa.array(tokens.langs, pa.string())).cast(pa.string())
        for k in range(0, len(ids), 100_000):
            part = slice(k, k + 100_000)
            yield pa.RecordBatch.from_arrays([lang[part], pa.array(ids[part].view(np.int64)), tokens.spelled(first[part]), pa.array(counts[part].astype(np.int64))], ["lang", "id", "word", "f"])


def _in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set; a bit's place is the hash's first bits."""
    place = hashes >> np.uint64(64 - int(math.log2(8 * len(bitmap))))
    return (bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed(a * np.uint64(0x9E3779B97F4A7C15) + mixed(b))


def _bits_of(hashes: np.ndarray, chunk_bits: int, bits: int) -> Iterator[tuple[int, bytes]]:
    """For each chunk that has hashes, its bits."""
    place = np.unique(hashes >> np.uint64(64 - bits)).astype(np.int64)
    size = 1 << (bits - chunk_bits)
    chunk = place // size
    for c in np.unique(chunk).tolist():
        flags = np.zeros(size, np.uint8)
        flags[place[chunk == c] - c * size] = 1
        yield c, np.packbits(flags, bitorder="little").tobytes()


def _as_bits(found: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([c for c, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())], ["chunk", "bits"])


def _merged_bits(rows: pa.Table) -> pa.Table:
    both = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in rows.column("bits").to_pylist()])
    return pa.Table.from_arrays([pa.array([rows.column("chunk")[0].as_py()], pa.int32()), pa.array([both.tobytes()], pa.binary())], ["chunk", "bits"])


def _bitmap(parts: DataFrame, chunk_bits: int, bits: int) -> np.ndarray:
    """The bitmap of 2**bits bits, from chunks that several tasks have parts of."""
    out = np.zeros((1 << bits) // 8, np.uint8)
    size = len(out) >> chunk_bits
    for chunk, raw in parts.groupBy("chunk").applyInArrow(_merged_bits, "chunk int, bits binary").collect():
        out[chunk * size : (chunk + 1) * size] = np.frombuffer(raw, np.uint8)
    return out


def _word_bits(chunk_bits: int, bits: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _as_bits(list(_bits_of(batch.column("id").to_numpy().view(np.uint64), chunk_bits, bits)))

    return make


def _pair_sums(words, range_bits: int):
    """Hashes of the pairs of frequent words with their counts (255 at most), packed by hash range."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            hashes, at = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
            counts = np.minimum(np.bincount(at, weights=np.concatenate([c for _, c in held])), 255).astype(np.uint8)
            ranges = hashes >> np.uint64(64 - range_bits)
            some, first = np.unique(ranges, return_index=True)
            bounds = np.append(first, len(hashes))
            low = ((hashes << np.uint64(range_bits)) >> np.uint64(32)).astype(np.uint32)
            for k in range(0, len(some), 4096):
                b = bounds[k : k + 4097]
                yield pa.RecordBatch.from_arrays([pa.array(some[k : k + 4096].astype(np.int32)), blobs(low[b[0] : b[-1]], b - b[0]).cast(pa.binary()), blobs(counts[b[0] : b[-1]], b - b[0]).cast(pa.binary())], ["range", "hashes", "counts"])

        for batch in slices(batches, most=SLICE):
            tokens = Tokens(batch)
            frequent = _in_bitmap(words.value, tokens.ids)
            at = np.flatnonzero(tokens.joined[:-1] & frequent[:-1] & frequent[1:]) if len(frequent) else np.zeros(0, np.int64)
            if len(at):
                held.append(np.unique(_pair_hash(tokens.ids[at], tokens.ids[at + 1]), return_counts=True))
                size += len(held[-1][0])
            if size > HELD:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    return count


def _pair_bits(least: int, range_bits: int, chunk_bits: int, bits: int):
    def add(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        of = [unblobs(rows.column(c).combine_chunks(), t)[0] for c, t in (("hashes", "<u4"), ("counts", np.uint8))]
        low, at = np.unique(of[0], return_inverse=True)
        low = low[np.bincount(at, weights=of[1]) >= least].astype(np.uint64)
        hashes = (np.uint64(rows.column("range")[0].as_py()) << np.uint64(64 - range_bits)) | (low << np.uint64(32 - range_bits) if range_bits <= 32 else low >> np.uint64(range_bits - 32))
        return pa.Table.from_batches([_as_bits(list(_bits_of(hashes, chunk_bits, bits)))])

    return add


def _merge(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal tuples once, with the sums of their counts, in order."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    first = np.flatnonzero(new)
    return [c[first] for c in columns], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


def _stripes(words, pairs, bucket_bits: int):
    """The stripes of a task's texts, packed by bucket: prefixes, lengths of the stripes, next words, counts."""
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[list[np.ndarray], np.ndarray]]] = {n: [] for n in range(2, LONGEST + 1)}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for n, some in held.items():
                if not some:
                    continue
                columns, counts = _merge([np.concatenate(c) for c in zip(*(c for c, _ in some), strict=True)], np.concatenate([c for _, c in some]))
                held[n] = []
                key = columns[-1] >> np.uint64(64 - PART_BITS)
                for c in columns[:-1]:
                    key = _pair_hash(key, c)
                bucket = key >> np.uint64(64 - bucket_bits)
                order = np.lexsort((key, bucket))
                columns, counts, key, bucket = [c[order] for c in columns], counts[order], key[order], bucket[order]
                new = np.ones(len(order), bool)
                new[1:] = (key[1:] != key[:-1]) | np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:-1]])
                first = np.flatnonzero(new)
                lengths = np.diff(np.append(first, len(order))).astype(np.int32)
                prefixes = np.stack([c[first] for c in columns[:-1]], axis=1)
                some_buckets, begin = np.unique(bucket, return_index=True)
                ends, stripes = np.append(begin, len(order)), np.append(np.searchsorted(first, begin), len(first))
                for k in range(0, len(some_buckets), 4096):
                    e, s = ends[k : k + 4097], stripes[k : k + 4097]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(some_buckets[k : k + 4096].astype(np.int32)), pa.array(np.full(len(e) - 1, n, np.int32)),
                        blobs(prefixes[s[0] : s[-1]].ravel(), (s - s[0]) * (n - 1)).cast(pa.binary()), blobs(lengths[s[0] : s[-1]], s - s[0]).cast(pa.binary()),
                        blobs(columns[-1][e[0] : e[-1]], e - e[0]).cast(pa.binary()), blobs(counts[e[0] : e[-1]].astype(np.int32), e - e[0]).cast(pa.binary()),
                    ], ["bucket", "n", "prefixes", "lengths", "words", "counts"])

        for batch in slices(batches, most=SLICE):
            tokens = Tokens(batch)
            ids = tokens.ids
            frequent = _in_bitmap(words.value, ids)
            run = np.zeros(len(ids), bool)
            at = np.flatnonzero(tokens.joined[:-1] & frequent[:-1] & frequent[1:]) if len(ids) else np.zeros(0, np.int64)
            run[at[_in_bitmap(pairs.value, _pair_hash(ids[at], ids[at + 1]))]] = True
            at = np.flatnonzero(run)
            for n in range(2, LONGEST + 1):
                if n > 2:
                    at = at[run[at + n - 2]] if len(at) else at
                if len(at):
                    held[n].append(_merge([ids[at + k] for k in range(n)], np.ones(len(at), np.int64)))
                    size += len(held[n][-1][1])
            if size > HELD:
                yield from flush()
                size = 0
        yield from flush()

    return fill


def _merged_stripes(least: int):
    def merge(rows: pa.Table) -> pa.Table:
        """The entries that occur often enough, after stripes of equal prefixes are added up elementwise."""
        rows = rows.combine_chunks()
        sizes = rows.column("n").to_numpy()
        out = [np.zeros((LONGEST, 0), np.uint64)]
        totals = [np.zeros(0, np.int64)]
        for n in np.unique(sizes).tolist():
            some = rows.take(pa.array(np.flatnonzero(sizes == n)))
            raw = {c: unblobs(some.column(c).combine_chunks(), t)[0] for c, t in (("prefixes", np.uint64), ("lengths", np.int32), ("words", np.uint64), ("counts", np.int32))}
            prefix = np.repeat(raw["prefixes"].reshape(-1, n - 1), raw["lengths"], axis=0)
            columns, counts = _merge([*prefix.T, raw["words"]], raw["counts"].astype(np.int64))
            often = counts >= least
            padded = np.zeros((LONGEST, int(often.sum())), np.uint64)
            for k, c in enumerate(columns):
                padded[k] = c[often]
            out.append(padded)
            totals.append(counts[often])
        words = np.concatenate(out, axis=1)
        return pa.Table.from_arrays([*(pa.array(c.view(np.int64)) for c in words), pa.array(np.concatenate(totals))], [*_WORDS, "f"])

    return merge


_WORDS = [f"w{k}" for k in range(1, LONGEST + 1)]


def _part(begin: int, length: int, size: int) -> Column:
    """Words begin..begin + length - 1 of a phrase of ``size`` words, padded."""
    return F.struct(*[F.col(_WORDS[begin + k]).alias(name) if k < length and begin + k < size else F.lit(0).cast("long").alias(name) for k, name in enumerate(_WORDS)])


def phrase_counts(docs: DataFrame, least: int = 30) -> tuple[DataFrame, DataFrame]:
    """Words (lang, id, word, f), all of them, and phrases (w1 to w4 as ids, 0 where shorter; f) with f >= least."""
    spark = docs.sparkSession
    texts = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    words = written(texts.mapInArrow(_word_counts, "lang string, id long, word string, f long").groupBy("lang", "id", "word").agg(F.sum("f").alias("f")), "words")
    total = words.agg(F.sum("f")).first()[0] or 0
    size = max(16, total.bit_length())
    bits, pair_bits = min(size, WORD_BITS), min(size, PAIR_BITS)
    ranges = min(30, max(3, (total // RANGE).bit_length()))
    chunks = min(ranges, 10)
    frequent = words.where(F.col("f") >= least).select("id").mapInArrow(_word_bits(chunks, bits), "chunk int, bits binary")
    word_map = spark.sparkContext.broadcast(_bitmap(frequent, chunks, bits))
    sums = texts.mapInArrow(_pair_sums(word_map, ranges), "range int, hashes binary, counts binary").groupBy("range")
    pair_map = spark.sparkContext.broadcast(_bitmap(sums.applyInArrow(_pair_bits(least, ranges, chunks, pair_bits), "chunk int, bits binary"), chunks, pair_bits))
    stripes = texts.mapInArrow(_stripes(word_map, pair_map, ranges), "bucket int, n int, prefixes binary, lengths binary, words binary, counts binary")
    schema = ", ".join(f"{w} long" for w in _WORDS) + ", f long"
    phrases = written(stripes.groupBy("bucket").applyInArrow(_merged_stripes(least), schema), "phrases")
    word_map.unpersist()
    pair_map.unpersist()
    return words, phrases


def collocations(docs: DataFrame, least: int = 30, scale: int = 2_000_000, keep_below: int = 80, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: each language's first ``top`` phrases.

    a is the phrase's count; of all ways to cut it in two the one with the lowest score counts, score being the whole part
    of scale * a / (l + r) with l and r the counts of the two parts, and ties going to the shortest first part. n counts the
    language's words. A phrase goes if a longer frequent one that holds it has keep_below hundredths of its count or more.
    """
    words, phrases = phrase_counts(docs, least)
    frequent = words.where(F.col("f") >= least)
    size = F.when(F.col("w3") == 0, 2).when(F.col("w4") == 0, 3).otherwise(4)
    by_size = lambda parts: F.coalesce(*[F.when(size == n, F.array(*parts(n))) for n in range(2, LONGEST + 1)])
    phrase = F.struct(*_WORDS)

    # the most that a phrase longer by one word keeps, at the right (the same stripe) or at the left
    shorter = by_size(lambda n: [_part(0, n - 1, n), _part(1, n - 1, n)])
    longer = phrases.where("w3 <> 0").select(F.explode(shorter).alias("phrase"), "f").groupBy("phrase").agg(F.max("f").alias("longest"))
    kept = phrases.select(phrase.alias("phrase"), F.col("f").alias("a")).join(longer, "phrase", "left")
    kept = kept.where(F.col("longest").isNull() | (100 * F.col("longest") < keep_below * F.col("a"))).select("phrase.*", "phrase", "a")

    none = F.lit(0).cast("long")
    parts = frequent.select(F.struct(F.col("id").alias("w1"), *[none.alias(w) for w in _WORDS[1:]]).alias("part"), "f").union(phrases.select(phrase.alias("part"), "f"))
    cuts = kept.select("phrase", "a", F.explode(by_size(lambda n: [F.struct(F.lit(k).alias("k"), _part(0, k, n).alias("left"), _part(k, n - k, n).alias("right")) for k in range(1, n)])).alias("cut"))
    cuts = cuts.select("phrase", "a", "cut.*").join(parts.select(F.col("part").alias("left"), F.col("f").alias("l")), "left").join(parts.select(F.col("part").alias("right"), F.col("f").alias("r")), "right")
    whole = F.expr(f"({scale} * cast(a as decimal(25, 0))) div cast(cast(l as decimal(20, 0)) + r as decimal(25, 0))")
    best = cuts.groupBy("phrase", "a").agg(F.min(F.struct(whole.alias("score"), "k", "l", "r")).alias("best")).select("phrase", "a", "best.*")

    lang = frequent.select(F.col("id").alias("w1"), "lang")
    best = best.withColumn("w1", F.col("phrase.w1")).join(lang, "w1")
    # spelled out are those that can be among the first, all that tie with the last of them included
    tied = best.withColumn("rank", F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))).where(F.col("rank") <= top)
    tied = written(tied.select("lang", "phrase", "a", "l", "r", "score"), "first")
    spelled = tied.select("phrase", F.posexplode(F.filter(F.array(*[F.col(f"phrase.{w}") for w in _WORDS]), lambda x: x != 0)).alias("at", "id")).join(frequent.select("id", "word"), "id")
    spelled = spelled.groupBy("phrase").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("words"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "words")
    ranked = tied.join(spelled, "phrase").withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    ranked = ranked.join(words.groupBy("lang").agg(F.sum("f").alias("n")), "lang")
    return ranked.select("lang", "rank", F.col("words").alias("phrase"), "a", "l", "r", "n", "score")
