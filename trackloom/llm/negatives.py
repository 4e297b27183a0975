"""Hard negatives by inner product, with length buckets and coordinate lists (LEMP's pruning).

For every anchor: its first rows of the same label by score (positives), and for each of these the first rows of other
labels whose score lies between a share of the positive's and the positive's (negatives). Vectors are whole numbers,
floor(scale * x), and every score is exact.

1. Rows are range-partitioned by (label, length, longest first); a partition is a block of bounded bytes. Inside a block,
   buckets hold rows of similar length, longest first, and per bucket and coordinate a sorted list of the rows' unit values.
2. An anchor that has a lower bound on the scores it still wants leaves out every bucket whose longest row can't reach it.
   In the others the bound becomes one on the cosine, t, and a row can reach it only if, for each coordinate f, its angle to
   axis f differs from the anchor's by arccos t at most. The ranges of the anchor's focus coordinates (its largest) are cut
   out of the sorted lists and intersected; what is left is verified by exact products. Where the shortest list is not
   much shorter than the bucket, the bucket is verified as one matrix product instead.
3. The first bounds come from the anchor's own block. Then anchors travel to the blocks that hold their label, and with
   their positives to all blocks they can reach, in packs of bounded size: a task has one block and one pack.

Rows with a null id, label or vector, with a null or non-finite component, and with a squared length of 2**63 or more
(whose scores a long can't hold) take no part. Rows of unequal dimension are not compared. Repeated rows are rows of their
own, so each copy is another row to every other; equal scores are ordered by id. Zero vectors score 0. An empty table has
an empty result, and other columns are left out whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.llm.tables import written

#: Components in a block and in a pack of anchors, rows in a bucket, least ratio of lengths in a bucket.
BLOCK, PACK, BUCKET, RATIO = 1 << 23, 1 << 20, 4096, 0.9
#: Focus coordinates, and the share of a bucket from which a matrix product is cheaper than its lists.
FOCUS, DENSE = 4, 0.3
#: Relative slack of every bound, above what rounding can do.
SLACK = 1e-9

_INDEX = "serial long, id long, label long, anchor boolean, block int, length double, vector array<double>, bound double"


class Rows:
    """Some rows as arrays: ``serial``, ``id``, ``label``, ``length`` and the matrix ``x`` of whole numbers."""

    def __init__(self, table: pa.Table | pa.RecordBatch):
        self.serial, self.id, self.label = (table.column(c).to_numpy().astype(np.int64) for c in ("serial", "id", "label"))
        self.length = table.column("length").to_numpy()
        vectors = table.column("vector")
        vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
        vectors = vectors.chunk(0) if isinstance(vectors, pa.ChunkedArray) else vectors
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        self.x = flat.reshape(table.num_rows, len(flat) // max(table.num_rows, 1))


class Bucket:
    """Rows of similar length, with their sorted coordinate lists, made when an anchor first asks for one."""

    def __init__(self, rows: Rows, at: np.ndarray):
        self.serial, self.id, self.label, self.x = rows.serial[at], rows.id[at], rows.label[at], rows.x[at]
        self.length = rows.length[at]
        self.longest = float(self.length[0])
        self._whole = None
        self._lists: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def list_of(self, f: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unit values of coordinate f in row order, the rows sorted by them, and the sorted values."""
        if f not in self._lists:
            unit = np.divide(self.x[:, f], self.length, out=np.zeros(len(self.x)), where=self.length > 0)
            order = np.argsort(unit, kind="stable")
            self._lists[f] = unit, order, unit[order]
        return self._lists[f]

    def candidates(self, unit: np.ndarray, t: float) -> np.ndarray | None:
        """Rows whose focus coordinates all lie in the feasible ranges for a cosine of t; None if that hardly prunes."""
        t = min(t, 1.0) * (1 - SLACK)
        focus = np.argpartition(-np.abs(unit), min(FOCUS, len(unit)) - 1)[:FOCUS]
        ranges = []
        for f in focus.tolist():
            q = max(-1.0, min(1.0, float(unit[f])))
            spread = math.sqrt(max(0.0, (1 - t * t) * (1 - q * q)))
            low = -2.0 if -q >= t else t * q - spread - SLACK
            high = 2.0 if q >= t else t * q + spread + SLACK
            _, _, values = self.list_of(f)
            ranges.append((f, low, high, int(np.searchsorted(values, low)), int(np.searchsorted(values, high, "right"))))
        ranges.sort(key=lambda r: r[4] - r[3])
        f, _, _, begin, end = ranges[0]
        if end - begin > DENSE * len(self.x):
            return None
        found = self.list_of(f)[1][begin:end]
        for f, low, high, _, _ in ranges[1:]:
            values = self.list_of(f)[0][found]
            found = found[(values >= low) & (values <= high)]
        return np.sort(found)

    def products(self, q: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """Exact inner products of the rows with the vectors of q (one a row), as whole numbers."""
        x = self.x if at is None else self.x[at]
        if self._whole is None:
            self._whole = float(np.abs(self.x).max(initial=0)) * self.x.shape[1]
        if self._whole * float(np.abs(q).max(initial=0)) < 2**53:
            return (q @ x.T).astype(np.int64)
        return q.astype(np.int64) @ x.astype(np.int64).T


def buckets(rows: Rows) -> list[Bucket]:
    """The rows in buckets, longest first."""
    order = np.lexsort((rows.serial, -rows.length))
    lengths, out, begin = rows.length[order], [], 0
    while begin < len(order):
        end = min(begin + BUCKET, int(np.searchsorted(-lengths, -RATIO * lengths[begin], "right")))
        out.append(Bucket(rows, order[begin : max(end, begin + 1)]))
        begin = max(end, begin + 1)
    return out


def _scan(found: list[Bucket], anchors: Rows, bound: np.ndarray, take) -> None:
    """Hands every row that reaches its anchor's bound to take(anchor, bucket, rows, scores), which may raise the bound."""
    units = np.divide(anchors.x, anchors.length[:, None], out=np.zeros_like(anchors.x), where=anchors.length[:, None] > 0)
    for bucket in found:
        if not len(anchors.x) or bucket.x.shape[1] != anchors.x.shape[1]:
            continue
        reach = anchors.length * bucket.longest * (1 + SLACK)
        dense = []
        for i in np.flatnonzero(reach >= bound).tolist():
            at = bucket.candidates(units[i], bound[i] / reach[i]) if bound[i] > 0 else None
            if at is None:
                dense.append(i)
            elif len(at):
                scores = bucket.products(anchors.x[i : i + 1], at)[0]
                hits = np.flatnonzero(scores >= bound[i])
                take(i, bucket, at[hits], scores[hits])
        for k in range(0, len(dense), 128):
            some = dense[k : k + 128]
            scores = bucket.products(anchors.x[some])
            for row, i in zip(scores, some, strict=True):
                hits = np.flatnonzero(row >= bound[i])
                take(i, bucket, hits, row[hits])


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The first k by score descending, then id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


class Positives:
    """The first k rows of each anchor's label."""

    def __init__(self, anchors: Rows, k: int, bound: np.ndarray):
        self.anchors, self.k, self.bound = anchors, k, bound
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in anchors.id]

    def take(self, i: int, bucket: Bucket, at: np.ndarray, scores: np.ndarray) -> None:
        ok = (bucket.label[at] == self.anchors.label[i]) & (bucket.serial[at] != self.anchors.serial[i])
        if ok.any():
            s, ids = np.concatenate((self.best[i][0], scores[ok])), np.concatenate((self.best[i][1], bucket.id[at[ok]]))
            first = _first(s, ids, self.k)
            self.best[i] = s[first], ids[first]
            if len(first) == self.k:
                self.bound[i] = max(self.bound[i], float(s[first[-1]]))


class Negatives:
    """For each positive of an anchor, the first k rows of other labels in its range of scores."""

    def __init__(self, anchors: Rows, positives: list[list[int]], k: int, percent: tuple[int, int]):
        self.anchors, self.k, self.positives = anchors, k, positives
        low, high = percent
        # rows wanted: ceil(low * p / 100) to floor(high * p / 100)
        self.ranges = [[(max(-(-low * p // 100), -(2**63)), min(high * p // 100, 2**63 - 1)) for p in ps] for ps in positives]
        self.best = [[(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ps] for ps in positives]
        self.bound = np.array([min([float(a) for a, b in r if a <= b], default=math.inf) for r in self.ranges])

    def take(self, i: int, bucket: Bucket, at: np.ndarray, scores: np.ndarray) -> None:
        ok = bucket.label[at] != self.anchors.label[i]
        scores, ids = scores[ok], bucket.id[at[ok]]
        bounds = []
        for j, (low, high) in enumerate(self.ranges[i]):
            fits = np.flatnonzero((scores >= low) & (scores <= high))
            have = self.best[i][j]
            if len(fits):
                s, n = np.concatenate((have[0], scores[fits])), np.concatenate((have[1], ids[fits]))
                first = _first(s, n, self.k)
                have = self.best[i][j] = s[first], n[first]
            if low <= high:
                bounds.append(float(have[0][-1]) if len(have[0]) == self.k else float(low))
        self.bound[i] = max(self.bound[i], min(bounds, default=math.inf))


def _vectors(scale: float):
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            n = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            with np.errstate(over="ignore", invalid="ignore"):
                flat = np.floor(scale * flat)
            row = np.repeat(np.arange(batch.num_rows), n)
            with np.errstate(over="ignore", invalid="ignore"):
                square = np.bincount(row, weights=flat * flat, minlength=batch.num_rows)
            ok = np.flatnonzero(np.isfinite(square) & (square < 2.0**63 * (1 - SLACK)))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32)), pa.array(flat))
            some = batch.select(["id", "label", "anchor"]).take(pa.array(ok))
            yield pa.RecordBatch.from_arrays([*some.columns, lists.take(pa.array(ok)), pa.array(np.sqrt(square[ok])), pa.array(n[ok])], ["id", "label", "anchor", "vector", "length", "size"])

    return whole


def _seeded(positives: int):
    """A partition is a block: its number, serial numbers, and for anchors the first bound from the block's own rows."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = [b for b in batches if b.num_rows]
        if not held:
            return
        block = TaskContext.get().partitionId()
        table = pa.Table.from_batches(held).combine_chunks()
        table = table.append_column("serial", pa.array((np.int64(block) << np.int64(32)) + np.arange(table.num_rows)))
        bound = np.full(table.num_rows, -np.inf)
        sizes = table.column("size").to_numpy()
        for size in np.unique(sizes):
            of = np.flatnonzero(sizes == size)
            some = table.take(pa.array(of))
            asks = np.flatnonzero(some.column("anchor").to_numpy(zero_copy_only=False))
            if len(asks):
                found = buckets(Rows(some))
                for k in range(0, len(asks), 4096):
                    anchors = Rows(some.take(pa.array(asks[k : k + 4096])))
                    best = Positives(anchors, positives, np.full(len(anchors.id), -np.inf))
                    _scan(found, anchors, best.bound, best.take)
                    bound[of[asks[k : k + 4096]]] = best.bound
        for batch in pa.Table.from_arrays([table.column("serial"), table.column("id"), table.column("label"), table.column("anchor"), pa.array(np.full(table.num_rows, block, np.int32)), table.column("length"), table.column("vector"), pa.array(bound)],
                                          ["serial", "id", "label", "anchor", "block", "length", "vector", "bound"]).to_batches(max_chunksize=10_000):
            yield batch

    return make


def _by_size(left: pa.Table, right: pa.Table):
    """The rows and anchors of a task, per dimension."""
    sizes = {s: pc.list_value_length(t.column("vector")).to_numpy() if t.num_rows else np.zeros(0) for s, t in (("l", left), ("r", right))}
    for size in np.unique(sizes["r"]):
        rows = left.take(pa.array(np.flatnonzero(sizes["l"] == size)))
        if rows.num_rows:
            yield buckets(Rows(rows)), right.take(pa.array(np.flatnonzero(sizes["r"] == size)))


def _find_positives(k: int):
    def find(rows: pa.Table, asks: pa.Table) -> pa.Table:
        out: list[tuple] = []
        for found, some in _by_size(rows, asks):
            anchors = Rows(some)
            best = Positives(anchors, k, some.column("bound").to_numpy().copy())
            _scan(found, anchors, best.bound, best.take)
            out += [(serial, p, s) for serial, (ss, ps) in zip(anchors.serial.tolist(), best.best, strict=True) for s, p in zip(ss.tolist(), ps.tolist(), strict=True)]
        columns = list(zip(*out, strict=True)) or [[], [], []]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], ["serial", "positive_id", "positive_score"])

    return find


def _find_negatives(k: int, percent: tuple[int, int]):
    def find(rows: pa.Table, asks: pa.Table) -> pa.Table:
        out: list[tuple] = []
        for found, some in _by_size(rows, asks):
            anchors = Rows(some)
            positives = some.column("scores").to_pylist()
            best = Negatives(anchors, positives, k, percent)
            _scan(found, anchors, best.bound, best.take)
            for serial, of in zip(anchors.serial.tolist(), best.best, strict=True):
                out += [(serial, j, n, s) for j, (ss, ns) in enumerate(of) for s, n in zip(ss.tolist(), ns.tolist(), strict=True)]
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        return pa.Table.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64())], ["serial", "place", "negative_id", "negative_score"])

    return find


def row_index(rows: DataFrame, scale: float, positives: int) -> DataFrame:
    """The rows that take part, in blocks, written to the shared folder."""
    spark = rows.sparkSession
    sound = "id is not null and label is not null and vector is not null and not exists(vector, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
    rows = rows.where(sound).mapInArrow(_vectors(scale), "id long, label long, anchor boolean, vector array<double>, length double, size long")
    n, size = rows.agg(F.count("*"), F.max("size")).first()
    per_block = max(BUCKET, BLOCK // max(size or 1, 1))
    blocks = max(1, -(-n // per_block), min(spark.sparkContext.defaultParallelism, n // BUCKET))
    # the last key tells repeated rows apart, so that even these can be split
    ranged = rows.withColumn("at", F.monotonically_increasing_id()).repartitionByRange(blocks, "label", F.desc("length"), "id", "at").drop("at")
    return written(ranged.mapInArrow(_seeded(positives), _INDEX), "vectors")


def hard_negatives(
    rows: DataFrame, anchor: Column, id_column: str = "vec_id", vector: str = "embedding", label: Column | str = "label",
    positives: int = 5, negatives: int = 5, percent: tuple[int, int] = (80, 100), scale: float = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    anchor tells which rows are anchors. For each anchor and each of its first ``positives`` rows of the same label, the
    first ``negatives`` rows of other labels that score from percent[0] to percent[1] hundredths of the positive's score.
    """
    label = F.col(label) if isinstance(label, str) else label
    rows = rows.select(F.col(id_column).cast("long").alias("id"), label.cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(vector).cast("array<double>").alias("vector"))
    index = row_index(rows, scale, positives)
    asking = index.where("anchor")
    n, size = asking.agg(F.count("*"), F.max(F.size("vector"))).first()
    packs = max(1, -(-n // max(256, PACK // max(size or 1, 1))))
    pack = F.pmod(F.xxhash64("serial"), F.lit(packs)).cast("int")
    asking = asking.select(*[F.col(c).alias(c) for c in ("serial", "id", "label", "length", "vector", "bound")], pack.alias("pack"))
    blocks = written(index.groupBy("block", "label").agg(F.max("length").alias("longest")), "blocks")
    held = index.select("block", "serial", "id", "label", "length", "vector").withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(packs - 1))))
    can_reach = F.col("length") * F.col("longest") * (1 + SLACK) >= F.col("bound")

    def searched(asks: DataFrame, find, schema: str) -> DataFrame:
        return held.groupBy("block", "pack").cogroup(asks.groupBy("block", "pack")).applyInArrow(find, schema)

    asks = asking.join(blocks, "label").where(can_reach).select("block", "pack", "serial", "id", "label", "length", "vector", "bound")
    hits = searched(asks, _find_positives(positives), "serial long, positive_id long, positive_score long")
    order = Window.partitionBy("serial").orderBy(F.desc("positive_score"), "positive_id")
    hits = hits.withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < positives)
    found = hits.groupBy("serial").agg(F.array_sort(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("positives"))
    found = written(asking.drop("bound").join(found, "serial"), "anchors")

    # from here on the bound is the least score that any positive allows
    low = F.array_min(F.transform("positives", lambda p: p["positive_score"])).cast("double") * (percent[0] / 100)
    of_block = blocks.groupBy("block").agg(F.max("longest").alias("longest"))
    n_blocks = (blocks.agg(F.max("block")).first()[0] or 0) + 1
    sent = found.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).withColumn("bound", F.when(low >= 0, low * (1 - SLACK)).otherwise(F.lit(0.0)))
    sent = sent.join(of_block, "block").where(can_reach).select("block", "pack", "serial", "id", "label", "length", "vector", F.transform("positives", lambda p: p["positive_score"]).alias("scores"))
    hits = searched(sent, _find_negatives(negatives, percent), "serial long, place int, negative_id long, negative_score long")
    order = Window.partitionBy("serial", "place").orderBy(F.desc("negative_score"), "negative_id")
    hits = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    pairs = found.select("serial", F.col("id").alias("anchor_id"), F.explode("positives").alias("p")).select("serial", "anchor_id", F.col("p.place").alias("place"), F.col("p.positive_id").alias("positive_id"), F.col("p.positive_score").alias("positive_score"))
    return hits.join(pairs, ["serial", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
