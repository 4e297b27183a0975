"""Toxicity scores: a recurrent network over all overlapping windows of a document.

Learning takes ``LEARN`` labelled documents at most (all bounds are arguments of ``fit``). Spark counts in how many toxic and other ones each hashed word stands; the
log-odds are the first component of the word vectors. The network is fitted on windows of ``SAMPLE`` of them: of each the
window with the highest log-odds, and one by chance of those that are not toxic. In training the log-odds of a document's
words come from the other half of the documents. A logistic step turns the highest window of a document into its score,
fitted on ``CALIBRATION`` of the documents with all their windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.llm import recurrent as net
from trackloom.llm.tables import written
from trackloom.llm.words import Words, blobs, slices, unblobs

#: Words in a window, and from one window's start to the next one's.
WINDOW, STRIDE = 48, 36
#: Labelled documents that are learned from; those of them that the network, and the calibration, are fitted on. At most.
LEARN, SAMPLE, CALIBRATION = 20_000, 5_000, 1_500
#: Bytes of a word that learning looks at; scoring reads all.
WORD_BYTES = 64
EPOCHS, BATCH, RATE, SEED = 8, 64, 0.01, 11
#: A document is predicted toxic from this score on.
THRESHOLD = 0.3
#: Documents that a word's log-odds are shrunk by.
SHRINK = 4.0
#: Words whose inputs a task remembers.
REMEMBERED = 200_000


def _rows(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(48)).astype(np.int64)


def _document_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic and other documents of each half have a hashed word."""
    counts = np.zeros((2, 2, net.ROWS), np.int64)
    for batch in slices(batches):
        w = Words(batch.column("text"), fold=True)
        pair = np.unique(w.doc * net.ROWS + _rows(w.hashes))
        doc, row = pair // net.ROWS, pair % net.ROWS
        half, toxic = batch.column("half").to_numpy(), batch.column("toxic").to_numpy()
        np.add.at(counts, (half[doc], toxic[doc], row), 1)
    row = np.flatnonzero(counts.any(axis=(0, 1)))
    if len(row):
        yield pa.RecordBatch.from_arrays([pa.array(row), *[pa.array(counts[h, t, row]) for h in (0, 1) for t in (0, 1)]], ["row", "n00", "n01", "n10", "n11"])


def log_odds(others: np.ndarray, toxic: np.ndarray, share: float) -> np.ndarray:
    """Shrunk towards 0: a word of one document says little."""
    return np.log((toxic + SHRINK * share) / (others + toxic + SHRINK) / share)


def windows_of(n_words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, first word and size of each window. Every word is in one; a document without words has none."""
    n = np.where(n_words > 0, np.maximum(-(-(n_words - WINDOW) // STRIDE), 0) + 1, 0)
    doc = np.repeat(np.arange(len(n)), n)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    return doc, first[doc] + STRIDE * k, np.minimum(WINDOW, n_words[doc] - STRIDE * k)


def _grid(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(WINDOW)[:, None]
    mask = at < size
    return np.where(mask, start + at, 0), mask.astype(np.float32)


def _examples(tables):
    """Each document's window to learn from: its words' bytes end to end, their lengths, hashed rows and half."""
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            w = Words(batch.column("text"), fold=True)
            half, toxic = batch.column("half").to_numpy(), batch.column("toxic").to_numpy()
            if not len(w):
                continue
            odds = np.where(half[w.doc] > 0, tables.value[0][_rows(w.hashes)], tables.value[1][_rows(w.hashes)])
            doc, start, size = windows_of(w.per_doc, w.first[:-1])
            words, mask = _grid(start, size)
            best = np.where(mask > 0, odds[words], -1e9).max(axis=0)
            order = np.lexsort((-best, doc))
            top = order[np.concatenate(([True], np.diff(doc[order]) > 0))]
            rng = np.random.default_rng(len(w))
            some = np.flatnonzero(np.concatenate(([True], np.diff(doc) > 0)))
            count = np.diff(np.append(some, len(doc)))
            chance = some + (rng.random(len(some)) * count).astype(np.int64)
            chosen = np.unique(np.concatenate((top, chance[toxic[doc[chance]] == 0])))
            for i in chosen.tolist():
                a, b = start[i], start[i] + size[i]
                sizes = w.ends[a:b] - w.starts[a:b]
                raw = b"".join(w.data[s:e].tobytes() for s, e in zip(w.starts[a:b].tolist(), w.ends[a:b].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays([pa.array([int(half[doc[i]])], pa.int32()), pa.array([int(toxic[doc[i]])], pa.int32()), pa.array([raw], pa.binary()), pa.array([sizes.astype("<i4").tobytes()], pa.binary()), pa.array([_rows(w.hashes[a:b]).astype("<i4").tobytes()], pa.binary())], ["half", "toxic", "raw", "sizes", "rows"])

    return pick


class Scorer:
    """Highest window logit of documents, with what it has worked out for words kept for the next batch."""

    def __init__(self, model: dict):
        self.model = model
        self.hashes, self.inputs = np.zeros(0, np.uint64), np.zeros((0, net.OWN + 2 * net.HIDDEN_BYTES), np.float32)

    def word_inputs(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """The inputs of the distinct words, and for each word its row there."""
        distinct, where, which = np.unique(w.hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == distinct[inside]
        new = np.flatnonzero(~known)
        if len(new):
            made = np.empty((len(new), self.inputs.shape[1]), np.float32)
            starts = w.starts[where[new]]
            sizes = w.ends[where[new]] - starts
            order = np.argsort(sizes, kind="stable")
            begin = 0
            while begin < len(order):  # words of about the same length together
                longest = int(sizes[order[begin]])
                end = int(np.searchsorted(sizes[order], longest + longest // 8, side="right"))
                end = min(max(end, begin + 1), begin + max(1, 400_000 // (longest + longest // 8)))
                part = order[begin:end]
                made[part] = net.word_inputs(self.model, *net.bytes_of(w.data, starts[part], sizes[part]), _rows(distinct[new[part]]))
                begin = end
            if len(self.hashes) + len(new) > REMEMBERED:
                keep = known.nonzero()[0]
                self.hashes, self.inputs = distinct[keep], self.inputs[at[keep]]
            hashes = np.concatenate((self.hashes, distinct[new]))
            order = np.argsort(hashes, kind="stable")
            self.hashes, self.inputs = hashes[order], np.concatenate((self.inputs, made))[order]
            at = np.searchsorted(self.hashes, distinct)
        return self.inputs[at], which

    def highest(self, texts: pa.Array) -> np.ndarray:
        """Per text; -inf for one without words."""
        w = Words(texts, fold=True)
        out = np.full(len(texts), -np.inf)
        if not len(w):
            return out
        inputs, row = self.word_inputs(w)
        projects = net.project(self.model, inputs)
        doc, start, size = windows_of(w.per_doc, w.first[:-1])
        for i in range(0, len(doc), 4096):
            words, mask = _grid(start[i : i + 4096], size[i : i + 4096])
            np.maximum.at(out, doc[i : i + 4096], net.window_logits(self.model, projects, row[words], mask))
        return out


def _fit(examples: list, own: np.ndarray, halves: list[np.ndarray], word_bytes: int) -> dict:
    """examples: (half, toxic, raw, sizes, rows). The word vectors of a half start from the other half's log-odds."""
    rng = np.random.default_rng(SEED)
    vectors = np.zeros((net.ROWS, net.OWN), np.float32)
    vectors[:, 1:] = rng.normal(size=(net.ROWS, net.OWN - 1)) / 20
    vectors[:, 0] = own
    model = net.new_model(SEED, vectors)
    positive = np.mean([e[1] for e in examples]) if examples else 0.0
    if not 0 < positive < 1:
        return model
    adam = net.Adam(RATE)
    shift = [halves[1] - own, halves[0] - own]  # what turns the final log-odds into those of the other half
    for _ in range(EPOCHS):
        order = rng.permutation(len(examples))
        for i in range(0, len(order), BATCH):
            batch = [examples[j] for j in order[i : i + BATCH]]
            sizes = np.concatenate([np.frombuffer(e[3], "<i4") for e in batch])
            n = np.array([len(e[3]) // 4 for e in batch])
            rows = np.concatenate([np.frombuffer(e[4], "<i4") for e in batch]).astype(np.int64)
            data = np.frombuffer(b"".join(e[2] for e in batch), np.uint8)
            short = np.minimum(sizes, word_bytes)
            chars, cmask = net.bytes_of(data, np.cumsum(sizes) - sizes, short)
            words, wmask = _grid(np.cumsum(n) - n, n)
            labels = np.array([e[1] for e in batch], np.float32)
            weights = np.where(labels > 0, 1.0, positive / (1 - positive) * 2).astype(np.float32)
            moved = np.concatenate([shift[e[0]][np.frombuffer(e[4], "<i4")] for e in batch])
            held = model["in"]["own"]
            local = held[rows].copy()
            local[:, 0] += moved
            model["in"]["own"] = local
            _, g = net.gradients(model, chars, cmask, np.arange(len(rows)), words, wmask, labels, weights)
            model["in"]["own"] = held
            g["in"]["own"] = (rows, np.concatenate((np.zeros((len(rows), 1), np.float32), g["in"]["own"][1][:, 1:]), axis=1))
            adam.step(model, g)
    return model


def _calibrated(logits: np.ndarray, labels: np.ndarray, steps: int = 400) -> tuple[float, float]:
    """a, b of the score 1 / (1 + exp(-(a * logit + b)))."""
    if not len(labels) or labels.min() == labels.max():
        return 1.0, 0.0
    mean, spread = logits.mean(), logits.std() + 1e-6
    x, a, b = (logits - mean) / spread, 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(a * x + b)))
        d = p - labels
        w = p * (1 - p) + 1e-3
        h = np.array([[np.mean(w * x * x) + 1e-3, np.mean(w * x)], [np.mean(w * x), np.mean(w) + 1e-3]])
        step = np.linalg.solve(h, [np.mean(d * x) + 1e-3 * (a - 1), np.mean(d)])
        a, b = a - 0.5 * step[0], b - 0.5 * step[1]
    a = max(a, 0.05)
    return a / spread, b - a * mean / spread


def fit(docs: DataFrame, labels: DataFrame, learn: Column, *, most: int = LEARN, sample: int = SAMPLE, calibration: int = CALIBRATION, word_bytes: int = WORD_BYTES) -> tuple[dict, float, float]:
    """The network and its calibration, from at most ``most`` labelled documents, drawn by a hash of their doc_ids.

    learn: condition on doc_id. sample, calibration: how many of them, at most, the network and the calibration are fitted
    on. word_bytes: bytes from a word's start that the network learns from.
    """
    spark = docs.sparkSession
    marks = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).where(learn)
    marks = marks.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    marks = marks.orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(most)
    marks = marks.withColumn("place", F.row_number().over(Window.orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id")))
    # at most ``most`` ids and numbers are broadcast, so no text is shuffled
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(marks), "doc_id")
    rows = written(rows.withColumn("half", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int")), "learned")
    words = rows.select("text", "toxic", "half").mapInArrow(_document_words, "row long, n00 long, n01 long, n10 long, n11 long")
    counts = np.zeros((2, 2, net.ROWS))
    for r in words.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n00", "n01", "n10", "n11")]).toLocalIterator():
        counts[:, :, r["row"]] = [[r["n00"], r["n01"]], [r["n10"], r["n11"]]]
    sizes = rows.groupBy("half", "toxic").agg(F.count("*").alias("n"), F.max("place").alias("last")).collect()
    n_docs = {(r["half"], r["toxic"]): r["n"] for r in sizes}
    n = np.array([[n_docs.get((h, t), 0) for t in (0, 1)] for h in (0, 1)], float)
    share = lambda x: min(max(x[1] / max(x.sum(), 1), 0.01), 0.9)
    halves = [log_odds(counts[h, 0], counts[h, 1], share(n[h])) for h in (0, 1)]
    own = log_odds(counts[:, 0].sum(axis=0), counts[:, 1].sum(axis=0), share(n.sum(axis=0)))

    tables = spark.sparkContext.broadcast(halves)
    drawn = rows.where(F.col("place") <= sample).select("text", "toxic", "half")
    examples = [tuple(r) for r in drawn.mapInArrow(_examples(tables), "half int, toxic int, raw binary, sizes binary, rows binary").collect()]
    model = _fit(sorted(examples), own, halves, word_bytes)
    shared = spark.sparkContext.broadcast(model)
    last = max((r["last"] for r in sizes), default=0)
    some = rows.where(F.col("place") > last - calibration).select("toxic", "text").repartition(8)
    seen = some.mapInArrow(_highest(shared), "toxic int, logit double").where("logit > double('-Infinity')").toPandas()
    return (model, *_calibrated(seen["logit"].to_numpy(), seen["toxic"].to_numpy().astype(float)))


def _highest(model):
    def run(batches):
        scorer = Scorer(model.value)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(scorer.highest(batch.column("text")))], ["toxic", "logit"])

    return run


def toxicity_scores(docs: DataFrame, labels: DataFrame, held_out: Column, **bounds: int) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted, one row per input row.

    held_out: condition on doc_id. Rows for which it is not true teach, if they are labelled 0 or 1; of several labels of a document the highest
    counts. A null or empty text has score 0. Repeated rows get equal scores; null doc_ids are scored and never learned
    from. Without labels of both kinds scores carry no meaning but are there. Columns besides doc_id and text are left out.
    bounds: the arguments of ``fit`` that limit what is learned from.
    """
    learn = ~F.coalesce(held_out, F.lit(False))
    model, a, b = fit(docs, labels, learn, **bounds)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        scorer = Scorer(shared.value)
        for batch in slices(batches):
            x = a * scorer.highest(batch.column("text")) + b
            p = 1 / (1 + np.exp(-np.clip(x, -30, 30)))
            p[np.isneginf(x)] = 0.0
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
