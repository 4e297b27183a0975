import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trackloom.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, anchor, k=5, percent=(80, 100)):
    """Every pair of rows, with Python's whole numbers."""
    sound = [(i, [math.floor(256 * x) for x in v], c) for i, v, c in rows
             if i is not None and c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, v, c) in enumerate(sound):
        if not anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), j, d) for m, (j, w, d) in enumerate(sound) if m != n and len(w) == len(v)]
        for p, j, _ in sorted(x for x in scored if x[2] == c)[:k]:
            fits = sorted(x for x in scored if x[2] != c and percent[0] * -p <= 100 * -x[0] <= percent[1] * -p)
            out += [(i, j, rank, other, -p, -s) for rank, (s, other, _) in enumerate(fits[:k], 1)]
    return sorted(out)


def mined(spark, rows, **more):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = negatives.hard_negatives(frame, F.col("vec_id") % 10 == 0, **more)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


@pytest.fixture(scope="module")
def varied():
    """Lengths from 0 to 40, clusters, copies under several labels, a direction that a third of all rows have."""
    r = np.random.default_rng(3)
    centres = r.normal(size=(6, 12))
    rows = []
    for i in range(600):
        kind = i % 6
        v = centres[kind] * r.uniform(0.2, 4) + r.normal(size=12) * r.choice([0.05, 1.0])
        if i % 3 == 0:
            v = centres[0] * 2
        if i % 50 == 0:
            v = v * 0
        rows.append((i, [float(x) for x in np.float32(v)], int(r.integers(0, 4))))
    return rows


def test_agrees_with_brute_force(spark, varied):
    got = mined(spark, varied)
    assert got == brute(varied, lambda i: i % 10 == 0)
    assert len(got) > 500


@pytest.mark.parametrize("percent", [(95, 100), (50, 120)])
def test_other_ranges_and_counts(spark, varied, percent):
    assert mined(spark, varied[:200], percent=percent, positives=3, negatives=3) == brute(varied[:200], lambda i: i % 10 == 0, 3, percent)


def test_small_buckets_and_many_packs(spark, varied, monkeypatch):
    """Many blocks and packs give the same rows."""
    monkeypatch.setattr(negatives, "BLOCK", 12 * 64)
    monkeypatch.setattr(negatives, "BUCKET", 16)
    monkeypatch.setattr(negatives, "PACK", 1)
    rows = [(i + 1000 * k, v, c) for k in range(2) for i, v, c in varied]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_coordinate_ranges_lose_no_row():
    r = np.random.default_rng(1)
    x = np.floor(256 * (r.normal(size=(500, 8)) * r.uniform(0.8, 1, size=(500, 1)) + np.array([3, 0, 0, 0, -2, 0, 0, 1])))
    lengths = np.sqrt((x * x).sum(axis=1))
    table = pa.table({"serial": np.arange(500), "id": np.arange(500), "label": np.zeros(500, np.int64), "length": lengths, "vector": pa.array(x.tolist())})
    pruned = 0
    for bucket in negatives.buckets(negatives.Rows(table)):
        for q in x[::50]:
            norm = float(np.sqrt(q @ q))
            scores = bucket.x @ q
            for share in (0.2, 0.6, 0.9, 0.99, 1.0):
                bound = share * norm * bucket.longest
                found = bucket.candidates(q / norm, share)
                if found is not None:
                    pruned += len(scores) - len(found)
                    assert set(np.flatnonzero(scores >= bound)) <= set(found.tolist())
    assert pruned > 1000


def test_odd_rows(spark):
    """Nulls, not-a-numbers, repeated rows and ids, ties, other dimensions, numbers past 53 bits, negative ids."""
    a, b = [1.0, 0.5], [0.5, 1.0]
    rows = [(0, a, 1), (0, a, 1), (10, a, 2), (1, a, 1), (1, a, 1), (2, b, 2), (2, b, 2), (3, a, None), (None, a, 1), (4, None, 2),
            (5, [1.0, None], 2), (6, [1.0, float("nan")], 2), (7, [float("inf"), 0.0], 2), (8, [1.0], 2), (20, [1.0], 1), (9, [-1.0, -1.0], 2),
            (30, [], 1), (31, [], 2), (-10, b, 1), (40, [0.0, 0.0], 3), (41, [0.0, 0.0], 3), (50, [9e6, 1.0], 4), (51, [9e6, 2.0], 4), (52, [8.9e6, 3.0], 5), (53, [3e38, 0.0], 5)]
    sound = [r for r in rows if r[0] != 53]  # too long for a score of 64 bits
    assert mined(spark, rows) == brute(sound, lambda i: i % 10 == 0)
    assert mined(spark, []) == []
    clashing = spark.createDataFrame([(0, a, 1, 5, "x"), (1, a, 1, 6, None), (2, a, 2, None, "y")], SCHEMA + ", serial int, block string")
    assert [tuple(r) for r in negatives.hard_negatives(clashing, F.col("vec_id") % 10 == 0).collect()] == [(0, 1, 1, 2, 81920, 81920)]
