import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.test_jaccard import shingles
from trackloom.llm import sketches


def brute(rows, percent=85):
    sets = {i: shingles(t, 3) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i), i == find(i)) for i, s in sets.items()}


def found(docs, percent=85):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in sketches.near_duplicates(docs, percent).collect()}


@pytest.mark.parametrize("percent", [85, 70])
def test_agrees_with_brute_force(odd_docs, percent):
    want = brute([(r.doc_id, r.text) for r in odd_docs.collect()], percent)
    assert found(odd_docs, percent) == want
    assert max(Counter(c for _, c, _ in want.values()).values()) > 5


def test_near_the_threshold(spark):
    """Groups whose members lie on both sides of it, so that first and last of a list link with a part of it only."""
    r = random.Random(4)
    rows = []
    for group in range(6):
        base = [f"g{group}w{r.randint(0, 900)}" for _ in range(120)]
        for _ in range(30):
            copy = list(base)
            for _ in range(r.randint(0, 5)):
                copy[r.randrange(len(copy))] = f"x{r.randint(0, 10**6)}"
            rows.append((len(rows) * 2, " ".join(copy)))
    want = brute(rows)
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == want
    assert len({c for _, c, _ in want.values()}) > 12


def test_chains_and_shared_passages(spark):
    """A sliding text, linked from neighbour to neighbour, and texts that share half of their words but are unlike."""
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join(words[5 * i : 5 * i + 120])) for i in range(40)]
    rows += [(100 + i, passage + " " + " ".join(f"o{i}v{k}" for k in range(60))) for i in range(40)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_sketches_estimate_likeness():
    r = np.random.default_rng(5)
    off = []
    for share in (0.7, 0.8, 0.9, 0.95, 1.0):
        for _ in range(60):
            common = r.integers(0, 2**63, int(400 * share), dtype=np.int64).astype(np.uint64)
            a, b = (np.unique(np.concatenate((common, r.integers(0, 2**63, 400 - len(common), dtype=np.int64).astype(np.uint64)))) for _ in range(2))
            true = len(common) / (800 - len(common))
            got = sketches.samples(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]))
            x, y = sketches.odd_sketches(got)
            differing = int(np.bitwise_count(x ^ y).sum())
            assert differing <= 2 * (got[:, 0] != got[:, 1]).sum()
            off.append(abs(sketches.likeness(differing) - true))
            if true >= 0.85:
                assert differing <= sketches.most_differing(85)
                keys = sketches.band_keys(got)
                assert (keys[0] == keys[1]).any()
    assert np.mean(off) < 0.05


def test_prefixes_lose_no_pair():
    r = np.random.default_rng(0)
    for _ in range(300):
        order = r.permutation(80)
        a = np.sort(order[: r.integers(5, 60)])
        b = np.union1d(np.setdiff1d(a, r.choice(a, r.integers(0, 4))), r.integers(0, 80, r.integers(0, 4)))
        if 100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b)):
            n, m = (sketches.prefix_size(np.array([len(s)]), 85)[0] for s in (a, b))
            assert len(np.intersect1d(a[:n], b[:m]))


def test_odd_tables(no_docs, clashing):
    assert sketches.near_duplicates(no_docs).count() == 0
    got = sketches.near_duplicates(clashing)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept", "class_id", "class_size"]
    rows = got.collect()
    assert len(rows) == 6
    # rows without an id are one node, which comes before all others and links with its equals
    assert all(r.component_id is None and r.kept == (r.doc_id is None) for r in rows if r.n_shingles == 6)
    assert {r.class_size for r in rows if r.n_shingles == 6} == {4}
