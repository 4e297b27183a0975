import re
from collections import Counter

import numpy as np
import pytest

from trackloom.llm import jaccard
from trackloom.llm.components import components, forest


def shingles(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())


def brute(rows, percent=75):
    sets = {i: shingles(t) for i, t in rows}
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
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("percent", [75, 50])
def test_agrees_with_brute_force(odd_docs, percent):
    want = brute([(r.doc_id, r.text) for r in odd_docs.collect()], percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(odd_docs, percent).collect()}
    assert got == want
    assert max(Counter(c for _, c in want.values()).values()) > 5


def test_chains_and_doubtful_pairs(spark):
    """A sliding text: neighbours are linked, ends are not, and no document is like the first."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[8 * i : 8 * i + 100])) for i in range(30)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_a_group_of_near_copies_makes_few_pairs(spark, monkeypatch):
    """Copies that are like each other but not like the smallest ones: pairs grow with the documents, not with their square."""
    words = [f"w{i}" for i in range(100)]

    def edited(doc, places):
        return " ".join(f"x{doc}" if i in places else w for i, w in enumerate(words))

    rows = [(i, edited(i, (10 + 8 * i, 14 + 8 * ((i + 5) % 10)))) for i in range(10)]
    rows += [(i, edited(i, (10 + i % 80,))) for i in range(10, 130)]
    made, links = [], jaccard._links

    def counted(pairs, sets, percent):
        made.append(pairs.count())
        return links(pairs, sets, percent)

    monkeypatch.setattr(jaccard, "_links", counted)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)
    assert max(Counter(c for _, c in got.values()).values()) >= 120
    assert sum(made) < 12 * len(rows)


def test_bounds_lose_no_pair():
    r = np.random.default_rng(0)
    for _ in range(300):
        universe = r.permutation(60)
        a, b = (np.sort(universe[: r.integers(5, 40)]) for _ in range(2))
        b = np.union1d(np.setdiff1d(b, r.choice(b, 2)), r.integers(0, 60, 2))
        shared = np.intersect1d(a, b)
        if len(shared) and 100 * len(shared) >= 75 * len(np.union1d(a, b)):
            i, j = np.searchsorted(a, shared[0]), np.searchsorted(b, shared[0])
            assert jaccard.may_reach(np.array([len(a)]), np.array([i]), len(b), j)[0]
            assert i < jaccard.prefix_size(np.array([len(a)]))[0] and j < jaccard.prefix_size(np.array([len(b)]))[0]


def test_parities_lose_no_pair():
    r = np.random.default_rng(2)
    dropped = 0
    for _ in range(400):
        a = np.unique(r.integers(0, 2**63, r.integers(5, 300), dtype=np.int64)).astype(np.uint64)
        b = np.union1d(r.choice(a, max(1, int(len(a) * r.uniform(0.5, 1))), replace=False), r.integers(0, 2**63, r.integers(1, 30), dtype=np.int64).astype(np.uint64))
        bits = jaccard.parities(np.repeat([0, 1], [len(a), len(b)]), np.concatenate((a, b)), 2)
        ok = jaccard.may_share(np.array([len(a)]), len(b), np.bitwise_count(bits[0] ^ bits[1]).sum(keepdims=True).astype(np.int64))[0]
        linked = 100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b))
        assert ok or not linked
        dropped += not ok
    assert dropped > 100


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (201, 202), (300, 300)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in [*range(1, 41), 100]} | {0: 0} | {i: 200 for i in (200, 201, 202)} or got == {i: 0 for i in [*range(1, 41), 100]} | {201: 200, 202: 200}
    node, least = forest(np.array([5, 6, 9]), np.array([6, 7, 8]))
    assert dict(zip(node.tolist(), least.tolist(), strict=True)) == {6: 5, 7: 5, 9: 8}


def test_odd_tables(no_docs, clashing):
    assert jaccard.jaccard_components(no_docs).count() == 0
    rows = jaccard.jaccard_components(clashing).collect()
    assert len(rows) == 6
    # rows without an id are one node, which comes before all others and links with its equals
    assert all(r.component_id is None for r in rows if r.n_shingles == 4)
