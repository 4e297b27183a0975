import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from trackloom.llm import mixing


def fold():
    return F.crc32(F.col("doc_id").cast("string")) % 7 == 2


def tokens(text):
    folded = re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", folded) + [None]


def test_counts_and_base(odd_docs):
    docs = {r.doc_id: tokens(r.text) for r in odd_docs.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    counts = Counter(w for i, ws in docs.items() if not held[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    rows = mixing.lm_scores(odd_docs, fold()).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ws = docs[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(ws), sum(counts[w] > 0 for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        assert r.score < 0 and math.isfinite(r.score)
    # near copies and common passages make held-out texts likelier than the base thinks
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_classes_get_all_of_the_probability():
    counts = np.random.default_rng(1).integers(0, 50, mixing.CLASSES) + 0.3
    coder = mixing.Coder(counts)
    # Kraft: the paths make a full tree
    assert math.isclose(float((0.5 ** coder.length.astype(float)).sum()), 1.0)
    codes = np.array([5, 70, 5, 9], "<u2")
    bits, slots, ends = coder.slots(codes, np.array([0, 3, 4]))
    assert ends[-1] == len(bits) == slots.shape[1] == coder.length[codes].sum()
    for i in range(4):
        assert slots[i].min() >= mixing._OFFSETS[i] and slots[i].max() < mixing._OFFSETS[i + 1]


def test_mixing_matches_one_bit_at_a_time():
    rng = np.random.default_rng(3)
    sizes = np.array([40, 7, 25])
    n = int(sizes.sum())
    bits = rng.integers(0, 2, n).astype(np.float32)
    odds = rng.normal(size=(4, n)).astype(np.float32)
    first = np.cumsum(sizes) - sizes
    order, live = mixing.side_by_side(first, sizes)
    assert sorted(order.tolist()) == list(range(n)) and live.tolist() == [3] * 7 + [2] * 18 + [1] * 15
    got = np.empty(n)
    got[order] = mixing.mix(bits[order], odds[:, order], live)
    for lane in range(3):
        weights = np.ones(4)
        fix = 1 / (1 + np.exp(-((np.arange(mixing._BINS) + 0.5) / mixing._BINS * 24 - 12)))
        for t in range(first[lane], first[lane] + sizes[lane]):
            dot = float(np.clip(odds[:, t] @ weights, -11.5, 11.5))
            p, cell = 1 / (1 + math.exp(-dot)), int((dot + 12) * mixing._BINS / 24)
            final = 0.75 * p + 0.25 * fix[cell]
            assert math.isclose(got[t], final if bits[t] else 1 - final, rel_tol=1e-3, abs_tol=1e-4)
            weights += mixing.RATE * (bits[t] - p) * odds[:, t]
            fix[cell] += mixing.CORRECTION_RATE * (bits[t] - fix[cell])


def test_gates_learn():
    """A gate's weights adapt with its own bits: a context that always lies in one gate is believed less there, not elsewhere."""
    bits = np.array([1, 1] * 100, np.float32)
    gate = np.array([0, 8] * 100)
    odds = np.zeros((4, 200), np.float32)
    odds[3] = np.where(gate == 0, -2, 2)
    got = mixing.mix(bits, odds, np.ones(200, np.int64), gate)
    weights = mixing._FIRST.astype(float).copy()
    fix = 1 / (1 + np.exp(-((np.arange(mixing._BINS) + 0.5) / mixing._BINS * 24 - 12)))
    for t in range(200):
        dot = float(odds[:, t] @ weights[gate[t]])
        p, cell = 1 / (1 + math.exp(-dot)), int((dot + 12) * mixing._BINS / 24)
        assert math.isclose(got[t], 0.75 * p + 0.25 * fix[cell], rel_tol=1e-3, abs_tol=1e-4)
        weights[gate[t]] += mixing.RATE * (1 - p) * odds[:, t]
        fix[cell] += mixing.CORRECTION_RATE * (1 - fix[cell])
    assert got[198] > 0.5 and weights[0, 3] < 0 < weights[8, 3]


def test_every_context_keeps_its_own_counts():
    """More bits of contexts than any table of fixed size had slots for, and none shares its counts with another."""
    rng = np.random.default_rng(4)
    codes = rng.zipf(1.2, 60_000) % 3000
    first = np.arange(0, len(codes) + 1, 300)
    coder = mixing.Coder(np.bincount(codes, minlength=mixing.CLASSES) + 0.3)
    train = np.repeat(np.arange(len(first) - 1) % 4 > 0, 300)
    bits, slots, _ = coder.slots(codes, first)
    keys, at = np.unique(coder.pairs(codes, codes, first).ravel(), return_inverse=True)
    some, much, odds = mixing.answers(coder, keys, np.bincount(at, weights=np.tile(train, 3)))
    begin = np.cumsum(some, dtype=np.int64) - some
    _, step, ends = coder.paths(codes)
    learned = np.repeat(train, coder.length[codes])
    for i in range(3):
        _, slot = np.unique(slots[i + 1], return_inverse=True)
        ones = np.bincount(slot, weights=learned * bits)[slot]
        seen = np.bincount(slot, weights=learned)[slot]
        taken = np.where(bits > 0, ones, seen - ones)
        pair = np.repeat(at.reshape(3, -1)[i], coder.length[codes])
        has = step < some[pair]
        assert (has == (seen > 0)).all() and ((step < much[pair]) == (seen >= mixing.MUCH)).all()
        want = np.log((taken[has] + 0.4) / (seen[has] - taken[has] + 0.4))
        assert np.allclose(odds[begin[pair[has]] + step[has]].astype(float), want, rtol=2e-3, atol=2e-3)


def test_the_last_words_are_words_not_classes():
    words = np.array([7, (mixing.RARE << 16) + 7, 9, 7], "<u4")
    codes = mixing.classes_of(words)
    assert codes[0] == codes[1]
    last = mixing.Coder(np.ones(mixing.CLASSES)).contexts(words, codes, np.array([0, 4]))[1]
    assert len(set(last.tolist())) == 4


def test_log_odds_that_paths_share_are_sent_once():
    """Of a context with many classes less than half of the log-odds are sent, and all come back as they were."""
    rng = np.random.default_rng(5)
    coder = mixing.Coder(rng.integers(0, 50, mixing.CLASSES) + 0.3)
    leaves = [np.sort(rng.choice(mixing.CLASSES, n, replace=False)) for n in (5000, 1, 300, 2, 1)]
    keys = np.concatenate([(np.uint64(i + 3) << np.uint64(mixing.CLASS_BITS)) | x.astype(np.uint64) for i, x in enumerate(leaves)])
    some, _, odds = mixing.answers(coder, keys, rng.integers(0, 3, len(keys)))
    some = some.astype(np.int64)
    shared = coder.shared(keys, some)
    assert shared[np.cumsum([0, *map(len, leaves[:-1])])].sum() == 0
    begin = np.cumsum(some) - some
    sent = odds[mixing._places(begin + shared, some - shared)]
    assert len(sent) < 0.5 * len(odds)
    assert mixing.completed(sent, some, shared).tobytes() == odds.tobytes()
    nothing = np.zeros(0, np.int64)
    assert len(mixing.completed(odds[:0], nothing, coder.shared(keys[:0], nothing))) == 0


def test_blocks_ask_and_are_answered_in_few_bytes():
    """Answers hold counts of turns not taken, less than half of what the log-odds took; all log-odds come back as they were."""
    rng = np.random.default_rng(6)
    coder = mixing.Coder(rng.integers(0, 50, mixing.CLASSES) + 0.3)
    members = np.concatenate([[5000, 1, 300], rng.integers(1, 6, 8000)])
    leaves = [np.sort(rng.choice(mixing.CLASSES, n, replace=False)) for n in members]
    keys = np.concatenate([(np.uint64(i * 40_000 + 3) << np.uint64(mixing.CLASS_BITS)) | x.astype(np.uint64) for i, x in enumerate(leaves)])
    counts = rng.zipf(1.5, len(keys)).clip(0, 100_000) - 1
    some, much, odds = mixing.answers(coder, keys, counts)
    whole = mixing.evidence(coder, keys, counts)
    assert (whole[0] == some).all()
    begin = np.cumsum(some, dtype=np.int64) - some
    # a block that has some of the pairs, and some of their counts
    has = np.flatnonzero(rng.random(len(keys)) < 0.7)
    own = counts[has] // 3
    pairs, asked = mixing.unpacked_pairs(coder, mixing.packed_pairs(coder, keys[has], own))
    assert (pairs == keys[has]).all() and (asked == own).all()
    cuts = np.array([0, 0, np.searchsorted(pairs, keys[5301]), len(pairs), len(pairs)])
    messages, before = [], 0
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        mine = has[a:b]
        evident = some[mine].astype(np.int64)
        messages.append(mixing.packed_answer(coder, pairs[a:b], own[a:b], evident, whole[1][mine], whole[2], begin[mine]))
        shared = coder.shared(pairs[a:b], evident)
        values = odds[mixing._places(begin[mine] + shared, evident - shared)]
        before += len(mixing._packed([some[mine].tobytes(), much[mine].tobytes(), mixing._plane(values)]))
    got = mixing.unpacked_answers(coder, pairs, own, cuts, messages)
    assert (got[0] == some[has]).all() and (got[1] == much[has]).all()
    assert got[2][:-1].tobytes() == odds[mixing._places(begin[has], some[has].astype(np.int64))].tobytes() and got[2][-1] == 0
    assert sum(map(len, messages)) < 0.5 * before


def test_odd_tables(no_docs, clashing):
    assert mixing.lm_scores(no_docs, fold()).count() == 0
    rows = mixing.lm_scores(clashing, fold()).collect()
    assert len(rows) == 6
    assert {r.n_tokens for r in rows if r.doc_id is None} == {9, 1}
