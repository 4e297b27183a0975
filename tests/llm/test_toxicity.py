import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.llm import recurrent as net
from trackloom.llm import toxicity
from trackloom.llm.words import Words


def test_gradients():
    rng = np.random.default_rng(0)
    wide = lambda o: {k: wide(v) if isinstance(v, dict) else v.astype(np.float64) for k, v in o.items()}
    model = wide(net.new_model(1, rng.normal(size=(50, net.OWN)) / 3))
    batch = (rng.integers(97, 110, (5, 7)), (np.arange(5)[:, None] < rng.integers(1, 6, 7)).astype(float), rng.integers(0, 50, 7),
             rng.integers(0, 7, (6, 3)), (np.arange(6)[:, None] < np.array([6, 3, 1])).astype(float), np.array([1, 0, 1.0]), np.array([1, 0.5, 1]))
    _, g = net.gradients(model, *batch)
    for part, grads in g.items():
        for name, d in grads.items():
            if isinstance(d, tuple):
                continue
            a = model[part][name]
            for _ in range(3):
                at = tuple(rng.integers(0, s) for s in a.shape)
                old, step = a[at], 1e-3
                a[at] = old + step
                up = net.gradients(model, *batch)[0]
                a[at] = old - step
                down = net.gradients(model, *batch)[0]
                a[at] = old
                assert abs((up - down) / (2 * step) - d[at]) < 2e-3 * (abs(d[at]) + 0.05), (part, name)


def test_windows_cover_every_word():
    n = np.array([0, 1, 47, 48, 49, 84, 85, 1000])
    first = np.cumsum(n) - n
    doc, start, size = toxicity.windows_of(n, first)
    seen = np.zeros(n.sum(), int)
    for a, s in zip(start, size, strict=True):
        assert 0 < s <= toxicity.WINDOW
        seen[a : a + s] += 1
    assert seen.min() >= 1 and not (doc == 0).any()


def test_batches_do_not_change_scores(odd_texts):
    import pyarrow as pa

    model = net.new_model(3, np.random.default_rng(1).normal(size=(net.ROWS, net.OWN)))
    texts = pa.array(odd_texts)
    whole = toxicity.Scorer(model).highest(texts)
    one = toxicity.Scorer(model)
    parts = np.concatenate([one.highest(texts.slice(i, 3)) for i in range(0, len(texts), 3)])
    assert np.allclose(whole, parts, atol=1e-4)
    assert np.isneginf(whole[[i for i, t in enumerate(odd_texts) if not (t or "").split()]]).all()


@pytest.fixture(scope="module")
def marked(spark):
    r = random.Random(9)
    rows = []
    for i in range(600):
        words = [r.choice("abcdefgh") * r.randint(1, 4) + r.choice("xyz") for _ in range(r.randint(5, 150))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                words.insert(r.randrange(len(words)), r.choice(["vile", "Rotten", "nasty"]))
        rows.append((i, " ".join(words), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_held_out_rows_are_told_apart(marked):
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    rows = toxicity.toxicity_scores(marked.select("doc_id", "text"), marked.select("doc_id", "toxic"), held).collect()
    assert len(rows) == 600
    truth = {r.doc_id: r.toxic for r in marked.collect()}
    out = [r for r in rows if r.held_out]
    right = sum(r.predicted == truth[r.doc_id] for r in out)
    assert len(out) > 100 and right >= 0.95 * len(out)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_bounds_are_arguments(marked):
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    docs, labels = marked.select("doc_id", "text"), marked.select("doc_id", "toxic")
    few = toxicity.toxicity_scores(docs, labels, held, most=0).collect()
    assert len(few) == 600 and len({r.score for r in few}) > 1
    small = toxicity.fit(docs, labels, ~held, most=60, sample=40, calibration=20, word_bytes=2)
    assert small[0]["in"]["own"][:, 0].any() and small[1] > 0


def test_odd_tables(no_docs, clashing, marked):
    labels = marked.select("doc_id", "toxic").limit(0)
    assert toxicity.toxicity_scores(no_docs, labels, F.lit(False)).count() == 0
    rows = toxicity.toxicity_scores(clashing, labels, F.lit(None).cast("boolean")).collect()
    assert len(rows) == 6 and all(r.score == 0 for r in rows if r.doc_id is None and r.score == 0)


def test_words_fold_ascii_only():
    import pyarrow as pa

    w = Words(pa.array(["Vile vile VILE Äx äx", None, "", " vile"]), fold=True)
    assert len(set(w.hashes[[0, 1, 2, 5]].tolist())) == 1 and w.hashes[3] != w.hashes[4]
    assert w.per_doc.tolist() == [5, 0, 0, 1]
