import hashlib
from collections import Counter

from pyspark.sql import functions as F

from conftest import plan_of
from trackloom.llm import fingerprints


def test_edited_texts(odd_docs):
    rows = sorted((r.doc_id, r.text or "") for r in odd_docs.collect())
    got = {r.doc_id: r for r in fingerprints.edited_pairs(odd_docs).collect()}
    assert len(got) == len(rows)
    by_text = {}
    for i, (doc_id, text) in enumerate(rows):
        after, half = rows[(i + 1) % len(rows)][1], len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        by_text.setdefault(text, set()).add(r.fingerprint)
        assert 0 <= r.near_edited <= 1
        if after == text:
            assert r.near_next == 1
    assert all(len(f) == 1 for f in by_text.values())


def test_rows_far_apart_follow_each_other(spark):
    ids = [-5, 3, 255, 256, 70_000, 10**9, 10**12]
    docs = spark.createDataFrame([(i, f"{i:013d}"[-13:] * 2) for i in ids], "doc_id long, text string")
    got = {r.doc_id: r.edited_sha256 for r in fingerprints.edited_pairs(docs).collect()}
    for i, after in zip(ids, ids[1:] + ids[:1], strict=True):
        t, a = (f"{x:013d}"[-13:] * 2 for x in (i, after))
        assert got[i] == hashlib.sha256((t[: len(t) - len(t) // 2] + a[: len(t) // 2]).encode()).hexdigest()


def test_collisions_follow_generalised_jaccard(spark):
    """Over many pairs the share of equal samples is the Jaccard similarity of the weighted terms."""
    pairs = []
    for k in range(60):
        w = [f"w{k}x{i}" for i in range(40)]
        pairs.append((" ".join(w + w[:20]), " ".join(w[10:] + [f"v{k}x{i}" for i in range(10)])))
    rows = [(2 * k + e, t) for k, p in enumerate(pairs) for e, t in enumerate(p)]
    ids = {r.doc_id: r.ids for r in fingerprints.signatures(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()}
    bag = lambda t: Counter(zip(t.split(), t.split()[1:]))
    same = sum(a == b for k in range(60) for a, b in zip(ids[2 * k], ids[2 * k + 1], strict=True)) / (60 * fingerprints.SAMPLES)
    a, b = (bag(t) for t in pairs[0])
    want = sum((a & b).values()) / sum((a | b).values())
    assert abs(same - want) < 0.06


def test_single_pairs_are_near_generalised_jaccard(spark):
    """Every single pair, whatever its likeness, lies near the exact value."""
    pairs = []
    for k in range(80):
        w = [f"w{k}x{i}" for i in range(60)]
        cut = k % 40
        pairs.append((" ".join(w + w[:20]), " ".join(w[cut:] + w[cut : cut + 10] + [f"v{k}x{i}" for i in range(cut)])))
    rows = [(2 * k + e, t) for k, p in enumerate(pairs) for e, t in enumerate(p)]
    ids = {r.doc_id: r.ids for r in fingerprints.signatures(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()}
    bag = lambda t: Counter(zip(t.split(), t.split()[1:]))
    off = []
    for k, pair in enumerate(pairs):
        a, b = (bag(t) for t in pair)
        same = sum(x == y for x, y in zip(ids[2 * k], ids[2 * k + 1], strict=True)) / fingerprints.SAMPLES
        off.append(same - sum((a & b).values()) / sum((a | b).values()))
    # the bounds in the module's docstring
    assert max(map(abs, off)) < 0.2
    assert (sum(x * x for x in off) / len(off)) ** 0.5 < 0.07


def test_groups_of_samples_change_nothing(spark, odd_docs, monkeypatch):
    """Each sample is the least over the terms, whichever samples share a row."""
    texts = odd_docs.select("doc_id", "text")
    grouped = {r.doc_id: r.ids for r in fingerprints.signatures(texts, ["doc_id"]).collect()}
    monkeypatch.setattr(fingerprints, "GROUP", 1)
    assert grouped == {r.doc_id: r.ids for r in fingerprints.signatures(texts, ["doc_id"]).collect()}
    assert grouped and all(len(ids) == fingerprints.SAMPLES for ids in grouped.values())


def test_few_samples_are_drawn_in_full(spark):
    """Of a text of 400 terms most samples can't win; that is told from their hashes, and changes none of the marks."""
    words = [f"w{i * 7919 % 400}" for i in range(401)]
    texts = spark.createDataFrame([(1, " ".join(words)), (2, "of the " * 200), (3, "a b"), (4, "one"), (5, "")], "doc_id long, text string")
    bag = fingerprints.bags(texts.where("doc_id = 1"), ["doc_id"])
    drawn = bag.select(*[F.count(fingerprints.drawn(j)).alias(f"n{j}") for j in range(fingerprints.GROUP)]).first()
    assert 0 < sum(drawn) < 0.4 * bag.count() * fingerprints.GROUP
    whole = {r.doc_id: r.ids for r in fingerprints.signatures(texts, ["doc_id"]).collect()}
    assert sorted(whole) == [1, 2, 3, 4] and not any(x is None for ids in whole.values() for x in ids)
    assert whole == {r.doc_id: r.ids for r in fingerprints.signatures(texts, ["doc_id"], fingerprints.LIMIT).collect()}


def test_texts_above_the_limit_are_drawn_anew(spark, odd_docs, monkeypatch):
    rows = sorted(fingerprints.edited_pairs(odd_docs).collect(), key=str)
    monkeypatch.setattr(fingerprints, "LIMIT", 0.5)
    few = fingerprints.signatures(odd_docs.select("doc_id", "text"), ["doc_id"], 0.5)
    assert few.where(F.exists("ids", F.isnull)).count() > 0
    assert sorted(fingerprints.edited_pairs(odd_docs).collect(), key=str) == rows


def test_plan_is_native(odd_docs):
    plan = plan_of(fingerprints.with_next(fingerprints.in_order(odd_docs), "text", ["key", "text"]))
    assert not any(x in plan for x in ("EvalPython", "InArrow", "InPandas"))


def test_odd_tables(no_docs, clashing):
    assert fingerprints.edited_pairs(no_docs).count() == 0
    rows = fingerprints.edited_pairs(clashing).collect()
    assert len(rows) == 6
    assert fingerprints.edited_pairs(clashing.where(F.col("doc_id") == 2).limit(1)).first().near_next == 1
