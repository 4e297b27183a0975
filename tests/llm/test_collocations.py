import random
import re
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from trackloom.llm import collocations

SCHEMA = "doc_id long, text string, lang string"


def brute(rows, least, top):
    counts: dict = {}
    for lang, text in rows:
        low = re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            c = counts.setdefault(lang or "und", Counter())
            for n in range(1, 5):
                c.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, c in counts.items():
        n = sum(f for p, f in c.items() if len(p) == 1)
        often = {p: f for p, f in c.items() if len(p) > 1 and f >= least}
        rows = []
        for p, a in often.items():
            if any(len(q) > len(p) and 100 * f >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, f in often.items()):
                continue
            score, _, left, right = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


@pytest.fixture(scope="module")
def texts():
    """Common words and passages, every separator, letters past ASCII, three languages, one that is null, a long text."""
    r = random.Random(2)
    words = ["The", "of", "größe", "ÉTÉ", "été", "x-y", "tea", "cup", "big", "old", "house", "#", "日本", "a"]
    ends = [" ", " ", " ", " ", "  ", "\t", ". ", ", ", "\n", "; ", ":", "!", "?", "\r\n", "\x0b"]
    passage = "Once upon a time there was"
    rows = []
    for i in range(120):
        text = "".join(r.choice(words) + r.choice(ends) for _ in range(r.randint(0, 60)))
        if i % 3 == 0:
            text += passage + r.choice(["", " a", ". The"])
        rows.append((r.choice(["en", "fr", None, "und"]), text))
    return [*rows, *rows[:5], ("en", None), (None, ""), ("xx", " \t.,"), ("en", "old house tea " * 3000)]


@pytest.mark.parametrize(("least", "top"), [(3, 2000), (8, 7)])
def test_agrees_with_brute_force(spark, texts, least, top):
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(texts)], SCHEMA).repartition(5)
    got = collocations.collocations(docs, least=least, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(texts, least, top)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert len(want) > 10


def test_full_bitmaps_change_nothing(spark, texts, monkeypatch):
    """Bitmaps of 64 bits let everything through, and tasks that send after every slice add up to the same."""
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(texts)], SCHEMA).repartition(2)
    monkeypatch.setattr(collocations, "WORD_BITS", 6)
    monkeypatch.setattr(collocations, "PAIR_BITS", 6)
    assert sorted(tuple(r) for r in collocations.collocations(docs, least=3, top=2000).collect()) == brute(texts, 3, 2000)


def test_stripes_agree_with_each_other(spark, texts):
    """The entry of a phrase in its prefix's stripe is the most that its own stripe's entries add up to."""
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(texts)], SCHEMA)
    words, phrases = collocations.phrase_counts(docs, 1)
    counts = {tuple(x for x in (r.w1, r.w2, r.w3, r.w4) if x): r.f for r in phrases.collect()}
    totals = Counter()
    for p, f in counts.items():
        totals[p[:-1]] += f
    assert counts and all(totals[p] <= f for p, f in counts.items())
    of_word = {r.id: r.f for r in words.collect()}
    assert all(totals[p] <= of_word[p[0]] for p in totals if len(p) == 1)


def test_scores_past_64_bits(spark):
    """2000000 * a needs more than 64 bits; the quotient stays exact."""
    from pyspark.sql import functions as F

    a, left, right = 9_000_000_000_000_000, 9_000_000_000_000_001, 9_100_000_000_000_007
    whole = F.expr("(2000000 * cast(a as decimal(25, 0))) div cast(cast(l as decimal(20, 0)) + r as decimal(25, 0))")
    got = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(whole.alias("s")).first().s
    assert got == 2_000_000 * a // (left + right)


def test_odd_tables(spark, no_docs, clashing):
    assert collocations.collocations(no_docs).count() == 0
    rows = clashing.withColumn("lang", clashing.component_id)
    want = brute([(r.lang, r.text) for r in rows.collect()], 2, 100)
    assert sorted(tuple(r) for r in collocations.collocations(rows, least=2, top=100).collect()) == want
    blank = spark.createDataFrame([(1, "  ", "en"), (2, None, None)], SCHEMA)
    assert collocations.collocations(blank).count() == 0


def test_packed_rows_round_trip():
    r = np.random.default_rng(0)
    columns = [r.integers(1, 5, 200).astype(np.uint64) for _ in range(3)]
    merged, counts = collocations._merge(columns, np.ones(200, np.int64))
    want = Counter(zip(*[c.tolist() for c in columns], strict=True))
    assert dict(zip(zip(*[c.tolist() for c in merged], strict=True), counts.tolist(), strict=True)) == want


def test_memory_of_a_pass_is_that_of_a_small_slice():
    """A worker's arrays don't grow with the batches that it gets."""
    text = " ".join(f"w{i % 5000}" for i in range(1000))
    batch = pa.record_batch([pa.array(["en"] * 3000), pa.array([text] * 3000)], ["lang", "text"])
    bits = SimpleNamespace(value=np.full(8192, 255, np.uint8))
    for work in (collocations._word_counts, collocations._pair_sums(bits, 3), collocations._stripes(bits, bits, 3)):
        for _ in work(iter([batch.slice(0, 10)])):
            pass
        tracemalloc.start()
        for _ in work(iter([batch])):
            pass
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 120_000_000
