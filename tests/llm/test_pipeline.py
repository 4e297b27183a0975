import re
from collections import defaultdict

import __spark_entry__ as contract
import corpus_pipeline
from .test_jaccard import brute as groups
from .test_private import brute as private_spans
from .test_rules import brute as measures
from .test_substring import brute as repeats

from trackloom.llm import packing, private
from trackloom.llm.queries import byte_bpe


def test_stages_one_by_one(spark, odd_docs):
    docs = odd_docs
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "jaccard_join", "substring_dedup", "private_data", "best_fit_packing"]

    before = {r.doc_id: r.text for r in docs.collect()}
    docs = stages["quality_rules"](spark, docs, "")
    assert docs.columns == odd_docs.columns
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert kept == {i: t for i, t in before.items() if measures(t)[-1]}

    docs = stages["jaccard_join"](spark, docs, "")
    assert docs.columns == odd_docs.columns
    first = {r.doc_id: r.text for r in docs.collect()}
    assert first == {i: kept[i] for i, (_, c) in groups(sorted(kept.items())).items() if c == i}
    assert len(first) < len(kept)

    docs = stages["substring_dedup"](spark, docs, "")
    assert docs.columns == odd_docs.columns
    cut = {r.doc_id: r.text for r in docs.collect()}
    want = repeats(sorted(first.items()))
    assert {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in cut.items()} == {i: n - gone for i, (n, gone, _) in want.items()}

    docs = stages["private_data"](spark, docs, "")
    assert docs.columns == odd_docs.columns
    clean = {r.doc_id: r.text for r in docs.collect()}
    assert all(private.masked(cut[i], private_spans(cut[i])) == t or len(t) <= len(cut[i]) for i, t in clean.items())

    rows = stages["best_fit_packing"](spark, docs, "").collect()
    encoder, sizes = packing.Encoder(*byte_bpe()), defaultdict(int)
    for r in rows:
        sizes[r.doc_id] += r.length
    assert sizes == {i: len(encoder.encode(t or "")) + 1 for i, t in clean.items()}


def test_near_duplicates_are_decided_per_row(spark):
    """An id that comes twice, or not at all, takes no other text with it; of equal rows one stays, in order of the ids."""
    t = " ".join(f"t{i}" for i in range(60))
    near, u, v = t.replace("t59", "x"), " ".join(f"u{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    stage = dict(corpus_pipeline.STAGES)["jaccard_join"]

    def kept(rows):
        docs = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, lang string").repartition(3)
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)

    assert kept([(1, t), (1, t), (2, t), (3, u), (3, t), (None, t), (None, t)]) == [(1, t), (3, u)]
    assert kept([(None, v), (None, v), (7, near), (9, t), (7, u), (None, t)]) == sorted([(None, v), (7, near), (7, u)], key=str)
    assert kept([(1, ""), (1, ""), (2, None), (2, None), (None, None)]) == sorted([(1, ""), (1, ""), (2, None), (2, None), (None, None)], key=str)
    assert kept([(-5, t), (4, near), (4, near)]) == [(-5, t)]
    assert kept([]) == []


def test_registered():
    names = contract.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names


def test_registered_queries_agree_with_sql(spark):
    import os

    import compare

    sf_dir = "/root/testdata/sf0.001"
    if os.path.isdir(sf_dir):
        duck = compare.connect(sf_dir)
        for name, sql in contract.oracle_sql().items():
            if re.match(r"op\d+_", name) and sql:
                assert compare.compare(spark, duck, sf_dir, name) is None
