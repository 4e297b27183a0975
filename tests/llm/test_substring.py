import hashlib
import re

from trackloom.llm import substring


def brute(rows, window=20):
    """rows of (doc_id, text), ordered: words removed by document."""
    seen, out = set(), {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            w = tuple(words[s : s + window])
            if w in seen:
                gone[s : s + window] = [True] * window
            seen.add(w)
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[i] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def test_agrees_with_brute_force(odd_docs):
    want = brute(odd_docs.select("doc_id", "text").orderBy("doc_id").collect())
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.dedup_digests(odd_docs).collect()}
    assert got == want
    assert any(n for _, n, _ in want.values())


def test_small_windows(odd_docs):
    want = brute(odd_docs.select("doc_id", "text").orderBy("doc_id").collect(), 3)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.dedup_digests(odd_docs, 3).collect()}
    assert got == want


def test_factors_go_on_in_their_source():
    # two pieces of the same source that touch are one factor; another source starts a new one
    assert substring.parse([(0, 5, 9, 100), (5, 3, 9, 105), (8, 1, 4, 0)], 60, 20) == [(0, 27, 9, 100), (8, 20, 4, 0)]


def test_texts_keep_what_is_not_repeated(odd_docs):
    before = {r.doc_id: r for r in odd_docs.collect()}
    after = {r.doc_id: r for r in substring.remove_repeats(odd_docs).collect()}
    want = brute(odd_docs.select("doc_id", "text").orderBy("doc_id").collect())
    assert before.keys() == after.keys()
    for i, r in after.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        assert hashlib.sha256(" ".join(words).encode()).hexdigest() == want[i][2]
        if not want[i][1]:
            assert r.text == before[i].text
        assert r.lang == "en" and r.n_chars == (len(r.text) if r.text is not None else None)


def test_odd_tables(no_docs, clashing):
    assert substring.dedup_digests(no_docs).count() == 0
    got = substring.dedup_digests(clashing, 3).collect()
    assert len(got) == 6
    # the null id comes first; the two equal rows are one document
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (0, 0), (1, 8), (1, 8), (2, 0), (2, 8)]
    assert substring.remove_repeats(clashing, 3).columns == clashing.columns
