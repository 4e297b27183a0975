import re
from collections import defaultdict

from conftest import plan_of
from trackloom.llm import rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = defaultdict(list)
    for i in range(len(words) - 2):
        at[tuple(words[i : i + 3])].append(i)
    covered = {j for p in at.values() if len(p) > 1 for i in p for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    chars, symbols, dup = sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines))
    marks = len(re.findall(r"[!?]{2,}", text))
    failed = n < 50 or 100 * len(covered) > 50 * n
    kept = not (failed or 100 * symbols > 40 * n or 100 * marks > 40 * n or 100 * dup > 50 * len(lines) or chars < 2 * n or chars > 15 * n)
    return n, chars, symbols, dup, len(covered), failed, kept


def test_agrees_with_brute_force(odd_docs):
    texts = {r.doc_id: r.text for r in odd_docs.collect()}
    rows = rules.judge(odd_docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r)[1:] == brute(texts[r.doc_id])


def test_order_changes_no_verdict(odd_docs, clashing):
    want = sorted(i for i, t in ((r.doc_id, r.text) for r in odd_docs.collect()) if brute(t)[-1])
    for order in (list(rules.RULES), list(reversed(rules.RULES)), None):
        kept = rules.keep_clean(odd_docs, order=order)
        assert kept.columns == odd_docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == want


def test_cascade_is_planned_and_native(odd_docs, no_docs):
    order = rules.plan_cascade(odd_docs)
    assert sorted(r.name for r in order) == sorted(r.name for r in rules.RULES)
    assert rules.plan_cascade(no_docs) == list(rules.RULES)
    plan = plan_of(rules.judge(odd_docs, order=order))
    assert not any(x in plan for x in ("EvalPython", "InArrow", "InPandas"))


def test_odd_tables(no_docs, clashing):
    assert rules.judge(no_docs).count() == 0
    assert rules.judge(clashing).count() == 6
    few = (rules.Rule("few_words", ("n_words",), "n_words < 3"),)
    kept = rules.keep_clean(clashing, few)
    assert kept.columns == clashing.columns and kept.count() == 5
    assert sorted(r.n_words for r in kept.collect()) == [2, 4, 6, 8, 8]
