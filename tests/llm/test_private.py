import random
import re
import time

from trackloom.llm import private

TEXTS = [
    None, "", "nothing here", "mail bo.x+1@a-b.example.com, and 10.20.30.256 or 10.20.30.25.",
    "card 4111 1111 1111 1111 or 4111-1111-1111-1112", "call +1 (988) 555-2485 now or +12", "a@b a@b.c@d.e 1.2.3.4.5.6.7.8",
    "+44 20 7946 0958 4111111111111111", "4111111111111111 " * 300,
]


def luhn(d):
    t = [int(c) for c in d[::-1]]
    return sum(t[::2]) + sum(sum(divmod(2 * x, 10)) for x in t[1::2])


def brute(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((0, m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if max(int(p) for p in m.group().split(".")) <= 255:
            out.append((1, m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 16 <= len(d) <= 19 and luhn(d) % 10 == 0:
            out.append((2, m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def test_base_spans():
    for t in TEXTS:
        assert private.base_spans(t or "") == brute(t)


def test_base_spans_of_random_signs():
    r = random.Random(3)
    for signs in ("a.@-", "1.2", "1 -+()", "ab@.c1+- ", "0123456789.+@ -x"):
        for _ in range(3000):
            t = "".join(r.choice(signs) for _ in range(r.randint(0, 30)))
            assert private.base_spans(t) == brute(t), t


def test_words_of_a_field_are_those_with_a_digit_or_at():
    r = random.Random(4)
    for _ in range(2000):
        t = "".join(r.choice("a@1 \t\x0b.\xa0") for _ in range(25))
        assert [m.span() for m in private._WORD.finditer(t)] == [
            m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", t) if re.search("[0-9@]", m.group())
        ]


def test_labels_of_words_with_many_spans():
    """A word's label is the first span that it touches, whatever lies between."""
    long_number = "+1" + "(" * 40 + "555" + ")" * 40 + "1234567"
    text = ";".join(f"a{i}@b.cd" for i in range(30)) + " " + long_number + " 1.2.3.4 " + "4111111111111111-" * 20 + "@x.y"
    field = private.Field([text])
    spans = sorted(private.base_spans(text), key=lambda s: s[1])
    for m, label in zip(private._WORD.finditer(text), field.label.tolist(), strict=True):
        assert label == next((k + 1 for k, a, b in spans if a < m.end() and m.start() < b), 0)


def test_very_long_texts_take_linear_time():
    n = 1_000_000
    for text in ("1" * n, "a" * n + " x@y.zz", "a" * n, "1." * (n // 2), "a@" * (n // 2), "+1" + "(" * n, "@" * n, "1 " * (n // 2)):
        began = time.monotonic()
        private.base_spans(text)
        assert time.monotonic() - began < 5, text[:5]
    began = time.monotonic()
    assert len(private.Field(["1" * n + " " + "a" * n + "@"]).label) == 2
    assert time.monotonic() - began < 5


def test_base_stays_and_counts(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in private.private_spans(docs).collect():
        base = brute(TEXTS[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in range(4)]
        assert set(private.spans_text(base).split(",")) <= set(r.spans.split(",")) or not base


def test_distant_tokens_share_their_label():
    """A number that its shape leaves open follows a sure one far away; without it, it stays clean."""
    counts = [("16d+", 3, 0, 900), ("16d-", 0, 0, 30), ("16d-", 3, 0, 60), ("\tskip", 3, 3, 500), ("\tskip", 0, 0, 500), ("\tchain", 0, 0, 10)]
    model = private.Potentials(counts)
    far = "4111111111111111 " + "word " * 500 + "4111111111111112"
    (base, spans), (_, alone) = private.find([far, "word 4111111111111112 word"], model)
    assert base == [(2, 0, 16)]
    assert (2, len(far) - 16, len(far)) in spans
    assert alone == []


def test_messages_match_enumeration():
    """On a graph without cycles belief propagation gives the exact marginals."""
    import itertools

    import numpy as np

    counts = [("3d", 1, 0, 40), ("3d", 0, 0, 60), ("4d", 2, 0, 30), ("4d", 0, 0, 30), ("\tchain", 1, 1, 50), ("\tchain", 0, 0, 80), ("\tchain", 1, 2, 9)]
    model, field = private.Potentials(counts), private.Field(["123 1234 321"])
    p = private.marginals(field, model)
    own = np.stack([model.shapes[s] for s in field.shape])
    want = np.zeros_like(p)
    for ys in itertools.product(range(5), repeat=3):
        w = np.exp(sum(own[i, y] for i, y in enumerate(ys)) + sum(model.pairs[0][ys[a], ys[b]] for a, b in field.chain))
        for i, y in enumerate(ys):
            want[i, y] += w
    assert np.allclose(p, want / want.sum(axis=1, keepdims=True), atol=1e-3)


def test_masking(spark, no_docs, clashing):
    docs = spark.createDataFrame([(1, "to a@b.cd from +1 (988) 555-2485", 32), (2, "clean", 5), (3, None, None)], "doc_id long, text string, n_chars long")
    rows = {r.doc_id: r for r in private.mask_private(docs).collect()}
    assert rows[1].text == "to <EMAIL> from <PHONE>" and rows[1].n_chars == 23
    assert rows[2].text == "clean" and rows[3].text is None
    assert private.private_spans(no_docs).count() == 0
    assert private.private_spans(clashing).count() == 6
    assert private.mask_private(clashing).columns == clashing.columns
