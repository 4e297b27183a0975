import random

import public_tokenizers
import pytest

from trackloom.llm import unigram

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def encoder():
    return unigram.Encoder(PATH)


def brute(v, text):
    """Best score over all segmentations, character by character."""
    ids = {v.text[i].decode(): i for i in range(len(v.text)) if v.text[i] and not v.is_byte[i]}
    text = " " + text.replace("▁", " ") if text else ""
    best = [0.0] + [float("-inf")] * len(text)
    for i in range(len(text)):
        for j in range(i + 1, min(len(text), i + v.longest) + 1):
            if text[i:j] in ids:
                best[j] = max(best[j], best[i] + v.score[ids[text[i:j]]])
        if text[i] not in ids:
            best[i + 1] = max(best[i + 1], best[i] + v.unknown)
    return best[-1]


def test_agrees_with_brute_force(encoder):
    r = random.Random(1)
    signs = list("abcdeé  \n中the in and 😀▁ßqz.,12")
    texts = ["", None] + ["".join(r.choice(signs) for _ in range(r.randint(0, 30))) for _ in range(400)]
    for text, (ids, score) in zip(texts, encoder.encode(texts), strict=True):
        assert abs(score - brute(encoder.vocabulary, text or "")) < 1e-9
        assert encoder.vocabulary.decode(ids) == (text or "").replace("▁", " ")


def test_trie_finds_every_piece(encoder):
    import numpy as np

    v = encoder.vocabulary
    for i in range(0, len(v.text), 97):
        if v.text[i] and not v.is_byte[i]:
            node = np.zeros(1, np.int64)
            for c in v.text[i]:
                node = v.trie.walk(node, np.array([c]))
                assert node[0] >= 0
            assert v.trie.value[node[0]] == i


def test_byte_fallback(encoder):
    (ids, _), = encoder.encode(["\U0001f9ff"])
    assert encoder.vocabulary.is_byte[ids].sum() == 4


def test_round_trip_of_documents(odd_docs, no_docs, clashing):
    rows = unigram.round_trips(odd_docs, PATH).collect()
    assert len(rows) == odd_docs.count() and all(r.same for r in rows)
    texts = {r.doc_id: r.text or "" for r in odd_docs.collect()}
    back = unigram.decode_documents(unigram.encode_documents(odd_docs, PATH), PATH)
    assert {r.doc_id: r.text for r in back.collect()} == texts
    assert unigram.round_trips(no_docs, PATH).count() == 0
    assert unigram.round_trips(clashing, PATH).count() == 6
