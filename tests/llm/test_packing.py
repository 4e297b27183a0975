import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from trackloom.llm import packing
from trackloom.llm.queries import byte_bpe


def test_ids_are_those_of_the_tokenizers_file(odd_texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = packing.Encoder(*byte_bpe())
    r = random.Random(1)
    signs = ["a", "é", " ", "  ", "\n", " ", "'s", "12", ".", "!!", "中", "😀", "<|endoftext|>", "\t", "\x85"]
    texts = [t or "" for t in odd_texts] + ["".join(r.choice(signs) for _ in range(20)) for _ in range(500)]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert list(encoder.encode(text)) == want.ids


@pytest.mark.parametrize("capacity", [8, 64])
def test_pieces_and_places(odd_docs, capacity):
    encoder = packing.Encoder(*byte_bpe())
    texts = {r.doc_id: r.text or "" for r in odd_docs.collect()}
    rows = packing.pack_documents(odd_docs, byte_bpe(), capacity=capacity).collect()
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == texts.keys()
    for i, text in texts.items():
        ids = np.append(encoder.encode(text), 0).astype("<u4")
        at = 0
        for n, r in enumerate(sorted(pieces[i], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (n, at)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            assert r.length == capacity or n == 0
            at += r.length
        assert at == len(ids)
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in rows)
    assert len(bins) <= 1.1 * total / capacity + 2


def test_sum_of_squares_rule():
    # 5 opens a bin (gap 3); 4 another (gap 4); 3 may fill the first or leave 1 in the second: filling is the smaller change
    assert packing.place([5, 4, 3], 8) == ([0, 1, 0], [0, 0, 5])
    bins, _ = packing.place(sorted([random.Random(2).randint(1, 100) for _ in range(500)], reverse=True), 100)
    assert max(bins) + 1 <= 270


def test_full_pieces_are_not_placed(spark):
    """A very long document among short ones: its full pieces have sequences of their own, which no task packs."""
    docs = spark.createDataFrame([(1, "word " * 5000), (2, "a b"), (3, "c"), (1, "word " * 5000)], "doc_id long, text string")
    rows = packing.pack_documents(docs, byte_bpe(), capacity=64).collect()
    full = [r for r in rows if r.length == 64]
    assert len({r.sequence_id for r in full}) == len(full) and all(r.sequence_id < 0 and r.offset == 0 for r in full)
    assert all(r.sequence_id >= 0 for r in rows if r.length < 64)
    tokens = len(packing.Encoder(*byte_bpe()).encode("word " * 5000)) + 1
    assert sum(r.length for r in rows if r.doc_id == 1) == 2 * tokens


def test_odd_tables(no_docs, clashing):
    assert packing.pack_documents(no_docs, byte_bpe()).count() == 0
    rows = packing.pack_documents(clashing, byte_bpe()).collect()
    assert len(rows) == 6 and sum(r.doc_id is None for r in rows) == 2
