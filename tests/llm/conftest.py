import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and to in that is was for on with as by at from thing other small great house river stone tree light".split()


@pytest.fixture(scope="session")
def odd_texts():
    """Texts with copies, near copies, shared passages, nulls, blanks, ties and one that is long."""
    r = random.Random(5)
    word = lambda: r.choice(WORDS) + str(r.randint(0, 40))
    plain = lambda n: [word() for _ in range(n)]
    passage = plain(60)
    out = [None, "", "  \t\n ", "one", "two words", "A b C d E", "a b c d e"]
    for _ in range(12):
        out.append(" ".join(plain(r.randint(30, 120))))
    for _ in range(8):
        out.append(" ".join(plain(10) + passage[r.randint(0, 20) :] + plain(10)))
    base = plain(150)
    for _ in range(10):
        copy = list(base)
        for _ in range(r.randint(0, 4)):
            copy[r.randrange(len(copy))] = word()
        out.append(" ".join(copy))
    out += [" ".join(base)] * 4 + [" ".join(base).upper()]
    out.append("same " * 400)
    out.append("line of words here\n" * 40 + " ".join(plain(3000)))
    r.shuffle(out)
    return out


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    rows = [(3 * i + 5, t, "en", "s", len(t or "")) for i, t in enumerate(odd_texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(spark):
    """Repeated rows, ids that repeat with other texts, a null id, and columns whose names an operator may use itself."""
    rows = [(1, "a b c d e f g h", 7, 8, "x"), (1, "a b c d e f g h", 7, 8, "x"), (2, "other text of some words here", 1, 2, "y"),
            (2, "a b c d e f g h", 3, 4, "z"), (None, "a b c d e f g h", 5, 6, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, key int, n_words int, component_id string")
