import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp bigint, row string, id string, kept boolean"


@pytest.fixture
def make(spark):
    """Documents from ``(doc_id, text)`` pairs, with extra columns whose names clash with internal ones."""
    def build(rows):
        full = [(i, t, "en" if i is None or i % 2 else "de", "s", None if t is None else len(t), 1, "r", "x", True) for i, t in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return build


@pytest.fixture
def words():
    r = random.Random(5)
    vocabulary = ["".join(r.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(r.randint(2, 9))) for _ in range(400)]

    def text(n, seed):
        own = random.Random(seed)
        return " ".join(own.choice(vocabulary) for _ in range(n))

    return text


@pytest.fixture
def odd_rows(words):
    """Nulls, empties, ties, repeats, near copies and a very long text."""
    a, b = words(60, 1), words(80, 2)
    return [(1, a), (2, a), (2, a), (3, b), (4, b.replace("a", "e", 1)), (5, None), (6, ""), (7, " \n\t"), (None, a), (None, None),
            (8, a + "\n" + b + "\n" + a), (9, "one two"), (10, words(30000, 3)), (11, words(25, 4)), (12, "x\n" * 30)]
