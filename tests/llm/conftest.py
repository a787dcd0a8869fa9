import random

import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def awkward():
    """Rows (doc_id, text, source) with nulls, empty and long texts, ties and repeated rows."""
    rng = random.Random(5)
    base = words(rng, 120)
    near = base.replace(" w1", " x1", 1)
    long = words(rng, 30_000)
    passage = words(rng, 70)
    return [
        (1, base, "a"),
        (2, base, "a"),
        (2, base, "a"),
        (3, near, None),
        (4, None, "b"),
        (5, "", "b"),
        (6, " \n\t ", "c"),
        (None, words(rng, 50), "c"),
        (None, base, None),
        (7, long, "d"),
        (8, long + " tail", "d"),
        (9, words(rng, 30) + " " + passage + " " + words(rng, 40), "é"),
        (10, words(rng, 25) + " " + passage, "é"),
        (11, "one two three", "Z"),
        (12, "ONE two\nthree", "Z"),
        (13, "a" * 5000, "Z"),
        (14, "日本語 😀 " * 60, "a"),
        (15, words(rng, 60) + " mail me: jo.doe@mail.example.com or +1 (415) 555-0100", "a"),
    ]


@pytest.fixture(scope="session")
def documents(spark, awkward):
    """The rows above as a table, with columns whose names operators use themselves."""
    rows = [
        (i, t, "xx", s, None if t is None else len(t), -1, "old", True, [1]) for i, t, s in awkward
    ]
    extra = "size int, component_id string, kept boolean, ids array<int>"
    return spark.createDataFrame(rows, f"{DOCUMENTS}, {extra}").repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
