import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, g string, component string"


@pytest.fixture(scope="session")
def documents(spark):
    """Builds documents with extra columns whose names operators use themselves."""
    def build(rows):
        return spark.createDataFrame([(i, t, "en", s, 0, -1, "x", "y") for i, t, s in rows], SCHEMA)
    return build


def words(seed: int, n: int) -> str:
    import random
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(n))


@pytest.fixture(scope="session")
def corpus(documents):
    """Nulls, empty and long texts, copies, near copies, shared passages, repeated rows, non-ASCII."""
    a, b, p = words(1, 300), words(2, 80), words(3, 60)
    near = " ".join(w if i != 40 else "changed" for i, w in enumerate(b.split()))
    rows = [(1, a, "s1"), (2, a, "s1"), (3, b, "s1"), (4, near, "s2"), (5, None, "s2"), (6, "", None), (7, "   \n\t", "s3"), (8, "One two", "s3"),
            (9, words(4, 50) + " " + p + " " + words(5, 30), "s3"), (10, p + "\n" + words(6, 40), None), (11, "Ünïcode ßtraße — " + words(7, 5000), "s1"),
            (12, "la " * 400, "s2"), (13, words(8, 25), "s2"), (14, "one TWO", "s3"), (15, "a" * 700, "s1")]
    return documents(rows), rows
