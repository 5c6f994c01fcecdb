import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size string, score string, "
          "digest string, shard string, spans string, word string, tree string, trusted string, key string")


def rows(texts, first=0, source=lambda i: f"s{i % 3}"):
    """Documents with extra columns whose names operators use themselves."""
    return [(first + i, t, "en", source(i), len(t) if t is not None else None, *["x"] * 9)
            for i, t in enumerate(texts)]


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    rng = random.Random(3)
    texts = [None, "", " \n\t ", "one", "a b c d", words(rng, 20_000), words(rng, 60), "é ñ 🙂 " * 30,
             'token = "abcdef0123456789abcdef0123" x', "x" * 5000, "line\n" * 200]
    texts += [words(rng, rng.randrange(5, 300)) for _ in range(40)]
    texts += texts[5:25]
    data = rows(texts)
    data += data[10:14]
    data += [(None, "no id here at all", None, None, None, *[None] * 9), (None, None, None, None, None, *[None] * 9)]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
