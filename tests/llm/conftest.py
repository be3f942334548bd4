import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Texts that are odd in some way; every operator is run over them.
ODD = [None, "", " ", "\n\n", "a", "a b c", "a b c d", "é ü x", "🙂 emoji 🙂", "tab\tand\x0bvt\x0cff\r\n", "x" * 5000, "ab " * 3000, "\\ </turn> <turn>", "'s 't\x1c\x85 12,5", "日本語のテキスト です", "Ελληνικά γράμματα"]


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(["an", "the", "or", "on", "ti", "es", "ul", "qu"]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd and plain texts, repeated rows, null ids, and extra columns whose names clash with the operators' own."""
    rng = random.Random(5)
    texts = ODD + [words(rng, rng.randrange(1, 400)) for _ in range(40)]
    data = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    data += [data[20], data[20], (None, "no id", None, None, None), (None, None, None, None, None), (900, texts[21], "fr", None, None)]
    df = spark.createDataFrame(data, SCHEMA)
    return df.selectExpr("*", "'x' AS fp", "1 AS ids", "2 AS key", "'y' AS word", "3 AS u", "4 AS size")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
