import random

import pytest


@pytest.fixture(scope="session")
def texts():
    """Small texts with copies, near copies, shared passages, blanks of all kinds and odd characters."""
    rng = random.Random(5)
    words = [
        "".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 7))) for _ in range(300)
    ] + ["The", "THE", "12", "x|y", "ß", "日本", "a\tb", "don't"]

    def prose(n):
        return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", ", ", ".\n"]) for _ in range(n))

    out = [None, "", " ", "\n\n", "a", "x" * 99, "x" * 100, "x" * 5000, "ab" * 400]
    shared = prose(60)
    repeated = "A line that is found again and again in many documents."
    for i in range(60):
        body = prose(rng.randint(1, 120))
        if i % 4 == 0:
            body = prose(10) + shared[rng.randint(0, 40):] + prose(10)
        if i % 3 == 0:
            body += f"\n {repeated.upper() if i % 2 else repeated}\t\n" + prose(5)
        out.append(body)
    out += [out[12], out[12], out[13] + " end", out[14].upper(), shared, shared, shared * 30]
    return out


@pytest.fixture(scope="session")
def documents(spark, texts):
    """The texts as documents, with columns whose names operators use inside."""
    rows = [(i * 3, t, "en", f"src{i % 3}", len(t or ""), -i, "k", "d") for i, t in enumerate(texts)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, start long, key string, doc string"
    ).repartition(5)


def empty_like(df):
    return df.limit(0)


def with_oddities(spark, df):
    """Null ids, repeated rows, and one id with two texts."""
    more = spark.createDataFrame(
        [(None, "a text without an id"), (3, "zz another text of the same id"), (6, None), (6, None)],
        "doc_id long, text string",
    )
    return df.select("doc_id", "text").union(more).repartition(3)
