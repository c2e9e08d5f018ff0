import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType()))])


def words(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("aeiou" if k % 2 else "bcdfgklmnprst") for k in range(r.randint(2, 9))) for _ in range(n))


def rows() -> list[tuple]:
    """Nulls in any column, empty and long texts, ties, repeated rows."""
    base = words(1, 120)
    texts = [
        base, base, base + " tail", None, "", " \n\t ", "one", "One", words(2, 40), words(2, 40) + "\n" + words(3, 12), words(4, 30) + "\n" + words(3, 12),
        words(5, 60_000), "École élève naïve 日本語 \U0001f600", "x" * 200_000, "a\n\nb\n\n\nc", "!!! ??? ...", "1 2 3 4 5", words(7, 25),
    ]
    found = [(10 * k + 3, t, "en" if k % 2 else "fr", f"s{k}", len(t or "")) for k, t in enumerate(texts)]
    found.append(found[8])  # a repeated row
    found.append((None, words(9, 20), None, None, None))
    found.append((777, words(10, 20), None, None, None))
    return found


@pytest.fixture(scope="session")
def nasty(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def nasty_rows():
    return rows()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(nasty):
    """The same rows with columns whose names the operators use themselves."""
    extra = ("fp", "first", "hash", "row", "key", "n", "u", "v", "bucket", "copy", "place", "term", "df", "score", "label", "drops", "_drops0", "id", "items", "tokens",
             "kept_text", "n_lines", "n_dropped", "_drops", "_text", "_doc", "_row", "places", "statistics", "_statistics", "_pipeline_row", "_hash_of", "fingerprint", "hits", "a.b")
    return nasty.select("*", *[F.lit(k).alias(c) for k, c in enumerate(extra)])
