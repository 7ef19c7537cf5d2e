import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("size", T.StringType()), T.StructField("copies", T.StringType()), T.StructField("src", T.StringType()), T.StructField("_x", T.StringType())])


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    said = ["".join(rng.choice(["an", "er", "th", "on", "ing", "re", "st", "ou"]) for _ in range(rng.randint(1, 3))) for _ in range(words)]
    return " ".join(w.capitalize() + ("." if i % 8 == 7 else "") for i, w in enumerate(said))


def rows() -> list[tuple]:
    """Clean texts, near and exact copies, personal data, nulls everywhere, empty and very long texts, a repeated row."""
    base = [(i, prose(i, 60 + i), "en", f"s{i % 4}") for i in range(30)]
    base += [(100 + i, prose(3, 63), "en", "s1") for i in range(5)]
    base += [(200, prose(5, 65) + " extra", "en", "s2"), (200, prose(5, 65) + " extra", "en", "s2")]
    base += [(300, None, None, None), (301, "", "en", None), (302, " \t\n", "en", "s0"), (None, prose(900, 40), "en", "s3"), (303, "one two", None, "s0"), (304, "Ünï   cöde 😀 wörd", "de", "é")]
    base += [(400, "x" * 50_000 + " " + prose(7, 9000), "en", "s0")]
    base += [(500, "mail a.b@c.de or call +1 (234) 555-1234, ip 10.0.0.1 card 4111 1111 1111 1111 bad 4111 1111 1111 1112 and 999.1.1.1 😀 q@r.st_u@v.wx", "en", "s1")]
    return [(i, t, lang, s, None if t is None else len(t), "9", "many", "v", None) for i, t, lang, s in base]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
