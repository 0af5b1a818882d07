import random

import pytest
from pyspark.sql import types as T

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# names that operators use inside; whatever they are, they must not matter
CLASHING = ["fp", "root", "node", "h", "rid", "size", "pattern", "u", "copies", "_id", "_hash", "_sha", "_keep", "_pattern", "kept", "bad", "rule", "cell", "rank", "ids", "a.b"]


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(n))


def edge_rows() -> list[tuple]:
    rng = random.Random(5)
    long = words(rng, 30_000)
    plain = [words(rng, 60) for _ in range(12)]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(plain)]
    rows += [
        (100, plain[0], "en", "s0", 1),  # equal text
        (101, plain[0].replace(" ", " \t\n"), "en", None, None),  # equal but for white space
        (102, plain[0].upper(), None, "s1", 1),
        (103, "", "en", "s1", 0),
        (104, None, "en", "s2", None),
        (105, " \n\t ", "de", "s2", 3),
        (106, long, "en", "s0", len(long)),
        (107, long + " x", "en", "s1", len(long)),
        (108, "one two", "fr", "s2", 7),
        (3, plain[3], "en", "s0", len(plain[3])),  # a repeated row
        (3, plain[3], "en", "s0", len(plain[3])),
        (None, plain[4], "en", "s1", 1),  # a null id with a known text
        (None, "a text of its own with ten words or more in it", "en", None, 1),
        (None, None, None, None, None),
        (109, "日本語 ▁ \x00 «ñandú» 👍 <s> <|endoftext|>  double  blanks ", "es", "s0", 1),
    ]
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    docs = spark.createDataFrame(edge_rows(), SCHEMA)
    return docs.select("*", *[docs["doc_id"].cast("string").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def none(edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())])
    return spark.createDataFrame([(0, 1, 0), (1, 0, 1), (2, None, None), (None, 1, 1), (3, 1, 0), (3, 1, 0)], schema)
