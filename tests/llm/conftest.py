from __future__ import annotations

import random

import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, _k long, key string"


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    words = ["".join(r.choice(s) for s in ("bdfglmnprst", "aeiou", "bdfglmnprst", "aeiou")) for _ in range(vocabulary)]
    r = random.Random(seed * 7919 + 1)
    return " ".join(r.choice(words) for _ in range(n))


#: Nulls in every column, empty and blank texts, a very long one, repeated rows
#: and texts, one id with two texts, and columns whose names operators use inside.
EDGE = [
    (1, prose(1, 60), "en", "a", 1, "x", 9, "k"),
    (2, prose(1, 60), "en", "b", 1, None, None, None),
    (2, prose(1, 60), "en", "b", 1, None, None, None),
    (3, None, None, None, None, None, None, None),
    (4, "", "en", "a", 0, "x", 9, "k"),
    (5, " \n\t", "en", "é", 0, "x", 9, "k"),
    (None, prose(2, 40), "en", "a", 1, "x", 9, "k"),
    (None, None, "de", "a", 1, "x", 9, "k"),
    (7, prose(3, 30_000), "en", None, 1, "x", 9, "k"),
    (7, prose(4, 20), "fr", "a", 1, "x", 9, "k"),
    (8, "one two", "en", "Z", 1, "x", 9, "k"),
    (9, "One  two\n", "en", "Z", 1, "x", 9, "k"),
]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(EDGE, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def collected(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
