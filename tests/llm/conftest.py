import random

import pytest

from contentloom.llm.common import table

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tables(spark):
    """The smallest test tables by name."""
    return lambda name: table(spark, SMALL, name)


@pytest.fixture
def odd_docs(spark):
    """NULLs in every column, empty and long texts, repeated rows and ids, clashing names."""
    words = [f"w{n}" for n in random.Random(1).sample(range(100_000), 20_000)]
    long = " ".join(words)
    rows = [
        (1, "a b c d e f g", "en", "x", 1),
        (1, "a b c d e f g", "en", "x", 1),
        (2, None, None, None, None),
        (3, "", "en", "y", 0),
        (None, "a b c d e f g", "en", "y", 7),
        (4, " \t\n ", "de", "y", 4),
        (5, long, "en", "x", len(long)),
        (6, long, None, "x", len(long)),
        (7, "A B c d e f g", "en", "x", 13),
        (7, "something else altogether", "en", "x", 25),
        (8, "İßé 漢字 𝄞 'tis", "fr", "x", -1),
    ]
    names = "doc_id long, text string, kept string, TEXT string, score long"
    return spark.createDataFrame(rows, names)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, n_chars long")


@pytest.fixture
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
