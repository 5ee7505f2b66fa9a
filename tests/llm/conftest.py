import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977}" for i in range(30_000))
PROSE = "the quick brown fox jumps over a lazy dog and then it goes home again to rest for the long night under the trees"
TEXTS = [
    None, "", " \n\t", "a", "one two", PROSE, PROSE, PROSE + " now", LONG, "#*$%&|<>", "Ünïcödé ÀÉ x y\u00a0z", "you are an idiot and a moron. loser!", "He said \"idiot\".",
    "Released under the MIT License.", "licensed under the apach license, version 2.0", "x <|endoftext|> y", "a  b   c \n  d ", "A\nA\nB\nA", "cc by nc cc by nc",
]


@pytest.fixture(scope="session")
def docs(spark):
    """Edge cases: nulls in any column, empty and very long texts, ties, repeated rows, clashing column names."""
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}" if i % 5 else None, len(t or "")) for i, t in enumerate(TEXTS)]
    rows += [(None, PROSE, "en", "s0", 1), (None, None, None, None, None), rows[5], rows[5]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = ["score", "size", "copies", "fp", "host", "target", "n_words", "bucket", "shard", "near", "labels", "component_id"]
    return df.select("*", *(F.lit("own").alias(c) for c in clash)).repartition(3)


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)
