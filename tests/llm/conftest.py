import datetime

import pytest


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns whose names clash with working names."""
    base = "the quick brown fox jumps over the lazy dog and runs far away from here "
    rows = [
        (1, base * 12, "en", "a", 5),
        (2, base * 12, "en", "a", None),
        (2, base * 12, "en", "a", None),
        (3, None, "en", None, 0),
        (None, base * 3, None, "b", 1),
        (4, "", "fr", "b", 0),
        (5, " \t\n ", "fr", "b", 4),
        (6, "une petite phrase avec des mots et encore des mots à lire " * 9, "fr", "c", 1),
        (7, "x", "de", "c", 1),
        (8, "wort " * 30_000, "de", "c", 1),
        (9, base * 12 + "Released under the MIT License.", "en", "a", 1),
        (10, "ñandú 東京 ☃ " * 40, "es", "d", 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F

    return (docs.withColumn("blk", F.lit("mine")).withColumn("row", F.lit(7)).withColumn("txt", F.lit("other")).withColumn("h", F.lit(1.5))
            .withColumn("id", F.lit(datetime.date(2024, 1, 1))).withColumn("n", F.lit(0)).withColumn("score", F.lit("s")))


@pytest.fixture(scope="session")
def small_docs(spark):
    """The smallest documents table."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def small_texts(small_docs):
    return {r["doc_id"]: r["text"] for r in small_docs.select("doc_id", "text").collect()}
