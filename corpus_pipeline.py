"""The training-data pipeline over ``documents``: each stage is one operator, written as Parquet and read again.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import decontam, jaccard, langid, packing, suffix
from shelfwise.session import scratch_dir

#: Bytes of a repeated passage from which it is removed: fifty short words.
PASSAGE_BYTES = 200
#: A document whose language is less likely than this is rejected.
LEAST_LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; null, letterless and undecided texts go.

    Where no row has a label there is nothing to learn, and every document with a text stays.
    """
    model = langid.fit(docs, F.lit(True))
    if model is None:
        return docs.where(F.col("text").isNotNull())
    names = docs.columns
    rest = F.struct(*[F.col(f"`{c}`") for c in names if c != "text"])
    out = langid.predict(docs.select(rest.alias("doc"), F.col("text")), model, pred_name="guess", score_name="sure")
    out = out.where((F.col("guess") != langid.UNDETERMINED) & (F.col("sure") >= LEAST_LANGUAGE_SCORE))
    return out.select(*[F.col("text") if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in names])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by a similarity of 0.8 or more of five-word shingles."""
    return jaccard.keep_one(docs, k=5, num=4, den=5)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that also stand elsewhere; a document of which no word is left goes.

    A character that a cut splits is dropped; ``n_chars`` is counted anew where a text changed; a null text comes back empty.
    """
    names = docs.columns
    rest = F.struct(*[F.col(f"`{c}`") for c in names if c != "text"])
    out = suffix.remove_repeated_bytes(docs.select(rest.alias("doc"), F.col("text")), window=PASSAGE_BYTES, as_text=True)
    out = out.where((F.col("n_removed") == 0) | F.col("kept").rlike(r"[^\x20\x09-\x0D]"))
    chars = F.when(F.col("n_removed") == 0, F.col("doc.n_chars")).otherwise(F.char_length("kept").cast("long"))
    put = {"text": F.col("kept"), "n_chars": chars}
    return out.select(*[put[c].alias(c) if c in put else F.col(f"doc.`{c}`").alias(c) for c in names])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark text."""
    marked = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("mark"), F.col("text"))
    found = decontam.find_passages(marked, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=["id", "mark"])
    return docs.join(found, docs["doc_id"].eqNullSafe(found["id"]) & (F.xxhash64(docs["text"]) == found["mark"]), "left_anti")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of power-of-two lengths, one document each."""
    return packing.power_of_two_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), seq_len=2048, end_id=1, keep_words=False)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what a stage returns is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Classifiers, alignments and tokenizers are beyond SQL.  The tests hold each stage's operator against plain Python, and
#: the stages' columns, kept ids and packed ids; they do not yet compare whole rows of every stage.
ORACLE_SQL = None
