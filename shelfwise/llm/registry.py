"""The registered queries of this package and their DuckDB SQL, each applied to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import oracles

def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_kd_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.kdtree import top_k

    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0, k=5, scale=256.0)


def op2_gru_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.gru_lm import score_documents
    from shelfwise.llm.sampling import held_out

    docs = _documents(spark, sf_dir)
    out = score_documents(docs, ~held_out(docs["doc_id"], 10), carry=["doc_id"])
    return out.select("doc_id", held_out(F.col("doc_id"), 10).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.jaccard import link_documents

    out = link_documents(_documents(spark, sf_dir), k=4, num=85, den=100, carry=["doc_id"])
    return out.select("doc_id", "n_shingles", "component_id", "n_links")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.licenses import scan

    return scan(_documents(spark, sf_dir), carry=["doc_id"]).drop("places")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm import quality
    from shelfwise.llm.sampling import held_out

    docs, labels = _documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels, lambda key: ~held_out(key, 5))
    out = quality.score(docs, model, carry=["doc_id"], name="score")
    return out.select("doc_id", held_out(F.col("doc_id"), 5).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.substring import remove_repeated_windows

    out = remove_repeated_windows(_documents(spark, sf_dir), window=35, carry=["doc_id"])
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.decontam import find_passages

    out = find_passages(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=["doc_id"])
    return out.withColumnRenamed("item", "item_id")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.suffix import remove_repeated_bytes

    out = remove_repeated_bytes(_documents(spark, sf_dir), window=400, carry=["doc_id"])
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from shelfwise.llm.packing import power_of_two_pieces

    return power_of_two_pieces(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), seq_len=2048, end_id=1)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm import langid
    from shelfwise.llm.sampling import held_out

    docs = _documents(spark, sf_dir)
    model = langid.fit(docs, ~held_out(docs["doc_id"], 5))
    out = langid.predict(docs, model, carry=["doc_id"], score_name="score")
    return out.select("doc_id", held_out(F.col("doc_id"), 5).alias("held_out"), "lang_pred", "score")


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.source_audit import divergence

    return divergence(_documents(spark, sf_dir))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.vector_codes import encode

    out, books = encode(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), carry=["vec_id"])
    return out.withColumn("codebooks_sha256", F.lit(books.sha256()))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.pii import find

    out = find(_documents(spark, sf_dir), carry=["doc_id"])
    return out.withColumn("base_sha256", F.sha2("base_spans", 256)).drop("base_spans")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_kd_search, op2_gru_scoring, op3_jaccard_join, op4_licenses, op5_quality, op6_substring_dedup, op7_decontamination, op8_suffix_dedup, op9_packing, op10_language_id, op11_source_audit, op12_vector_codes, op13_pii, pipeline)}

ORACLES: dict[str, str] = {
    "op1_kd_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::HUGEINT) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op3_jaccard_join": oracles.jaccard_join(),
    "op6_substring_dedup": oracles.repeated_windows(),
    "op11_source_audit": oracles.source_audit(),
    "op12_vector_codes": oracles.vector_codes(),
}
