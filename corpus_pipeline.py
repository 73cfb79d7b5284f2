"""Training-data pipeline over ``documents``.

``STAGES`` in order: language ID, near-duplicate removal, benchmark
decontamination, secret redaction, SentencePiece encoding. Every stage takes
``(spark, docs, sf_dir)`` and returns a DataFrame with the columns of
``documents`` (the last: ids and decoded text); each result is written as
Parquet and read again as the next one's ``docs``.

No stage reads anything but its ``docs`` and the benchmark. Empty tables pass
through; null and repeated ids and null texts are handled as the operators
say, and a null text counts as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm import decontaminate, language_id, secret_scan, sentencepiece_bpe, superminhash
from waymark.llm.columns import broadcast_if_small, text_key
from waymark.session import scratch_path
from waymark.sources.tables import stage_table, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; texts without a letter, texts
    for which no language reaches the least score and texts too improbable for
    their best language (foreign ones, random letters) go."""
    found = language_id.predict(docs, language_id.fit_documents(docs), docs.columns,
                                names=("_wm_lang", "_wm_score", "_wm_own"))
    return found.where((F.col("_wm_lang") != language_id.UNDETERMINED) & F.col("_wm_own")
                       & (F.col("_wm_score") >= language_id.MIN_SCORE)).select(*docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return superminhash.keep_one(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    found = decontaminate.overlaps(docs, table(spark, sf_dir, "benchmark", ["item_id", "text"]))
    # Written once: the count and the join below must not search the corpus again.
    leaks = broadcast_if_small(stage_table(
        found.select(F.col("doc_id").alias("_wm_id"), F.col("key").alias("_wm_key")).distinct(), "leaks"))
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks["_wm_id"])
                     & (text_key(F.coalesce("text", F.lit(""))) == leaks["_wm_key"]), "left_anti")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked; ``n_chars`` follows the text."""
    return secret_scan.redact(docs).withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, text``: ids with the end id, and the text that
    they decode to."""
    import public_tokenizers
    path = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece_bpe.round_trip(docs, path).select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "text")


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", remove_near_duplicates),
    ("decontamination", remove_benchmark),
    ("secret_scan", redact_secrets),
    ("sentencepiece", encode),
]

#: Trained models and similarity components have no SQL form; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
