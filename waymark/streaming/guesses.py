"""Continuous guess scoring (J1): a stream of guesses joined to the static
round table, scored with the same function as the batch path.

Stateless stream-static join: no watermark or state store is needed, each
micro-batch scores its own guesses. The file sink and the checkpoint live in
the shared checkpoint folder, so a restarted query resumes from its last
committed batch and writes each batch exactly once.

:func:`run_with_rejects` writes scores and rejected guesses to two tables.
``foreachBatch`` promises a batch at least once; each batch owns one folder in
either table and replaces it, so a batch that is run again leaves the same
rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.operators.score import judge_guesses, score_guesses
from waymark.session import scratch_path


def guess_stream(spark: SparkSession, directory: str, schema, file_glob: str = "*.parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over Parquet files dropped into ``directory``."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(directory)


def score_guess_stream(guesses: DataFrame, rounds: DataFrame) -> DataFrame:
    """Streaming twin of :func:`waymark.operators.score.score_guesses`."""
    return score_guesses(guesses, rounds)


def run_to_table(stream_df: DataFrame, name: str = "guess-scores", available_now: bool = True,
                 output_path: str | None = None, checkpoint: str | None = None):
    """Run a streaming query into a Parquet table. With ``available_now`` the
    query processes every file present, stops, and the table's path is
    returned; otherwise it runs on, and ``(path, query)`` is returned so that
    the caller can watch and stop it."""
    spark = stream_df.sparkSession
    out = output_path or scratch_path(spark, name)
    ckpt = checkpoint or scratch_path(spark, name + "-ckpt")
    writer = (stream_df.writeStream.format("parquet").outputMode("append")
              .option("path", out).option("checkpointLocation", ckpt))
    return _finish(writer, available_now, out)


def run_with_rejects(guesses: DataFrame, rounds: DataFrame, scores_path: str, rejects_path: str, checkpoint: str,
                     available_now: bool = True):
    """Judge a stream of guesses into two Parquet tables: scores, and rejects
    with their ``reason``. Rows carry ``batch``, the micro-batch that wrote
    them. The guesses of a batch join the rounds once. Returns the two paths,
    or ``(paths, query)`` for a query that runs on."""
    def write(batch: DataFrame, batch_id: int) -> None:
        judged = judge_guesses(batch, rounds).persist()
        try:
            judged.where(F.col("reason").isNull()).drop("reason").write.mode("overwrite").parquet(f"{scores_path}/batch={batch_id}")
            judged.where(F.col("reason").isNotNull()).write.mode("overwrite").parquet(f"{rejects_path}/batch={batch_id}")
        finally:
            judged.unpersist()

    writer = guesses.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _finish(writer, available_now, (scores_path, rejects_path))


def _finish(writer, available_now: bool, out):
    """Start the query; with ``available_now`` wait until what is there is
    processed."""
    query = (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")).start()
    if not available_now:
        return out, query
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return out
