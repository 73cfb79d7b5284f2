"""Column helpers shared by the native operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that may be broadcast after they are counted.
BROADCAST_ROWS = 1_000_000

#: Bytes of an Arrow batch between the JVM and a Python worker.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """From now on this session sends Arrow batches of at most ``BATCH_BYTES``
    (or one longer row) to Python workers. Spark's own bound counts rows, so ten
    thousand long texts would be one batch, held on both sides of the pipe."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def text_key(text: Column) -> Column:
    """Tells apart the texts of rows that share an id."""
    return F.struct(F.xxhash64(text).alias("hash"), F.char_length(text).alias("chars"))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast when its counted rows are within the bound;
    otherwise the planner shuffles (and splits skewed keys at run time)."""
    return F.broadcast(df) if df.count() <= limit else df
