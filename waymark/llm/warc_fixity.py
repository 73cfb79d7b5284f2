"""WARC records and a Merkle fixity audit between replicas.

An archive is a table of WARC records in order: each has a shard, its byte
offset in the shard, its length and its bytes. A leaf hashes the records that
begin in one range of ``RANGE`` bytes of a shard, each with its offset and
length; the node above hashes the ordered hashes of 16 neighbouring nodes, up
to one root per replica. Node numbers come from offsets, so both replicas have
the same tree shape whatever was lost or altered.

The audit compares the roots and goes down one level at a time, reading only
the children of nodes that differ; below the leaves the records of the
differing ranges are compared one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.token_store import parts_for
from waymark.sources.tables import stage_table, table

RANGE = 64 << 10
SHARD = 64 << 20
FANOUT_BITS = 4
#: Shards of one task: the task's number and the shard's share the shard id.
TASK_SHARDS = 1 << 10


def warc_record(record_id: Column, uri: Column, payload: Column) -> Column:
    """Bytes of a WARC response record. Nulls are empty."""
    empty = F.lit("")
    body = F.encode(F.coalesce(payload, empty), "UTF-8")
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
                    F.coalesce(record_id.cast("string"), empty), F.lit(">\r\nWARC-Target-URI: "),
                    F.coalesce(uri, empty), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(F.encode(head, "UTF-8"), body, F.encode(F.lit("\r\n\r\n"), "UTF-8"))


def write_archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  num_partitions: int | None = None) -> DataFrame:
    """``shard, start, length, page_id, record`` of all pages in id order,
    written below the checkpoint folder. Rows with a null id come first; rows
    of one id are ordered by their bytes and all kept. No rows, no records."""
    rows = pages.select(F.col(id_col).alias("page_id"),
                        warc_record(F.col(id_col), F.col(url_col), F.col(html_col)).alias("record"))
    ranged = (rows.repartitionByRange(num_partitions or parts_for(rows), "page_id")
                  .sortWithinPartitions("page_id", "record"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, used = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            lengths = pc.binary_length(batch.column("record")).to_numpy().astype(np.int64)
            begins = used + np.cumsum(lengths) - lengths
            used = int(begins[-1] + lengths[-1])
            if used // SHARD >= TASK_SHARDS:
                raise ValueError("too many bytes in one task; use more partitions")
            yield pa.record_batch([pa.array(part * TASK_SHARDS + begins // SHARD), pa.array(begins % SHARD),
                                   pa.array(lengths), batch.column("page_id"), batch.column("record")],
                                  ["shard", "start", "length", "page_id", "record"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return stage_table(ranged.mapInArrow(
        run, f"shard bigint, start bigint, length bigint, page_id {kind}, record binary"), "archive")


def record_hashes(archive: DataFrame) -> DataFrame:
    """``leaf, shard, start, length, page_id, digest``, written once."""
    leaf = F.col("shard") * (SHARD // RANGE) + F.floor(F.col("start") / RANGE)
    return stage_table(archive.select(leaf.alias("leaf"), "shard", "start", "length", "page_id",
                                      F.sha2("record", 256).alias("digest")), "record-hashes")


def merkle_levels(records: DataFrame, height: int) -> list[DataFrame]:
    """``node, hash`` of levels 0 (leaves) to ``height`` (the root). A group
    holds the records of one range, or at most 16 children."""
    entry = F.concat_ws(":", "start", "length", "digest")
    entries = F.array_sort(F.collect_list(F.struct("start", "length", entry.alias("entry"))))
    level = records.groupBy(F.col("leaf").alias("node")).agg(F.sha2(F.array_join(entries["entry"], "\n"), 256).alias("hash"))
    levels = [stage_table(level, "merkle-0")]
    for k in range(1, height + 1):
        children = F.array_sort(F.collect_list(F.struct("node", F.concat_ws(":", "node", "hash").alias("entry"))))
        level = (levels[-1].groupBy(F.shiftright("node", FANOUT_BITS).alias("up"))
                           .agg(F.sha2(F.array_join(children["entry"], "\n"), 256).alias("hash"))
                           .select(F.col("up").alias("node"), "hash"))
        levels.append(stage_table(level, f"merkle-{k}"))
    return levels


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nodes that one replica lacks or whose hashes differ."""
    other = b.select("node", F.col("hash").alias("other"))
    return a.join(other, "node", "full").where(~F.col("hash").eqNullSafe(F.col("other"))).select("node")


def audit(original: DataFrame, replica: DataFrame) -> DataFrame:
    """``shard, start, length, page_id, status`` of every record on which the
    replicas differ: ``changed``, ``missing`` (not in the replica) or
    ``added``. Both are archives as :func:`write_archive` gives them. Equal
    replicas, and two empty ones, give no rows. Records that share an offset
    (a replica that holds one twice) are compared as a set."""
    first, second = record_hashes(original), record_hashes(replica)
    top = first.unionByName(second).agg(F.max("leaf")).first()[0]
    height = 0 if top is None else -(-int(top).bit_length() // FANOUT_BITS)
    trees = merkle_levels(first, height), merkle_levels(second, height)
    differing = stage_table(_differing(trees[0][height], trees[1][height]), "merkle-differ")
    for level in range(height - 1, -1, -1):
        parents = differing.withColumnRenamed("node", "up")
        children = [t[level].withColumn("up", F.shiftright("node", FANOUT_BITS)).join(parents, "up", "left_semi")
                    for t in trees]
        differing = stage_table(_differing(*children), "merkle-differ")
    leaves = differing.withColumnRenamed("node", "leaf")
    keys = ["leaf", "shard", "start"]
    ours, theirs = (records.join(leaves, "leaf", "left_semi")
                           .groupBy(*keys).agg(F.min("length").alias(f"length_{k}"), F.min("page_id").alias(f"page_{k}"),
                                               F.sort_array(F.collect_set("digest")).alias(f"digest_{k}"))
                    for k, records in (("a", first), ("b", second)))
    pairs = ours.join(theirs, keys, "full").where(~F.col("digest_a").eqNullSafe(F.col("digest_b")))
    status = (F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "added")
               .otherwise("changed"))
    return pairs.select("shard", "start", F.coalesce("length_a", "length_b").alias("length"),
                        F.coalesce("page_a", "page_b").alias("page_id"), status.alias("status"))


def damaged(archive: DataFrame) -> DataFrame:
    """A replica with faults planted by page id: the last byte of the payload
    of every 61st page is overwritten, every 127th record is lost."""
    n = F.octet_length("record")
    head, tail = F.substring("record", F.lit(1), n - 5), F.encode(F.lit("#\r\n\r\n"), "UTF-8")
    hit = F.coalesce((F.col("page_id") % 61 == 7), F.lit(False))
    return stage_table(archive.where(F.coalesce(F.col("page_id") % 127 != 5, F.lit(True)))
                              .withColumn("record", F.when(hit, F.concat(head, tail)).otherwise(F.col("record"))),
                       "archive-replica")


def op5_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records, a replica with planted faults, and what the
    audit finds."""
    archive = write_archive(table(spark, sf_dir, "pages", ["page_id", "url", "html"]))
    found = audit(archive, damaged(archive))
    return found.select("page_id", "status", F.col("length").alias("record_bytes"))


OP5_SQL = """
SELECT page_id, CASE WHEN page_id % 127 = 5 THEN 'missing' ELSE 'changed' END AS status,
       CAST(octet_length(encode('WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
              || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10) || 'WARC-Target-URI: '
              || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
              || 'Content-Length: ' || octet_length(encode(coalesce(html, ''))) || chr(13) || chr(10) || chr(13) || chr(10)
              || coalesce(html, ''))) + 4 AS BIGINT) AS record_bytes
FROM pages
WHERE page_id % 127 = 5
   OR (page_id % 61 = 7 AND (coalesce(html, '') = '' OR right(html, 1) <> '#'))
"""
