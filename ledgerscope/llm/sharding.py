"""Sharding by a two-pass external shuffle.

Pass one scatters the records by a seeded hash of their row key into buckets that fit in memory; one
bucket is one task. Pass two puts each bucket in the order of its row keys, permutes it by Fisher and
Yates (Spark's ``shuffle`` of an array, seeded by the bucket) and writes it. The buckets one after
another are a random order of all rows; shard k holds the k-th of equal parts of that order.

DataFrame operations only. Row keys are written once before anything is scattered, so a task that runs
again after a lost executor scatters and permutes alike. Keys, not contents, are hashed: copies, equal
sources and null ids spread like any other rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerscope.llm.common import remove
from ledgerscope.session import shared_dir

SEED = 20_011
#: text bytes that a bucket should hold; a task needs several times as much memory, so that large
#: executors can take larger buckets and as many fewer tasks
BUCKET_BYTES = 32 << 20
#: what a row counts for besides its text
ROW_BYTES = 64


def size_of(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def _bucket(row: str, buckets: int, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.col(row)), F.lit(buckets)).cast("int")


def _permuted(records: DataFrame, buckets: int, seed: int) -> DataFrame:
    """``bucket, at, item``: the records of each bucket by their place in its Fisher-Yates permutation."""
    scattered = records.withColumn("bucket", _bucket("row", buckets, seed)).repartitionById(buckets, "bucket")
    packed = scattered.groupBy("bucket").agg(F.collect_list(F.struct("row", "record")).alias("items"))
    by_key = F.array_sort("items", lambda a, b: F.when(a["row"] < b["row"], -1).otherwise(1))
    # Spark seeds each task with ``seed`` plus its partition, which is the bucket
    return packed.withColumn("items", F.shuffle(by_key, seed)).select("bucket", F.posexplode("items").alias("at", "item"))


def write_shards(
    docs: DataFrame,
    path: str,
    shards: int = 8,
    text: str = "text",
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Writes all rows of ``docs`` in random order as Parquet under ``path`` and returns them: ``record, slot, shard``.

    ``record`` holds the columns of ``docs``, whatever their names. Shards 0 to ``shards - 1`` have row
    counts at most one apart; ``slot`` counts from 0 within a shard, and the files of a shard hold its
    slots in order. Null and empty texts, null and repeated ids and repeated rows are rows like any
    others; a text of any length stays whole in its record. With fewer rows than shards some shards are
    empty, and an empty table gives no rows. The same rows in the same files give the same shards; a
    frame whose row order varies may get others from run to run.
    """
    spark = docs.sparkSession
    written = shared_dir(spark, f"records-{uuid.uuid4().hex}")
    keyed = docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("record"), size_of(F.col(text)).alias("size"))
    keyed.write.option("compression", "zstd").parquet(written)
    records = spark.read.parquet(written)
    total = records.agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes")).first()
    rows, held = total["rows"], (total["bytes"] or 0) + ROW_BYTES * total["rows"]
    buckets = max(1, -(-held // bucket_bytes))
    # one row per bucket, so one per task of the scatter
    counts = records.groupBy(_bucket("row", buckets, seed).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = F.broadcast(counts.select("bucket", F.coalesce(before, F.lit(0)).alias("before")))
    placed = _permuted(records.select("row", "record"), buckets, seed).join(offsets, "bucket")
    ranked = placed.select(F.col("item.record").alias("record"), (F.col("before") + F.col("at")).alias("rank"))
    ranked = ranked.withColumn("shard", F.expr(f"int(rank * {shards} div {max(rows, 1)})"))
    first = F.expr(f"(shard * {rows}L + {shards - 1}) div {shards}")
    out = ranked.select("record", (F.col("rank") - first).alias("slot"), "shard")
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").option("compression", "zstd").parquet(path)
    remove(spark, written)
    return spark.read.schema(out.schema).parquet(path)


def shard_rows(shards: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of the rows that ``write_shards`` returned.

    The law is ``rows``. It says nothing of a shard count that grows, so ``grown_shard`` is null.
    """
    own = F.col(f"record.`{text}`")
    return shards.select(
        F.col(f"record.`{doc_id}`").alias("doc_id"),
        size_of(own).alias("size"),
        F.crc32(F.coalesce(own, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
