"""Exact deduplication: group by a 128-bit content hash, compare bytes inside the groups.

Main path is DataFrame operations only. Texts never travel except those in groups of two or
more, and those are collapsed map-side (the text itself is a grouping key, so equality is
decided by bytes) before any shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerscope.llm.common import cut, keep_rows

#: the characters of ``[\x20\x09-\x0D]``
WHITE = "\t\n\x0b\x0c\r "

#: hashes of repeated texts that are broadcast at most (32 characters each, about 16 MB);
#: beyond it the byte comparison uses a shuffled semi-join
BROADCAST_HASHES = 200_000


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def _classes(docs: DataFrame, content_hash: Callable[[Column], Column], doc_id: str, text: str) -> DataFrame:
    """One row per distinct (class, id, length): ``key, sub, doc_id, n_chars, text_sha256, copies``."""
    norm = normalised(F.col(text))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n_chars"),
        norm.alias("norm"),
    ).withColumn("key", content_hash(F.col("norm")))
    digests = cut(
        rows.withColumn("text_sha256", F.sha2(F.col("norm"), 256))
        .groupBy("key", "doc_id", "n_chars", "text_sha256")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    repeated = cut(digests.groupBy("key").agg(F.sum("copies").alias("n")).where("n > 1").select("key"))
    hashes = F.broadcast(repeated) if repeated.count() <= BROADCAST_HASHES else repeated
    texts = rows.join(hashes, "key", "left_semi").groupBy("key", "norm").agg(F.count(F.lit(1)).alias("n"))
    colliding = cut(texts.groupBy("key").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("key"))
    if colliding.isEmpty():
        return digests.withColumn("sub", F.lit(""))
    # different texts behind one hash: there the text itself separates the classes
    apart = (
        rows.join(colliding, "key", "left_semi")
        .groupBy("key", "doc_id", "n_chars", F.sha2(F.col("norm"), 256).alias("text_sha256"), F.col("norm").alias("sub"))
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    sure = digests.join(colliding, "key", "left_anti").withColumn("sub", F.lit(""))
    return cut(sure.unionByName(apart))


def _ranked(docs: DataFrame, content_hash: Callable[[Column], Column], doc_id: str, text: str) -> DataFrame:
    """The classes with ``best`` and ``group_size`` of their texts; ``first`` marks the class that keeps a row."""
    classes = _classes(docs, content_hash, doc_id, text)
    best = cut(
        classes.groupBy("key", "sub").agg(
            F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"))).alias("best"),
            F.sum("copies").alias("group_size"),
        )
    )
    first = (F.col("best.doc_id").eqNullSafe(F.col("doc_id"))) & (F.col("best.n") == -F.col("n_chars"))
    return classes.join(best, ["key", "sub"]).withColumn("first", first)


def _md5(norm: Column) -> Column:
    return F.md5(norm.cast("binary"))


def exact_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    content_hash: Callable[[Column], Column] = _md5,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are identical without white space. Of equal texts the row with the
    most characters stays, then the smallest id; null ids come last. Null texts count as empty,
    and empty texts are equal to each other. Of rows that agree in id and length exactly one is
    kept. An empty table gives no rows; other columns are ignored.
    """
    joined = _ranked(docs, content_hash, doc_id, text)
    return joined.select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        "first",
        "text_sha256",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    ).select("doc_id", "keep_id", "group_size", (F.col("first") & (F.col("copy") == 1)).alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` does not keep; all columns of ``docs`` come back.

    Of each group of equal texts exactly one row stays, whatever ids are null or repeated.
    """
    classes = _ranked(docs, _md5, doc_id, text).select(
        "doc_id", F.concat_ws(":", "text_sha256", "n_chars").alias("digest"), F.col("first").alias("kept"), "copies"
    )
    digest = F.concat_ws(":", F.sha2(normalised(F.col(text)), 256), F.length(F.coalesce(F.col(text), F.lit(""))))
    return keep_rows(docs, classes, digest, doc_id)
