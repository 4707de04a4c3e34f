"""Order statistics without a global sort: exact ROC-AUC (M8) and top-fraction precision /
recall (O1, M9).

Both need, for every score, how many rows lie below (or above) it. A window ordered over
the whole table would run in one partition, and ``orderBy().limit(n)`` merges n rows on the
driver, while n grows with the data. Instead:

1. aggregate to one row per distinct value (partial aggregation, so ties cost nothing);
2. range-partition the distinct values by the order column itself, whatever its type, into about
   (distinct values / ``rows_per_bucket``) buckets, and write that down (checkpoint), as the
   cut points are sampled; a bucket is a task and a file, so small buckets are made larger until
   there are no more of them than shuffle partitions (``bucket_count``);
3. per-bucket totals (one row a bucket) give each bucket's offset; a window *partitioned by
   bucket* gives the exclusive prefix inside the bucket.

Rows without a score (null or NaN) rank last, below every other score, in both metrics.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: target rows per bucket window
ROWS_PER_BUCKET = 1_000_000


def bucket_count(rows: int, rows_per_bucket: int, partitions: int) -> int:
    """Buckets for so many rows: as asked, but beyond ``partitions`` only what ``ROWS_PER_BUCKET`` calls for."""
    asked = math.ceil(rows / rows_per_bucket)
    return max(1, min(asked, max(partitions, math.ceil(rows / ROWS_PER_BUCKET))))


def exclusive_prefix(df: DataFrame, order_col: str, sum_cols: list[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add ``below_<c>`` = sum of ``c`` over rows whose ``order_col`` is strictly smaller.

    ``df`` must hold one row per distinct, non-null ``order_col`` value (aggregate first).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    buckets = bucket_count(df.count(), rows_per_bucket, int(spark.conf.get("spark.sql.shuffle.partitions")))
    if buckets == 1:  # at most ``rows_per_bucket`` rows: one window, nothing to write
        whole = Window.orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
        return df.select(*df.columns, *[F.coalesce(F.sum(c).over(whole), F.lit(0)).alias(f"below_{c}") for c in sum_cols])
    x = df.repartitionByRange(buckets, order_col).withColumn("__b", F.spark_partition_id()).checkpoint()
    totals = x.groupBy("__b").agg(*[F.sum(c).alias(f"__t_{c}") for c in sum_cols]).collect()  # one row a bucket
    running = dict.fromkeys(sum_cols, 0)
    offsets = []
    for row in sorted(totals, key=lambda r: r["__b"]):
        offsets.append((row["__b"], *[running[c] for c in sum_cols]))
        for c in sum_cols:
            running[c] += row[f"__t_{c}"] or 0
    off = spark.createDataFrame(offsets, ", ".join(["`__b` int"] + [f"`__o_{c}` long" for c in sum_cols]))
    w = Window.partitionBy("__b").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    return x.join(F.broadcast(off), "__b", "left").select(
        *df.columns,
        *[(F.col(f"__o_{c}") + F.coalesce(F.sum(c).over(w), F.lit(0))).alias(f"below_{c}") for c in sum_cols],
    )


def _rankable(score_col: str) -> Column:
    s = F.col(score_col).cast("double")
    return F.when(s.isNull() | F.isnan(s), F.lit(-math.inf)).otherwise(s)


def roc_auc(
    scored: DataFrame, label_col: str = "CHURN", score_col: str = "score", rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Exact ROC-AUC, ties counted one half (Mann-Whitney); one row: auc, positives, negatives.

    The per-score table (one row per distinct score) is read by the few small jobs below, so
    it is kept for their duration instead of re-deriving it from the scored rows each time.
    """
    per_score = (
        scored.groupBy(_rankable(score_col).alias("s"))
        .agg(
            F.sum(F.when(F.col(label_col) == 1, 1).otherwise(0)).cast("long").alias("pos"),
            F.sum(F.when(F.col(label_col) == 1, 0).otherwise(1)).cast("long").alias("neg"),
        )
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        ranked = exclusive_prefix(per_score, "s", ["neg"], rows_per_bucket)
        row = ranked.agg(
            F.sum(F.col("pos") * (F.col("below_neg") + F.col("neg") * 0.5)).alias("num"),
            F.sum("pos").alias("positives"),
            F.sum("neg").alias("negatives"),
        ).first()
    finally:
        per_score.unpersist()
    pos, neg = int(row["positives"] or 0), int(row["negatives"] or 0)
    auc = float(row["num"]) / (pos * neg) if pos and neg else None
    return scored.sparkSession.createDataFrame([(auc, pos, neg)], "auc double, positives long, negatives long")


def top_fraction_metrics(
    scored: DataFrame,
    k_frac: float = 0.10,
    label_col: str = "CHURN",
    score_col: str = "score",
    key_col: str = "ACCOUNT_ID",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Precision and recall among the ceil(k*n) (at least 1) highest scores; ties by smaller key.

    Keys are compared as what they are (numbers, strings, ...), a null key comes last. One row:
    n_top, true_positives, precision, recall (recall 0 when there is no positive).
    """
    spark = scored.sparkSession
    rows = scored.select(
        F.col(key_col).alias("k"),
        _rankable(score_col).alias("s"),
        F.when(F.col(label_col) == 1, 1).otherwise(0).alias("y"),
    )
    per_score = (
        rows.groupBy("s")
        .agg(F.count(F.lit(1)).alias("cnt"), F.sum("y").cast("long").alias("pos"))
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        # ascending prefix over the negated score == rows strictly above each score
        above = exclusive_prefix(per_score.withColumn("neg_s", -F.col("s")), "neg_s", ["cnt"], rows_per_bucket)
        tot = per_score.agg(F.sum("cnt").alias("n"), F.sum("pos").alias("p")).first()
        n_all, p_all = int(tot["n"] or 0), int(tot["p"] or 0)
        n_top = max(1, int(math.ceil(n_all * k_frac)))
        full = above.filter(F.col("below_cnt") + F.col("cnt") <= n_top).agg(
            F.coalesce(F.sum("pos"), F.lit(0)).alias("tp"), F.coalesce(F.sum("cnt"), F.lit(0)).alias("taken")
        ).first()
        tp, taken = int(full["tp"]), int(full["taken"])
        split = above.filter((F.col("below_cnt") < n_top) & (F.col("below_cnt") + F.col("cnt") > n_top)).first()
        if split is not None:
            tp += _positives_among_ties(rows.filter(F.col("s") == F.lit(split["s"])), n_top - taken, rows_per_bucket)
    finally:
        per_score.unpersist()
    precision = tp / n_top if n_top else 0.0
    recall = tp / p_all if p_all else 0.0
    return spark.createDataFrame(
        [(n_top, tp, float(precision), float(recall))], "n_top long, true_positives long, precision double, recall double"
    )


def _positives_among_ties(ties: DataFrame, wanted: int, rows_per_bucket: int) -> int:
    """Positives among the ``wanted`` rows with the smallest keys; of a key that is cut, positives come first."""
    per_key = (
        ties.groupBy("k").agg(F.sum("y").cast("long").alias("y"), F.count(F.lit(1)).alias("c")).persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        ranked = exclusive_prefix(per_key.filter(F.col("k").isNotNull()), "k", ["c"], rows_per_bucket)
        taken = ranked.filter(F.col("below_c") < wanted).agg(
            F.coalesce(F.sum(F.least(F.col("y"), F.lit(wanted) - F.col("below_c"))), F.lit(0)).alias("y"),
            F.coalesce(F.sum("c"), F.lit(0)).alias("c"),
        ).first()
        left = wanted - int(taken["c"])
        if left <= 0:
            return int(taken["y"])
        without = per_key.filter(F.col("k").isNull()).first()
        return int(taken["y"]) + (min(int(without["y"]), left) if without else 0)
    finally:
        per_key.unpersist()
