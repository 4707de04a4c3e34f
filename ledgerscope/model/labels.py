"""Label preparation (P14, J8), time-ordered split (M3, A12), train sampling (M4), class
weights (M5, A13) and the train / score matrices (J7, P12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ACCOUNT, NON_FEATURE_COLUMNS, SPLIT_DATE_CANDIDATES
from ..functions.exprs import as_date, numeric_columns
from ..operators.dimension import one_row_per_account


class NoSplitColumn(ValueError):
    """No date column to split on; a random split would leak, so none is made."""


def prepare_labels(labels: DataFrame, kyc: DataFrame) -> DataFrame:
    """P14 + J8: label dates as dates; the account open date joined from kyc when absent.

    The kyc side is reduced to one row per account first, so a duplicated kyc row can not
    duplicate a training row.
    """
    out = labels
    for c in ("LABEL_DATE", "SNAPSHOT_DATE", "AS_OF_DATE"):
        if c in out.columns:
            out = out.withColumn(c, as_date(c, out.schema[c].dataType))
    if "ACCOUNT_OPEN_DATE" in kyc.columns and "ACCOUNT_OPEN_DATE" not in out.columns:
        open_dates = one_row_per_account(
            kyc.select(ACCOUNT, as_date("ACCOUNT_OPEN_DATE", kyc.schema["ACCOUNT_OPEN_DATE"].dataType).alias("ACCOUNT_OPEN_DATE")),
            ["ACCOUNT_OPEN_DATE"],
        )
        out = out.join(open_dates, ACCOUNT, "left")
    return out.withColumn("CHURN", F.col("CHURN").cast("int"))


def split_column(df: DataFrame) -> str:
    for c in SPLIT_DATE_CANDIDATES:
        if c in df.columns:
            return c
    raise NoSplitColumn(
        f"rows cannot be split by time: none of {', '.join(SPLIT_DATE_CANDIDATES)} is there, "
        "and a split at random would let the future leak into the training rows"
    )


def split_threshold(df: DataFrame, valid_frac: float) -> tuple[str, float | None]:
    """Exact (1 - f) quantile of the split date in epoch days, linear interpolation.

    ``percentile`` keeps one counter per distinct value, i.e. per calendar day: bounded.
    """
    col = split_column(df)
    row = df.agg(F.percentile(F.unix_date(F.col(col)), 1.0 - valid_frac).alias("t")).first()
    return col, (None if row is None or row["t"] is None else float(row["t"]))


def time_split(df: DataFrame, valid_frac: float) -> DataFrame:
    """M3: ``is_valid`` = split date >= threshold; rows without a date train."""
    col, thr = split_threshold(df, valid_frac)
    flag = F.lit(False) if thr is None else F.coalesce(F.unix_date(F.col(col)) >= F.lit(thr), F.lit(False))
    return df.withColumn("is_valid", flag)


def sample_bound(frac: float) -> str:
    """Upper bound (exclusive) on the first 8 hex digits of the row hash for a kept row."""
    return format(min(int(frac * 16**8), 16**8 - 1) if frac < 1 else 16**8 - 1, "08x")


def sample_key(seed: int) -> F.Column:
    return F.substring(F.md5(F.concat(F.col(ACCOUNT).cast("string"), F.lit(f"|{seed}"))), 1, 8)


def sample_flag(frac: float, seed: int) -> F.Column:
    """True for every validation row and for a hash-chosen ``frac`` of the train rows."""
    if frac >= 1.0:
        return F.lit(True)
    return F.col("is_valid") | (sample_key(seed) < F.lit(sample_bound(frac)))


def train_sample(df: DataFrame, frac: float, seed: int) -> DataFrame:
    """M4: keep every validation row and a hash-chosen ``frac`` of the train rows.

    The hash of (key, seed) is stable under re-partitioning and recomputation, unlike
    ``sample``; the kept share is ``frac`` in expectation.
    """
    return df if frac >= 1.0 else df.filter(sample_flag(frac, seed))


def class_counts(df: DataFrame) -> DataFrame:
    """A13 + M5 on the train rows: pos, neg (each at least 1) and neg / pos."""
    train = df.filter(~F.col("is_valid")) if "is_valid" in df.columns else df
    agg = train.agg(F.sum(F.col("CHURN")).alias("p"), F.count(F.lit(1)).alias("n"))
    return agg.select(
        F.greatest(F.coalesce(F.col("p"), F.lit(0)), F.lit(1)).cast("long").alias("pos"),
        F.greatest(F.col("n") - F.coalesce(F.col("p"), F.lit(0)), F.lit(1)).cast("long").alias("neg"),
    ).select("pos", "neg", (F.col("neg") / F.col("pos")).alias("scale_pos_weight"))


def with_weights(df: DataFrame, scale_pos_weight: float) -> DataFrame:
    """M5: positives weigh neg / pos, negatives 1."""
    return df.withColumn("weight", F.when(F.col("CHURN") == 1, F.lit(float(scale_pos_weight))).otherwise(F.lit(1.0)))


def feature_columns(df: DataFrame) -> list[str]:
    """Every numeric column except key, label and date columns (and our helper columns)."""
    skip = set(NON_FEATURE_COLUMNS) | {"is_valid", "weight"}
    return numeric_columns(df, exclude=skip)


def train_matrix(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Feature rows of labelled accounts."""
    return features.join(labels, ACCOUNT, "inner")


def score_matrix(features: DataFrame, test_ids: DataFrame) -> DataFrame:
    """Feature rows of the accounts to score."""
    return features.join(test_ids.select(ACCOUNT), ACCOUNT, "inner")
