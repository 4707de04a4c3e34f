"""Sinks (S9-S14): feature store with a cutoff/version stamp, predictions, metrics,
importance and model. Everything is written by Spark; nothing is collected first."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ACCOUNT, FEATURE_VERSION
from .readers import path_exists, remove


class StaleFeatureStore(ValueError):
    """The stored table was built for another cutoff date or feature version."""


def write_feature_store(df: DataFrame, path: str, cutoff_date: str, version: str = FEATURE_VERSION) -> None:
    """S9 + R3: snappy Parquet under ``path/data``, grouped by account, and a stamp under ``path/stamp``.

    The stamp goes first and comes last: whatever fails in between leaves no valid store behind.
    The table has one row an account, so grouping its files by key is a small shuffle beside the
    scans of the facts, and holds whichever joins AQE chose.
    """
    remove(df.sparkSession, f"{path}/stamp")
    df.repartition(ACCOUNT).write.mode("overwrite").option("compression", "snappy").parquet(f"{path}/data")
    spark = df.sparkSession
    stamp = spark.createDataFrame(
        [(cutoff_date, version, json.dumps(df.columns))], "cutoff_date string, feature_version string, columns string"
    )
    stamp.coalesce(1).write.mode("overwrite").json(f"{path}/stamp")


def feature_store_exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/stamp") and path_exists(spark, f"{path}/data")


def read_feature_store(spark: SparkSession, path: str, cutoff_date: str, version: str = FEATURE_VERSION) -> DataFrame:
    """Reuse a stored table only when it was built for the same cutoff and version."""
    row = spark.read.json(f"{path}/stamp").first()
    if row is None or row["cutoff_date"] != cutoff_date or row["feature_version"] != version:
        found = None if row is None else (row["cutoff_date"], row["feature_version"])
        raise StaleFeatureStore(f"feature store at {path} has {found}, wanted {(cutoff_date, version)}")
    return spark.read.parquet(f"{path}/data")


def write_predictions(scores: DataFrame, path: str) -> None:
    """ACCOUNT_ID, CHURN_PROB as header CSV (one part file per task)."""
    scores.select("ACCOUNT_ID", "CHURN_PROB").write.mode("overwrite").option("header", "true").csv(path)


def write_record(spark: SparkSession, record: dict, path: str) -> None:
    """A metrics / config record as a one-row JSON file."""
    spark.createDataFrame([tuple(json.dumps(v) if isinstance(v, dict) else v for v in record.values())], list(record)) \
        .coalesce(1).write.mode("overwrite").json(path)


def write_importance(importance: DataFrame, path: str) -> None:
    """(feature, gain) sorted by gain; bounded by the number of features."""
    importance.orderBy(F.desc("gain"), F.asc("feature")).coalesce(1).write.mode("overwrite").option(
        "header", "true"
    ).csv(path)


def save_model(model, path: str) -> None:
    """MLlib persistence (readable by ``GBTClassificationModel.load``)."""
    model.write().overwrite().save(path)
