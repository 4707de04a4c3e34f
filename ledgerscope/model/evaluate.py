"""Model read-outs: gain importance (M12, O2), the driver-summary replacement (M13) and the
metric record (M14)."""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ACCOUNT

SUMMARY_ROWS = 20_000
SUMMARY_TOP = 30


def gain_importance(spark: SparkSession, model: GBTClassificationModel, feature_cols: list[str]) -> DataFrame:
    """MLlib's impurity-gain importance per feature (normalised to sum 1), as a table.

    The vector has one entry per feature, so the table is bounded by the feature count.
    """
    imp = model.featureImportances.toArray().tolist()
    rows = [(name, float(imp[i]) if i < len(imp) else 0.0) for i, name in enumerate(feature_cols)]
    return spark.createDataFrame(rows, "feature string, gain double")


def sampled_rows(matrix: DataFrame, seed: int, max_rows: int) -> DataFrame:
    """About ``max_rows`` rows by a hash of the account, so that a lost task samples the same rows again; spread over tasks."""
    share = min(1.0, max_rows / max(matrix.count(), 1))
    place = F.pmod(F.xxhash64(F.col(ACCOUNT), F.lit(seed)), F.lit(1 << 30))
    tasks = max(1, matrix.sparkSession.sparkContext.defaultParallelism)
    return matrix.filter(place < F.lit(int(share * (1 << 30)))).select(ACCOUNT, "features").repartition(tasks, ACCOUNT)


def median_substitution_summary(
    model: GBTClassificationModel,
    matrix: DataFrame,
    feature_cols: list[str],
    wide: DataFrame,
    seed: int,
    max_rows: int = SUMMARY_ROWS,
    top: int = SUMMARY_TOP,
) -> DataFrame:
    """M13, re-aimed: mean |change of the predicted probability| when one feature is set to
    its median, over about ``max_rows`` sampled rows; the ``top`` features by that mean.

    This is a different measure than SHAP values (the reference draws a SHAP plot on the
    driver); it is computed as Spark jobs: sampled rows x features are exploded (bounded by
    max_rows x features), rescored by the model, and averaged per feature.
    """
    spark = matrix.sparkSession
    sample = sampled_rows(matrix, seed, max_rows)
    medians = wide.approxQuantile(feature_cols, [0.5], 0.001)  # one number per feature
    med = [float(m[0]) if m and m[0] is not None and not math.isnan(m[0]) else 0.0 for m in medians]
    base = model.transform(sample).select(ACCOUNT, vector_to_array("probability")[1].alias("p0"))
    med_arr = F.array(*[F.lit(v) for v in med])
    arr = vector_to_array("features")
    exploded = sample.select(ACCOUNT, arr.alias("x"), F.posexplode(med_arr).alias("j", "m"))
    changed = exploded.select(
        ACCOUNT,
        "j",
        array_to_vector(F.transform("x", lambda v, i: F.when(i == F.col("j"), F.col("m")).otherwise(v))).alias("features"),
    )
    scored = model.transform(changed).select(ACCOUNT, "j", vector_to_array("probability")[1].alias("pj"))
    names = spark.createDataFrame(list(enumerate(feature_cols)), "j int, feature string")
    per_feature = (
        scored.join(base, ACCOUNT, "inner")
        .groupBy("j")
        .agg(F.avg(F.abs(F.col("pj") - F.col("p0"))).alias("mean_abs_change"))
        .join(F.broadcast(names), "j", "inner")
    )
    return per_feature.orderBy(F.desc("mean_abs_change"), F.asc("feature")).limit(top).select("feature", "mean_abs_change")


def node_table(spark: SparkSession, model_path: str) -> DataFrame:
    """The nodes of a saved model as rows: tree, node, left, right (-1 at a leaf), split, prediction, gain, count."""
    n = F.col("nodeData")
    return spark.read.parquet(f"{model_path}/data").select(
        F.col("treeID").alias("tree"),
        n["id"].alias("node"),
        n["leftChild"].alias("left"),
        n["rightChild"].alias("right"),
        n["split"]["featureIndex"].alias("feature"),
        F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        n["prediction"].alias("prediction"),
        n["gain"].alias("gain"),
        F.get(n["impurityStats"], F.lit(0)).alias("count"),
    )


def rescore(rows: DataFrame, nodes: DataFrame, tree_weights: list[float], depth: int) -> DataFrame:
    """``ACCOUNT_ID, probability`` from the node table alone: every row walks down every tree.

    A second way to the scores of M11 that shares nothing with the fitted object but its nodes; the
    node table is bounded by trees x 2^depth.
    """
    trees = F.array(*[F.struct(F.lit(i).alias("tree"), F.lit(float(w)).alias("weight")) for i, w in enumerate(tree_weights)])
    at = rows.select(ACCOUNT, vector_to_array("features").alias("x"), F.explode(trees).alias("t")).select(
        ACCOUNT, "x", "t.tree", "t.weight", F.lit(0).alias("node")
    )
    inner = F.broadcast(nodes.filter("left >= 0").select("tree", "node", "left", "right", "feature", "threshold"))
    for _ in range(depth):
        goes = F.when(F.get("x", F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        at = at.join(inner, ["tree", "node"], "left").select(ACCOUNT, "x", "tree", "weight", F.coalesce(goes, F.col("node")).alias("node"))
    leaves = F.broadcast(nodes.select("tree", "node", "prediction"))
    margin = at.join(leaves, ["tree", "node"]).groupBy(ACCOUNT).agg(F.sum(F.col("weight") * F.col("prediction")).alias("m"))
    return margin.select(ACCOUNT, (1 / (1 + F.exp(-2 * F.col("m")))).alias("probability"))


def gain_from_nodes(nodes: DataFrame) -> DataFrame:
    """``feature, gain``: weighted gain of each feature's splits as a share of all, from the node table."""
    splits = nodes.filter("left >= 0").groupBy("feature").agg(F.sum(F.col("gain") * F.col("count")).alias("g"))
    whole = splits.agg(F.sum("g").alias("whole"))
    return splits.withColumn("whole", F.lit(whole.first()["whole"])).select("feature", (F.col("g") / F.col("whole")).alias("gain"))


def metric_record(
    auc: float,
    precision: float,
    recall: float,
    best_iteration: int,
    scale_pos_weight: float,
    best_search_auc: float,
    final_rows: int,
    final_rounds: int,
) -> dict:
    """The eight published metric keys (names are fixed values of the output format)."""
    return {
        "auc_roc": float(auc),
        "precision_at_10pct": float(precision),
        "recall_at_10pct": float(recall),
        "best_iteration": int(best_iteration),
        "scale_pos_weight": float(scale_pos_weight),
        "optuna_best_auc": float(best_search_auc),
        "final_train_rows": int(final_rows),
        "final_num_boost_round": int(final_rounds),
    }
