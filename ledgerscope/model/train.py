"""Distributed boosted trees on MLlib: fit with early stopping (M6), seeded random
search (M7), refit on all labelled rows (M10) and scoring (M11).

The reference fits its booster on the driver; here every fit is a Spark job over the
cached assembled matrix (one vector column, not the 233-column row), and only scalars
(parameters, tree counts, metrics) reach Python.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

import numpy as np
from pyspark import SparkContext, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ACCOUNT
from ..operators.ranking import roc_auc

# --------------------------------------------------------------------------------------
# The tuning ranges of the published search, mapped to MLlib parameters.
#   learning_rate 0.005-0.08 (log) -> stepSize; max_depth 4-14 -> maxDepth;
#   min_child_samples 20-500 -> minInstancesPerNode; subsample 0.6-1.0 -> subsamplingRate;
#   colsample_bytree 0.6-1.0 -> featureSubsetStrategy (per node in MLlib).
#   L1 / L2 penalties have no counterpart; minInfoGain takes their place, over a range of ours.
# --------------------------------------------------------------------------------------
MAX_DEPTH_RANGE = (4, 14)
MIN_INSTANCES_RANGE = (20, 500)
SUBSAMPLING_RANGE = (0.6, 1.0)
FEATURE_FRACTION_RANGE = (0.6, 1.0)
MIN_INFO_GAIN_RANGE = (1e-6, 1e-3)


@dataclass
class GBTParams:
    stepSize: float = 0.05
    maxDepth: int = 5
    minInstancesPerNode: int = 20
    subsamplingRate: float = 1.0
    featureFraction: float = 1.0
    minInfoGain: float = 0.0

    def to_dict(self) -> dict:
        return asdict(self)


def _log_uniform(rng: np.random.Generator, low: float, high: float) -> float:
    return float(np.exp(rng.uniform(np.log(low), np.log(high))))


def sample_params(rng: np.random.Generator, step_sizes: tuple[float, float]) -> GBTParams:
    return GBTParams(
        stepSize=_log_uniform(rng, *step_sizes),
        maxDepth=int(rng.integers(MAX_DEPTH_RANGE[0], MAX_DEPTH_RANGE[1] + 1)),
        minInstancesPerNode=int(rng.integers(MIN_INSTANCES_RANGE[0], MIN_INSTANCES_RANGE[1] + 1)),
        subsamplingRate=float(rng.uniform(*SUBSAMPLING_RANGE)),
        featureFraction=float(rng.uniform(*FEATURE_FRACTION_RANGE)),
        minInfoGain=_log_uniform(rng, *MIN_INFO_GAIN_RANGE),
    )


def assemble(df: DataFrame, feature_cols: list[str], keep: list[str]) -> DataFrame:
    """Vector column + the few columns training needs (the wide row is dropped)."""
    va = VectorAssembler(inputCols=feature_cols, outputCol="features", handleInvalid="keep")
    return va.transform(df).select(*keep, "features")


def gbt(params: GBTParams, rounds: int, seed: int) -> GBTClassifier:
    return GBTClassifier(
        featuresCol="features",
        labelCol="CHURN",
        weightCol="weight",
        maxIter=rounds,
        stepSize=params.stepSize,
        maxDepth=params.maxDepth,
        minInstancesPerNode=params.minInstancesPerNode,
        minInfoGain=params.minInfoGain,
        subsamplingRate=params.subsamplingRate,
        featureSubsetStrategy="all" if params.featureFraction >= 0.999 else f"{params.featureFraction:.4f}",
        maxBins=32,
        seed=seed,
        cacheNodeIds=True,
        checkpointInterval=10,
    )


def positive_probability(model: GBTClassificationModel, df: DataFrame, out_col: str = "score") -> DataFrame:
    """Probability of the positive class as a double column."""
    return model.transform(df).withColumn(out_col, vector_to_array(F.col("probability")).getItem(1))


@dataclass
class Trial:
    trial: int
    params: GBTParams
    trees: int
    auc: float


def best_round(losses: list[float]) -> int:
    """Number of rounds with the lowest loss, the fewest on a tie."""
    return int(np.argmin(losses)) + 1


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model after its first rounds: the trees and weights that a fit of so many rounds with the same seed has."""
    context = SparkContext._active_spark_context
    jvm, java = context._jvm, model._java_obj
    trees = context._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = context._gateway.new_array(jvm.double, rounds)
    for i, (tree, weight) in enumerate(zip(list(java.trees())[:rounds], model.treeWeights)):
        trees[i], weights[i] = tree, float(weight)
    prefix = GBTClassificationModel(jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), trees, weights))
    return model._copyValues(prefix)


def fit_with_validation(
    matrix: DataFrame, params: GBTParams, limit: int, patience: int, seed: int
) -> tuple[GBTClassificationModel, float]:
    """M6: boost on the train rows until the validation loss has not improved for ``patience`` rounds.

    The kept model is the prefix with the lowest validation loss; also returns its AUC on the
    validation rows. MLlib can't go on from a fitted model, so the number of rounds is doubled
    until the loss has risen for long enough (equal seeds give equal first rounds), which costs at
    most about twice the last fit. The prefix consists of that fit's first trees.
    """
    train, valid = matrix.filter(~F.col("is_valid")), matrix.filter(F.col("is_valid"))
    rounds = min(limit, 2 * patience)
    if valid.isEmpty():
        return gbt(params, rounds, seed).fit(train), float("nan")
    while True:
        model = gbt(params, rounds, seed).fit(train)
        best = best_round(model.evaluateEachIteration(valid))
        if rounds - best >= patience or rounds >= limit:
            break
        rounds = min(limit, 2 * rounds)
    if best < rounds:
        # MLlib's model gives its prefix; one of another booster, whose trees aren't known here, is fitted again
        model = first_rounds(model, best) if isinstance(model, GBTClassificationModel) else gbt(params, best, seed).fit(train)
    auc = roc_auc(positive_probability(model, valid), "CHURN", "score").first()["auc"]
    return model, float(auc) if auc is not None else float("nan")


def random_search(
    matrix: DataFrame, trials: int, limit: int, patience: int, seed: int, step_sizes: tuple[float, float]
) -> list[Trial]:
    """M7: seeded random search over the published ranges, maximising validation AUC."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(trials):
        params = sample_params(rng, step_sizes)
        model, auc = fit_with_validation(matrix, params, limit, patience, seed)
        out.append(Trial(i, params, model.getNumTrees, auc))
    return out


def best_trial(trials: list[Trial]) -> Trial:
    return max(trials, key=lambda t: (t.auc if t.auc == t.auc else -1.0, -t.trial))


def refit(full: DataFrame, params: GBTParams, rounds: int, seed: int) -> GBTClassificationModel:
    """All labelled rows, the chosen parameters and round count, no validation part."""
    return gbt(params, max(1, rounds), seed).fit(full)


def cached(df: DataFrame) -> DataFrame:
    """The assembled matrix is read by every trial: keep it (spilling to disk if needed), in one partition a core.

    Each level of a tree shuffles the sums of all open nodes (features x bins each) once per partition, however few
    rows it has, so partitions beyond the cores would only add to the shuffle.
    """
    return df.coalesce(max(1, df.sparkSession.sparkContext.defaultParallelism)).persist(StorageLevel.MEMORY_AND_DISK)


__all__ = [
    "ACCOUNT",
    "GBTParams",
    "Trial",
    "assemble",
    "best_round",
    "best_trial",
    "cached",
    "first_rounds",
    "fit_with_validation",
    "gbt",
    "positive_probability",
    "random_search",
    "refit",
    "sample_params",
]
