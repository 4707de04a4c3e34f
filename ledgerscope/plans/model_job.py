"""Paths B and C: feature table -> labelled matrix -> search -> metrics -> refit -> scores.

The matrix is built from the feature table (normally read back from the written store, so
its lineage is a Parquet scan), assembled into one vector column and cached. Two engines fit on
it: ``leafwise`` (``model/boost.py``, the published parameters: leaf-wise growth, L1 / L2 leaf
penalties, an end by validation AUC) and ``mllib``. Nothing is collected but parameters, trees and
metrics.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ACCOUNT, PipelineConfig
from ..model import boost
from ..model import labels as L
from ..model.evaluate import SUMMARY_ROWS, SUMMARY_TOP, gain_importance, median_substitution_summary, metric_record, sampled_rows
from ..model.search import SearchResult, draw_params, successive_halving
from ..model.train import Trial, assemble, best_trial, cached, fit_with_validation, positive_probability, random_search, refit
from ..model.trees import BoostedTrees, attribute, mean_contributions
from ..operators.ranking import top_fraction_metrics
from ..sources import sinks

KEEP = [ACCOUNT, "CHURN", "is_valid", "in_sample", "weight"]


@dataclass
class Matrix:
    data: DataFrame  # every labelled row: ACCOUNT_ID, CHURN, is_valid, in_sample, weight, features (cached)
    feature_cols: list[str]
    scale_pos_weight: float
    rows: int

    @property
    def fit(self) -> DataFrame:
        """The rows the search and the validated fit use: validation + sampled train rows."""
        return self.data.filter(F.col("in_sample"))


@dataclass
class ModelRun:
    model: object
    final_model: object
    matrix: Matrix
    trials: list[Trial] | SearchResult
    metrics: dict
    predictions: DataFrame
    importance: DataFrame
    extra: dict = field(default_factory=dict)

    def trials_table(self) -> DataFrame:
        spark = self.predictions.sparkSession
        return self.trials.table(spark) if isinstance(self.trials, SearchResult) else trials_frame(spark, self.trials)

    def summary(self, features: DataFrame, seed: int) -> DataFrame:
        """The features that move the margins most (leafwise: exact contributions; mllib: medians put in)."""
        m = self.matrix
        if not isinstance(self.final_model, BoostedTrees):
            return median_substitution_summary(self.final_model, m.data, m.feature_cols, features, seed)
        found = attribute(self.final_model, sampled_rows(m.data, seed, SUMMARY_ROWS))
        return mean_contributions(found, m.feature_cols, SUMMARY_TOP)

    def save(self, path: str) -> None:
        """S14."""
        if isinstance(self.final_model, BoostedTrees):
            self.final_model.save(self.predictions.sparkSession, path)
        else:
            sinks.save_model(self.final_model, path)


def labelled_matrix(features: DataFrame, labels: DataFrame, kyc: DataFrame, cfg: PipelineConfig) -> Matrix:
    lab = L.prepare_labels(labels, kyc)
    tm = L.time_split(L.train_matrix(features, lab), cfg.valid_frac)
    tm = tm.withColumn("in_sample", L.sample_flag(cfg.train_sample_frac, cfg.random_seed))
    counts = L.class_counts(tm.filter(F.col("in_sample"))).first()
    scale = float(counts["scale_pos_weight"])
    cols = L.feature_columns(features)
    data = cached(assemble(L.with_weights(tm, scale), cols, KEEP))
    return Matrix(data, cols, scale, data.count())


def _full_weights(m: Matrix) -> DataFrame:
    """Every labelled row (sampled or not), weights recomputed over them."""
    full_counts = m.data.agg(F.sum("CHURN").alias("p"), F.count(F.lit(1)).alias("n")).first()
    pos = max(1, int(full_counts["p"] or 0))
    neg = max(1, int(full_counts["n"]) - int(full_counts["p"] or 0))
    return m.data.withColumn("weight", F.when(F.col("CHURN") == 1, F.lit(neg / pos)).otherwise(F.lit(1.0)))


def _leafwise(m: Matrix, to_score: DataFrame, cfg: PipelineConfig) -> ModelRun:
    spark = m.data.sparkSession
    rates = (cfg.step_size_min, cfg.step_size_max)
    params = [draw_params(cfg.random_seed, i, rates) for i in range(cfg.search_trials)]
    # the winner of the search goes on where it stands, with the final fit's patience
    found = successive_halving(m.fit, m.feature_cols, params, cfg.search_first_rounds, cfg.final_max_iter, cfg.final_patience, cfg.random_seed)
    searched = [r.auc for r in found.rungs if r.rung == max(0, found.rungs[-1].rung - 1) and r.trial == found.trial]
    valid = m.data.filter(F.col("is_valid"))
    scored = found.model.score(valid).join(valid.select(ACCOUNT, "CHURN"), ACCOUNT)
    pr = top_fraction_metrics(scored, cfg.top_frac, "CHURN", "score", ACCOUNT).first()
    final = boost.refit(_full_weights(m), m.feature_cols, found.params, found.rounds, cfg.random_seed)
    predictions = final.score(to_score, "CHURN_PROB")
    metrics = metric_record(
        found.auc, pr["precision"], pr["recall"], found.rounds, m.scale_pos_weight, searched[0], m.rows, found.rounds
    )
    return ModelRun(found.model, final, m, found, metrics, predictions, final.gains(spark))


def train_and_score(
    features: DataFrame, labels: DataFrame, kyc: DataFrame, test_ids: DataFrame, cfg: PipelineConfig
) -> ModelRun:
    """The whole model half. The matrix stays cached for the caller's read-outs (``ModelRun.matrix.data``)."""
    spark = features.sparkSession
    m = labelled_matrix(features, labels, kyc, cfg)
    to_score = assemble(L.score_matrix(features, test_ids), m.feature_cols, [ACCOUNT])
    if cfg.engine == "leafwise":
        return _leafwise(m, to_score, cfg)
    step_sizes = (cfg.step_size_min, cfg.step_size_max)
    trials = random_search(m.fit, cfg.search_trials, cfg.search_max_iter, cfg.search_patience, cfg.random_seed, step_sizes)
    best = best_trial(trials)
    model, auc = fit_with_validation(m.fit, best.params, cfg.final_max_iter, cfg.final_patience, cfg.random_seed)
    best_iteration = model.getNumTrees
    valid = positive_probability(model, m.data.filter(F.col("is_valid")))
    pr = top_fraction_metrics(valid, cfg.top_frac, "CHURN", "score", ACCOUNT).first()
    final_model = refit(_full_weights(m), best.params, best_iteration, cfg.random_seed)
    predictions = positive_probability(final_model, to_score, "CHURN_PROB").select(ACCOUNT, "CHURN_PROB")
    metrics = metric_record(
        auc, pr["precision"], pr["recall"], best_iteration, m.scale_pos_weight, best.auc, m.rows, best_iteration
    )
    importance = gain_importance(spark, final_model, m.feature_cols)
    return ModelRun(model, final_model, m, trials, metrics, predictions, importance)


def trials_frame(spark, trials: list[Trial]) -> DataFrame:
    rows = [
        (t.trial, t.params.stepSize, t.params.maxDepth, t.params.minInstancesPerNode, t.params.subsamplingRate,
         t.params.featureFraction, t.params.minInfoGain, t.trees, t.auc)
        for t in trials
    ]
    return spark.createDataFrame(
        rows,
        "trial int, step_size double, max_depth int, min_instances int, subsampling double, "
        "feature_fraction double, min_info_gain double, trees int, auc double",
    )
