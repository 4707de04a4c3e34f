"""Model stage: exact AUC vs MLlib, top-fraction bounds, planted-signal fit, guards."""

import math

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from ledgerscope.config import ACCOUNT, PipelineConfig
from ledgerscope.model import labels as L
from ledgerscope.model.train import GBTParams, fit_with_validation
from ledgerscope.operators.ranking import roc_auc, top_fraction_metrics
from ledgerscope.plans import catalog
from ledgerscope.plans.feature_job import build_features
from ledgerscope.plans.model_job import labelled_matrix
from ledgerscope.sources.normalize import InputError
from ledgerscope.sources.sinks import StaleFeatureStore, read_feature_store, write_feature_store

from conftest import MEDIUM, SMALL


@pytest.fixture(scope="module")
def store(spark):
    inp = catalog.fixture(spark, MEDIUM)
    return inp, build_features(inp, catalog.CUTOFF).features.cache()


def test_exact_auc_equals_mllib_unbinned(spark, store):
    inp, feats = store
    m = L.train_matrix(feats, L.prepare_labels(inp.labels, inp.kyc))
    scored = m.select(ACCOUNT, "CHURN", F.col("out_days_since_last_transaction").cast("double").alias("score"))
    ours = roc_auc(scored).first()["auc"]
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="CHURN", metricName="areaUnderROC", numBins=0)
    theirs = ev.evaluate(scored.withColumn("CHURN", F.col("CHURN").cast("double")))
    assert abs(ours - theirs) < 1e-12


def test_top_fraction_bounds(spark, store):
    inp, feats = store
    m = L.train_matrix(feats, L.prepare_labels(inp.labels, inp.kyc))
    scored = m.select(ACCOUNT, "CHURN", F.col("out_txn_count_90d").cast("double").alias("score"))
    r = top_fraction_metrics(scored, 0.1).first()
    assert r["n_top"] == max(1, math.ceil(m.count() * 0.1))
    assert 0 <= r["precision"] <= 1 and 0 <= r["recall"] <= 1


def test_planted_signal_is_learned(spark, store):
    inp, feats = store
    # planted label: inactive in the last 60 days, with seeded hash noise on 10 % of rows
    noise = F.substring(F.md5(F.col(ACCOUNT).cast("string")), 1, 1).isin("0", "1")
    planted = feats.select(
        ACCOUNT,
        (F.when(noise, F.col("out_txn_count_60d") > 0).otherwise(F.col("out_txn_count_60d") == 0)).cast("int").alias("CHURN"),
    )
    cfg = PipelineConfig(cutoff_date=catalog.CUTOFF, valid_frac=0.2)
    m = labelled_matrix(feats, planted, inp.kyc, cfg)
    model, auc = fit_with_validation(m.fit, GBTParams(maxDepth=3, minInstancesPerNode=5), 200, 5, 42)
    assert model.getNumTrees >= 1
    assert auc > 0.8


def test_split_without_date_column_refuses(spark):
    df = spark.createDataFrame([(1, 0)], "ACCOUNT_ID long, CHURN int")
    with pytest.raises(L.NoSplitColumn):
        L.time_split(df, 0.2)


def test_missing_inputs_raise_before_any_job(spark, tmp_path):
    from ledgerscope.plans.pipeline import discover

    with pytest.raises(InputError):
        discover(spark, PipelineConfig(data_dir=str(tmp_path)))


def test_feature_store_stamp_refuses_other_cutoff(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0)], "ACCOUNT_ID long, x double")
    write_feature_store(df, str(tmp_path / "fs"), "2024-01-01")
    assert read_feature_store(spark, str(tmp_path / "fs"), "2024-01-01").count() == 1
    with pytest.raises(StaleFeatureStore):
        read_feature_store(spark, str(tmp_path / "fs"), "2024-02-01")


def test_sampling_shrinks_the_fit_rows_but_not_the_refit_rows(spark, store):
    inp, feats = store
    full = labelled_matrix(feats, inp.labels, inp.kyc, PipelineConfig(cutoff_date=catalog.CUTOFF, train_sample_frac=1.0))
    half = labelled_matrix(feats, inp.labels, inp.kyc, PipelineConfig(cutoff_date=catalog.CUTOFF, train_sample_frac=0.5))
    assert half.rows == full.rows == full.fit.count()
    n_valid = half.data.filter(F.col("is_valid")).count()
    assert n_valid < half.fit.count() < full.rows
    assert half.fit.filter(F.col("is_valid")).count() == n_valid
    full.data.unpersist()
    half.data.unpersist()


def test_ranking_metrics_on_empty_and_tiny_inputs(spark):
    empty = spark.createDataFrame([], "ACCOUNT_ID long, CHURN int, score double")
    r = roc_auc(empty).first()
    assert r["auc"] is None and r["positives"] == 0
    t = top_fraction_metrics(empty, 0.1).first()
    assert t["n_top"] == 1 and t["true_positives"] == 0 and t["recall"] == 0.0
    tiny = spark.createDataFrame([(1, 1, 0.9), (2, 0, 0.9), (3, 0, 0.1)], "ACCOUNT_ID long, CHURN int, score double")
    assert roc_auc(tiny).first()["auc"] == 0.75  # the positive ties one negative (1/2) and beats the other
    top = top_fraction_metrics(tiny, 0.5).first()  # n_top = 2: both 0.9 rows
    assert (top["n_top"], top["true_positives"], top["recall"]) == (2, 1, 1.0)


def test_bucketed_prefix_path_gives_the_same_metrics(spark, store):
    """Force many quantile buckets (the path taken above a million distinct scores)."""
    inp, feats = store
    m = L.train_matrix(feats, L.prepare_labels(inp.labels, inp.kyc))
    continuous = m.select(ACCOUNT, "CHURN", (F.col("out_txn_sum_90d") / 1000 + F.col(ACCOUNT) / 1e7).alias("score"))
    tied = m.select(ACCOUNT, "CHURN", F.col("out_days_since_last_transaction").cast("double").alias("score"))
    for scored in (continuous, tied):
        one = roc_auc(scored).first()["auc"]
        many = roc_auc(scored, rows_per_bucket=25).first()["auc"]
        ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="CHURN", numBins=0)
        assert abs(one - many) < 1e-12 and abs(one - ev.evaluate(scored.withColumn("CHURN", F.col("CHURN").cast("double")))) < 1e-12
        a = top_fraction_metrics(scored, 0.1).first()
        b = top_fraction_metrics(scored, 0.1, rows_per_bucket=7).first()
        assert a == b


def test_a_fit_goes_on_after_one_bad_round_and_ends_by_patience(spark, monkeypatch):
    """The loss rises once, falls to its lowest in round 9 and rises for good: nine rounds are kept."""
    from ledgerscope.model import train as T

    losses = [1.0, 0.8, 0.9, 0.7, 0.75, 0.6, 0.65, 0.55, 0.5] + [0.6 + i / 100 for i in range(40)]
    fits = []

    class Fitted:
        def __init__(self, rounds):
            self.getNumTrees = rounds

        def evaluateEachIteration(self, valid):
            return losses[: self.getNumTrees]

    class Booster:
        def __init__(self, rounds):
            self.rounds = rounds

        def fit(self, train):
            fits.append(self.rounds)
            return Fitted(self.rounds)

    monkeypatch.setattr(T, "gbt", lambda params, rounds, seed: Booster(rounds))
    monkeypatch.setattr(T, "positive_probability", lambda model, df: df.selectExpr("CHURN", "0.5D AS score"))
    matrix = spark.createDataFrame([(1, True), (0, True), (1, False)], "CHURN int, is_valid boolean")
    model, auc = T.fit_with_validation(matrix, GBTParams(), 5_000, 3, 1)
    assert model.getNumTrees == 9 and auc == 0.5
    assert fits == [6, 12, 9]  # doubled until patience ran out, then the prefix


def test_the_search_draws_from_the_whole_published_ranges():
    import numpy as np

    from ledgerscope.model.train import sample_params

    drawn = [sample_params(np.random.default_rng(i), (0.005, 0.08)) for i in range(400)]
    assert {p.maxDepth for p in drawn} == set(range(4, 15))
    assert min(p.stepSize for p in drawn) < 0.006 and max(p.stepSize for p in drawn) > 0.07
    defaults = PipelineConfig()
    assert (defaults.search_trials, defaults.search_patience, defaults.final_patience) == (50, 150, 250)


def test_tied_big_keys_do_not_depend_on_row_order(spark):
    rows = [((1 << 60) + i, int(i < 5), 1.0) for i in range(20)]
    for order in (rows, rows[::-1], rows[7:] + rows[:7]):
        df = spark.createDataFrame(order, "ACCOUNT_ID long, CHURN int, score double").repartition(3)
        for bucket in (1_000_000, 3):
            assert top_fraction_metrics(df, 0.25, rows_per_bucket=bucket).first()["true_positives"] == 5
    named = spark.createDataFrame([(f"k{i:02d}", int(i < 5), 1.0) for i in range(20)], "ACCOUNT_ID string, CHURN int, score double")
    assert top_fraction_metrics(named, 0.25).first()["true_positives"] == 5


def test_rows_without_a_score_rank_last_in_both_metrics(spark):
    rows = [(i, 1, 0.9) for i in range(5)] + [(i, 0, 0.1) for i in range(5, 20)] + [(i, 0, None) for i in range(20, 23)] + [(23, 0, float("nan"))]
    df = spark.createDataFrame(rows, "ACCOUNT_ID long, CHURN int, score double")
    assert top_fraction_metrics(df, 0.2).first()["precision"] == 1.0
    assert roc_auc(df).first().asDict() == {"auc": 1.0, "positives": 5, "negatives": 19}


def test_a_failed_store_write_leaves_no_stamp(spark, tmp_path):
    from ledgerscope.sources.sinks import feature_store_exists

    path = str(tmp_path / "fs")
    write_feature_store(spark.createDataFrame([(1, 2.0)], "ACCOUNT_ID long, x double"), path, "2024-01-01")
    bad = spark.createDataFrame([(1, 2.0)], "ACCOUNT_ID long, x double").withColumn("x", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        write_feature_store(bad, path, "2024-01-01")
    assert not feature_store_exists(spark, path)


def test_the_fill_leaves_the_key_alone(spark):
    from ledgerscope.operators.assemble import fill_missing

    row = fill_missing(spark.createDataFrame([(None, None, None)], "ACCOUNT_ID long, gap_days double, x double")).first()
    assert (row["ACCOUNT_ID"], row["gap_days"], row["x"]) == (None, 9999.0, 0.0)
