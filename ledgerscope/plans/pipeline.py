"""The end-to-end run: resolve -> read -> normalise -> feature store -> model -> sinks.

``run_pipeline`` replaces the command-line ``main`` of the reference; the caller passes a
``PipelineConfig`` and owns the SparkSession. ``work_dir`` and ``output_dir`` must be
shared folders (HDFS / object store) on a cluster.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..config import PipelineConfig
from ..sources import sinks
from ..sources.normalize import InputError, Inputs, RawInputs, normalize_inputs
from ..sources.readers import read_any, resolve_inputs
from ..session import ensure_checkpoint_dir
from .feature_job import build_features
from .model_job import ModelRun, train_and_score


@dataclass
class PipelineResult:
    features: DataFrame
    run: ModelRun
    paths: dict


def discover(spark: SparkSession, cfg: PipelineConfig) -> dict[str, list[str]]:
    """S1 + S8: find the inputs and fail on the driver, before any job, if one is missing."""
    found = resolve_inputs(spark, cfg.data_dir)
    missing = [name for name, paths in found.items() if not paths]
    if missing:
        raise InputError(f"{cfg.data_dir} holds nothing that looks like: {', '.join(missing)}")
    return found


def read_inputs(
    spark: SparkSession,
    found: dict[str, list[str]],
    labels_schema: T.StructType | None = None,
    test_schema: T.StructType | None = None,
    cfg: PipelineConfig | None = None,
) -> RawInputs:
    """S2-S6 for the five inputs (CSV schemas explicit when given, inferred otherwise).

    With ``cfg`` the facts' scans leave out what lies after the cutoff where the stored type allows.
    """
    trx_cut, bal_cut = ({c: cfg.cutoff_date} for c in (cfg.columns.txn_date_col, cfg.columns.balance_date_col)) if cfg else (None, None)
    return RawInputs(
        transactions=read_any(spark, found["transactions"], before=trx_cut),
        balances=read_any(spark, found["balances"], before=bal_cut),
        kyc=read_any(spark, found["kyc"]),
        labels=read_any(spark, found["train_labels"], "csv", labels_schema),
        test_ids=read_any(spark, found["test_ids"], "csv", test_schema),
    )


def build_feature_store(
    spark: SparkSession,
    cfg: PipelineConfig,
    labels_schema: T.StructType | None = None,
    test_schema: T.StructType | None = None,
) -> tuple[Inputs, DataFrame, str]:
    """Path A: resolve, read, normalise, build and write the stamped store (or reuse it).

    Returns the canonical inputs, the store read back (its lineage is a Parquet scan, not the
    whole job) and the store's path.
    """
    if not cfg.cutoff_date:
        raise InputError("a run needs a cutoff date")
    # the run's work dir is shared storage: use it for checkpoints when the session names none
    ensure_checkpoint_dir(spark, fallback=f"{cfg.work_dir.rstrip('/')}/checkpoints")
    found = discover(spark, cfg)
    inp = normalize_inputs(read_inputs(spark, found, labels_schema, test_schema, cfg), cfg.cutoff_date, cfg.columns)
    store = f"{cfg.work_dir.rstrip('/')}/account_features"
    if not (cfg.reuse_feature_store and sinks.feature_store_exists(spark, store)):
        built = build_features(inp, cfg.cutoff_date, cfg.broadcast_max_rows).features
        sinks.write_feature_store(built, store, cfg.cutoff_date)
    return inp, sinks.read_feature_store(spark, store, cfg.cutoff_date), store


def run_pipeline(
    spark: SparkSession,
    cfg: PipelineConfig,
    labels_schema: T.StructType | None = None,
    test_schema: T.StructType | None = None,
    summary: bool = True,
) -> PipelineResult:
    inp, features, store = build_feature_store(spark, cfg, labels_schema, test_schema)

    run = train_and_score(features, inp.labels, inp.kyc, inp.test_ids, cfg)
    out = cfg.output_dir.rstrip("/")
    paths = {
        "feature_store": store,
        "predictions": f"{out}/predictions",
        "metrics": f"{out}/metrics",
        "config": f"{out}/config",
        "importance": f"{out}/feature_importance",
        "model": f"{out}/gbt_churn_model",
        "trials": f"{out}/search_trials",
        "summary": f"{out}/driver_summary",
    }
    try:
        sinks.write_predictions(run.predictions, paths["predictions"])
        sinks.write_record(spark, run.metrics, paths["metrics"])
        sinks.write_record(spark, cfg.to_dict(), paths["config"])
        sinks.write_importance(run.importance, paths["importance"])
        run.save(paths["model"])
        run.trials_table().coalesce(1).write.mode("overwrite").json(paths["trials"])
        if summary:
            run.summary(features, cfg.random_seed).coalesce(1).write.mode("overwrite").option("header", "true").csv(paths["summary"])
    finally:
        run.matrix.data.unpersist()
    return PipelineResult(features, run, paths)
