"""Registered queries (one per operator group of the inventory) and their DuckDB oracles.

Every query reads the driver's test tables through the wallet fixtures, so its work grows
with them; none runs on made-up input. Doubles are rounded to 4 digits on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ACCOUNT, BALANCE_AGGREGATES, ColumnMap, PipelineConfig
from ..functions.exprs import days_before, round_doubles, window_sql
from ..model import labels as L
from ..model.boost import Boosting, LeafParams
from ..model.evaluate import gain_from_nodes, median_substitution_summary, node_table, rescore
from ..model.search import draw_params, successive_halving
from ..model.train import GBTParams, assemble, fit_with_validation, positive_probability, random_search
from ..model.trees import attribute
from ..operators.assemble import CROSS_FEATURES, median_impute
from ..operators.balances import balance_feature_names, balance_features
from ..operators.dimension import kyc_features
from ..operators.population import Population, population_ids
from ..operators.ranking import roc_auc, top_fraction_metrics
from ..operators.transactions import TYPE_NAMES, derived_names, directed_rows, feature_names, transaction_features
from ..session import shared_dir
from ..sources.fixtures import (
    FIXTURE_CUTOFF,
    fixture_columns,
    fixture_inputs,
    wallet_labels,
    wallet_trx,
    write_fixture_layout,
    write_nanos_copy,
)
from ..sources.normalize import Inputs, asof_filter, canonical_transactions, normalize_inputs
from ..sources.readers import read_any, read_parquet, resolve_inputs
from ..sources.sinks import read_feature_store, save_model, write_feature_store, write_predictions
from . import oracle as O
from .feature_job import build_features
from .model_job import labelled_matrix, train_and_score, trials_frame
from .pipeline import discover, read_inputs, run_pipeline

CUTOFF = FIXTURE_CUTOFF


def fixture(spark: SparkSession, sf_dir: str) -> Inputs:
    return normalize_inputs(fixture_inputs(spark, sf_dir), CUTOFF, fixture_columns())


def fixture_population(spark: SparkSession, inp: Inputs) -> Population:
    return Population.of(population_ids(inp.labels, inp.test_ids, inp.kyc))


def feature_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """``fixture`` with its transfers written once and read back.

    The feature job scans the transfers three times, as it does the Parquet export of a real run; over ``fixture``
    itself each of these scans would join lineitem with orders again.
    """
    inp, path = fixture(spark, sf_dir), _scratch(spark, "transfers")
    inp.transactions.write.parquet(path)
    return replace(inp, transactions=spark.read.parquet(path))


def _txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = feature_inputs(spark, sf_dir)
    return transaction_features(inp.transactions, CUTOFF, fixture_population(spark, inp))


# ----------------------------------------------------------------------------- column groups

def _txn_cols(prefix: str, group: str) -> list[str]:
    names = feature_names()
    if group == "windows":
        sel = [n for n in names if n.startswith("txn_count_") or n.startswith("txn_sum_")]
        sel = [n for n in sel if "_to_" not in n and "_vs_" not in n]
    elif group == "stats":
        sel = ["avg_txn_amount", "std_txn_amount", "max_txn_amount", "min_txn_amount", "median_txn_amount"]
    elif group == "distincts":
        sel = [n for n in names if n.startswith("unique_") or n.startswith("active_days_")]
    elif group == "types":
        sel = [f"{t}_count_90d" for t in TYPE_NAMES] + [f"{t}_count_30d" for t in TYPE_NAMES]
    elif group == "gaps":
        sel = ["max_txn_gap_days", "avg_txn_gap_days"]
    elif group == "derived":
        sel = derived_names()
    else:
        raise ValueError(group)
    return [f"{prefix}_{n}" for n in sel]


def _txn_query(prefixes: tuple[str, ...], group: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        cols = [c for p in prefixes for c in _txn_cols(p, group)]
        df = _txn(spark, sf_dir)
        if len(prefixes) == 1:
            df = df.filter(F.col(f"{prefixes[0]}_txn_count_90d").isNotNull())
        return round_doubles(df.select(ACCOUNT, *cols))

    return q


INT_COLUMNS_MARKERS = ("days_since_", "max_txn_gap_days", "account_age_days")
KYC_NAMES = ["account_age_days", "gender_idx", "region_idx", "account_type_idx"]


def feature_table_columns() -> list[str]:
    """The 233 feature names of the assembled table, in order."""
    return feature_names("out") + feature_names("in") + balance_feature_names() + KYC_NAMES + list(CROSS_FEATURES)


def _sql_type(name: str) -> str:
    """Spark result type of a feature column, for casting the oracle output."""
    base = name.split("_", 1)[1] if name.startswith(("out_", "in_")) else name
    if any(base.startswith(m) for m in INT_COLUMNS_MARKERS):
        return "INTEGER"
    if base.startswith(("txn_count_", "unique_", "active_days_", "zero_balance_days", "balance_obs")) and (
        "_to_" not in base and "_vs_" not in base
    ):
        return "BIGINT"
    if base.startswith(("p2p_count_", "bill_count_", "merchant_count_", "cashout_count_")):
        return "BIGINT"
    return "DOUBLE"


def _cast(expr: str, name: str) -> str:
    t = _sql_type(name)
    if t == "DOUBLE":
        return f"{O.round4(expr)} AS {name}"
    return f"CAST({expr} AS {t}) AS {name}"


def _txn_sql(prefixes: tuple[str, ...], group: str) -> str:
    cols = []
    for p in prefixes:
        for c in _txn_cols(p, group):
            base = c.split("_", 1)[1]
            cols.append(_cast(f"{p}_f.{base}", c))
    if len(prefixes) == 1:
        p = prefixes[0]
        src = f"{p}_f"
        key = f"{p}_f.ACCOUNT_ID"
    else:
        src = "out_f FULL OUTER JOIN in_f ON in_f.ACCOUNT_ID = out_f.ACCOUNT_ID"
        key = "COALESCE(out_f.ACCOUNT_ID, in_f.ACCOUNT_ID)"
    return f"""{O.with_all(O.base_ctes(CUTOFF), O.txn_feature_ctes(CUTOFF))}
SELECT {key} AS ACCOUNT_ID, {", ".join(cols)}
FROM {src}"""


# ----------------------------------------------------------------------------- simple operators

def q_asof_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 + S7: canonical transfers strictly before the cutoff."""
    t = fixture(spark, sf_dir).transactions
    return round_doubles(t.select(ACCOUNT, "DST_ACCOUNT_ID", "TXN_DATE", "TXN_AMOUNT", "TXN_TYPE"))


SQL_ASOF_FILTER = f"""{O.with_all(O.base_ctes(CUTOFF))}
SELECT ACCOUNT_ID, DST_ACCOUNT_ID, TXN_DATE, {O.round4("TXN_AMOUNT")} AS TXN_AMOUNT, TXN_TYPE FROM trx"""


def q_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = fixture(spark, sf_dir)
    return population_ids(inp.labels, inp.test_ids, inp.kyc)


SQL_POPULATION = f"""{O.with_all(O.base_ctes(CUTOFF))}
SELECT ACCOUNT_ID FROM population"""


def q_role_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 + J2b: incoming transfers of population accounts."""
    inp = fixture(spark, sf_dir)
    pop = fixture_population(spark, inp)
    inc = directed_rows(inp.transactions, CUTOFF, pop).filter("dir = 1")
    return round_doubles(inc.select(ACCOUNT, F.col("cp").alias("DST_ACCOUNT_ID"), "TXN_DATE", "TXN_AMOUNT", "TXN_TYPE"))


SQL_ROLE_SWAP = f"""{O.with_all(O.base_ctes(CUTOFF))}
SELECT ACCOUNT_ID, DST_ACCOUNT_ID, TXN_DATE, {O.round4("TXN_AMOUNT")} AS TXN_AMOUNT, TXN_TYPE FROM in_t"""


def q_window_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day offset and 7/30/90-day flags on the outgoing transfers."""
    inp = fixture(spark, sf_dir)
    pop = fixture_population(spark, inp)
    t = pop.semi_join(inp.transactions).withColumn("d", days_before("TXN_DATE", CUTOFF))
    flags = [f"CAST({window_sql(1, n)} AS INT) AS in_{n}d" for n in (7, 30, 90)]
    return t.selectExpr(ACCOUNT, "DST_ACCOUNT_ID", "TXN_DATE", "d AS days_before_cutoff", *flags)


SQL_WINDOW_FLAGS = f"""{O.with_all(O.base_ctes(CUTOFF))}
SELECT ACCOUNT_ID, DST_ACCOUNT_ID, TXN_DATE, CAST(d AS INTEGER) AS days_before_cutoff,
       CASE WHEN d BETWEEN 1 AND 7 THEN 1 ELSE 0 END AS in_7d,
       CASE WHEN d BETWEEN 1 AND 30 THEN 1 ELSE 0 END AS in_30d,
       CASE WHEN d BETWEEN 1 AND 90 THEN 1 ELSE 0 END AS in_90d
FROM out_t"""


# ----------------------------------------------------------------------------- balances, kyc, store

BAL_GROUPS = {
    "windows": [n for n, fn, _, _ in BALANCE_AGGREGATES if fn != "median"],
    "median": ["median_balance_30d"],
    "first_last": ["last_balance", "first_balance_90d"],
}


def _bal_group(group: str) -> list[str]:
    if group == "derived":
        names = balance_feature_names()
        return names[names.index("first_balance_90d") + 1:]
    return BAL_GROUPS[group]


def _bal_query(group: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        inp = fixture(spark, sf_dir)
        df = balance_features(inp.balances, CUTOFF, fixture_population(spark, inp))
        return round_doubles(df.select(ACCOUNT, *_bal_group(group)))

    return q


def _bal_sql(group: str) -> str:
    cols = ", ".join(_cast(n, n) for n in _bal_group(group))
    return f"""{O.with_all(O.base_ctes(CUTOFF), O.balance_feature_cte(CUTOFF))}
SELECT ACCOUNT_ID, {cols} FROM bal_f"""


def q_kyc_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P13 + M1 + U3 + J2d."""
    inp = fixture(spark, sf_dir)
    return round_doubles(kyc_features(inp.kyc, CUTOFF, fixture_population(spark, inp)))


SQL_KYC_FEATURES = f"""{O.with_all(O.base_ctes(CUTOFF), O.kyc_feature_cte(CUTOFF))}
SELECT ACCOUNT_ID, {", ".join(_cast(n, n) for n in KYC_NAMES)} FROM kyc_f"""


def _fill_value(name: str) -> str:
    return "9999" if ("days_since" in name or "gap_days" in name) else "0"


def _store_sql(fill: bool = True, columns: list[str] | None = None) -> str:
    cols = columns or feature_table_columns()
    ctes = O.feature_store_ctes(feature_names(), balance_feature_names(), KYC_NAMES, CUTOFF)
    sel = ", ".join(_cast(f"COALESCE({n}, {_fill_value(n)})" if fill else n, n) for n in cols)
    return f"""WITH {ctes}
SELECT ACCOUNT_ID, {sel} FROM joined"""


def q_feature_store_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The assembled, filled 233-feature table."""
    return round_doubles(build_features(feature_inputs(spark, sf_dir), CUTOFF).features)


def q_feature_store_large_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2a-d beyond the broadcast bound: the same table by way of the key filter and the exact join on grain rows."""
    return round_doubles(build_features(feature_inputs(spark, sf_dir), CUTOFF, broadcast_max_rows=0).features)


def q_feature_store_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9 + S10 + R3: write the store (stamped with cutoff and version) and read it back."""
    path = shared_dir(spark, f"feature_store_{uuid.uuid4().hex[:8]}")
    write_feature_store(build_features(feature_inputs(spark, sf_dir), CUTOFF).features, path, CUTOFF)
    return round_doubles(read_feature_store(spark, path, CUTOFF))


MEDIAN_IMPUTE_COLUMNS = ["avg_balance_30d", "out_avg_txn_amount", "in_median_txn_amount", "balance_std_7d"]


def q_median_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: unfilled feature columns with their exact medians put in."""
    feats = build_features(feature_inputs(spark, sf_dir), CUTOFF, fill=False).features
    df = feats.select(ACCOUNT, *MEDIAN_IMPUTE_COLUMNS)
    return round_doubles(median_impute(df, MEDIAN_IMPUTE_COLUMNS))


def _median_impute_sql() -> str:
    ctes = O.feature_store_ctes(feature_names(), balance_feature_names(), KYC_NAMES, CUTOFF)
    meds = ", ".join(f"QUANTILE_DISC({c}, 0.5) AS m_{c}" for c in MEDIAN_IMPUTE_COLUMNS)
    sel = ", ".join(_cast(f"COALESCE({c}, (SELECT m_{c} FROM meds))", c) for c in MEDIAN_IMPUTE_COLUMNS)
    return f"""WITH {ctes},
meds AS (SELECT {meds} FROM joined)
SELECT ACCOUNT_ID, {sel} FROM joined"""


# ----------------------------------------------------------------------------- labels, split, metrics


VALID_FRAC = 0.2
SAMPLE_FRAC = 0.5
SEED = 42
TOP_FRAC = 0.10
MATRIX_FEATURES = ["out_txn_count_30d", "avg_balance_30d", "account_age_days"]


def _split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled population rows with their split date (P14, J8) and ``is_valid``."""
    inp = fixture(spark, sf_dir)
    pop = fixture_population(spark, inp)
    lab = L.prepare_labels(inp.labels, inp.kyc).join(pop.ids, ACCOUNT, "left_semi")
    return L.time_split(lab, VALID_FRAC)


def q_time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split_rows(spark, sf_dir).select(ACCOUNT, "CHURN", "ACCOUNT_OPEN_DATE", "is_valid")


def q_train_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.train_sample(_split_rows(spark, sf_dir), SAMPLE_FRAC, SEED).select(ACCOUNT, "is_valid")


def q_class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(L.class_counts(_split_rows(spark, sf_dir)))


def _store(spark: SparkSession, sf_dir: str):
    """The inputs and the feature table, written once and read back as ``run_pipeline`` does."""
    inp, path = feature_inputs(spark, sf_dir), _scratch(spark, "store")
    write_feature_store(build_features(inp, CUTOFF).features, path, CUTOFF)
    return inp, read_feature_store(spark, path, CUTOFF)


def q_train_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp, feats = _store(spark, sf_dir)
    m = L.train_matrix(feats, L.prepare_labels(inp.labels, inp.kyc))
    m = m.withColumn("n_features", F.lit(len(L.feature_columns(m))))
    return round_doubles(m.select(ACCOUNT, "CHURN", "ACCOUNT_OPEN_DATE", "n_features", *MATRIX_FEATURES))


def q_score_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp, feats = _store(spark, sf_dir)
    return round_doubles(L.score_matrix(feats, inp.test_ids).select(ACCOUNT, *MATRIX_FEATURES))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows scored by recency (a model-free score with many ties)."""
    inp, feats = _store(spark, sf_dir)
    m = L.train_matrix(feats, L.prepare_labels(inp.labels, inp.kyc))
    return m.select(ACCOUNT, "CHURN", F.col("out_days_since_last_transaction").cast("double").alias("score"))


def q_roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(roc_auc(_scored(spark, sf_dir), "CHURN", "score"))


def q_topk_precision_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(top_fraction_metrics(_scored(spark, sf_dir), TOP_FRAC, "CHURN", "score", ACCOUNT))


def _label_ctes() -> str:
    return f"""
kyc1 AS (SELECT ACCOUNT_ID, MIN(ACCOUNT_OPEN_DATE) AS ACCOUNT_OPEN_DATE FROM wallet_kyc GROUP BY ACCOUNT_ID),
lab AS (
  SELECT l.ACCOUNT_ID, CAST(l.CHURN AS INTEGER) AS CHURN, k.ACCOUNT_OPEN_DATE
  FROM wallet_labels l LEFT JOIN kyc1 k ON k.ACCOUNT_ID = l.ACCOUNT_ID
),
split_in AS (SELECT * FROM lab WHERE ACCOUNT_ID IN (SELECT ACCOUNT_ID FROM population)),
thr AS (SELECT quantile_cont(date_diff('day', DATE '1970-01-01', ACCOUNT_OPEN_DATE), {1.0 - VALID_FRAC!r}) AS t FROM split_in),
split AS (
  SELECT *, COALESCE(date_diff('day', DATE '1970-01-01', ACCOUNT_OPEN_DATE) >= (SELECT t FROM thr), FALSE) AS is_valid
  FROM split_in
)"""


def _split_sql(select: str) -> str:
    return f"""{O.with_all(O.base_ctes(CUTOFF), _label_ctes())}
{select}"""


SQL_TIME_SPLIT = _split_sql("SELECT ACCOUNT_ID, CHURN, ACCOUNT_OPEN_DATE, is_valid FROM split")
SQL_TRAIN_SAMPLE = _split_sql(
    "SELECT ACCOUNT_ID, is_valid FROM split WHERE is_valid OR "
    f"substr(md5(CAST(ACCOUNT_ID AS VARCHAR) || '|{SEED}'), 1, 8) < '{L.sample_bound(SAMPLE_FRAC)}'"
)
SQL_CLASS_WEIGHTS = _split_sql(
    "SELECT pos, neg, " + O.round4("CAST(neg AS DOUBLE) / pos") + " AS scale_pos_weight FROM ("
    "SELECT CAST(GREATEST(COALESCE(SUM(CHURN), 0), 1) AS BIGINT) AS pos, "
    "CAST(GREATEST(COUNT(*) - COALESCE(SUM(CHURN), 0), 1) AS BIGINT) AS neg FROM split WHERE NOT is_valid) c"
)


def _store_with_labels_sql(select: str) -> str:
    ctes = O.feature_store_ctes(feature_names(), balance_feature_names(), KYC_NAMES, CUTOFF)
    filled = ", ".join(_cast(f"COALESCE({n}, {_fill_value(n)})", n) for n in MATRIX_FEATURES + ["out_days_since_last_transaction"])
    return f"""WITH {ctes}, {_label_ctes()},
store AS (SELECT ACCOUNT_ID, {filled} FROM joined)
{select}"""


SQL_TRAIN_MATRIX = _store_with_labels_sql(
    f"SELECT s.ACCOUNT_ID, l.CHURN, l.ACCOUNT_OPEN_DATE, 233 AS n_features, {', '.join('s.' + c for c in MATRIX_FEATURES)} "
    "FROM store s JOIN lab l ON l.ACCOUNT_ID = s.ACCOUNT_ID"
)
SQL_SCORE_MATRIX = _store_with_labels_sql(
    f"SELECT s.ACCOUNT_ID, {', '.join('s.' + c for c in MATRIX_FEATURES)} "
    "FROM store s WHERE s.ACCOUNT_ID IN (SELECT ACCOUNT_ID FROM wallet_test_ids)"
)
_SCORED = """
m AS (SELECT s.ACCOUNT_ID, l.CHURN AS y, CAST(s.out_days_since_last_transaction AS DOUBLE) AS sc
      FROM store s JOIN lab l ON l.ACCOUNT_ID = s.ACCOUNT_ID)"""
def _with_scored(sql: str) -> str:
    """Insert the scored-rows CTE ``m`` before the final SELECT line."""
    head, sel = sql.rsplit("\n", 1)
    return head + "," + _SCORED + "\n" + sel


SQL_ROC_AUC = _with_scored(_store_with_labels_sql(
    "SELECT " + O.round4(
        "(SUM(CASE WHEN y = 1 THEN rk + (c - 1) / 2.0 ELSE 0 END) - SUM(y) * (SUM(y) + 1) / 2.0) "
        "/ (CAST(SUM(y) AS DOUBLE) * (COUNT(*) - SUM(y)))"
    ) + " AS auc, CAST(SUM(y) AS BIGINT) AS positives, CAST(COUNT(*) - SUM(y) AS BIGINT) AS negatives "
    "FROM (SELECT y, RANK() OVER (ORDER BY sc) AS rk, COUNT(*) OVER (PARTITION BY sc) AS c FROM m) r"
))
SQL_TOPK = _with_scored(_store_with_labels_sql(
    "SELECT n_top, tp AS true_positives, "
    + O.round4("CAST(tp AS DOUBLE) / n_top") + " AS precision, "
    + O.round4("CASE WHEN p > 0 THEN CAST(tp AS DOUBLE) / p ELSE 0.0 END") + " AS recall FROM ("
    "SELECT CAST(MAX(n_top) AS BIGINT) AS n_top, CAST(SUM(CASE WHEN rn <= n_top THEN y ELSE 0 END) AS BIGINT) AS tp, "
    "MAX(p) AS p FROM (SELECT y, ROW_NUMBER() OVER (ORDER BY sc DESC, ACCOUNT_ID) AS rn, "
    f"GREATEST(1, CEIL(COUNT(*) OVER () * CAST({TOP_FRAC!r} AS DOUBLE))) AS n_top, SUM(y) OVER () AS p FROM m) t) a"
))


def q_topk_big_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 + M9: all scores tied, keys beyond 2^53, in several buckets: the smallest keys win."""
    scored = _scored(spark, sf_dir).select((F.col(ACCOUNT) + F.lit(1 << 60)).alias(ACCOUNT), "CHURN", F.lit(0.5).alias("score"))
    return round_doubles(top_fraction_metrics(scored, TOP_FRAC, rows_per_bucket=100))


def _with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows, a third of them without a score."""
    return _scored(spark, sf_dir).withColumn("score", F.when(F.col(ACCOUNT) % 3 != 0, F.col("score")))


def q_topk_null_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 + M9: rows without a score rank last."""
    return round_doubles(top_fraction_metrics(_with_gaps(spark, sf_dir), 0.9, rows_per_bucket=50))


def q_roc_auc_null_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: rows without a score rank last."""
    return round_doubles(roc_auc(_with_gaps(spark, sf_dir), rows_per_bucket=50))


SQL_TOPK_BIG_KEYS = SQL_TOPK.replace("ORDER BY sc DESC, ACCOUNT_ID", "ORDER BY ACCOUNT_ID")
_GAPS = ("FROM m)", "FROM (SELECT ACCOUNT_ID, y, CASE WHEN ACCOUNT_ID % 3 <> 0 THEN sc ELSE -1e300 END AS sc FROM m) g)")
SQL_TOPK_NULL_SCORES = SQL_TOPK.replace(*_GAPS).replace(f"CAST({TOP_FRAC!r} AS DOUBLE)", "CAST(0.9 AS DOUBLE)")
SQL_ROC_AUC_NULL_SCORES = SQL_ROC_AUC.replace(*_GAPS)


# ----------------------------------------------------------------------------- sources and sinks


LABELS_SCHEMA = T.StructType([T.StructField("ACCOUNT_ID", T.LongType()), T.StructField("CHURN", T.IntegerType())])
TEST_SCHEMA = T.StructType([T.StructField("ACCOUNT_ID", T.LongType())])


def _scratch(spark: SparkSession, name: str) -> str:
    return shared_dir(spark, f"{name}_{uuid.uuid4().hex[:8]}")


def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + S4: labels written as header CSV, read back by suffix with an explicit schema."""
    path = _scratch(spark, "labels") + "/train_labels.csv"
    wallet_labels(spark, sf_dir).write.mode("overwrite").option("header", "true").csv(path)
    return read_any(spark, [path], csv_schema=LABELS_SCHEMA)


SQL_CSV_ROUNDTRIP = f"""{O.with_all(O.base_ctes(CUTOFF))}
SELECT ACCOUNT_ID, CHURN FROM wallet_labels"""


def q_nanos_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfers stored with TIMESTAMP(NANOS), read without a driver-side rewrite."""
    path = _scratch(spark, "trx_nanos")
    write_nanos_copy(wallet_trx(spark, sf_dir), path)
    trx = asof_filter(canonical_transactions(read_parquet(spark, [path]), fixture_columns()), "TXN_DATE", CUTOFF)
    return round_doubles(trx.select(ACCOUNT, "DST_ACCOUNT_ID", "TXN_DATE", "TXN_AMOUNT", "TXN_TYPE"))


def _transfers_before_cutoff(df: DataFrame) -> DataFrame:
    trx = asof_filter(canonical_transactions(df, fixture_columns()), "TXN_DATE", CUTOFF)
    return round_doubles(trx.select(ACCOUNT, "DST_ACCOUNT_ID", "TXN_DATE", "TXN_AMOUNT", "TXN_TYPE"))


def q_partitioned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: transfers partitioned by their type and read with a cutoff: the partition column is kept."""
    path = _scratch(spark, "trx_by_type")
    # gathered by type into few files, but a type beyond the advisory size is shared by several tasks
    wallet_trx(spark, sf_dir).hint("rebalance", "TRX_TYPE").write.partitionBy("TRX_TYPE").parquet(path)
    return _transfers_before_cutoff(read_parquet(spark, [path], before={"TRX_DATETIME": CUTOFF}))


def q_resolve_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfers in two files under names of different token groups; both are read."""
    root = _scratch(spark, "two_names")
    even = F.col("SRC_ACCOUNT") % 2 == 0
    for name, part in (("trx_even", even), ("transaction_odd", ~even)):
        wallet_trx(spark, sf_dir).where(part).write.parquet(f"{root}/{name}.parquet")
    return _transfers_before_cutoff(read_any(spark, resolve_inputs(spark, root)["transactions"], "parquet"))


def q_nanos_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder, older files in nanoseconds, newer ones in microseconds."""
    path = _scratch(spark, "trx_mixed")
    trx = wallet_trx(spark, sf_dir).withColumn("TRX_DATETIME", F.col("TRX_DATETIME").cast("timestamp"))
    old = F.col("TRX_DATETIME") < F.lit("1996-01-01").cast("timestamp")
    trx.where(~old).write.parquet(path)
    write_nanos_copy(trx.where(old), path)
    return _transfers_before_cutoff(read_parquet(spark, [path], before={"TRX_DATETIME": CUTOFF}))


def q_nanos_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 + S6: one folder of nanosecond files, some with wall-clock times, some with instants, and newer ones in microseconds."""
    path = _scratch(spark, "trx_kinds")
    trx = wallet_trx(spark, sf_dir).withColumn("TRX_DATETIME", F.col("TRX_DATETIME").cast("timestamp_ntz"))
    time = F.col("TRX_DATETIME")
    first, second = (F.lit(d).cast("timestamp_ntz") for d in ("1994-01-01", "1996-01-01"))
    write_nanos_copy(trx.where(time < first), path)
    write_nanos_copy(trx.where((time >= first) & (time < second)), path, instants=True)
    trx.where(time >= second).withColumn("TRX_DATETIME", time.cast("timestamp")).write.mode("append").parquet(path)
    return _transfers_before_cutoff(read_parquet(spark, [path], before={"TRX_DATETIME": CUTOFF}))


def q_nanos_and_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 + X1: one folder, older files with nanoseconds, newer ones with bigint seconds since the epoch."""
    path = _scratch(spark, "trx_seconds")
    trx = wallet_trx(spark, sf_dir).withColumn("TRX_DATETIME", F.col("TRX_DATETIME").cast("timestamp"))
    old = F.col("TRX_DATETIME") < F.lit("1996-01-01").cast("timestamp")
    trx.where(~old).withColumn("TRX_DATETIME", F.unix_timestamp("TRX_DATETIME")).write.parquet(path)
    write_nanos_copy(trx.where(old), path, instants=True)
    return _transfers_before_cutoff(read_parquet(spark, [path], before={"TRX_DATETIME": CUTOFF}))


def q_epoch_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfer times as bigint seconds since the epoch."""
    trx = wallet_trx(spark, sf_dir)
    return _transfers_before_cutoff(trx.withColumn("TRX_DATETIME", F.unix_timestamp(F.col("TRX_DATETIME").cast("timestamp"))))


def q_resolve_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S3 + S4 + S5 + S8: find the five inputs in an export folder, read, normalise,
    and derive the population from what was found."""
    root = write_fixture_layout(spark, sf_dir, _scratch(spark, "export"))
    found = discover(spark, PipelineConfig(data_dir=root))
    inp = normalize_inputs(read_inputs(spark, found, LABELS_SCHEMA, TEST_SCHEMA), CUTOFF, ColumnMap())
    return population_ids(inp.labels, inp.test_ids, inp.kyc)


# ----------------------------------------------------------------------------- model (rows-only checks)

def fixture_config(**kw):
    """Two trials with large steps and little patience, so that fits stop early; depth, rounds and rows as published."""
    base = dict(
        engine="mllib", cutoff_date=CUTOFF, search_trials=2, search_patience=3, final_patience=3, step_size_min=0.3, step_size_max=0.5, random_seed=SEED
    )
    base.update(kw)
    return PipelineConfig(**base)


def _matrix(spark: SparkSession, sf_dir: str):
    inp, feats = _store(spark, sf_dir)
    return inp, feats, labelled_matrix(feats, inp.labels, inp.kyc, fixture_config())


def _fitted(m):
    cfg = fixture_config()
    return fit_with_validation(m.fit, GBTParams(stepSize=0.4), cfg.final_max_iter, cfg.final_patience, SEED)[0]


def q_gbt_train_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 + M11 + J7 + S14: a fit that patience ended, and the test accounts' probabilities two ways."""
    inp, feats, m = _matrix(spark, sf_dir)
    model = _fitted(m)
    to_score = assemble(L.score_matrix(feats, inp.test_ids), m.feature_cols, [ACCOUNT])
    return _score_checks(spark, model, to_score, positive_probability(model, to_score, "CHURN_PROB"))


def _saved(spark: SparkSession, model) -> DataFrame:
    """Node table of the model as its sink (S14) wrote it."""
    path = _scratch(spark, "model")
    save_model(model, path)
    return node_table(spark, path)


def _score_checks(spark: SparkSession, model, to_score: DataFrame, scored: DataFrame) -> DataFrame:
    """Per account: is the score a probability, and does the saved node table give the same one?"""
    again = rescore(to_score, _saved(spark, model), model.treeWeights, model.getOrDefault("maxDepth"))
    p = F.col("CHURN_PROB")
    return scored.select(ACCOUNT, "CHURN_PROB").join(again, ACCOUNT).select(
        ACCOUNT, p.between(0, 1).alias("in_range"), (F.abs(p - F.col("probability")) < 1e-9).alias("rescored")
    )


def q_gbt_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: seeded random search; one row per trial: parameters in the published ranges, ended by patience."""
    _, _, m = _matrix(spark, sf_dir)
    cfg = fixture_config()
    steps = (cfg.step_size_min, cfg.step_size_max)
    trials = trials_frame(spark, random_search(m.fit, cfg.search_trials, cfg.search_max_iter, cfg.search_patience, SEED, steps))
    published = "max_depth BETWEEN 4 AND 14 AND min_instances BETWEEN 20 AND 500 AND subsampling BETWEEN 0.6 AND 1 AND feature_fraction BETWEEN 0.6 AND 1"
    return trials.selectExpr(
        "trial",
        f"{published} AND step_size BETWEEN {steps[0]} AND {steps[1]} AS in_ranges",
        f"trees BETWEEN 1 AND {cfg.search_max_iter - 1} AS ended_early",
        "auc BETWEEN 0 AND 1 AS auc_ok",
    )


def _train(spark: SparkSession, sf_dir: str):
    inp, feats = _store(spark, sf_dir)
    return inp, feats, train_and_score(feats, inp.labels, inp.kyc, inp.test_ids, fixture_config())


def q_gbt_refit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10 + M11 + S11 + S14: refit on all labelled rows; test-account scores, through the prediction sink, two ways."""
    inp, feats, run = _train(spark, sf_dir)
    path = _scratch(spark, "predictions")
    write_predictions(run.predictions, path)
    scored = read_any(spark, [path], "csv", T.StructType([T.StructField(ACCOUNT, T.LongType()), T.StructField("CHURN_PROB", T.DoubleType())]))
    to_score = assemble(L.score_matrix(feats, inp.test_ids), run.matrix.feature_cols, [ACCOUNT])
    return _score_checks(spark, run.final_model, to_score, scored)


def q_gain_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M12 + O2 + P12: every feature once; its gain is what the saved node table gives."""
    _, _, run = _train(spark, sf_dir)
    names = spark.createDataFrame(list(enumerate(run.matrix.feature_cols)), "j int, feature string")
    nodes = gain_from_nodes(_saved(spark, run.final_model)).toDF("j", "again")
    both = run.importance.join(names, "feature").join(nodes, "j", "left")
    same = F.abs(F.col("gain") - F.coalesce("again", F.lit(0.0))) < 1e-9
    return both.select("feature", same.alias("recomputed")).orderBy("feature")


def q_driver_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean probability change when one feature is set to its median (top 30)."""
    _, feats, m = _matrix(spark, sf_dir)
    return median_substitution_summary(_fitted(m), m.data, m.feature_cols, feats, SEED)


def q_metric_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M14 + S9-S14 end to end: export folder -> pipeline -> metrics read back from their sink."""
    root = _scratch(spark, "run")
    write_fixture_layout(spark, sf_dir, f"{root}/data")
    cfg = fixture_config(data_dir=f"{root}/data", work_dir=f"{root}/work", output_dir=f"{root}/out")
    res = run_pipeline(spark, cfg, LABELS_SCHEMA, TEST_SCHEMA, summary=False)
    return round_doubles(_metric_checks(spark, res.paths["metrics"], cfg.final_max_iter))


def _metric_checks(spark: SparkSession, path: str, limit: int) -> DataFrame:
    shares = " AND ".join(f"{k} BETWEEN 0 AND 1" for k in ("auc_roc", "precision_at_10pct", "recall_at_10pct", "optuna_best_auc"))
    return spark.read.json(path).selectExpr(
        "CAST(final_train_rows AS BIGINT) AS final_train_rows",
        "scale_pos_weight",
        f"{shares} AS shares_ok",
        f"best_iteration = final_num_boost_round AND best_iteration BETWEEN 1 AND {limit - 1} AS rounds_ok",
    )


# ----------------------------------------------------------------------------- leaf-wise boosting

BOOST_FEATURES = MATRIX_FEATURES + ["out_days_since_last_transaction"]
BOOST_BINS, BOOST_PARAMS = 16, LeafParams(num_leaves=2, learning_rate=0.5, min_child_samples=20, lambda_l1=0.5, lambda_l2=2.0)


def _boost_matrix(spark: SparkSession, sf_dir: str):
    """The labelled matrix of a few features, rounded as the oracle has them."""
    inp, feats = _store(spark, sf_dir)
    return labelled_matrix(round_doubles(feats.select(ACCOUNT, *BOOST_FEATURES)), inp.labels, inp.kyc, fixture_config())


def q_boost_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: the first round: every split of the root with its gain and leaf values; ``best`` is the one the tree took."""
    m = _boost_matrix(spark, sf_dir)
    with Boosting(m.fit, m.feature_cols, [BOOST_PARAMS], SEED, BOOST_BINS) as b:
        splits = b.splits(b.histogram({0: [0]}, {}, {0: np.arange(len(m.feature_cols))})).checkpoint()
        b.round()
        root, edges = b.trials[0].trees[0], b.edges
    m.data.unpersist()
    borders = spark.createDataFrame(
        [(j, k, m.feature_cols[j], t, root.feature[0] == j and root.threshold[0] == t) for j, e in enumerate(edges) for k, t in enumerate(e)],
        "feature int, bin int, name string, threshold double, best boolean",
    )

    def value(g: str, h: str) -> str:
        p = BOOST_PARAMS
        return f"-sign({g}) * greatest(abs({g}) - {p.lambda_l1}D, 0D) / ({h} + {p.lambda_l2}D)"

    return round_doubles(
        splits.join(F.broadcast(borders), ["feature", "bin"]).selectExpr(
            "name AS feature", "threshold", "nl AS rows_left", "nt AS rows_all", "gain",
            f"{value('gl', 'hl')} AS left_value", f"{value('(gt - gl)', '(ht - hl)')} AS right_value", "best",
        )
    )


def q_tree_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Margin, expected margin and contributions of every labelled account after one round of two leaves."""
    m = _boost_matrix(spark, sf_dir)
    with Boosting(m.fit, m.feature_cols, [BOOST_PARAMS], SEED, BOOST_BINS) as b:
        b.round()
        model = b.model(b.trials[0], 1)
    found = attribute(model, m.data)
    return round_doubles(
        found.select(ACCOUNT, "margin", "base", *[F.get("contributions", F.lit(j)).alias(f"of_{c}") for j, c in enumerate(m.feature_cols)])
    )


def q_halving_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: one row per trial and comparison: parameters, rounds, best round, validation AUC, and whether it went on."""
    inp, feats = _store(spark, sf_dir)
    m = labelled_matrix(feats, inp.labels, inp.kyc, fixture_config())
    params = [draw_params(SEED, i) for i in range(4)]
    found = successive_halving(m.fit, m.feature_cols, params, 2, 8, 3, SEED, eta=2)
    m.data.unpersist()
    return found.table(spark)


def q_metric_record_leafwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6-M14 + S9-S14 end to end on the leaf-wise engine, exact contributions included."""
    root = _scratch(spark, "run")
    write_fixture_layout(spark, sf_dir, f"{root}/data")
    cfg = fixture_config(
        engine="leafwise", data_dir=f"{root}/data", work_dir=f"{root}/work", output_dir=f"{root}/out", search_first_rounds=2, final_max_iter=30
    )
    res = run_pipeline(spark, cfg, LABELS_SCHEMA, TEST_SCHEMA)
    return round_doubles(_metric_checks(spark, res.paths["metrics"], cfg.final_max_iter))


_BOOST_SQL = f"""
weights AS (SELECT CAST(GREATEST(SUM(CASE WHEN CHURN = 1 THEN 0 ELSE 1 END), 1) AS DOUBLE) / GREATEST(SUM(CHURN), 1) AS scale
            FROM split WHERE NOT is_valid),
train AS (SELECT s.*, t.CHURN, CASE WHEN t.CHURN = 1 THEN scale ELSE 1.0 END AS w
          FROM store s JOIN split t ON t.ACCOUNT_ID = s.ACCOUNT_ID CROSS JOIN weights WHERE NOT t.is_valid),
start AS (SELECT SUM(w * CHURN) / SUM(w) AS p FROM train),
wide AS (SELECT train.*, w * (p - CHURN) AS g, w * p * (1 - p) AS h FROM train CROSS JOIN start),
long AS ({" UNION ALL ".join(f"SELECT {j} AS j, '{c}' AS feature, CAST({c} AS DOUBLE) AS x, g, h FROM wide" for j, c in enumerate(BOOST_FEATURES))}),
borders AS (SELECT DISTINCT j, t FROM (
  SELECT j, UNNEST(QUANTILE_DISC(x, [{", ".join(str(i / BOOST_BINS) for i in range(1, BOOST_BINS))}])) AS t FROM long GROUP BY j) q),
sums AS (
  SELECT l.j, l.feature, b.t, COUNT(*) FILTER (WHERE x <= t) AS nl, COUNT(*) AS nt,
         COALESCE(SUM(g) FILTER (WHERE x <= t), 0) AS gl, COALESCE(SUM(h) FILTER (WHERE x <= t), 0) AS hl, SUM(g) AS gt, SUM(h) AS ht
  FROM long l JOIN borders b ON b.j = l.j GROUP BY l.j, l.feature, b.t
),
gains AS (
  SELECT *, POWER(GREATEST(ABS(gl) - {BOOST_PARAMS.lambda_l1}, 0), 2) / (hl + {BOOST_PARAMS.lambda_l2})
    + POWER(GREATEST(ABS(gt - gl) - {BOOST_PARAMS.lambda_l1}, 0), 2) / (ht - hl + {BOOST_PARAMS.lambda_l2})
    - POWER(GREATEST(ABS(gt) - {BOOST_PARAMS.lambda_l1}, 0), 2) / (ht + {BOOST_PARAMS.lambda_l2}) AS gain,
    -SIGN(gl) * GREATEST(ABS(gl) - {BOOST_PARAMS.lambda_l1}, 0) / (hl + {BOOST_PARAMS.lambda_l2}) AS left_value,
    -SIGN(gt - gl) * GREATEST(ABS(gt - gl) - {BOOST_PARAMS.lambda_l1}, 0) / (ht - hl + {BOOST_PARAMS.lambda_l2}) AS right_value
  FROM sums WHERE nl >= {BOOST_PARAMS.min_child_samples} AND nt - nl >= {BOOST_PARAMS.min_child_samples}
),
ranked AS (SELECT *, ROW_NUMBER() OVER (ORDER BY gain DESC, j, t) = 1 AND gain > 0 AS best FROM gains)"""
SQL_BOOST_ROUND = _store_with_labels_sql("").rstrip() + "," + _BOOST_SQL + f"""
SELECT feature, {O.round4('t')} AS threshold, nl AS rows_left, nt AS rows_all, {O.round4('gain')} AS gain,
       {O.round4('left_value')} AS left_value, {O.round4('right_value')} AS right_value, best FROM ranked"""
_RATE = BOOST_PARAMS.learning_rate
SQL_TREE_ATTRIBUTION = _store_with_labels_sql("").rstrip() + "," + _BOOST_SQL + f""",
chosen AS (
  SELECT feature, t, {_RATE} * left_value AS lv, {_RATE} * right_value AS rv,
         {_RATE} * (nl * left_value + (nt - nl) * right_value) / nt AS expected, (SELECT LN(p / (1 - p)) FROM start) AS start
  FROM ranked WHERE best
),
rows_ AS (
  SELECT s.ACCOUNT_ID, c.*,
         CASE WHEN CASE c.feature {" ".join(f"WHEN '{c}' THEN CAST(s.{c} AS DOUBLE)" for c in BOOST_FEATURES)} END <= c.t THEN lv ELSE rv END AS v
  FROM store s JOIN lab l ON l.ACCOUNT_ID = s.ACCOUNT_ID CROSS JOIN chosen c
)
SELECT ACCOUNT_ID, {O.round4('start + v')} AS margin, {O.round4('start + expected')} AS base,
       {", ".join(O.round4(f"CASE WHEN feature = '{c}' THEN v - expected ELSE 0 END") + f" AS of_{c}" for c in BOOST_FEATURES)} FROM rows_"""


# what SQL can say of the fits: which rows there are, the counts, and that every check holds
_CHECKS = "TRUE AS in_range, TRUE AS rescored"
SQL_GBT_SCORES = _store_with_labels_sql(
    f"SELECT s.ACCOUNT_ID, {_CHECKS} FROM store s WHERE s.ACCOUNT_ID IN (SELECT ACCOUNT_ID FROM wallet_test_ids)"
)
SQL_GBT_SEARCH = "SELECT CAST(range AS INTEGER) AS trial, TRUE AS in_ranges, TRUE AS ended_early, TRUE AS auc_ok FROM range(2)"
SQL_GAIN_IMPORTANCE = (
    "SELECT feature, TRUE AS recomputed FROM (VALUES " + ", ".join(f"('{c}')" for c in feature_table_columns()) + ") f(feature)"
)
SQL_METRIC_RECORD = _store_with_labels_sql(
    "SELECT (SELECT COUNT(*) FROM store s JOIN lab l ON l.ACCOUNT_ID = s.ACCOUNT_ID) AS final_train_rows, "
    + O.round4("CAST(neg AS DOUBLE) / pos")
    + " AS scale_pos_weight, TRUE AS shares_ok, TRUE AS rounds_ok FROM ("
    "SELECT GREATEST(COALESCE(SUM(CHURN), 0), 1) AS pos, GREATEST(COUNT(*) - COALESCE(SUM(CHURN), 0), 1) AS neg "
    "FROM split WHERE NOT is_valid) c"
)


# ----------------------------------------------------------------------------- registry

def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "asof_filter": q_asof_filter,
        "population": q_population,
        "role_swap": q_role_swap,
        "window_flags": q_window_flags,
        "type_mix": _txn_query(("out", "in"), "types"),
        "txn_windows_out": _txn_query(("out",), "windows"),
        "txn_windows_in": _txn_query(("in",), "windows"),
        "txn_amount_stats": _txn_query(("out", "in"), "stats"),
        "txn_distincts": _txn_query(("out", "in"), "distincts"),
        "txn_gaps": _txn_query(("out", "in"), "gaps"),
        "txn_derived": _txn_query(("out", "in"), "derived"),
        "balance_windows": _bal_query("windows"),
        "balance_median": _bal_query("median"),
        "balance_first_last": _bal_query("first_last"),
        "balance_derived": _bal_query("derived"),
        "kyc_features": q_kyc_features,
        "feature_store_flow": q_feature_store_flow,
        "feature_store_large_population": q_feature_store_large_population,
        "feature_store_roundtrip": q_feature_store_roundtrip,
        "median_impute": q_median_impute,
        "time_split": q_time_split,
        "train_sample": q_train_sample,
        "class_weights": q_class_weights,
        "train_matrix": q_train_matrix,
        "score_matrix": q_score_matrix,
        "roc_auc": q_roc_auc,
        "topk_precision_recall": q_topk_precision_recall,
        "topk_big_keys": q_topk_big_keys,
        "topk_null_scores": q_topk_null_scores,
        "roc_auc_null_scores": q_roc_auc_null_scores,
        "csv_roundtrip": q_csv_roundtrip,
        "partitioned_scan": q_partitioned_scan,
        "resolve_multi": q_resolve_multi,
        "nanos_mixed": q_nanos_mixed,
        "nanos_kinds": q_nanos_kinds,
        "nanos_and_seconds": q_nanos_and_seconds,
        "epoch_seconds": q_epoch_seconds,
        "nanos_timestamps": q_nanos_timestamps,
        "resolve_inputs": q_resolve_inputs,
        "gbt_train_score": q_gbt_train_score,
        "gbt_search": q_gbt_search,
        "gbt_refit": q_gbt_refit,
        "gain_importance": q_gain_importance,
        "driver_summary": q_driver_summary,
        "metric_record": q_metric_record,
        "boost_round": q_boost_round,
        "tree_attribution": q_tree_attribution,
        "halving_search": q_halving_search,
        "metric_record_leafwise": q_metric_record_leafwise,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "asof_filter": SQL_ASOF_FILTER,
        "population": SQL_POPULATION,
        "role_swap": SQL_ROLE_SWAP,
        "window_flags": SQL_WINDOW_FLAGS,
        "type_mix": _txn_sql(("out", "in"), "types"),
        "txn_windows_out": _txn_sql(("out",), "windows"),
        "txn_windows_in": _txn_sql(("in",), "windows"),
        "txn_amount_stats": _txn_sql(("out", "in"), "stats"),
        "txn_distincts": _txn_sql(("out", "in"), "distincts"),
        "txn_gaps": _txn_sql(("out", "in"), "gaps"),
        "txn_derived": _txn_sql(("out", "in"), "derived"),
        "balance_windows": _bal_sql("windows"),
        "balance_median": _bal_sql("median"),
        "balance_first_last": _bal_sql("first_last"),
        "balance_derived": _bal_sql("derived"),
        "kyc_features": SQL_KYC_FEATURES,
        "feature_store_flow": _store_sql(),
        "feature_store_large_population": _store_sql(),
        "feature_store_roundtrip": _store_sql(),
        "median_impute": _median_impute_sql(),
        "time_split": SQL_TIME_SPLIT,
        "train_sample": SQL_TRAIN_SAMPLE,
        "class_weights": SQL_CLASS_WEIGHTS,
        "train_matrix": SQL_TRAIN_MATRIX,
        "score_matrix": SQL_SCORE_MATRIX,
        "roc_auc": SQL_ROC_AUC,
        "topk_precision_recall": SQL_TOPK,
        "topk_big_keys": SQL_TOPK_BIG_KEYS,
        "topk_null_scores": SQL_TOPK_NULL_SCORES,
        "roc_auc_null_scores": SQL_ROC_AUC_NULL_SCORES,
        "csv_roundtrip": SQL_CSV_ROUNDTRIP,
        "partitioned_scan": SQL_ASOF_FILTER,
        "resolve_multi": SQL_ASOF_FILTER,
        "nanos_mixed": SQL_ASOF_FILTER,
        "nanos_kinds": SQL_ASOF_FILTER,
        "nanos_and_seconds": SQL_ASOF_FILTER,
        "epoch_seconds": SQL_ASOF_FILTER,
        "nanos_timestamps": SQL_ASOF_FILTER,
        "resolve_inputs": SQL_POPULATION,
        "gbt_train_score": SQL_GBT_SCORES,
        "gbt_search": SQL_GBT_SEARCH,
        "gbt_refit": SQL_GBT_SCORES,
        "gain_importance": SQL_GAIN_IMPORTANCE,
        "metric_record": SQL_METRIC_RECORD,
        "boost_round": SQL_BOOST_ROUND,
        "tree_attribution": SQL_TREE_ATTRIBUTION,
        "metric_record_leafwise": SQL_METRIC_RECORD,
    }
