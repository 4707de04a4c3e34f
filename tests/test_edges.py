"""Edge rows of FIXTURES §3 as tiny inline frames (unit tests; no registered query uses them)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerscope.operators.assemble import assemble_features
from ledgerscope.operators.balances import balance_features
from ledgerscope.operators.dimension import kyc_features
from ledgerscope.operators.population import Population
from ledgerscope.operators.transactions import transaction_features
from ledgerscope.sources.normalize import asof_filter, canonical_transactions
from ledgerscope.config import ColumnMap

CUT = "2024-04-01"
TRX_SCHEMA = "SRC_ACCOUNT long, DST_ACCOUNT long, TRX_DATETIME string, TRX_AMT double, TRX_TYPE string"


def trx(spark, rows):
    raw = spark.createDataFrame(rows, TRX_SCHEMA)
    return asof_filter(canonical_transactions(raw, ColumnMap()), "TXN_DATE", CUT)


def pop(spark, ids):
    return Population.of(spark.createDataFrame([(i,) for i in ids], "ACCOUNT_ID long"))


def feats(spark, rows, ids=(1, 2, 3)):
    return {r["ACCOUNT_ID"]: r for r in transaction_features(trx(spark, rows), CUT, pop(spark, ids)).collect()}


def test_cutoff_day_is_dropped_and_old_rows_count_in_90d(spark):
    rows = [
        (1, 2, "2024-04-01 10:00:00", 5.0, "P2P"),  # on the cutoff: dropped
        (1, 2, "2023-12-03 10:00:00", 7.0, "P2P"),  # 120 days back: still in every plain 90d name
        (1, 3, "2024-03-31 08:00:00", 1.0, "P2P"),
    ]
    f = feats(spark, rows)[1]
    assert f["out_txn_count_90d"] == 2
    assert f["out_txn_sum_90d"] == 8.0
    assert f["out_active_days_90d"] == 2
    assert f["out_p2p_count_90d"] == 2
    assert f["out_txn_count_61_90d"] == 0
    assert f["out_txn_count_1d"] == 1
    assert f["out_max_txn_gap_days"] == 119


def test_billpay_is_bill_and_merchant(spark):
    f = feats(spark, [(1, 2, "2024-03-30 00:00:00", 3.0, "BillPay")])[1]
    assert (f["out_bill_count_90d"], f["out_merchant_count_90d"], f["out_p2p_count_90d"]) == (1, 1, 0)
    assert f["out_cashout_count_90d"] == 0


def test_single_transaction_and_incoming_side(spark):
    f = feats(spark, [(1, 2, "2024-03-30 00:00:00", 3.0, "Cash Out")])
    assert f[1]["out_std_txn_amount"] is None
    assert f[1]["out_max_txn_gap_days"] is None and f[1]["out_avg_txn_gap_days"] is None
    assert f[1]["in_txn_count_90d"] is None  # no incoming rows: the whole direction is null
    assert f[2]["in_txn_count_90d"] == 1 and f[2]["in_unique_dst_accounts"] == 1
    assert f[1]["out_cashout_count_90d"] == 1


def test_negative_sum_log1p_null(spark):
    f = feats(spark, [(1, 2, "2024-03-30 00:00:00", -5.0, "P2P")])[1]
    assert f["out_recency_x_sum_30d"] is None


def test_malformed_date_is_null_not_error(spark):
    t = trx(spark, [(1, 2, "not a date", 1.0, "P2P"), (1, 2, "2024-03-30 00:00:00", 1.0, "P2P")])
    assert t.count() == 1


def test_null_counterparty_not_counted(spark):
    f = feats(spark, [(1, None, "2024-03-30 00:00:00", 1.0, None), (1, 2, "2024-03-29 00:00:00", 1.0, "P2P")])[1]
    assert f["out_txn_count_90d"] == 2
    assert f["out_unique_dst_accounts"] == 1
    assert f["out_unique_txn_types"] == 1


def test_balance_tie_is_deterministic_and_null_balance_divides_by_one(spark):
    rows = [
        (1, dt.date(2024, 3, 31), 10.0),
        (1, dt.date(2024, 3, 31), 30.0),
        (1, dt.date(2024, 3, 1), 5.0),
        (2, dt.date(2024, 3, 31), None),
    ]
    bal = spark.createDataFrame(rows, "ACCOUNT_ID long, BAL_DATE date, BALANCE double")
    out = {r["ACCOUNT_ID"]: r for r in balance_features(bal, CUT).collect()}
    assert out[1]["last_balance"] == 30.0 and out[1]["first_balance_90d"] == 5.0
    assert out[2]["avg_balance_30d"] is None
    assert out[2]["balance_cv_30d"] is None


def test_assembly_fill_rules(spark):
    p = pop(spark, [1, 2])
    t = transaction_features(trx(spark, [(1, 3, "2024-03-30 00:00:00", 2.0, "P2P")]), CUT, p)
    bal = balance_features(spark.createDataFrame([], "ACCOUNT_ID long, BAL_DATE date, BALANCE double"), CUT, p)
    kyc = spark.createDataFrame([(1, "2020-01-01", None, "R", "Customer"), (2, None, "F", None, "customer")],
                                "ACCOUNT_ID long, ACCOUNT_OPEN_DATE string, GENDER string, REGION string, ACCOUNT_TYPE string")
    k = kyc_features(kyc, CUT, p)
    f = {r["ACCOUNT_ID"]: r for r in assemble_features(p.ids, t, bal, k).collect()}
    two = f[2]
    assert two["out_days_since_last_transaction"] == 9999
    assert two["out_max_txn_gap_days"] == 9999 and two["in_avg_txn_gap_days"] == 9999
    assert two["out_recency_x_count_30d"] == 0
    assert two["out_txn_to_balance_ratio"] == 0.0
    one = f[1]
    assert one["out_txn_to_balance_ratio"] == 2.0  # null balance: divide by one
    assert one["in_days_since_last_transaction"] == 9999
    # null category -> index = number of labels; both GENDER values: F (1 row) -> 0, null -> 1
    assert one["gender_idx"] == 1.0 and two["gender_idx"] == 0.0
    assert all(v is not None for r in f.values() for v in r.asDict().values())


def test_duplicated_kyc_row_gives_one_feature_row(spark):
    kyc = spark.createDataFrame(
        [(1, "2020-01-01", "M", "R", "Customer"), (1, "2019-01-01", "M", "R", "Customer")],
        "ACCOUNT_ID long, ACCOUNT_OPEN_DATE string, GENDER string, REGION string, ACCOUNT_TYPE string",
    )
    rows = kyc_features(kyc, CUT, pop(spark, [1])).collect()
    assert len(rows) == 1
    assert rows[0]["account_age_days"] == (dt.date(2024, 4, 1) - dt.date(2019, 1, 1)).days


def test_kyc_without_optional_columns(spark):
    from ledgerscope.model import labels as L
    from ledgerscope.operators.population import population_ids

    kyc = spark.createDataFrame([(1,), (2,), (2,)], "ACCOUNT_ID long")
    labels = spark.createDataFrame([(1, 0), (3, 1)], "ACCOUNT_ID long, CHURN int")
    tests = spark.createDataFrame([(2,)], "ACCOUNT_ID long")
    ids = population_ids(labels, tests, kyc)
    assert sorted(r[0] for r in ids.collect()) == [1, 2]  # no type column: every kyc account is a customer
    feats = kyc_features(kyc, CUT, Population.of(ids))
    assert feats.columns == ["ACCOUNT_ID"] and feats.count() == 2
    prepared = L.prepare_labels(labels, kyc)
    with pytest.raises(L.NoSplitColumn):
        L.split_column(prepared)
