"""Canonical schema mapping, input validation and the as-of (leak guard) cut."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ACCOUNT, ColumnMap
from ..functions.exprs import as_date, as_timestamp, cutoff_lit


@dataclass
class RawInputs:
    """The five tables as read, under their raw column names."""

    transactions: DataFrame
    balances: DataFrame
    kyc: DataFrame
    labels: DataFrame
    test_ids: DataFrame


@dataclass
class Inputs:
    """Canonical inputs; fact tables already cut at the as-of date."""

    transactions: DataFrame  # ACCOUNT_ID, DST_ACCOUNT_ID, TXN_TS, TXN_DATE, TXN_AMOUNT, TXN_TYPE
    balances: DataFrame  # ACCOUNT_ID, BAL_DATE, BALANCE
    kyc: DataFrame  # ACCOUNT_ID + optional ACCOUNT_TYPE, ACCOUNT_OPEN_DATE, GENDER, REGION
    labels: DataFrame  # ACCOUNT_ID, CHURN + optional LABEL_DATE, SNAPSHOT_DATE, AS_OF_DATE
    test_ids: DataFrame  # ACCOUNT_ID, distinct


class InputError(ValueError):
    """Raised on the driver, before any Spark job, when an input or column is missing."""


def _require(df: DataFrame | None, name: str, cols: list[str]) -> DataFrame:
    if df is None:
        raise InputError(f"required input '{name}' was not found")
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise InputError(f"input '{name}' lacks column(s) {missing}; has {df.columns}")
    return df


def _dtype(df: DataFrame, col: str):
    return df.schema[col].dataType


def canonical_transactions(trx: DataFrame, cols: ColumnMap) -> DataFrame:
    """Rename + parse; the date is derived from the parsed timestamp."""
    _require(
        trx,
        "transactions",
        [cols.src_account_col, cols.dst_account_col, cols.txn_date_col, cols.txn_amount_col, cols.txn_type_col],
    )
    ts_type = _dtype(trx, cols.txn_date_col)
    return trx.select(
        F.col(cols.src_account_col).alias(ACCOUNT),
        F.col(cols.dst_account_col).alias("DST_ACCOUNT_ID"),
        as_timestamp(cols.txn_date_col, ts_type).alias("TXN_TS"),
        as_date(cols.txn_date_col, ts_type).alias("TXN_DATE"),
        F.col(cols.txn_amount_col).try_cast("double").alias("TXN_AMOUNT"),
        F.col(cols.txn_type_col).alias("TXN_TYPE"),
    )


def canonical_balances(bal: DataFrame, cols: ColumnMap) -> DataFrame:
    _require(bal, "balances", [cols.account_col, cols.balance_date_col, cols.balance_amount_col])
    return bal.select(
        F.col(cols.account_col).alias(ACCOUNT),
        as_date(cols.balance_date_col, _dtype(bal, cols.balance_date_col)).alias("BAL_DATE"),
        F.col(cols.balance_amount_col).try_cast("double").alias("BALANCE"),
    )


def canonical_kyc(kyc: DataFrame, cols: ColumnMap) -> DataFrame:
    _require(kyc, "kyc", [cols.account_col])
    return kyc.withColumnRenamed(cols.account_col, ACCOUNT) if cols.account_col != ACCOUNT else kyc


def canonical_labels(labels: DataFrame, cols: ColumnMap) -> DataFrame:
    _require(labels, "train_labels", [cols.account_col, cols.label_col])
    out = labels
    if cols.account_col != ACCOUNT:
        out = out.withColumnRenamed(cols.account_col, ACCOUNT)
    if cols.label_col != "CHURN":
        out = out.withColumnRenamed(cols.label_col, "CHURN")
    return out


def canonical_test_ids(test_ids: DataFrame, cols: ColumnMap) -> DataFrame:
    _require(test_ids, "test_ids", [cols.account_col])
    return test_ids.select(F.col(cols.account_col).alias(ACCOUNT)).distinct()


def asof_filter(df: DataFrame, date_col: str, cutoff_date: str) -> DataFrame:
    """Keep rows dated strictly before the cutoff; null dates drop out."""
    return df.filter(F.col(date_col) < cutoff_lit(cutoff_date))


def normalize_inputs(raw: RawInputs, cutoff_date: str, cols: ColumnMap | None = None) -> Inputs:
    """S7 + S8 + P1 in one call; all checks run on the driver before any job."""
    cols = cols or ColumnMap()
    trx = canonical_transactions(raw.transactions, cols)
    bal = canonical_balances(raw.balances, cols)
    kyc = canonical_kyc(raw.kyc, cols)
    labels = canonical_labels(raw.labels, cols)
    test_ids = canonical_test_ids(raw.test_ids, cols)
    return Inputs(
        transactions=asof_filter(trx, "TXN_DATE", cutoff_date),
        balances=asof_filter(bal, "BAL_DATE", cutoff_date),
        kyc=kyc,
        labels=labels,
        test_ids=test_ids,
    )
