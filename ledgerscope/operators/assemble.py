"""Feature assembly (P17): population-anchored joins, cross-table features (F7), fill
and the optional median imputation operator (M2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ACCOUNT, MISSING_RECENCY_FILL, RECENCY_NAME_MARKERS
from ..functions.exprs import numeric_columns
from .quantiles import exact_quantiles

#: F7 as SQL over the joined columns (fixed values: names and definitions). In braces: 0 where missing;
#: ``greatest`` skips nulls, so a missing denominator divides by one
_CROSS_SQL: dict[str, str] = {
    "out_txn_to_balance_ratio": "{out_txn_sum_30d} / greatest(abs(avg_balance_30d), 1D)",
    "in_txn_to_balance_ratio": "{in_txn_sum_30d} / greatest(abs(avg_balance_30d), 1D)",
    "net_flow_30d": "{in_txn_sum_30d} - {out_txn_sum_30d}",
    "net_flow_90d": "{in_txn_sum_90d} - {out_txn_sum_90d}",
    "in_out_amount_ratio_30d": "{in_txn_sum_30d} / greatest({out_txn_sum_30d}, 1D)",
    "in_out_count_ratio_30d": "{in_txn_count_30d} / greatest({out_txn_count_30d}, 1D)",
    "amount_per_active_day_90d": "({out_txn_sum_90d} + {in_txn_sum_90d})"
    " / greatest({out_active_days_90d}, {in_active_days_90d}, 1D)",
}
CROSS_FEATURES = tuple(_CROSS_SQL)


class _ZeroIfMissing(dict):
    """``{column}`` as SQL: 0 where the value is null, or where no joined part has the column."""

    def __missing__(self, column: str) -> str:
        return f"coalesce({column}, 0D)" if column in self["columns"] else "0D"


def join_features(population_ids: DataFrame, *parts: DataFrame) -> DataFrame:
    """Population left-joined with every per-account part (all keyed, so no fan-out).

    Every part is hash-partitioned on ACCOUNT_ID by its own aggregate, so the joins are
    sort-merge joins on already co-partitioned inputs.
    """
    df = population_ids.select(ACCOUNT)
    for p in parts:
        df = df.join(p, ACCOUNT, "left")
    return df


def cross_features(df: DataFrame) -> DataFrame:
    """F7, computed before the fill, so that a missing balance divides by one."""
    if "avg_balance_30d" not in df.columns:
        return cross_features(df.withColumn("avg_balance_30d", F.lit(None).cast("double"))).drop("avg_balance_30d")
    known = _ZeroIfMissing(columns=set(df.columns))
    return df.selectExpr("*", *[f"{sql.format_map(known)} AS {name}" for name, sql in _CROSS_SQL.items()])


def fill_missing(df: DataFrame) -> DataFrame:
    """Recency / gap features -> 9999, every other numeric -> 0 (NaN too), in one projection."""
    numeric = numeric_columns(df, exclude=[ACCOUNT])
    values = {
        c: (MISSING_RECENCY_FILL if any(m in c for m in RECENCY_NAME_MARKERS) else 0) for c in numeric
    }
    others = [c for c in df.columns if c != ACCOUNT and c not in values]
    filled = df.fillna(values) if values else df
    return filled.fillna(0, subset=others) if others else filled


def assemble_features(
    population_ids: DataFrame,
    txn_f: DataFrame,
    bal_f: DataFrame,
    kyc_f: DataFrame,
    fill: bool = True,
) -> DataFrame:
    """ACCOUNT_ID + 233 features, one row per population account."""
    df = cross_features(join_features(population_ids, txn_f, bal_f, kyc_f))
    return fill_missing(df) if fill else df


def median_impute(df: DataFrame, columns: list[str]) -> DataFrame:
    """M2: replace nulls / NaN of ``columns`` by their exact lower median (a column without values stays as it is).

    Offered on its own: in the default assembly it would change nothing, because the fill
    runs first. The medians come from a distributed selection; one number a column reaches the driver.
    """
    medians = {c: m for c, m in exact_quantiles(df, columns).items() if m is not None}

    def filled(c: str):
        own = F.col(c).cast("double")
        return F.when(own.isNull() | F.isnan(own), F.lit(medians[c])).otherwise(own).alias(c)

    return df.select(*[filled(c) if c in medians else F.col(c) for c in df.columns])
