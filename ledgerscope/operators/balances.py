"""Balance features (F4, F5, F6) in one account-level aggregate.

The newest and oldest balance come from ``max_by`` / ``min_by`` inside the same aggregate
instead of two ``row_number`` windows and two joins; the ordering key is (date, balance),
so two snapshots on one day resolve deterministically (newest: the higher balance,
oldest: the lower). Balances are an (account, day) snapshot, so a group is bounded by the
number of days, and the aggregate has a map-side partial step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ACCOUNT, BALANCE_AGGREGATES, BALANCE_RATIOS, BALANCE_RATIOS_TAIL
from ..functions.exprs import days_before, window_sql
from .population import Population


def _aggregate(fn: str, cond: str) -> str:
    if fn in ("avg", "min", "max", "stddev"):
        return f"{fn}(CASE WHEN {cond} THEN BALANCE END)"
    if fn == "count":
        return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"
    if fn == "count_nonpositive":
        return f"CAST(sum(CASE WHEN {cond} AND BALANCE <= 0 THEN 1 ELSE 0 END) AS BIGINT)"
    if fn == "median":
        return f"percentile_approx(CASE WHEN {cond} THEN BALANCE END, 0.5)"
    raise ValueError(fn)


def balance_feature_names() -> list[str]:
    names = [n for n, _, _, _ in BALANCE_AGGREGATES] + ["last_balance", "first_balance_90d"]
    names += [n for n, _, _, _ in BALANCE_RATIOS] + ["balance_drop_30d"] + [n for n, _, _, _ in BALANCE_RATIOS_TAIL]
    return names


def _ratio(name: str, num: str, den: str, absolute: bool) -> str:
    return f"{num} / greatest(abs({den}), 1.0D) AS {name}" if absolute else f"{num} / greatest({den}, 1) AS {name}"


def balance_features(bal: DataFrame, cutoff_date: str, population: Population | None = None) -> DataFrame:
    """ACCOUNT_ID + 34 balance features."""
    b = population.restrict(bal) if population is not None else bal
    b = b.select(ACCOUNT, "BAL_DATE", "BALANCE", days_before("BAL_DATE", cutoff_date).alias("d"))
    aggs = [f"{_aggregate(fn, window_sql(lo, hi))} AS {name}" for name, fn, lo, hi in BALANCE_AGGREGATES]
    aggs += [
        "max_by(BALANCE, struct(BAL_DATE, BALANCE)) AS last_balance",
        "min_by(BALANCE, struct(BAL_DATE, BALANCE)) AS first_balance_90d",
    ]
    agg = b.groupBy(ACCOUNT).agg(*[F.expr(e) for e in aggs])
    agg = population.settle(agg) if population is not None else agg
    derived = [_ratio(*r) for r in BALANCE_RATIOS]
    derived.append("avg_balance_90d - avg_balance_30d AS balance_drop_30d")
    derived += [_ratio(*r) for r in BALANCE_RATIOS_TAIL]
    out = agg.selectExpr("*", *derived).select(ACCOUNT, *balance_feature_names())
    return out
