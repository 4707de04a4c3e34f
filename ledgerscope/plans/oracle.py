"""DuckDB oracle SQL for the registered queries.

The oracle is deliberately written the straightforward way — one aggregate per direction
with ``COUNT(DISTINCT ...)``, ``LAG`` over distinct days, ``arg_max`` for the newest
balance — so that it checks the two-level Spark plans instead of restating them. It reads
only the driver's pre-registered raw tables: the wallet tables are inlined as CTEs.
"""

from __future__ import annotations

from ..sources.fixtures import FIXTURE_CUTOFF, fixture_ctes
from .oracle_definitions import (
    ACTIVE_DAY_RATIO_DAYS,
    ACTIVE_DAY_WINDOWS,
    BALANCE_AGGREGATES,
    BALANCE_RATIOS,
    BALANCE_RATIOS_TAIL,
    COUNTERPARTY_WINDOWS,
    TXN_COUNT_RATIOS,
    TXN_SUM_RATIOS,
    TXN_TYPE_PATTERNS,
    TXN_TYPES_WITH_RECENCY,
    TXN_WINDOWS,
)

TYPE_NAMES = tuple(n for n, _ in TXN_TYPE_PATTERNS)


def _cut(cutoff: str) -> str:
    return f"DATE '{cutoff}'"


def base_ctes(cutoff: str = FIXTURE_CUTOFF) -> str:
    """Fixture tables, canonical inputs cut at the as-of date, population, both directions."""
    c = _cut(cutoff)
    return fixture_ctes() + f""",
trx AS (
  SELECT SRC_ACCOUNT AS ACCOUNT_ID, DST_ACCOUNT AS DST_ACCOUNT_ID, CAST(TRX_DATETIME AS DATE) AS TXN_DATE,
         CAST(TRX_AMT AS DOUBLE) AS TXN_AMOUNT, TRX_TYPE AS TXN_TYPE
  FROM wallet_trx WHERE CAST(TRX_DATETIME AS DATE) < {c}
),
bal AS (
  SELECT ACCOUNT_ID, CAST(BAL_DATE AS DATE) AS BAL_DATE, CAST(AVAILABLE_BALANCE AS DOUBLE) AS BALANCE
  FROM wallet_balance WHERE CAST(BAL_DATE AS DATE) < {c}
),
customers AS (SELECT DISTINCT ACCOUNT_ID FROM wallet_kyc WHERE lower(ACCOUNT_TYPE) = 'customer'),
population AS (
  SELECT ACCOUNT_ID FROM (SELECT ACCOUNT_ID FROM wallet_labels UNION SELECT ACCOUNT_ID FROM wallet_test_ids) u
  WHERE ACCOUNT_ID IN (SELECT ACCOUNT_ID FROM customers)
),
out_t AS (
  SELECT ACCOUNT_ID, DST_ACCOUNT_ID, TXN_DATE, TXN_AMOUNT, TXN_TYPE, date_diff('day', TXN_DATE, {c}) AS d
  FROM trx WHERE ACCOUNT_ID IN (SELECT ACCOUNT_ID FROM population)
),
in_t AS (
  SELECT DST_ACCOUNT_ID AS ACCOUNT_ID, ACCOUNT_ID AS DST_ACCOUNT_ID, TXN_DATE, TXN_AMOUNT, TXN_TYPE,
         date_diff('day', TXN_DATE, {c}) AS d
  FROM trx WHERE DST_ACCOUNT_ID IS NOT NULL AND DST_ACCOUNT_ID IN (SELECT ACCOUNT_ID FROM population)
)"""


def _win(lo: int | None, hi: int | None) -> str:
    if lo is None:
        return "TRUE"
    if lo == hi:
        return f"d = {lo}"
    return f"d BETWEEN {lo} AND {hi}"


def _is_type(name: str) -> str:
    pattern = dict(TXN_TYPE_PATTERNS)[name]
    return f"regexp_matches(lower(coalesce(CAST(TXN_TYPE AS VARCHAR), '')), '{pattern}')"


def _txn_base_cols() -> list[str]:
    cols = []
    for sfx, lo, hi in TXN_WINDOWS:
        expr = "COUNT(*)" if lo is None else f"SUM(CASE WHEN {_win(lo, hi)} THEN 1 ELSE 0 END)"
        cols.append(f"CAST({expr} AS BIGINT) AS txn_count_{sfx}")
    for sfx, lo, hi in TXN_WINDOWS:
        expr = "SUM(TXN_AMOUNT)" if lo is None else f"SUM(CASE WHEN {_win(lo, hi)} THEN TXN_AMOUNT ELSE 0.0 END)"
        cols.append(f"{expr} AS txn_sum_{sfx}")
    cols += [
        "AVG(TXN_AMOUNT) AS avg_txn_amount",
        "STDDEV_SAMP(TXN_AMOUNT) AS std_txn_amount",
        "MAX(TXN_AMOUNT) AS max_txn_amount",
        "MIN(TXN_AMOUNT) AS min_txn_amount",
        "QUANTILE_DISC(TXN_AMOUNT, 0.5) AS median_txn_amount",
    ]
    for sfx, hi in COUNTERPARTY_WINDOWS:
        arg = "DST_ACCOUNT_ID" if hi is None else f"CASE WHEN {_win(1, hi)} THEN DST_ACCOUNT_ID END"
        cols.append(f"COUNT(DISTINCT {arg}) AS unique_dst_accounts{sfx}")
    cols.append("COUNT(DISTINCT TXN_TYPE) AS unique_txn_types")
    for sfx, hi in ACTIVE_DAY_WINDOWS:
        arg = "TXN_DATE" if hi is None else f"CASE WHEN {_win(1, hi)} THEN TXN_DATE END"
        cols.append(f"COUNT(DISTINCT {arg}) AS active_days_{sfx}")
    cols += ["MAX(TXN_DATE) AS last_txn_date", "MIN(TXN_DATE) AS first_txn_date"]
    for t in TYPE_NAMES:
        cols.append(f"CAST(SUM(CASE WHEN {_is_type(t)} THEN 1 ELSE 0 END) AS BIGINT) AS {t}_count_90d")
    for t in TYPE_NAMES:
        cols.append(f"CAST(SUM(CASE WHEN {_is_type(t)} AND d BETWEEN 1 AND 30 THEN 1 ELSE 0 END) AS BIGINT) AS {t}_count_30d")
    for t in TXN_TYPES_WITH_RECENCY:
        cols.append(f"MAX(CASE WHEN {_is_type(t)} THEN TXN_DATE END) AS last_{t}_date")
    return cols


def _ratio(a: str, b: str, one: str = "1") -> str:
    return f"CAST({a} AS DOUBLE) / GREATEST({b}, {one})"


def _ln1p(x: str) -> str:
    return f"(CASE WHEN {x} > -1 THEN ln(1 + {x}) END)"


def _txn_derived_cols(cutoff: str) -> list[tuple[str, str]]:
    c = _cut(cutoff)
    dl = f"date_diff('day', last_txn_date, {c})"
    df = f"date_diff('day', first_txn_date, {c})"
    out = [("days_since_last_transaction", dl), ("days_since_first_transaction", df)]
    for t in TXN_TYPES_WITH_RECENCY:
        out.append((f"days_since_last_{t}", f"date_diff('day', last_{t}_date, {c})"))
    for t in TYPE_NAMES:
        out.append((f"{t}_ratio", _ratio(f"{t}_count_90d", "txn_count_90d")))
    for t in TYPE_NAMES:
        out.append((f"{t}_ratio_30d", _ratio(f"{t}_count_30d", "txn_count_30d")))
    for a, b in TXN_COUNT_RATIOS:
        out.append((f"txn_count_{a}_to_{b}", _ratio(f"txn_count_{a}", f"txn_count_{b}")))
    for a, b in TXN_SUM_RATIOS:
        out.append((f"txn_sum_{a}_to_{b}", _ratio(f"txn_sum_{a}", f"txn_sum_{b}", "1.0")))
    out += [
        ("txn_count_recent_vs_prev30", _ratio("txn_count_30d", "txn_count_31_60d")),
        ("txn_count_prev30_vs_old30", _ratio("txn_count_31_60d", "txn_count_61_90d")),
        ("txn_sum_recent_vs_prev30", _ratio("txn_sum_30d", "txn_sum_31_60d", "1.0")),
        ("txn_sum_prev30_vs_old30", _ratio("txn_sum_31_60d", "txn_sum_61_90d", "1.0")),
    ]
    for n in ACTIVE_DAY_RATIO_DAYS:
        out.append((f"active_day_ratio_{n}d", f"active_days_{n}d / {float(n)}"))
    out += [
        ("active_day_7d_to_30d", _ratio("active_days_7d", "active_days_30d")),
        ("active_day_14d_to_30d", _ratio("active_days_14d", "active_days_30d")),
        ("dst_diversity_7d_to_30d", _ratio("unique_dst_accounts_7d", "unique_dst_accounts_30d")),
        ("dst_per_txn_30d", _ratio("unique_dst_accounts_30d", "txn_count_30d")),
        ("txn_per_active_day_30d", _ratio("txn_count_30d", "active_days_30d")),
        ("txn_per_active_day_90d", _ratio("txn_count_90d", "active_days_90d")),
        ("recency_x_count_30d", f"{dl} * {_ln1p('txn_count_30d')}"),
        ("recency_x_sum_30d", f"{dl} * {_ln1p('txn_sum_30d')}"),
        ("activity_frequency_score", _ratio("txn_count_90d", df)),
    ]
    return out


def txn_feature_ctes(cutoff: str = FIXTURE_CUTOFF) -> str:
    """``out_f`` / ``in_f``: one row per account and direction, unprefixed feature names."""
    parts = []
    for p in ("out", "in"):
        base = ",\n    ".join(_txn_base_cols())
        derived = ",\n    ".join(f"{expr} AS {name}" for name, expr in _txn_derived_cols(cutoff))
        parts.append(f"""
{p}_base AS (
  SELECT ACCOUNT_ID,
    {base}
  FROM {p}_t GROUP BY ACCOUNT_ID
),
{p}_gap AS (
  SELECT ACCOUNT_ID, MAX(g) AS max_txn_gap_days, AVG(g) AS avg_txn_gap_days
  FROM (SELECT ACCOUNT_ID, date_diff('day', LAG(TXN_DATE) OVER (PARTITION BY ACCOUNT_ID ORDER BY TXN_DATE), TXN_DATE) AS g
        FROM (SELECT DISTINCT ACCOUNT_ID, TXN_DATE FROM {p}_t) x) y
  GROUP BY ACCOUNT_ID
),
{p}_f AS (
  SELECT b.*, g.max_txn_gap_days, g.avg_txn_gap_days,
    {derived}
  FROM {p}_base b LEFT JOIN {p}_gap g ON g.ACCOUNT_ID = b.ACCOUNT_ID
)""")
    return ",".join(parts)


def _bal_agg(fn: str, lo: int, hi: int) -> str:
    w = _win(lo, hi)
    if fn == "avg":
        return f"AVG(CASE WHEN {w} THEN BALANCE END)"
    if fn == "min":
        return f"MIN(CASE WHEN {w} THEN BALANCE END)"
    if fn == "max":
        return f"MAX(CASE WHEN {w} THEN BALANCE END)"
    if fn == "stddev":
        return f"STDDEV_SAMP(CASE WHEN {w} THEN BALANCE END)"
    if fn == "count":
        return f"CAST(SUM(CASE WHEN {w} THEN 1 ELSE 0 END) AS BIGINT)"
    if fn == "count_nonpositive":
        return f"CAST(SUM(CASE WHEN {w} AND BALANCE <= 0 THEN 1 ELSE 0 END) AS BIGINT)"
    if fn == "median":
        return f"QUANTILE_DISC(BALANCE, 0.5) FILTER (WHERE {w})"
    raise ValueError(fn)


def balance_feature_cte(cutoff: str = FIXTURE_CUTOFF) -> str:
    """``bal_f``: balance aggregates, newest / oldest balance and the derived ratios."""
    c = _cut(cutoff)
    aggs = ",\n    ".join(f"{_bal_agg(fn, lo, hi)} AS {name}" for name, fn, lo, hi in BALANCE_AGGREGATES)

    def rat(name: str, a: str, b: str, absolute: bool) -> str:
        den = f"ABS({b})" if absolute else b
        one = "1.0" if absolute else "1"
        return f"CAST({a} AS DOUBLE) / GREATEST({den}, {one}) AS {name}"

    derived = [rat(*r) for r in BALANCE_RATIOS]
    derived.append("avg_balance_90d - avg_balance_30d AS balance_drop_30d")
    derived += [rat(*r) for r in BALANCE_RATIOS_TAIL]
    derived_sql = ",\n    ".join(derived)
    return f"""
bal_t AS (
  SELECT ACCOUNT_ID, BAL_DATE, BALANCE, date_diff('day', BAL_DATE, {c}) AS d
  FROM bal WHERE ACCOUNT_ID IN (SELECT ACCOUNT_ID FROM population)
),
bal_a AS (
  SELECT ACCOUNT_ID,
    {aggs},
    arg_max_null(BALANCE, BAL_DATE) AS last_balance,
    arg_min_null(BALANCE, BAL_DATE) AS first_balance_90d
  FROM bal_t GROUP BY ACCOUNT_ID
),
bal_f AS (
  SELECT *,
    {derived_sql}
  FROM bal_a
)"""


def kyc_feature_cte(cutoff: str = FIXTURE_CUTOFF) -> str:
    """``kyc_f``: account age and frequency-ranked category indices (null = number of labels)."""
    c = _cut(cutoff)
    idx_ctes = []
    idx_cols = []
    for col in ("GENDER", "REGION", "ACCOUNT_TYPE"):
        low = col.lower()
        idx_ctes.append(f"""
{low}_labels AS (
  SELECT v, CAST(ROW_NUMBER() OVER (ORDER BY n DESC, v) - 1 AS DOUBLE) AS idx
  FROM (SELECT {col} AS v, COUNT(*) AS n FROM kyc_p WHERE {col} IS NOT NULL GROUP BY {col}) s
)""")
        idx_cols.append(
            f"COALESCE((SELECT idx FROM {low}_labels WHERE v = k.{col}), "
            f"CAST((SELECT COUNT(*) FROM {low}_labels) AS DOUBLE)) AS {low}_idx"
        )
    return f"""
kyc_p AS (SELECT * FROM wallet_kyc WHERE ACCOUNT_ID IN (SELECT ACCOUNT_ID FROM population)),""" + ",".join(idx_ctes) + f""",
kyc_rows AS (
  SELECT k.ACCOUNT_ID, k.ACCOUNT_OPEN_DATE,
    CAST(date_diff('day', CAST(k.ACCOUNT_OPEN_DATE AS DATE), {c}) AS INTEGER) AS account_age_days,
    {", ".join(idx_cols)}
  FROM kyc_p k
),
kyc_f AS (
  SELECT ACCOUNT_ID, account_age_days, gender_idx, region_idx, account_type_idx
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY ACCOUNT_ID ORDER BY ACCOUNT_OPEN_DATE NULLS LAST) AS rn FROM kyc_rows) r
  WHERE rn = 1
)"""


def round4(expr: str) -> str:
    """Half-up rounding on the decimal value, the same rule Spark's ``round`` applies."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38, 10)), 4) AS DOUBLE)"


def with_all(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def _cross_cols() -> list[tuple[str, str]]:
    o30, i30 = "COALESCE(out_txn_sum_30d, 0.0)", "COALESCE(in_txn_sum_30d, 0.0)"
    o90, i90 = "COALESCE(out_txn_sum_90d, 0.0)", "COALESCE(in_txn_sum_90d, 0.0)"
    oc, ic = "COALESCE(out_txn_count_30d, 0.0)", "COALESCE(in_txn_count_30d, 0.0)"
    days = "GREATEST(COALESCE(out_active_days_90d, 0.0), COALESCE(in_active_days_90d, 0.0), 1.0)"
    return [
        ("out_txn_to_balance_ratio", f"{o30} / GREATEST(ABS(avg_balance_30d), 1.0)"),
        ("in_txn_to_balance_ratio", f"{i30} / GREATEST(ABS(avg_balance_30d), 1.0)"),
        ("net_flow_30d", f"{i30} - {o30}"),
        ("net_flow_90d", f"{i90} - {o90}"),
        ("in_out_amount_ratio_30d", f"{i30} / GREATEST({o30}, 1.0)"),
        ("in_out_count_ratio_30d", f"{ic} / GREATEST({oc}, 1.0)"),
        ("amount_per_active_day_90d", f"({o90} + {i90}) / {days}"),
    ]


def feature_store_ctes(txn_names: list[str], bal_names: list[str], kyc_names: list[str],
                       cutoff: str = FIXTURE_CUTOFF) -> str:
    """``joined`` (population-anchored, unfilled, with the cross features)."""
    sel = ["p.ACCOUNT_ID"]
    sel += [f"out_f.{n} AS out_{n}" for n in txn_names]
    sel += [f"in_f.{n} AS in_{n}" for n in txn_names]
    sel += [f"bal_f.{n}" for n in bal_names]
    sel += [f"kyc_f.{n}" for n in kyc_names]
    cross = ",\n    ".join(f"{e} AS {n}" for n, e in _cross_cols())
    return ",".join([
        base_ctes(cutoff), txn_feature_ctes(cutoff), balance_feature_cte(cutoff), kyc_feature_cte(cutoff),
        f"""
pre AS (
  SELECT {", ".join(sel)}
  FROM population p
  LEFT JOIN out_f ON out_f.ACCOUNT_ID = p.ACCOUNT_ID
  LEFT JOIN in_f ON in_f.ACCOUNT_ID = p.ACCOUNT_ID
  LEFT JOIN bal_f ON bal_f.ACCOUNT_ID = p.ACCOUNT_ID
  LEFT JOIN kyc_f ON kyc_f.ACCOUNT_ID = p.ACCOUNT_ID
),
joined AS (
  SELECT *,
    {cross}
  FROM pre
)"""])
