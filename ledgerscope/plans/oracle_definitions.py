"""The feature definitions as the oracle reads them, kept apart from ``config``.

A wrong window or pattern in ``config`` must not pass by being wrong on both sides, so windows are
worked out here from the published names themselves, and the rest is stated again.
"""

from __future__ import annotations

# Published names, in published order.
_TXN_SUFFIXES = "90d 1d 2d 3d 5d 14d 21d 45d 60d 31_60d 61_90d 30d 7d"
_ACTIVE_SUFFIXES = "30d 7d 14d 21d 90d"


def _window(suffix: str) -> tuple[str, int | None, int | None]:
    """``7d``: days 1 to 7; ``31_60d``: days 31 to 60; ``90d``: everything before the cutoff."""
    if suffix == "90d":
        return suffix, None, None
    low, _, high = suffix.removesuffix("d").rpartition("_")
    return suffix, int(low or 1), int(high)


TXN_WINDOWS = tuple(_window(s) for s in _TXN_SUFFIXES.split())
ACTIVE_DAY_WINDOWS = tuple((s, _window(s)[2]) for s in _ACTIVE_SUFFIXES.split())
ACTIVE_DAY_RATIO_DAYS = (7, 14, 21, 30, 90)
COUNTERPARTY_WINDOWS = (("", None), ("_7d", 7), ("_30d", 30))

TXN_TYPE_PATTERNS = (
    ("p2p", "p2p|send|transfer"),
    ("bill", "bill"),
    ("merchant", "merchant|pay"),
    ("cashout", "cash.?out|cashout"),
)
TXN_TYPES_WITH_RECENCY = ("p2p", "bill", "merchant")


def _pairs(text: str) -> tuple[tuple[str, str], ...]:
    return tuple(tuple(p.split("/")) for p in text.split())


TXN_COUNT_RATIOS = _pairs("1d/7d 3d/14d 7d/14d 14d/30d 21d/45d 7d/30d 30d/90d")
TXN_SUM_RATIOS = _pairs("1d/7d 3d/14d 7d/14d 14d/30d 7d/30d 30d/90d")

#: function of each published balance name; its window is in the name (``90d`` here is days 1 to 90)
_BALANCE_FUNCTIONS = {
    "avg_balance": "avg",
    "balance_min": "min",
    "balance_max": "max",
    "balance_std": "stddev",
    "zero_balance_days": "count_nonpositive",
    "balance_obs": "count",
    "median_balance": "median",
}
_BALANCE_NAMES = (
    "avg_balance_1d avg_balance_3d avg_balance_7d avg_balance_14d balance_min_7d balance_max_7d balance_std_7d "
    "zero_balance_days_7d balance_obs_7d avg_balance_30d avg_balance_31_60d avg_balance_61_90d balance_std_30d "
    "balance_min_30d balance_max_30d avg_balance_90d balance_std_90d zero_balance_days_30d balance_obs_30d "
    "median_balance_30d"
)


def _balance(name: str) -> tuple[str, str, int, int]:
    stem = next(s for s in _BALANCE_FUNCTIONS if name.startswith(f"{s}_"))
    low, _, high = name.removeprefix(f"{stem}_").removesuffix("d").rpartition("_")
    return name, _BALANCE_FUNCTIONS[stem], int(low or 1), int(high)


BALANCE_AGGREGATES = tuple(_balance(n) for n in _BALANCE_NAMES.split())
BALANCE_RATIOS = (
    ("zero_balance_ratio_7d", "zero_balance_days_7d", "balance_obs_7d", False),
    ("zero_balance_ratio", "zero_balance_days_30d", "balance_obs_30d", False),
    ("balance_cv_7d", "balance_std_7d", "avg_balance_7d", True),
    ("balance_cv_30d", "balance_std_30d", "avg_balance_30d", True),
    ("balance_1d_to_7d", "avg_balance_1d", "avg_balance_7d", True),
    ("balance_3d_to_14d", "avg_balance_3d", "avg_balance_14d", True),
    ("balance_7d_to_30d", "avg_balance_7d", "avg_balance_30d", True),
    ("balance_14d_to_30d", "avg_balance_14d", "avg_balance_30d", True),
)
BALANCE_RATIOS_TAIL = (
    ("balance_recent_vs_prev30", "avg_balance_30d", "avg_balance_31_60d", True),
    ("balance_prev30_vs_old30", "avg_balance_31_60d", "avg_balance_61_90d", True),
    ("balance_last_vs_first", "last_balance", "first_balance_90d", True),
)
