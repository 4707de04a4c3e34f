"""Run configuration, canonical column names and the fixed feature definitions.

The window table, the transaction-type patterns and the fill values below decide the
meaning of every feature name; they must stay equal to the published feature list, so they
live here as plain data and every builder (Spark side and oracle side) reads them.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

# --------------------------------------------------------------------------------------
# Fixed values (must equal the published pipeline for identical features)
# --------------------------------------------------------------------------------------

#: transaction count / sum windows: (suffix, first day, last day); ``None`` = all history.
#: The plain ``90d`` name has no lower bound: it covers every row before the cutoff.
TXN_WINDOWS: tuple[tuple[str, int | None, int | None], ...] = (
    ("90d", None, None),
    ("1d", 1, 1),
    ("2d", 1, 2),
    ("3d", 1, 3),
    ("5d", 1, 5),
    ("14d", 1, 14),
    ("21d", 1, 21),
    ("45d", 1, 45),
    ("60d", 1, 60),
    ("31_60d", 31, 60),
    ("61_90d", 61, 90),
    ("30d", 1, 30),
    ("7d", 1, 7),
)

#: distinct active days windows (last day; ``None`` = all history, named ``90d``).
ACTIVE_DAY_WINDOWS: tuple[tuple[str, int | None], ...] = (
    ("30d", 30),
    ("7d", 7),
    ("14d", 14),
    ("21d", 21),
    ("90d", None),
)

#: distinct counterparty windows (suffix, last day); "" = all history.
COUNTERPARTY_WINDOWS: tuple[tuple[str, int | None], ...] = (
    ("", None),
    ("_7d", 7),
    ("_30d", 30),
)

#: transaction type classes, matched on lower(coalesce(type, '')); they overlap on purpose.
TXN_TYPE_PATTERNS: tuple[tuple[str, str], ...] = (
    ("p2p", "p2p|send|transfer"),
    ("bill", "bill"),
    ("merchant", "merchant|pay"),
    ("cashout", "cash.?out|cashout"),
)

#: type classes that get a "last date" / "days since last" feature.
TXN_TYPES_WITH_RECENCY: tuple[str, ...] = ("p2p", "bill", "merchant")

#: fill for missing recency and gap features; every other numeric feature gets 0.
MISSING_RECENCY_FILL = 9999
RECENCY_NAME_MARKERS: tuple[str, ...] = ("days_since", "gap_days")

#: account-dimension category columns, indexed by frequency.
KYC_CATEGORY_COLUMNS: tuple[str, ...] = ("GENDER", "REGION", "ACCOUNT_TYPE")

#: split-date candidates for the time-ordered validation split, first present wins.
SPLIT_DATE_CANDIDATES: tuple[str, ...] = ("LABEL_DATE", "SNAPSHOT_DATE", "AS_OF_DATE", "ACCOUNT_OPEN_DATE")

#: columns that never enter the feature vector.
NON_FEATURE_COLUMNS: tuple[str, ...] = (
    "ACCOUNT_ID", "CHURN", "LABEL_DATE", "SNAPSHOT_DATE", "AS_OF_DATE", "ACCOUNT_OPEN_DATE",
)

#: derived transaction ratios: numerator window / denominator window
TXN_COUNT_RATIOS: tuple[tuple[str, str], ...] = (
    ("1d", "7d"), ("3d", "14d"), ("7d", "14d"), ("14d", "30d"), ("21d", "45d"), ("7d", "30d"), ("30d", "90d"),
)
TXN_SUM_RATIOS: tuple[tuple[str, str], ...] = (
    ("1d", "7d"), ("3d", "14d"), ("7d", "14d"), ("14d", "30d"), ("7d", "30d"), ("30d", "90d"),
)
#: active-day share denominators (days in the window)
ACTIVE_DAY_RATIO_DAYS: tuple[int, ...] = (7, 14, 21, 30, 90)

#: balance aggregates: (name, function, window first day, window last day)
BALANCE_AGGREGATES: tuple[tuple[str, str, int, int], ...] = (
    ("avg_balance_1d", "avg", 1, 1),
    ("avg_balance_3d", "avg", 1, 3),
    ("avg_balance_7d", "avg", 1, 7),
    ("avg_balance_14d", "avg", 1, 14),
    ("balance_min_7d", "min", 1, 7),
    ("balance_max_7d", "max", 1, 7),
    ("balance_std_7d", "stddev", 1, 7),
    ("zero_balance_days_7d", "count_nonpositive", 1, 7),
    ("balance_obs_7d", "count", 1, 7),
    ("avg_balance_30d", "avg", 1, 30),
    ("avg_balance_31_60d", "avg", 31, 60),
    ("avg_balance_61_90d", "avg", 61, 90),
    ("balance_std_30d", "stddev", 1, 30),
    ("balance_min_30d", "min", 1, 30),
    ("balance_max_30d", "max", 1, 30),
    ("avg_balance_90d", "avg", 1, 90),
    ("balance_std_90d", "stddev", 1, 90),
    ("zero_balance_days_30d", "count_nonpositive", 1, 30),
    ("balance_obs_30d", "count", 1, 30),
    ("median_balance_30d", "median", 1, 30),
)

#: derived balance ratios: (name, numerator, denominator, denominator in absolute value)
BALANCE_RATIOS: tuple[tuple[str, str, str, bool], ...] = (
    ("zero_balance_ratio_7d", "zero_balance_days_7d", "balance_obs_7d", False),
    ("zero_balance_ratio", "zero_balance_days_30d", "balance_obs_30d", False),
    ("balance_cv_7d", "balance_std_7d", "avg_balance_7d", True),
    ("balance_cv_30d", "balance_std_30d", "avg_balance_30d", True),
    ("balance_1d_to_7d", "avg_balance_1d", "avg_balance_7d", True),
    ("balance_3d_to_14d", "avg_balance_3d", "avg_balance_14d", True),
    ("balance_7d_to_30d", "avg_balance_7d", "avg_balance_30d", True),
    ("balance_14d_to_30d", "avg_balance_14d", "avg_balance_30d", True),
)
#: placed after balance_14d_to_30d: balance_drop_30d = avg_balance_90d - avg_balance_30d
BALANCE_RATIOS_TAIL: tuple[tuple[str, str, str, bool], ...] = (
    ("balance_recent_vs_prev30", "avg_balance_30d", "avg_balance_31_60d", True),
    ("balance_prev30_vs_old30", "avg_balance_31_60d", "avg_balance_61_90d", True),
    ("balance_last_vs_first", "last_balance", "first_balance_90d", True),
)

# --------------------------------------------------------------------------------------

#: bump when a feature definition changes; stored with the feature store and checked on reuse.
FEATURE_VERSION = "1"

ACCOUNT = "ACCOUNT_ID"


@dataclass(frozen=True)
class ColumnMap:
    """Raw input column names, renamed to the canonical schema on load (defaults: fixed values of the export)."""

    account_col: str = "ACCOUNT_ID"
    src_account_col: str = "SRC_ACCOUNT"
    dst_account_col: str = "DST_ACCOUNT"
    txn_date_col: str = "TRX_DATETIME"
    txn_amount_col: str = "TRX_AMT"
    txn_type_col: str = "TRX_TYPE"
    balance_date_col: str = "DATE"
    balance_amount_col: str = "AVAILABLE_BALANCE"
    label_col: str = "CHURN"


@dataclass
class PipelineConfig:
    """Everything a run needs; the caller owns the SparkSession."""

    data_dir: str = ""
    work_dir: str = ""
    output_dir: str = ""
    #: rows dated before this day are used; required
    cutoff_date: str = ""
    valid_frac: float = 0.20
    train_sample_frac: float = 1.0
    search_trials: int = 50
    random_seed: int = 42
    reuse_feature_store: bool = False
    #: the population is broadcast into the fact scans only when its counted size is below this
    broadcast_max_rows: int = 2_000_000
    #: top fraction for precision / recall
    top_frac: float = 0.10
    #: ``leafwise``: leaf-wise boosting with the published parameters, trials by successive halving, an end by
    #: validation AUC; ``mllib``: MLlib's boosting, trials one after another, an end by validation loss
    engine: str = "leafwise"
    #: rounds after which the trials are compared for the first time (leafwise)
    search_first_rounds: int = 100
    #: a fit ends when it has not improved on the validation rows for ``patience`` rounds; the limits are only there
    #: to end a fit that never stops improving
    search_max_iter: int = 5_000
    search_patience: int = 150
    final_max_iter: int = 8_000
    final_patience: int = 250
    #: range of the step sizes that the search draws from (log scale)
    step_size_min: float = 0.005
    step_size_max: float = 0.08
    #: initial shuffle partitions of a cluster run; AQE coalesces from there
    shuffle_partitions: int = 800
    columns: ColumnMap = field(default_factory=ColumnMap)

    def to_dict(self) -> dict:
        return asdict(self)
