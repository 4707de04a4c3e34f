"""Parameter search by successive halving (M7).

All trials are fits in progress over one binned matrix: each job works for all that are left. After a
number of rounds the trials are ranked by their best validation AUC, one in ``eta`` goes on where it
stands, and the number of rounds grows ``eta``-fold, until one is left; that one boosts until patience
ends it. Parameters are drawn by a hash of (seed, trial, name), so a trial is the same wherever and
whenever it is drawn.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .boost import BINS, Boosting, LeafParams
from .trees import BoostedTrees

# --------------------------------------------------------------------------------------
# The ranges of the published search. Whole numbers include both ends.
# --------------------------------------------------------------------------------------
WHOLE_RANGES: dict[str, tuple[int, int]] = {
    "num_leaves": (31, 255),
    "max_depth": (4, 14),
    "min_child_samples": (20, 500),
}
LINEAR_RANGES: dict[str, tuple[float, float]] = {
    "subsample": (0.6, 1.0),
    "colsample_bytree": (0.6, 1.0),
    "lambda_l1": (0.0, 5.0),
    "lambda_l2": (0.0, 10.0),
}

#: one in so many trials goes on
ETA = 3


def draw(seed: int, trial: int, name: str) -> float:
    """A number in [0, 1): the first 8 hex digits of the MD5 of ``seed|trial|name``."""
    return int(hashlib.md5(f"{seed}|{trial}|{name}".encode()).hexdigest()[:8], 16) / 2.0**32


def draw_params(seed: int, trial: int, learning_rates: tuple[float, float] = (0.005, 0.08)) -> LeafParams:
    """The parameters of a trial; the learning rate is uniform on a log scale, all others on their own."""
    found: dict[str, float] = {}
    for name, (low, high) in WHOLE_RANGES.items():
        found[name] = low + math.floor(draw(seed, trial, name) * (high - low + 1))
    for name, (low, high) in LINEAR_RANGES.items():
        found[name] = low + draw(seed, trial, name) * (high - low)
    low, high = learning_rates
    found["learning_rate"] = low * (high / low) ** draw(seed, trial, "learning_rate")
    return LeafParams(**found)


@dataclass
class Rung:
    """Where a trial stood when trials were compared."""

    trial: int
    rung: int
    rounds: int
    best_round: int
    auc: float
    kept: bool


@dataclass
class SearchResult:
    params: LeafParams
    trial: int
    rounds: int
    auc: float
    model: BoostedTrees
    all_params: list[LeafParams]
    rungs: list[Rung]

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per trial and rung with the trial's parameters."""
        names = list(self.all_params[0].to_dict())
        rows = [
            (r.trial, r.rung, r.rounds, r.best_round, r.auc, r.kept, *[float(self.all_params[r.trial].to_dict()[n]) for n in names])
            for r in self.rungs
        ]
        kinds = ", ".join(f"{n} double" for n in names)
        return spark.createDataFrame(rows, f"trial int, rung int, rounds int, best_round int, auc double, kept boolean, {kinds}")


def successive_halving(
    matrix: DataFrame,
    feature_cols: list[str],
    params: list[LeafParams],
    first_rounds: int,
    limit: int,
    patience: int,
    seed: int = 42,
    eta: int = ETA,
    bins: int = BINS,
) -> SearchResult:
    """The best of the trials and its model; the last row of its trial in ``rungs`` is its whole fit."""
    rungs: list[Rung] = []
    with Boosting(matrix, feature_cols, params, seed, bins) as b:
        rung, done, rounds = 0, 0, min(first_rounds, limit)
        while len(b.live) > 1 and done < limit:
            b.advance(rounds - done)
            done = rounds
            ranked = sorted(b.live, key=lambda t: (-t.auc if t.auc == t.auc else math.inf, t.number))
            kept = ranked[: -(-len(ranked) // eta)]
            rungs += [Rung(t.number, rung, len(t.trees), t.best_round, t.auc, t in kept) for t in b.live]
            b.keep(kept)
            rung, rounds = rung + 1, min(limit, rounds * eta)
        winner = b.live[0]
        b.keep([winner])
        b.advance(limit - len(winner.trees), patience)
        rungs.append(Rung(winner.number, rung, len(winner.trees), winner.best_round, winner.auc, True))
        return SearchResult(winner.params, winner.number, winner.best_round, winner.auc, b.model(winner), params, rungs)
