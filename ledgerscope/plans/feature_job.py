"""Path A: canonical inputs -> account feature table (the "feature store")."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.assemble import assemble_features
from ..operators.balances import balance_features
from ..operators.dimension import kyc_features
from ..operators.population import Population, population_ids
from ..operators.transactions import transaction_features
from ..sources.normalize import Inputs


@dataclass
class FeatureBuild:
    features: DataFrame
    population: Population


def build_features(inp: Inputs, cutoff_date: str, broadcast_max_rows: int = 2_000_000, fill: bool = True) -> FeatureBuild:
    """One lazy plan for the whole feature table; only the population size is counted up front."""
    pop = Population.of(population_ids(inp.labels, inp.test_ids, inp.kyc), broadcast_max_rows)
    txn_f = transaction_features(inp.transactions, cutoff_date, pop)
    bal_f = balance_features(inp.balances, cutoff_date, pop)
    kyc_f = kyc_features(inp.kyc, cutoff_date, pop)
    return FeatureBuild(assemble_features(pop.ids, txn_f, bal_f, kyc_f, fill=fill), pop)
