"""Population operators: the scored population (P2, J1, U1, U2) and the restriction of fact
rows to it (J2a-d) with a size-checked broadcast."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ACCOUNT
from ..session import ensure_checkpoint_dir
from .key_filter import KeyFilter


def population_ids(labels: DataFrame, test_ids: DataFrame, kyc: DataFrame) -> DataFrame:
    """J1 + U1: (label keys UNION test keys) restricted to customers, one row per key.

    A semi-join gives the same rows as the inner join with the distinct customer keys,
    without materialising the customer side's distinct first.
    """
    keys = labels.select(ACCOUNT).unionByName(test_ids.select(ACCOUNT)).distinct()
    customers = kyc.filter(F.lower(F.col("ACCOUNT_TYPE")) == "customer") if "ACCOUNT_TYPE" in kyc.columns else kyc
    return keys.join(customers.select(ACCOUNT), ACCOUNT, "left_semi")


@dataclass
class Population:
    """The scored population plus the decision how fact rows are restricted to it.

    The keys are checkpointed once (into the session's ``spark.checkpoint.dir``): every
    later join reads that small file set instead of re-deriving the population from labels,
    test ids and kyc, and an executor loss does not re-run that derivation.

    ``rows`` and ``bytes`` (of the keys as text) are exact, taken once. Below both bounds the
    keys are broadcast into the fact scans (a map-side semi-join, no fact shuffle). Above them a Bloom
    filter of the keys (``KeyFilter``, built once) takes other accounts' rows out at the scan, the facts are
    aggregated as usual, map-side first, and the exact semi-join is made on the aggregated rows, which are
    partitioned by the account already: no raw fact row is shuffled for the population's sake.
    """

    ids: DataFrame
    rows: int
    bytes: int
    broadcast_max_rows: int
    broadcast_max_bytes: int
    _filter: KeyFilter | None = None

    @classmethod
    def of(cls, ids: DataFrame, broadcast_max_rows: int = 2_000_000, broadcast_max_bytes: int = 64 << 20) -> "Population":
        ensure_checkpoint_dir(ids.sparkSession)
        frozen = ids.checkpoint(eager=True)
        size = frozen.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col(ACCOUNT).cast("string"))).alias("b")).first()
        return cls(frozen, int(size["n"]), int(size["b"] or 0), broadcast_max_rows, broadcast_max_bytes)

    @property
    def broadcastable(self) -> bool:
        return self.rows <= self.broadcast_max_rows and self.bytes <= self.broadcast_max_bytes

    def semi_join(self, df: DataFrame, key: str = ACCOUNT) -> DataFrame:
        """The rows of ``df`` whose ``key`` is in the population."""
        ids = self.ids.withColumnRenamed(ACCOUNT, key)
        return df.join(F.broadcast(ids) if self.broadcastable else ids, key, "left_semi")

    def may_hold(self, column: str, df: DataFrame) -> Column:
        """False only for values of ``column`` that aren't in the population."""
        if self._filter is None:
            self._filter = KeyFilter.of(self.ids, ACCOUNT, self.rows)
        return self._filter.may_hold(column, df)

    def restrict(self, facts: DataFrame) -> DataFrame:
        """Fact rows of the population; above the broadcast bound some others remain until ``settle``."""
        return self.semi_join(facts) if self.broadcastable else facts.where(self.may_hold(ACCOUNT, facts))

    def settle(self, aggregated: DataFrame) -> DataFrame:
        """Rows aggregated from ``restrict``'s, without other accounts.

        The keys are distinct, so an inner join is a semi-join; one written as such would be pushed below
        the aggregation, where it would shuffle the facts.
        """
        return aggregated if self.broadcastable else aggregated.join(self.ids, ACCOUNT)
