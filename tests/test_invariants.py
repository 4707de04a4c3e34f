"""Invariants of the feature table on the fixture (sf0.001) and its schema golden."""

import pytest
from pyspark.sql import functions as F

from ledgerscope.config import ACCOUNT
from ledgerscope.plans import catalog
from ledgerscope.plans.feature_job import build_features
from ledgerscope.sources.normalize import Inputs

from conftest import SMALL


@pytest.fixture(scope="module")
def features(spark):
    return build_features(catalog.fixture(spark, SMALL), catalog.CUTOFF).features.cache()


def test_schema_golden_233_numeric_features(features):
    cols = [c for c in features.columns if c != ACCOUNT]
    assert len(cols) == 233 and len(set(cols)) == 233
    assert cols == catalog.feature_table_columns()
    assert all(t in ("int", "bigint", "double") for c, t in features.dtypes if c != ACCOUNT)


def test_one_row_per_population_account_and_no_nulls(spark, features):
    inp = catalog.fixture(spark, SMALL)
    pop = catalog.fixture_population(spark, inp)
    assert features.count() == pop.rows == features.select(ACCOUNT).distinct().count()
    nulls = features.select([F.sum(F.col(c).isNull().cast("int")).alias(c) for c in features.columns]).first()
    assert all(v == 0 for v in nulls)


@pytest.mark.parametrize("p", ["out", "in"])
def test_windows_monotone_and_additive(features, p):
    chain = ["1d", "2d", "3d", "5d", "7d", "14d", "21d", "30d", "45d", "60d", "90d"]
    for a, b in zip(chain, chain[1:]):
        assert features.filter(F.col(f"{p}_txn_count_{a}") > F.col(f"{p}_txn_count_{b}")).count() == 0
    bad = features.filter(F.col(f"{p}_txn_count_60d") != F.col(f"{p}_txn_count_30d") + F.col(f"{p}_txn_count_31_60d"))
    assert bad.count() == 0
    assert features.filter(F.col(f"{p}_active_days_90d") > F.col(f"{p}_txn_count_90d")).count() == 0
    assert features.filter(F.col(f"{p}_unique_dst_accounts_30d") > F.col(f"{p}_txn_count_30d")).count() == 0


def test_leak_guard_rows_after_cutoff_change_nothing(spark, features):
    inp = catalog.fixture(spark, SMALL)
    # future copies of real transfers, one year after the cutoff
    later = inp.transactions.select(
        "ACCOUNT_ID", "DST_ACCOUNT_ID", "TXN_TS", F.date_add("TXN_DATE", 4000).alias("TXN_DATE"), "TXN_AMOUNT", "TXN_TYPE"
    )
    from ledgerscope.sources.normalize import asof_filter

    leaky = Inputs(asof_filter(inp.transactions.unionByName(later), "TXN_DATE", catalog.CUTOFF), inp.balances, inp.kyc,
                   inp.labels, inp.test_ids)
    again = build_features(leaky, catalog.CUTOFF).features
    assert features.exceptAll(again).count() == 0 and again.exceptAll(features).count() == 0


def test_result_unchanged_by_repartitioning(spark, features):
    inp = catalog.fixture(spark, SMALL)
    shuffled = Inputs(inp.transactions.repartition(7), inp.balances.repartition(3), inp.kyc, inp.labels, inp.test_ids)
    again = build_features(shuffled, catalog.CUTOFF).features
    cols = [c for c, t in features.dtypes if t != "double"]
    assert features.select(cols).exceptAll(again.select(cols)).count() == 0
