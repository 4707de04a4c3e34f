"""Plan-shape checks: the cutoff reaches the scan, no Expand, no single-partition exchange,
population broadcast only below its counted bound."""

from ledgerscope.operators.population import Population, population_ids
from ledgerscope.operators.transactions import transaction_features
from ledgerscope.plans import catalog
from ledgerscope.plans.feature_job import build_features

from conftest import SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cutoff_filter_is_pushed_to_the_scan(spark):
    inp = catalog.fixture(spark, SMALL)
    p = inp.transactions._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in p.splitlines() if "FileScan parquet" in line and "l_shipdate" in line][0]
    assert "PushedFilters" in scan and "LessThan(l_shipdate" in scan


def test_feature_plan_has_no_expand_and_no_single_partition(spark):
    f = build_features(catalog.fixture(spark, SMALL), catalog.CUTOFF).features
    f.write.format("noop").mode("overwrite").save()
    p = plan_of(f)
    assert "Expand" not in p
    assert "SinglePartition" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_transactions_scanned_three_times_not_more(spark):
    inp = catalog.fixture(spark, SMALL)
    t = transaction_features(inp.transactions, catalog.CUTOFF, catalog.fixture_population(spark, inp))
    t.write.format("noop").mode("overwrite").save()
    p = plan_of(t)
    assert p.count("FileScan parquet") - p.count("FileScan parquet [c_") - p.count("FileScan parquet [n_") \
        - p.count("FileScan parquet [r_") - p.count("FileScan parquet [o_") <= 3


def test_population_broadcast_only_under_the_bound(spark):
    inp = catalog.fixture(spark, SMALL)
    ids = population_ids(inp.labels, inp.test_ids, inp.kyc)
    small = Population.of(ids, broadcast_max_rows=10**6)
    large = Population.of(ids, broadcast_max_rows=1)
    assert small.broadcastable and not large.broadcastable
    a = transaction_features(inp.transactions, catalog.CUTOFF, small)
    b = transaction_features(inp.transactions, catalog.CUTOFF, large)
    ka = [c for c, t in a.dtypes if t != "double"]
    assert a.select(ka).exceptAll(b.select(ka)).count() == 0 and b.count() == a.count()


def test_whole_table_identical_with_and_without_population_broadcast(spark):
    from ledgerscope.functions.exprs import round_doubles

    inp = catalog.fixture(spark, SMALL)
    a = round_doubles(build_features(inp, catalog.CUTOFF).features)
    b = round_doubles(build_features(inp, catalog.CUTOFF, broadcast_max_rows=0).features)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_the_cutoff_prunes_partitions_and_nanosecond_scans(spark, tmp_path):
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq

    from ledgerscope.sources.readers import read_parquet

    os.makedirs(tmp_path / "ns")
    pq.write_table(pa.table({"t": pa.array([1_700_000_000_000_000_000], pa.timestamp("ns", tz="UTC"))}), tmp_path / "ns/p.parquet")
    p = plan_of(read_parquet(spark, [str(tmp_path / "ns")], before={"t": "2024-04-01"}))
    assert "LessThan(t,1711929600000000000)" in p
    spark.range(4).selectExpr("id", "date_add(date'2024-03-30', CAST(id AS INT)) AS day").write.partitionBy("day").parquet(str(tmp_path / "parts"))
    df = read_parquet(spark, [str(tmp_path / "parts")], before={"day": "2024-04-01"})
    assert "PartitionFilters: [isnotnull(day" in plan_of(df) and df.count() == 2


def test_a_large_population_filters_both_keys_at_the_scan(spark, tmp_path):
    inp = catalog.fixture(spark, SMALL)
    inp.transactions.write.parquet(str(tmp_path / "t"))
    large = Population.of(population_ids(inp.labels, inp.test_ids, inp.kyc), broadcast_max_rows=1)
    t = transaction_features(spark.read.parquet(str(tmp_path / "t")), catalog.CUTOFF, large)
    plan = t._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]

    def above(i):
        """The lines of the operators between line i and the root, nearest first."""
        out, at = [], depth[i]
        for j in range(i, -1, -1):
            if depth[j] < at:
                out.append(plan[j].lstrip(" :+-"))
                at = depth[j]
        return out

    scans = [i for i, line in enumerate(plan) if "Relation [" in line]
    assert len(scans) == 3
    for i in scans:
        up = above(i)
        fan_out = next(k for k, line in enumerate(up) if line.startswith("Generate"))
        tested = next(k for k, line in enumerate(up) if line.startswith("Filter") and " OR " in line)
        # both keys are tested below the fan-out; what stands between is neither join nor aggregation
        assert up[tested].count("getbit") >= 6 and "DST_ACCOUNT_ID" in up[tested] and tested < fan_out
        assert not any(line.startswith(("Join", "Aggregate")) for line in up[:fan_out])
        # each side is tested again alone, and no join comes before the first aggregation
        assert any(line.startswith("Filter") and line.count("getbit") >= 3 for line in up[fan_out + 1 :])
        kinds = [line.split(" ")[0] for line in up if line.startswith(("Join", "Aggregate"))]
        assert kinds[0] == "Aggregate"
    # the exact join: the day grain meets the keys
    assert sum("LogicalRDD [ACCOUNT_ID" in line for line in plan) == 1


def test_key_filter_misses_no_key_and_few_others_pass(spark):
    from ledgerscope.operators.key_filter import KeyFilter, filter_bits

    keys = spark.range(0, 150_000, 3).withColumnRenamed("id", "k").unionByName(spark.createDataFrame([(None,), (-5,), (1 << 60,)], "k long"))
    found = KeyFilter.of(keys, "k", 50_002)
    rows = spark.range(200_000).selectExpr("id AS x").unionByName(spark.createDataFrame([(None,), (-5,), (1 << 60,)], "x long"))
    passed = rows.where(found.may_hold("x", rows))
    assert passed.where("x % 3 = 0 AND x < 150000 AND x >= 0 OR x = -5 OR x = 1L << 60").count() == 50_002
    assert passed.where("x IS NULL").count() == 0 and passed.count() < 50_002 + 0.05 * 150_000
    assert filter_bits(0) == 1 << 16 and filter_bits(10**9) == 1 << 28 and filter_bits(10**6) >= 10**7
    other = rows.selectExpr("CAST(x AS STRING) AS x")
    assert other.where(found.may_hold("x", other)).count() == 200_002
    none = KeyFilter.of(keys.where("k = 7"), "k", 0)
    assert rows.where(none.may_hold("x", rows)).count() == 0


def test_keys_are_bounded_by_bytes_too(spark):
    ids = spark.createDataFrame([("k" * 1000,)], "ACCOUNT_ID string")
    assert not Population.of(ids, broadcast_max_bytes=999).broadcastable
    assert Population.of(ids, broadcast_max_bytes=1000).broadcastable
