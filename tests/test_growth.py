"""What keeps shuffles and tasks small on larger tables: shown on rows of the tests' own."""

import glob

from pyspark.sql import functions as F

from ledgerscope.config import ACCOUNT
from ledgerscope.model import train
from ledgerscope.operators.transactions import day_features, directed_rows
from ledgerscope.plans import catalog


def write_tables(spark, root, rows=400):
    """Every table of the fixtures, small; all orders have one priority, so all transfers have one type."""
    day = F.expr("CAST(date_add(date'2000-01-01', CAST(id % 700 AS INT)) AS TIMESTAMP_NTZ)")
    n = spark.range(rows)
    tables = {
        "orders": n.select(F.col("id").alias("o_orderkey"), (F.col("id") % 40).alias("o_custkey"), F.lit("1-URGENT").alias("o_orderpriority"), day.alias("o_orderdate")),
        "lineitem": n.select(F.col("id").alias("l_orderkey"), (F.col("id") % 60).alias("l_partkey"), day.alias("l_shipdate"), (F.col("id") * 1.25).alias("l_extendedprice")),
        "customer": spark.range(40).select(F.col("id").alias("c_custkey"), F.lit(0).alias("c_nationkey"), F.lit("A").alias("c_mktsegment")),
        "nation": spark.range(1).select(F.lit(0).alias("n_nationkey"), F.lit(0).alias("n_regionkey")),
        "region": spark.range(1).select(F.lit(0).alias("r_regionkey"), F.lit("R").alias("r_name")),
        "events": n.select(F.col("id").alias("event_id"), (F.col("id") % 40).alias("user_id"), F.col("id").cast("double").alias("value"), day.alias("ts")),
    }
    for name, df in tables.items():
        df.write.parquet(f"{root}/{name}.parquet")
    return str(root)


def matrix(spark, rows=3000):
    a, b = F.rand(1), F.rand(2)
    df = spark.range(rows).repartition(37).select(F.col("id").alias(ACCOUNT), a.alias("a"), b.alias("b"), F.lit(1.0).alias("weight"))
    df = df.withColumn("CHURN", (F.col("a") + F.rand(3) > 1.0).cast("int")).withColumn("is_valid", F.col(ACCOUNT) % 4 == 0)
    return train.cached(train.assemble(df, ["a", "b"], [ACCOUNT, "CHURN", "is_valid", "weight"]))


def test_the_matrix_has_a_partition_a_core_at_most(spark):
    m = matrix(spark)
    assert m.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism and m.count() == 3000


def test_the_best_prefix_is_taken_from_the_fit_that_found_it(spark, monkeypatch):
    m, asked, plain = matrix(spark), [], train.gbt
    monkeypatch.setattr(train, "gbt", lambda p, rounds, seed: asked.append(rounds) or plain(p, rounds, seed))
    params = train.GBTParams(stepSize=0.5, maxDepth=4, subsamplingRate=0.7, featureFraction=0.7)
    model, auc = train.fit_with_validation(m, params, 40, 3, 42)
    assert asked == [6 << i for i in range(len(asked))] and 1 <= model.getNumTrees < asked[-1]
    fresh = plain(params, model.getNumTrees, 42).fit(m.where("NOT is_valid"))
    assert model.treeWeights == fresh.treeWeights and model.getOrDefault("maxDepth") == 4
    both = train.positive_probability(model, m).select(ACCOUNT, "score").join(train.positive_probability(fresh, m).select(ACCOUNT, F.col("score").alias("again")), ACCOUNT)
    assert both.where("score <> again").count() == 0 and both.count() == 3000 and 0 <= auc <= 1


def test_a_large_type_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    root = write_tables(spark, tmp_path / "in", 40_000)
    monkeypatch.setattr(catalog, "_scratch", lambda _, name: str(tmp_path / name))
    # small parts, and as many tasks before the write as there are shuffle partitions
    wanted = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        assert catalog.q_partitioned_scan(spark, root).count() == spark.read.parquet(f"{root}/lineitem.parquet").where("l_shipdate < '2001-01-01'").count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(glob.glob(str(tmp_path / "trx_by_type/TRX_TYPE=P2P/*.parquet"))) > 1


def test_feature_queries_join_the_transfers_once(spark, tmp_path):
    root = write_tables(spark, tmp_path)
    for name in ("type_mix", "feature_store_flow"):
        df = catalog.queries()[name](spark, root)
        # what is read three times is the written transfers; lineitem is left to the labels' checkpointed keys
        assert "l_partkey" not in df._jdf.queryExecution().optimizedPlan().toString()
        assert df.count() == 36  # customers without merchants
    inp, stored = catalog.fixture(spark, root), catalog.feature_inputs(spark, root)
    assert stored.transactions.dtypes == inp.transactions.dtypes
    assert stored.transactions.exceptAll(inp.transactions).count() == 0 == inp.transactions.exceptAll(stored.transactions).count()


def test_a_day_row_is_aggregated_for_its_own_direction_only(spark, tmp_path):
    inp = catalog.fixture(spark, write_tables(spark, tmp_path))
    df = day_features(directed_rows(inp.transactions, catalog.CUTOFF))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert any(line.lstrip(" :+-").startswith(f"Aggregate [{ACCOUNT}") and ", dir#" in line.split("]")[0] and "_to_" not in line and "gday" not in line.split("]")[0] for line in plan.splitlines())
    r = df.where(f"{ACCOUNT} = 3").first()
    days = inp.transactions.where(f"{ACCOUNT} = 3").selectExpr("count(DISTINCT TXN_DATE) AS d", "count(*) AS n", "max(TXN_DATE) AS last").first()
    assert (r["out_active_days_90d"], r["out_txn_count_90d"], r["out_last_txn_date"]) == (days["d"], days["n"], days["last"])
    assert df.where(f"{ACCOUNT} = 50").first()["out_txn_count_90d"] is None  # a receiver only
