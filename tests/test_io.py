"""Sources and sinks: nanosecond Parquet, input resolution, the end-to-end run's outputs."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from ledgerscope.config import ColumnMap, PipelineConfig
from ledgerscope.plans import catalog
from ledgerscope.plans.pipeline import run_pipeline
from ledgerscope.sources.fixtures import write_fixture_layout
from ledgerscope.sources.normalize import canonical_transactions
from ledgerscope.sources.readers import read_any, resolve_inputs

from conftest import SMALL


def test_nanosecond_timestamps_truncate_like_a_cast(spark, tmp_path):
    ns = [1_700_000_000_123_456_789, -1_500, 86_400_000_000_000 - 1]  # 2023, just before 1970, end of day 0
    table = pa.table({
        "SRC_ACCOUNT": pa.array([1, 2, 3], pa.int64()),
        "DST_ACCOUNT": pa.array([2, 3, 1], pa.int64()),
        "TRX_DATETIME": pa.array(ns, pa.timestamp("ns")),
        "TRX_AMT": pa.array([1.0, 2.0, 3.0]),
        "TRX_TYPE": pa.array(["P2P", "bill", None]),
    })
    path = str(tmp_path / "trx")
    os.makedirs(path)
    pq.write_table(table, f"{path}/part-0.parquet")
    t = canonical_transactions(read_any(spark, [path]), ColumnMap())
    rows = {r["ACCOUNT_ID"]: r for r in t.select("ACCOUNT_ID", "TXN_DATE", F.unix_micros("TXN_TS").alias("us")).collect()}
    assert rows[1]["us"] == 1_700_000_000_123_456 and rows[1]["TXN_DATE"] == dt.date(2023, 11, 14)
    assert rows[2]["us"] == -1 and rows[2]["TXN_DATE"] == dt.date(1969, 12, 31)
    assert rows[3]["us"] == 86_399_999_999 and rows[3]["TXN_DATE"] == dt.date(1970, 1, 1)


def test_resolution_order_and_fallbacks(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([(1,)], "ACCOUNT_ID long")
    df.write.parquet(f"{root}/nested/TRX")          # only found through the directory-name fallback
    df.write.parquet(f"{root}/balance")             # fixed name
    os.makedirs(f"{root}/x")
    pq.write_table(pa.table({"ACCOUNT_ID": [1]}), f"{root}/x/my_kyc_table.parquet")  # file-name token fallback
    df.write.option("header", True).csv(f"{root}/labels.csv")
    df.write.option("header", True).csv(f"{root}/public/sample_submission.csv")
    found = resolve_inputs(spark, root)
    assert [os.path.basename(p) for p in found["transactions"]] == ["TRX"]
    assert [os.path.basename(p) for p in found["balances"]] == ["balance"]
    assert found["kyc"] and found["kyc"][0].endswith("my_kyc_table.parquet")
    assert found["train_labels"][0].endswith("labels.csv")
    assert found["test_ids"][0].endswith("sample_submission.csv")


def test_end_to_end_run_writes_every_output(spark, tmp_path):
    root = str(tmp_path)
    write_fixture_layout(spark, SMALL, f"{root}/data")
    cfg = catalog.fixture_config(data_dir=f"{root}/data", work_dir=f"{root}/work", output_dir=f"{root}/out")
    res = run_pipeline(spark, cfg, catalog.LABELS_SCHEMA, catalog.TEST_SCHEMA)
    preds = spark.read.option("header", True).csv(res.paths["predictions"])
    tests = spark.read.option("header", True).schema(catalog.TEST_SCHEMA).csv(f"{root}/data/test.csv")
    expected = tests.join(res.features.select("ACCOUNT_ID"), "ACCOUNT_ID", "left_semi").count()
    assert preds.count() == expected and preds.columns == ["ACCOUNT_ID", "CHURN_PROB"]
    metrics = spark.read.json(res.paths["metrics"]).first().asDict()
    assert set(metrics) == {"auc_roc", "precision_at_10pct", "recall_at_10pct", "best_iteration", "scale_pos_weight",
                            "optuna_best_auc", "final_train_rows", "final_num_boost_round"}
    assert spark.read.option("header", True).csv(res.paths["importance"]).count() == 233
    assert spark.read.option("header", True).csv(res.paths["summary"]).count() == 30
    from pyspark.ml.classification import GBTClassificationModel

    assert GBTClassificationModel.load(res.paths["model"]).getNumTrees >= 1
    # a second run reuses the stamped store
    cfg.reuse_feature_store = True
    again = run_pipeline(spark, cfg, catalog.LABELS_SCHEMA, catalog.TEST_SCHEMA, summary=False)
    assert again.features.count() == res.features.count()


def test_csv_labels_with_inferred_types_join_parquet_keys(spark, tmp_path):
    from ledgerscope.operators.population import population_ids
    from ledgerscope.sources.normalize import canonical_labels, canonical_test_ids

    root = str(tmp_path)
    spark.createDataFrame([(1, 0), (2, 1)], "ACCOUNT_ID long, CHURN int").write.option("header", True).csv(f"{root}/labels.csv")
    spark.createDataFrame([(3,)], "ACCOUNT_ID long").write.option("header", True).csv(f"{root}/test.csv")
    kyc = spark.createDataFrame([(1, "Customer"), (2, "Merchant"), (3, "customer")], "ACCOUNT_ID long, ACCOUNT_TYPE string")
    labels = canonical_labels(read_any(spark, [f"{root}/labels.csv"]), ColumnMap())
    tests = canonical_test_ids(read_any(spark, [f"{root}/test.csv"]), ColumnMap())
    assert dict(labels.dtypes)["ACCOUNT_ID"] in ("int", "bigint")
    assert sorted(r[0] for r in population_ids(labels, tests, kyc).collect()) == [1, 3]


def _write(path, values, unit, name="part-0.parquet"):
    os.makedirs(path, exist_ok=True)
    n = len(values)
    pq.write_table(pa.table({
        "SRC_ACCOUNT": pa.array(range(n), pa.int64()), "DST_ACCOUNT": pa.array(range(n), pa.int64()),
        "TRX_DATETIME": pa.array(values, pa.timestamp(unit, tz="UTC")), "TRX_AMT": pa.array([1.0] * n), "TRX_TYPE": pa.array(["P2P"] * n),
    }), f"{path}/{name}")


def test_nanosecond_and_microsecond_files_mix_and_the_session_keeps_its_settings(spark, tmp_path):
    from ledgerscope.sources.readers import NANOS_AS_LONG, read_parquet

    us = 1_700_000_000_000_000
    for i in range(5):
        _write(str(tmp_path), [us + i], "us", f"a{i}.parquet")
        _write(str(tmp_path), [(us + 100 + i) * 1000 + 7], "ns", f"b{i}.parquet")
    before = spark.conf.get(NANOS_AS_LONG)
    df = read_parquet(spark, [str(tmp_path)])
    assert sorted(r[0] for r in df.select(F.unix_micros("TRX_DATETIME")).collect()) == [us + i for i in range(5)] + [us + 100 + i for i in range(5)]
    assert spark.conf.get(NANOS_AS_LONG) == before


def test_one_instant_has_one_day_whatever_its_unit(spark, tmp_path):
    instant = 1_711_911_600  # 2024-03-31 19:00 UTC, 2024-04-01 00:30 in Kolkata
    for unit, scale in (("us", 10**6), ("ns", 10**9)):
        _write(str(tmp_path / unit), [instant * scale], unit)
    seconds = spark.createDataFrame([(1, 2, instant, 1.0, "P2P")], "SRC_ACCOUNT long, DST_ACCOUNT long, TRX_DATETIME long, TRX_AMT double, TRX_TYPE string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz, day in (("UTC", dt.date(2024, 3, 31)), ("Asia/Kolkata", dt.date(2024, 4, 1))):
            spark.conf.set("spark.sql.session.timeZone", tz)
            frames = [read_any(spark, [str(tmp_path / u)]) for u in ("us", "ns")] + [seconds]
            assert [canonical_transactions(f, ColumnMap()).first()["TXN_DATE"] for f in frames] == [day] * 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_times_of_every_kind_in_one_folder(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from ledgerscope.sources.readers import footer_table, nanos_columns, read_parquet

    def write(name, values, kind):
        n = len(values)
        pq.write_table(pa.table({
            "SRC_ACCOUNT": pa.array(range(n), pa.int64()), "DST_ACCOUNT": pa.array(range(n), pa.int64()),
            "TRX_DATETIME": pa.array(values, kind), "TRX_AMT": pa.array([1.0] * n), "TRX_TYPE": pa.array([name] * n),
        }), f"{tmp_path}/{name}.parquet")

    second = 1_711_911_600  # 2024-03-31 19:00 UTC, 2024-04-01 00:30 in Kolkata
    write("wall_ns", [second * 10**9], pa.timestamp("ns"))
    write("instant_ns", [second * 10**9], pa.timestamp("ns", tz="UTC"))
    write("wall_us", [second * 10**6], pa.timestamp("us"))
    write("instant_us", [second * 10**6], pa.timestamp("us", tz="UTC"))
    write("seconds", [second], pa.int64())
    files = [f"{tmp_path}/{n}.parquet" for n in ("wall_ns", "instant_ns", "wall_us", "instant_us", "seconds")]
    kinds = {f[0].rsplit("/", 1)[1]: nanos_columns(c) for c, f in footer_table(spark, files).items()}
    assert kinds == {"wall_ns.parquet": {"TRX_DATETIME": False}, "instant_ns.parquet": {"TRX_DATETIME": True},
                     "wall_us.parquet": {}, "instant_us.parquet": {}, "seconds.parquet": {}}
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz, instant_day in (("UTC", dt.date(2024, 3, 31)), ("Asia/Kolkata", dt.date(2024, 4, 1)), ("America/New_York", dt.date(2024, 3, 31))):
            spark.conf.set("spark.sql.session.timeZone", tz)
            for before in (None, {"TRX_DATETIME": "2025-01-01"}):
                df = canonical_transactions(read_parquet(spark, [str(tmp_path)], before=before), ColumnMap())
                days = {r["TXN_TYPE"]: r["TXN_DATE"] for r in df.collect()}
                assert days == {"wall_ns": dt.date(2024, 3, 31), "wall_us": dt.date(2024, 3, 31), "instant_ns": instant_day,
                                "instant_us": instant_day, "seconds": instant_day}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_columns_that_came_later_and_files_of_other_times_keep_partitions(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from ledgerscope.sources.readers import read_parquet

    for day, kind, extra in (("2024-01-01", pa.timestamp("ns"), {}), ("2024-01-02", pa.timestamp("us"), {"more": pa.array([5])})):
        os.makedirs(tmp_path / f"day={day}")
        pq.write_table(pa.table({"t": pa.array([10**9], kind), **extra}), tmp_path / f"day={day}/p.parquet")
    rows = read_parquet(spark, [str(tmp_path)]).selectExpr("CAST(day AS STRING) AS day", "more", "unix_micros(CAST(t AS TIMESTAMP)) AS t").collect()
    assert sorted(map(tuple, rows), key=str) == [("2024-01-01", None, 10**6), ("2024-01-02", 5, 10**9)]


def test_nested_folders_and_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "v long, day string")
    df.write.partitionBy("day").parquet(str(tmp_path / "parts"))
    df.where("v = 1").write.parquet(str(tmp_path / "nested/a"))
    df.where("v = 2").write.parquet(str(tmp_path / "nested/b/c"))
    read = read_any(spark, [str(tmp_path / "parts")], "parquet")
    assert sorted(map(tuple, read.selectExpr("v", "cast(day as string)").collect())) == [(1, "2024-01-01"), (2, "2024-01-02")]
    assert read_any(spark, [str(tmp_path / "nested")], "parquet").count() == 2


def test_every_token_group_is_found(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "ACCOUNT_ID long")
    for name in ("trx_2023", "transaction_2024"):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    assert {os.path.basename(os.path.dirname(p)) for p in resolve_inputs(spark, str(tmp_path))["transactions"]} == {"trx_2023.parquet", "transaction_2024.parquet"}
