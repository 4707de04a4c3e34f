"""Label preparation and split details, and independence from the session time zone."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerscope.model import labels as L
from ledgerscope.plans import catalog

from conftest import SMALL


def test_label_date_is_parsed_and_preferred_for_the_split(spark):
    labels = spark.createDataFrame(
        [(i, i % 2, f"2024-0{1 + i % 5}-15") for i in range(1, 11)] + [(11, 1, "garbage")],
        "ACCOUNT_ID long, CHURN string, LABEL_DATE string",
    )
    kyc = spark.createDataFrame([(i, "2020-01-01") for i in range(1, 12)], "ACCOUNT_ID long, ACCOUNT_OPEN_DATE string")
    prepared = L.prepare_labels(labels, kyc)
    assert dict(prepared.dtypes)["LABEL_DATE"] == "date" and dict(prepared.dtypes)["CHURN"] == "int"
    assert L.split_column(prepared) == "LABEL_DATE"
    split = {r["ACCOUNT_ID"]: r for r in L.time_split(prepared, 0.2).collect()}
    # quantile 0.8 of the epoch days (linear interpolation) lies inside May; the undated row trains
    assert split[11]["is_valid"] is False
    assert all(split[i]["is_valid"] == (split[i]["LABEL_DATE"] >= dt.date(2024, 5, 15)) for i in range(1, 11))


def test_sampling_keeps_validation_rows_and_is_stable(spark):
    rows = catalog._split_rows(spark, SMALL)
    a = L.train_sample(rows, 0.5, 7).select("ACCOUNT_ID")
    b = L.train_sample(rows.repartition(5), 0.5, 7).select("ACCOUNT_ID")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    valid = rows.filter(F.col("is_valid")).select("ACCOUNT_ID")
    assert valid.exceptAll(L.train_sample(rows, 0.5, 7).filter(F.col("is_valid")).select("ACCOUNT_ID")).count() == 0


def test_results_do_not_depend_on_the_session_time_zone(spark):
    base = catalog.q_asof_filter(spark, SMALL).collect()
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        other = catalog.q_asof_filter(spark, SMALL).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert sorted(map(tuple, base)) == sorted(map(tuple, other))
