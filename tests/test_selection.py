"""Exact quantiles and category ranks against plain versions, for odd values and many of them."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerscope.config import ACCOUNT
from ledgerscope.operators import dimension, quantiles
from ledgerscope.operators.assemble import median_impute
from ledgerscope.operators.dimension import category_ranks, with_category_indices


def columns():
    rng = random.Random(4)
    n = 6000
    return {
        "normal": [rng.gauss(0, 1e6) for _ in range(n)],
        "heavy": [rng.paretovariate(0.3) for _ in range(n)],
        "ties": [float(rng.choice([1, 1, 1, 2, 7])) for _ in range(n)],
        "gaps": [rng.random() if rng.random() < 0.3 else None for _ in range(n)],
        "nans": [math.nan if rng.random() < 0.4 else float(i) for i in range(n)],
        "infinite": [rng.choice([-math.inf, math.inf, 1.5, -2.5]) for _ in range(n)],
        "mostly": [math.inf if rng.random() < 0.7 else float(i) for i in range(n)],
        "one": [3.25] + [None] * (n - 1),
        "none": [None] * n,
        "whole": [float(rng.randint(-50, 50)) for _ in range(n)],
    }


def plain(values, share):
    held = sorted(v for v in values if v is not None and not math.isnan(v))
    return held[max(1, math.ceil(share * len(held))) - 1] if held else None


@pytest.fixture(scope="module")
def wide(spark):
    cols = columns()
    schema = ", ".join(f"{c} double" for c in cols)
    return cols, spark.createDataFrame(list(zip(*cols.values(), strict=True)), schema).repartition(5).cache()


@pytest.mark.parametrize("share", [0.5, 0.0, 0.9, 1.0, 0.013])
def test_quantiles_are_exact(wide, share, monkeypatch):
    cols, df = wide
    monkeypatch.setattr(quantiles, "FEW", 40)
    monkeypatch.setattr(quantiles, "ACCURACY", 20)
    assert quantiles.exact_quantiles(df, list(cols), share) == {c: plain(v, share) for c, v in cols.items()}


def test_median_impute(wide, spark):
    cols, df = wide
    out = median_impute(df, ["gaps", "nans", "none"]).toPandas()
    median = plain(cols["gaps"], 0.5)
    assert sorted(out["gaps"]) == sorted(median if v is None else v for v in cols["gaps"])
    assert out["nans"].isna().sum() == 0 and out["none"].isna().all()
    assert median_impute(df.limit(0), ["gaps"]).count() == 0


def plain_ranks(values):
    counts = Counter(v for v in values if v is not None)
    return {v: float(i) for i, v in enumerate(sorted(counts, key=lambda v: (-counts[v], v.encode())))}


@pytest.mark.parametrize("most, rows_per_bucket", [(1 << 25, 10**6), (0, 10**6), (1 << 25, 30)])
def test_ranks_by_frequency_then_label(spark, monkeypatch, most, rows_per_bucket):
    monkeypatch.setattr(dimension, "LABEL_BYTES", most)
    monkeypatch.setattr(dimension, "exclusive_prefix", lambda df, c, s: exclusive(df, c, s, rows_per_bucket))
    from ledgerscope.operators.ranking import exclusive_prefix as exclusive

    rng = random.Random(1)
    many = [f"label {int(rng.paretovariate(0.5)) % 400}" if rng.random() < 0.9 else None for _ in range(3000)]
    few = [rng.choice(["b", "a", "ä", "", None]) for _ in range(3000)]
    empty = [None] * 3000
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(zip(many, few, empty, strict=True))], f"{ACCOUNT} long, MANY string, FEW string, EMPTY string")
    ranks, sizes = category_ranks(df, ["MANY", "FEW", "EMPTY"])
    got = {(r["column"], r["label"]): r["idx"] for r in ranks.collect()}
    expected = {(c, v): i for c, values in (("MANY", many), ("FEW", few)) for v, i in plain_ranks(values).items()}
    assert got == expected and sizes["FEW"][0] == 4 and "EMPTY" not in sizes
    rows = with_category_indices(df, ["MANY", "FEW", "EMPTY"]).collect()
    of_many, of_few = plain_ranks(many), plain_ranks(few)
    assert len(rows) == 3000
    assert all((r["many_idx"], r["few_idx"], r["empty_idx"]) == (of_many.get(r["MANY"], len(of_many)), of_few.get(r["FEW"], 4.0), 0.0) for r in rows)


def test_many_labels_stay_off_the_driver(spark):
    df = spark.range(300_000).select(F.col("id").alias(ACCOUNT), F.concat(F.lit("v"), F.col("id") % 250_000).alias("KIND"))
    ranks, sizes = category_ranks(df, ["KIND"])
    assert sizes["KIND"][0] == 250_000
    top = ranks.where("idx < 50000").select("label").collect()
    assert {int(r["label"][1:]) for r in top} == set(range(50_000))
    assert ranks.agg(F.countDistinct("idx")).first()[0] == 250_000
