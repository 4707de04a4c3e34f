"""The histogram and the tree walk of leaf-wise boosting against plain loops."""

import numpy as np
import pytest

from ledgerscope.model import boost
from ledgerscope.model.trees import Tree


def _plain_walk(tree: Tree, row, border) -> int:
    node = 0
    while tree.left[node] >= 0:
        node = tree.left[node] if row[tree.feature[node]] <= border[node] else tree.right[node]
    return node


def _tree() -> Tree:
    tree = Tree()
    for v in range(7):
        tree.add(float(v), 1)
    for node, feature, border in ((0, 2, 1), (1, 0, 3), (2, 1, 0)):
        tree.split(node, feature, border + 0.5, border, 1.0, 2 * node + 1, 2 * node + 2)
    return tree


def test_rows_end_where_a_plain_walk_ends():
    tree, rng = _tree(), np.random.default_rng(3)
    bins = rng.integers(0, 5, (200, 3)).astype(np.uint8)
    assert tree.find(bins).tolist() == [_plain_walk(tree, r, tree.edge) for r in bins]
    x = rng.normal(1.5, 2, (200, 3))
    x[::5, 1] = x[::7, 2] = np.nan
    assert tree.predict(x).tolist() == [tree.value[_plain_walk(tree, r, tree.threshold)] for r in x]
    lone = Tree()
    lone.add(0.25, 1)
    assert lone.predict(np.empty((3, 0))).tolist() == [0.25] * 3 and lone.find(bins[:0]).tolist() == []
    splits = {n: boost.Split(tree.feature[n], tree.edge[n], 1.0, (0, 0, 1), (0, 0, 1)) for n in (0, 1, 2)}
    assert boost._heap_nodes(splits, bins).tolist() == tree.find(bins).tolist()
    del splits[1]
    assert set(boost._heap_nodes(splits, bins).tolist()) == {1, 5, 6}


def _rows_of_bins(spark, n=900):
    from pyspark.ml.functions import array_to_vector

    # every third row has no value in the second feature, every fourth is for validation
    rows = spark.range(n).selectExpr(
        "id AS ACCOUNT_ID", "CAST(id % 5 = 0 AS INT) AS CHURN", "id % 4 = 3 AS is_valid", "1D + id % 2 AS weight",
        "array(CAST(id % 11 AS DOUBLE), CASE WHEN id % 3 = 0 THEN double('nan') ELSE CAST(id % 29 AS DOUBLE) END, CAST(id * 7 % 13 AS DOUBLE)) AS x",
    )
    return rows.withColumn("features", array_to_vector("x")).drop("x")


@pytest.mark.parametrize("held", [1, 50, 1 << 16])
def test_the_histogram_holds_few_rows_and_adds_up_the_same(spark, monkeypatch, held):
    monkeypatch.setattr(boost, "HELD", held)
    with boost.Boosting(_rows_of_bins(spark), ["a", "b", "c"], [boost.LeafParams(num_leaves=4), boost.LeafParams(num_leaves=4)], bins=8) as b:
        split = {0: boost.Split(0, 2, 1.0, (0, 0, 1), (0, 0, 1))}
        cells = b.histogram({0: [1, 2], 1: [0]}, {0: split, 1: {}}, {0: np.array([0, 2]), 1: np.array([1])}).collect()
        edges = b.edges
    want: dict[tuple, int] = {}
    for i in range(900):
        if i % 4 == 3:
            continue
        bins = boost.binned(np.array([[i % 11, np.nan if i % 3 == 0 else i % 29, i * 7 % 13]], dtype=float), edges)[0]
        for key in [(0, 1 if bins[0] <= 2 else 2, j, bins[j]) for j in (0, 2)] + [(1, 0, 1, bins[1])]:
            want[key] = want.get(key, 0) + 1
    assert {(r["trial"], r["node"], r["feature"], r["bin"]): r["n"] for r in cells} == want
