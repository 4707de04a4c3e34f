"""Trees of the leaf-wise booster: node arrays, scoring, their table, and exact attribution."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ACCOUNT
from ..functions.arrow import map_arrow

#: rows handled at a time inside a task
SLICE = 4096


@dataclass
class Tree:
    """Nodes by number, the root first; ``left`` is -1 at a leaf. A row goes left if its value is at most the threshold."""

    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    edge: list[int] = field(default_factory=list)  # the threshold's bin
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    count: list[int] = field(default_factory=list)

    def add(self, value: float, count: int) -> int:
        for name, x in zip(("feature", "threshold", "edge", "left", "right", "value", "gain", "count"), (-1, 0.0, 0, -1, -1, value, 0.0, count), strict=True):
            getattr(self, name).append(x)
        return len(self.left) - 1

    def split(self, node: int, feature: int, threshold: float, edge: int, gain: float, left: int, right: int) -> None:
        self.feature[node], self.threshold[node], self.edge[node], self.gain[node] = feature, threshold, edge, gain
        self.left[node], self.right[node] = left, right

    @property
    def leaves(self) -> int:
        return sum(x < 0 for x in self.left)

    def find(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row of binned values."""
        return _descend(self, bins, np.array(self.edge))

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The value of each row; missing values go right."""
        return np.array(self.value)[_descend(self, x, np.array(self.threshold))]


def walk(child: np.ndarray, feature: np.ndarray, border: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The node at which each row ends, from node 0: a value of at most the border goes to the left child (2 n in
    ``child``), any other to the right one (2 n + 1); a node that is its own child ends the way."""
    flat, firsts = x.ravel(), np.arange(len(x)) * x.shape[1]
    at = np.zeros(len(x), dtype=np.int64)
    while True:
        beyond = ~(flat[firsts + feature[at]] <= border[at])  # so a missing value goes right
        after = child[2 * at + beyond]
        if np.array_equal(after, at):
            return at
        at = after


def _descend(tree: Tree, x: np.ndarray, border: np.ndarray) -> np.ndarray:
    left, right = np.array(tree.left), np.array(tree.right)
    if len(left) == 1:
        return np.zeros(len(x), dtype=np.int64)
    own = np.arange(len(left))
    child = np.where(left < 0, own, np.stack([left, right])).T.ravel()
    return walk(child, np.maximum(tree.feature, 0), border, x)


@dataclass
class BoostedTrees:
    """A fitted model: the margin is ``base`` plus the values of the trees."""

    base: float
    trees: list[Tree]
    feature_cols: list[str]

    def prefix(self, rounds: int) -> BoostedTrees:
        """The model after the first rounds."""
        return BoostedTrees(self.base, self.trees[:rounds], self.feature_cols)

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for t in self.trees:
            out += t.predict(x)
        return out

    def score(self, df: DataFrame, out_col: str = "score", features: str = "features") -> DataFrame:
        """``ACCOUNT_ID`` and the probability of the positive class."""

        def run(x: np.ndarray) -> list[pa.Array]:
            return [pa.array(1 / (1 + np.exp(-self.margins(x))))]

        return _map_rows(df, features, run, f"{out_col} double")

    def nodes(self, spark: SparkSession) -> DataFrame:
        """The nodes as rows; a model has at most rounds x twice the leaves of them."""
        rows = [
            (i, n, t.left[n], t.right[n], t.feature[n], t.edge[n], t.threshold[n], t.value[n], t.gain[n], t.count[n])
            for i, t in enumerate(self.trees)
            for n in range(len(t.left))
        ]
        return spark.createDataFrame(
            rows,
            "tree int, node int, left int, right int, feature int, edge int, threshold double, value double, gain double, count long",
        )

    @staticmethod
    def from_nodes(nodes: DataFrame, base: float, feature_cols: list[str]) -> BoostedTrees:
        trees: list[Tree] = []
        for r in nodes.orderBy("tree", "node").toLocalIterator():
            if r["tree"] == len(trees):
                trees.append(Tree())
            t = trees[r["tree"]]
            n = t.add(r["value"], r["count"])
            t.split(n, r["feature"], r["threshold"], r["edge"], r["gain"], r["left"], r["right"])
        return BoostedTrees(base, trees, feature_cols)

    def save(self, spark: SparkSession, path: str) -> None:
        """The node table and a record of base and features, as Parquet under ``path``."""
        self.nodes(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        record = spark.createDataFrame([(self.base, self.feature_cols)], "base double, feature_cols array<string>")
        record.coalesce(1).write.mode("overwrite").parquet(f"{path}/record")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTrees:
        r = spark.read.parquet(f"{path}/record").first()
        return BoostedTrees.from_nodes(spark.read.parquet(f"{path}/nodes"), r["base"], list(r["feature_cols"]))

    def gains(self, spark: SparkSession) -> DataFrame:
        """``feature, gain``: the summed gain of each feature's splits."""
        total = np.zeros(len(self.feature_cols))
        for t in self.trees:
            for f, g in zip(t.feature, t.gain, strict=True):
                if f >= 0:
                    total[f] += g
        return spark.createDataFrame(list(zip(self.feature_cols, total.tolist(), strict=True)), "feature string, gain double")


def _map_rows(df: DataFrame, features: str, run, schema: str) -> DataFrame:
    """``ACCOUNT_ID`` and what ``run`` gives for the rows' values, a block at a time."""
    source = df.select(ACCOUNT, vector_to_array(features).alias("x"))
    key = f"{ACCOUNT} {df.schema[ACCOUNT].dataType.simpleString()}"

    def blocks(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                values = part.column(1)
                x = values.flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                columns = run(x)
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=[ACCOUNT, *[s.split(" ")[0] for s in schema.split(", ")]])

    return map_arrow(source, blocks, f"{key}, {schema}")


# ------------------------------------------------------------------------------ attribution


def _paths(tree: Tree) -> list[tuple[float, list[tuple[int, float | None, float | None, float]]]]:
    """Per leaf: its value, and for each feature on its path the range a row must lie in and the share of rows that do.

    ``(feature, low, high, share)``: low < x <= high, where no high takes missing values as well and no low any x, and the
    product of the shares of the rows that took those branches.
    """
    out = []
    stack: list[tuple[int, dict[int, tuple[float | None, float | None, float]]]] = [(0, {})]
    while stack:
        node, seen = stack.pop()
        if tree.left[node] < 0:
            out.append((tree.value[node], [(f, *r) for f, r in seen.items()]))
            continue
        f, t = tree.feature[node], tree.threshold[node]
        low, high, share = seen.get(f, (None, None, 1.0))
        for child, bounds in (
            (tree.left[node], (low, t if high is None else min(high, t))),
            (tree.right[node], (t if low is None else max(low, t), high)),
        ):
            stack.append((child, {**seen, f: (*bounds, share * tree.count[child] / tree.count[node])}))
    return out


@lru_cache
def _weights(n: int) -> np.ndarray:
    """Weight of a set of k of the other n - 1 features: k! (n - k - 1)! / n!."""
    return np.array([factorial(k) * factorial(n - k - 1) / factorial(n) for k in range(n)])


def contributions(tree: Tree, x: np.ndarray, out: np.ndarray) -> float:
    """Adds the tree's path-dependent Shapley values of each row to ``out`` (rows x features); returns its expected value.

    For one leaf the expectation, given the features of a set, is its value times a factor per feature on its path: 1 or
    0 for a feature of the set (does the row satisfy its conditions?), the share of rows for another. The value of a
    feature sums over the sizes of sets, with an elementary-symmetric table per leaf in place of all sets.
    """
    expected = 0.0
    for value, path in _paths(tree):
        n = len(path)
        shares = [p[3] for p in path]
        expected += value * float(np.prod(shares))
        if not n:
            continue
        meets = [
            (np.ones(len(x), bool) if low is None else ~(x[:, f] <= low)) & (True if high is None else x[:, f] <= high)
            for f, low, high, _ in path
        ]
        weights = _weights(n)
        for i, (f, *_rest) in enumerate(path):
            # sets[k]: sum over sets of k of the other features of (meets of the set) x (shares of the rest)
            sets = np.zeros((n, len(x)))
            sets[0] = 1.0
            for j in range(n):
                if j != i:
                    sets[1:] = sets[1:] * shares[j] + sets[:-1] * meets[j]
                    sets[0] *= shares[j]
            out[:, f] += value * (meets[i] - shares[i]) * (weights @ sets)
    return expected


def expected_margin(model: BoostedTrees) -> float:
    """The margin before any feature is known: what all contributions are counted from."""
    return model.base + sum(v * float(np.prod([p[3] for p in path])) for t in model.trees for v, path in _paths(t))


def attribute(model: BoostedTrees, df: DataFrame, features: str = "features") -> DataFrame:
    """``ACCOUNT_ID, margin, base, contributions array<double>``: one contribution per feature column.

    ``base`` plus the contributions of a row is its margin. Rows are independent: each task holds the model and a
    block of rows.
    """
    base = expected_margin(model)

    def run(x: np.ndarray) -> list[pa.Array]:
        parts = np.zeros(x.shape)
        for t in model.trees:
            contributions(t, x, parts)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(parts.ravel()))
        return [pa.array(model.margins(x)), pa.array(np.full(len(x), base)), lists]

    return _map_rows(df, features, run, "margin double, base double, contributions array<double>")


def mean_contributions(attributed: DataFrame, feature_cols: Sequence[str], top: int) -> DataFrame:
    """``feature, mean_abs_contribution``: the ``top`` features by the mean size of their contributions."""
    names = attributed.sparkSession.createDataFrame(list(enumerate(feature_cols)), "j int, feature string")
    each = attributed.select(F.posexplode("contributions").alias("j", "c"))
    means = each.groupBy("j").agg(F.avg(F.abs("c")).alias("mean_abs_contribution")).join(F.broadcast(names), "j")
    return means.orderBy(F.desc("mean_abs_contribution"), F.asc("feature")).limit(top).select("feature", "mean_abs_contribution")
