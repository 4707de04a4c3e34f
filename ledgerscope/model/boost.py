"""Leaf-wise histogram boosting with L1 and L2 leaf penalties, several fits at a time.

The matrix is binned once and written to the checkpoint folder; its rows keep one margin for each fit
(trial) that is in progress, so that a fit goes on where it stands. A round grows one tree per trial:

1. Each level is one job: every task sums gradients, hessians and rows of its part by (trial, node,
   feature, bin), Spark adds the sums up, accumulates them over the bins and returns the best split of
   each node. The driver sees one row per open node.
2. Gains do not depend on the order of splitting, so the levels are expanded first and the leaves split
   best-first afterwards, by a queue, up to ``num_leaves``. A node that the queue can't reach any more,
   as enough others come before it whatever its children give, isn't expanded.
3. Sums are integers (gradients times a power of two), so they are the same in any order: a task that
   runs again, or another number of tasks, gives the same trees.

Every ``FOLD`` rounds one job writes the rows with their new margins and another gives the exact
validation AUC of each of those rounds; a fit has ended when its AUC hasn't improved for ``patience``
rounds, and its model is the prefix with the best one. The table written last replaces the one before.
"""

from __future__ import annotations

import heapq
import uuid
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import ACCOUNT
from ..functions.arrow import map_arrow
from ..operators.ranking import exclusive_prefix
from ..session import shared_dir
from .trees import SLICE, BoostedTrees, Tree, walk

#: bins of a feature (a power of two), missing values not counted
BINS = 64
#: rounds between two writes of the margins
FOLD = 10
#: rows that a task of the histogram holds, over all trials, before it adds them up
HELD = 1 << 16
#: least sum of hessians in a leaf (fixed value of the published booster's defaults)
LEAST_HESSIAN = 1e-3


@dataclass(frozen=True)
class LeafParams:
    """Parameters of a fit by their published names."""

    num_leaves: int = 31
    learning_rate: float = 0.05
    max_depth: int = 6
    min_child_samples: int = 20
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    lambda_l1: float = 0.0
    lambda_l2: float = 0.0

    def to_dict(self) -> dict:
        return asdict(self)


# ------------------------------------------------------------------------------ binning


def bin_edges(matrix: DataFrame, n_features: int, bins: int = BINS, features: str = "features") -> list[list[float]]:
    """Ascending distinct borders of each feature: quantiles i / bins of its values. Features x bins numbers."""
    shares = [i / bins for i in range(1, bins)]
    each = matrix.select(F.posexplode(vector_to_array(features)).alias("j", "x")).where(~F.isnan("x"))
    found = each.groupBy("j").agg(F.percentile_approx("x", shares, 10_000).alias("q")).collect()
    edges: list[list[float]] = [[] for _ in range(n_features)]
    for r in found:
        edges[r["j"]] = sorted(set(r["q"]))
    return edges


def binned(x: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    """Bin numbers: borders below the value; a missing value has the number after all bins."""
    out = np.empty(x.shape, dtype=np.uint8)
    for j, e in enumerate(edges):
        out[:, j] = np.where(np.isnan(x[:, j]), len(e) + 1, np.searchsorted(e, x[:, j], "left"))
    return out


STATE = f"{ACCOUNT} {{key}}, y int, w double, is_valid boolean, u long, bins binary, margins array<double>"


def _columns(batch: pa.RecordBatch, n_features: int) -> tuple[np.ndarray, ...]:
    """Labels, weights, validation flags, hashes, bins (rows x features) and margins (rows x trials) of a batch."""
    def column(name):
        return batch.column(batch.schema.get_field_index(name))

    bins = np.frombuffer(b"".join(column("bins").to_pylist()), dtype=np.uint8).reshape(batch.num_rows, n_features)
    margins = column("margins").flatten().to_numpy().reshape(batch.num_rows, -1)
    y, w, valid, u = (column(c).to_numpy(zero_copy_only=False) for c in ("y", "w", "is_valid", "u"))
    return y, w, valid.astype(bool), u, bins, margins


def _chance(u: np.ndarray, salt: int) -> np.ndarray:
    """A number in [0, 1) from each row's hash and a salt: the row's own draw for that salt."""
    z = u.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) & (1 << 64) - 1)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z ^ (z >> np.uint64(31))).astype(np.float64) / 2.0**64


# ------------------------------------------------------------------------------ splits


def leaf_value(g: float, h: float, l1: float, l2: float) -> float:
    """The step that lowers the loss most: minus the gradient, shortened by l1, over the hessian plus l2."""
    return -float(np.sign(g)) * max(abs(g) - l1, 0.0) / (h + l2) if h + l2 > 0 else 0.0


def _score_sql(g: str, h: str, l1: str, l2: str) -> str:
    return f"(greatest(abs({g}) - {l1}, 0D) * greatest(abs({g}) - {l1}, 0D) / ({h} + {l2}))"


def split_table(cells: DataFrame, scale: float) -> DataFrame:
    """All splits of the histogram cells ``trial, node, feature, bin, g, h, n, l1, l2, least``, with their gains.

    ``bin`` is the last bin that goes left. Splits that leave too few rows or too little hessian on a side aren't there.
    """
    node = Window.partitionBy("trial", "node", "feature")
    upto = node.orderBy("bin")
    sums = cells.select(
        "trial", "node", "feature", "bin", "l1", "l2", "least",
        *[(F.sum(c).over(upto) / F.lit(scale)).alias(f"{c}l") for c in "gh"],
        *[(F.sum(c).over(node) / F.lit(scale)).alias(f"{c}t") for c in "gh"],
        F.sum("n").over(upto).alias("nl"), F.sum("n").over(node).alias("nt"),
    )
    gain = f"{_score_sql('gl', 'hl', 'l1', 'l2')} + {_score_sql('(gt - gl)', '(ht - hl)', 'l1', 'l2')} - {_score_sql('gt', 'ht', 'l1', 'l2')}"
    enough = "nl >= least AND nt - nl >= least AND nl > 0 AND nt > nl"
    enough += f" AND hl >= {LEAST_HESSIAN} AND ht - hl >= {LEAST_HESSIAN}"
    return sums.where(enough).selectExpr("trial", "node", "feature", "bin", "gl", "hl", "nl", "gt", "ht", "nt", f"{gain} AS gain")


@dataclass
class Split:
    feature: int
    edge: int
    gain: float
    left: tuple[float, float, int]  # gradient, hessian, rows
    right: tuple[float, float, int]


def grow(splits: dict[int, Split], num_leaves: int) -> list[int]:
    """Nodes in the order in which a queue splits them, best gain first; ``splits`` is by heap number (children 2i+1, 2i+2)."""
    order: list[int] = []
    queue = [(-splits[0].gain, 0)] if 0 in splits else []
    while queue and len(order) + 1 < num_leaves:
        _, node = heapq.heappop(queue)
        order.append(node)
        for child in (2 * node + 1, 2 * node + 2):
            if child in splits:
                heapq.heappush(queue, (-splits[child].gain, child))
    return order


def _reachable(splits: dict[int, Split], fresh: list[int], num_leaves: int) -> list[int]:
    """Of the nodes just found, those that can still be split before the leaves are used up.

    A node comes up in the queue after every node that has a larger gain along its whole path.
    """
    worst: dict[int, float] = {}
    for node in sorted(splits):
        worst[node] = min(splits[node].gain, worst[(node - 1) // 2] if node else np.inf)
    ranked = sorted(worst.values(), reverse=True)
    border = ranked[num_leaves - 2] if len(ranked) >= num_leaves - 1 else -np.inf
    return [n for n in fresh if worst[n] >= border]


# ------------------------------------------------------------------------------ fits in progress


@dataclass
class Trial:
    number: int
    params: LeafParams
    trees: list[Tree] = field(default_factory=list)
    aucs: list[float] = field(default_factory=list)

    @property
    def best_round(self) -> int:
        """Number of rounds with the highest validation AUC, the fewest on a tie; all if there are no validation rows."""
        known = [a if a == a else -1.0 for a in self.aucs]
        return int(np.argmax(known)) + 1 if any(a == a for a in self.aucs) else len(self.trees)

    @property
    def auc(self) -> float:
        return self.aucs[self.best_round - 1] if self.aucs and self.trees else float("nan")


class Boosting:
    """Fits in progress over one binned matrix.

    ``matrix`` has ``ACCOUNT_ID, CHURN, is_valid, weight`` and a vector column ``features``. Rows with ``is_valid`` train
    nothing; without such rows fits have no AUC and don't end by patience.
    """

    def __init__(self, matrix: DataFrame, feature_cols: list[str], params: list[LeafParams], seed: int = 42, bins: int = BINS):
        self.spark, self.feature_cols, self.seed = matrix.sparkSession, feature_cols, seed
        self.trials = [Trial(i, p) for i, p in enumerate(params)]
        self.live = list(self.trials)
        train = matrix.where(~F.col("is_valid"))
        positive = F.when(F.col("CHURN") == 1, F.col("weight")).otherwise(0.0)
        t = train.agg(F.sum("weight").alias("w"), F.sum(positive).alias("p")).first()
        weight, share = float(t["w"] or 0.0), min(max(float(t["p"] or 0.0) / float(t["w"] or 1.0), 1e-6), 1 - 1e-6)
        self.base = float(np.log(share / (1 - share)))
        # all sums stay below 2^52, so they are exact as doubles, too
        self.scale = 2.0 ** min(32, 51 - int(np.ceil(np.log2(max(weight, 1.0) + 1))))
        v = matrix.where("is_valid").agg(F.sum("CHURN").alias("p"), F.count(F.lit(1)).alias("n")).first()
        self.valid_rows, self.valid_positive = int(v["n"]), int(v["p"] or 0)
        self.edges = bin_edges(train, len(feature_cols), bins)
        self.width = max((len(e) for e in self.edges), default=0) + 2
        self.pending = 0  # rounds whose trees the written margins don't hold yet
        self.key = matrix.schema[ACCOUNT].dataType.simpleString()
        self.table: str | None = None
        self._write(self._first(matrix))

    def _first(self, matrix: DataFrame) -> DataFrame:
        edges, base, trials = self.edges, self.base, len(self.live)
        rows = matrix.select(
            ACCOUNT, F.col("CHURN").cast("int").alias("y"), F.col("weight").alias("w"), "is_valid",
            F.xxhash64(F.col(ACCOUNT), F.lit(self.seed)).alias("u"), vector_to_array("features").alias("x"),
        )

        def run(batches):
            for whole in batches:
                for at in range(0, whole.num_rows, SLICE):
                    batch = whole.slice(at, SLICE)
                    x = batch.column(5).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                    found = binned(x, edges)
                    margins = pa.ListArray.from_arrays(
                        pa.array(np.arange(batch.num_rows + 1) * trials, pa.int32()), pa.array(np.full(batch.num_rows * trials, base))
                    )
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns[:5], pa.array([r.tobytes() for r in found], pa.binary()), margins],
                        names=[ACCOUNT, "y", "w", "is_valid", "u", "bins", "margins"],
                    )

        return map_arrow(rows, run, STATE.format(key=self.key))

    def _write(self, rows: DataFrame) -> None:
        path = shared_dir(self.spark, f"boosting-{uuid.uuid4().hex}")
        rows.write.parquet(path)
        before, self.table = self.table, path
        if before:
            self._remove(before)

    def _remove(self, path: str) -> None:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)

    def close(self) -> None:
        """Removes the written table; the trials and their trees stay."""
        if self.table:
            self._remove(self.table)
            self.table = None

    def __enter__(self) -> Boosting:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def _rows(self) -> DataFrame:
        return self.spark.read.parquet(self.table)

    # -------------------------------------------------------------------------- one round

    def _columns_of(self, trial: Trial) -> np.ndarray:
        """The features that the next tree of a trial may use."""
        n = len(self.feature_cols)
        rng = np.random.default_rng([self.seed, trial.number, len(trial.trees)])
        return np.sort(rng.choice(n, max(1, round(trial.params.colsample_bytree * n)), replace=False))

    def histogram(self, open_nodes: dict[int, list[int]], partial: dict[int, dict[int, Split]], columns: dict[int, np.ndarray]) -> DataFrame:
        """Cells ``trial, node, feature, bin, g, h, n`` of the open nodes (heap numbers) of the trees in progress."""
        n_features, width, scale, salt0 = len(self.feature_cols), self.width, self.scale, self.seed
        live = [(i, t.number, t.trees[len(t.trees) - self.pending :], len(t.trees), t.params.subsample) for i, t in enumerate(self.live) if open_nodes.get(t.number)]

        def run(batches):
            sums: dict[int, np.ndarray] = {}
            held: dict[int, list[tuple[np.ndarray, ...]]] = {}
            rows = 0

            def add_up():
                """Adds the rows held to the sums, a feature at a time: its cells are few enough to stay in the processor's cache."""
                for number, parts in held.items():
                    at, g, h, b = (np.concatenate(x) for x in zip(*parts, strict=True))
                    cells, each = len(open_nodes[number]) * width, np.ascontiguousarray(b.T)
                    if number not in sums:
                        sums[number] = np.zeros((3, len(each), cells))
                    for col, bin_ in enumerate(each):
                        cell = at + bin_
                        for k, v in enumerate((g, h, None)):
                            sums[number][k, col] += np.bincount(cell, v, cells)
                held.clear()

            for whole in batches:
                for start in range(0, whole.num_rows, SLICE):
                    y, w, valid, u, bins, margins = _columns(whole.slice(start, SLICE), n_features)
                    for i, number, recent, round_, subsample in live:
                        use = ~valid
                        if subsample < 1.0:
                            use &= _chance(u, salt0 + 1_000_003 * number + round_) < subsample
                        b, m = bins[use], margins[use, i].copy()
                        node = _heap_nodes(partial.get(number, {}), b)
                        slot = np.full(max(open_nodes[number]) + 2, -1)
                        slot[open_nodes[number]] = np.arange(len(open_nodes[number]))
                        at = np.where(node < len(slot), slot[np.minimum(node, len(slot) - 1)], -1)
                        inside = at >= 0
                        if not inside.any():
                            continue
                        b, m = b[inside], m[inside]
                        for tree in recent:
                            m += np.array(tree.value)[tree.find(b)]
                        p = 1 / (1 + np.exp(-m))
                        wi = w[use][inside]
                        g = np.round(wi * (p - y[use][inside]) * scale)
                        h = np.round(wi * p * (1 - p) * scale)
                        held.setdefault(number, []).append((at[inside] * width, g, h, b[:, columns[number]]))
                        rows += len(g)
                        if rows >= HELD:
                            add_up()
                            rows = 0
            add_up()
            for number, total in sums.items():
                filled = np.flatnonzero(total[2])
                total = total.reshape(3, -1)
                col, at = np.divmod(filled, len(open_nodes[number]) * width)
                at, bin_ = np.divmod(at, width)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(filled), number, np.int32)),
                        pa.array(np.array(open_nodes[number])[at].astype(np.int64)),
                        pa.array(columns[number][col].astype(np.int32)),
                        pa.array(bin_.astype(np.int32)),
                        *[pa.array(total[k][filled].astype(np.int64)) for k in range(3)],
                    ],
                    names=["trial", "node", "feature", "bin", "g", "h", "n"],
                )

        parts = map_arrow(self._rows(), run, "trial int, node long, feature int, bin int, g long, h long, n long")
        by_feature = parts.repartition("trial", "node", "feature")
        return by_feature.groupBy("trial", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))

    def splits(self, cells: DataFrame) -> DataFrame:
        """Every split of the cells with its gain."""
        limits = {t.number: t.params for t in self.live}

        def of(name: str, kind: str):
            return F.element_at(F.create_map(*[x for k, p in limits.items() for x in (F.lit(k), F.lit(getattr(p, name)).cast(kind))]), F.col("trial"))

        # a node's cells meet in one exchange that serves the sums over tasks and the sums over bins
        with_limits = cells.select("*", of("lambda_l1", "double").alias("l1"), of("lambda_l2", "double").alias("l2"), of("min_child_samples", "long").alias("least"))
        return split_table(with_limits, self.scale)

    def _best(self, open_nodes, partial, columns) -> dict[int, dict[int, Split]]:
        every = self.splits(self.histogram(open_nodes, partial, columns)).where("gain > 0")
        order = F.struct("gain", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "gl", "hl", "nl", "gt", "ht", "nt")
        found: dict[int, dict[int, Split]] = {}
        for r in every.groupBy("trial", "node").agg(F.max(order).alias("s")).collect():  # one row per open node
            s = r["s"]
            found.setdefault(r["trial"], {})[r["node"]] = Split(
                -s["f"], -s["b"], s["gain"], (s["gl"], s["hl"], s["nl"]), (s["gt"] - s["gl"], s["ht"] - s["hl"], s["nt"] - s["nl"])
            )
        return found

    def round(self) -> None:
        """Adds a tree to every live trial."""
        columns = {t.number: self._columns_of(t) for t in self.live}
        splits: dict[int, dict[int, Split]] = {t.number: {} for t in self.live}
        open_nodes = {t.number: [0] for t in self.live if t.params.num_leaves > 1 and t.params.max_depth > 0}
        depth = 0
        while open_nodes:
            found = self._best(open_nodes, splits, columns)
            depth += 1
            open_nodes = {}
            for t in self.live:
                fresh = found.get(t.number, {})
                splits[t.number].update(fresh)
                if depth < t.params.max_depth:
                    parents = _reachable(splits[t.number], sorted(fresh), t.params.num_leaves)
                    if parents:
                        open_nodes[t.number] = [c for n in parents for c in (2 * n + 1, 2 * n + 2)]
        for t in self.live:
            t.trees.append(self._tree(t.params, splits[t.number]))
        self.pending += 1

    def _tree(self, p: LeafParams, splits: dict[int, Split]) -> Tree:
        tree = Tree()

        def value(g: float, h: float) -> float:
            return p.learning_rate * leaf_value(g, h, p.lambda_l1, p.lambda_l2)

        order = grow(splits, p.num_leaves)
        if not order:
            tree.add(0.0, 0)  # nothing to gain: a round without an effect
            return tree
        root = splits[0]
        place = {0: tree.add(value(root.left[0] + root.right[0], root.left[1] + root.right[1]), root.left[2] + root.right[2])}
        for node in sorted(order):
            s = splits[node]
            left, right = (tree.add(value(g, h), n) for g, h, n in (s.left, s.right))
            place[2 * node + 1], place[2 * node + 2] = left, right
            tree.split(place[node], s.feature, self.edges[s.feature][s.edge] if s.edge < len(self.edges[s.feature]) else float("inf"), s.edge, s.gain, left, right)
        return tree

    # -------------------------------------------------------------------------- margins and AUC

    def fold(self) -> None:
        """Writes the margins of the rounds since the last time and adds their validation AUCs to the live trials."""
        if not self.pending:
            return
        recent = [(i, t.number, t.trees[len(t.trees) - self.pending :]) for i, t in enumerate(self.live)]
        if self.valid_rows:
            self._measure(recent)
        else:
            for t in self.live:
                t.aucs += [float("nan")] * self.pending
        self._write(self._moved(recent))
        self.pending = 0

    def _moved(self, recent) -> DataFrame:
        """The rows with the margins of the trials in ``recent`` (place, number, trees to add), in that order."""
        n_features = len(self.feature_cols)

        def run(batches):
            for whole in batches:
                for start in range(0, whole.num_rows, SLICE):
                    batch = whole.slice(start, SLICE)
                    *_, bins, margins = _columns(batch, n_features)
                    new = np.stack([margins[:, i] + sum((np.array(t.value)[t.find(bins)] for t in trees), np.zeros(len(bins))) for i, _, trees in recent], axis=1)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(bins) + 1) * new.shape[1], pa.int32()), pa.array(new.ravel()))
                    yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], names=batch.schema.names)

        return map_arrow(self._rows(), run, STATE.format(key=self.key))

    def _measure(self, recent) -> None:
        """Exact AUC of each trial after each recent round: one ranking over (trial and round, margin)."""
        n_features, rounds = len(self.feature_cols), self.pending

        def run(batches):
            for whole in batches:
                for start in range(0, whole.num_rows, SLICE):
                    y, _, _, _, bins, margins = _columns(whole.slice(start, SLICE), n_features)
                    for place, (i, _, trees) in enumerate(recent):
                        m = margins[:, i].copy()
                        for k, tree in enumerate(trees):
                            m += np.array(tree.value)[tree.find(bins)]
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(m), place * rounds + k, np.int64)), pa.array(m + 0.0), pa.array(y.astype(np.int64))],
                                names=["fit", "margin", "y"],
                            )

        scored = map_arrow(self._rows().where("is_valid"), run, "fit long, margin double, y long")
        each = scored.groupBy(F.struct("fit", "margin").alias("k")).agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")).checkpoint()
        negative = self.valid_rows - self.valid_positive
        ranked = exclusive_prefix(each, "k", ["neg"]).withColumn("below", F.col("below_neg") - F.col("k.fit") * negative)
        aucs = ranked.groupBy("k.fit").agg(F.sum(F.col("pos") * (F.col("below") + F.col("neg") * 0.5)).alias("a")).collect()
        pairs = self.valid_positive * negative
        found = {r["fit"]: float(r["a"]) / pairs if pairs else float("nan") for r in aucs}
        for place, t in enumerate(self.live):
            t.aucs += [found[place * rounds + k] for k in range(rounds)]

    def keep(self, trials: list[Trial]) -> None:
        """Goes on with these trials only; the margins of the others go with the next write."""
        if self.pending:
            self.fold()
        gone = [t for t in self.live if t not in trials]
        if gone:
            stay = [(i, t.number, []) for i, t in enumerate(self.live) if t in trials]
            self.live = [t for t in self.live if t in trials]
            if self.live:
                self._write(self._moved(stay))

    # -------------------------------------------------------------------------- whole fits

    def advance(self, rounds: int, patience: int | None = None) -> None:
        """Up to so many more rounds; trials whose AUC hasn't improved for ``patience`` rounds end before."""
        left = rounds
        while left > 0 and self.live:
            for _ in range(min(FOLD, left)):
                self.round()
            left -= min(FOLD, left)
            self.fold()
            if patience is not None and self.valid_rows:
                going = [t for t in self.live if len(t.trees) - t.best_round < patience]
                if len(going) < len(self.live):
                    self.keep(going)

    def model(self, trial: Trial, rounds: int | None = None) -> BoostedTrees:
        """The trial's model after its best round, or after so many."""
        return BoostedTrees(self.base, trial.trees[: trial.best_round if rounds is None else rounds], self.feature_cols)


def _heap_nodes(splits: dict[int, Split], bins: np.ndarray) -> np.ndarray:
    """The heap number at which each row stands in a tree in progress."""
    if not splits:
        return np.zeros(len(bins), dtype=np.int64)
    size = 2 * max(splits) + 3  # the children of the last split, too
    child, feature, edge = np.repeat(np.arange(size), 2), np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
    for n, s in splits.items():
        child[2 * n], child[2 * n + 1], feature[n], edge[n] = 2 * n + 1, 2 * n + 2, s.feature, s.edge
    return walk(child, feature, edge, bins)


def fit(matrix: DataFrame, feature_cols: list[str], params: LeafParams, limit: int, patience: int, seed: int = 42, bins: int = BINS) -> tuple[BoostedTrees, Trial]:
    """M6: boost until the validation AUC hasn't improved for ``patience`` rounds; the best prefix is the model."""
    with Boosting(matrix, feature_cols, [params], seed, bins) as b:
        b.advance(limit, patience)
        return b.model(b.trials[0]), b.trials[0]


def refit(matrix: DataFrame, feature_cols: list[str], params: LeafParams, rounds: int, seed: int = 42, bins: int = BINS) -> BoostedTrees:
    """So many rounds on all rows."""
    with Boosting(matrix.withColumn("is_valid", F.lit(False)), feature_cols, [params], seed, bins) as b:
        b.advance(max(1, rounds))
        return b.model(b.trials[0], max(1, rounds))
