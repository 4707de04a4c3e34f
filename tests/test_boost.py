"""Leaf-wise boosting against a plain version, attribution against all feature subsets, halving against SQL."""

import hashlib
import itertools
import math

import duckdb
import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ledgerscope.config import ACCOUNT
from ledgerscope.model import boost, search, trees
from ledgerscope.model.boost import Boosting, LeafParams

COLS = ["a", "b", "c", "d", "e"]


def data(n=500, seed=0):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.normal(size=n), rng.integers(0, 4, n), rng.exponential(size=n), rng.normal(size=n), np.zeros(n)], axis=1)
    x[rng.random(n) < 0.1, 3] = np.nan
    y = (x[:, 0] + (x[:, 1] == 2) - 0.5 * x[:, 2] + rng.normal(scale=0.5, size=n) > 0).astype(int)
    return x, y, np.where(y == 1, 1.75, 1.0), np.arange(n) % 4 == 0


def frame(spark, x, y, w, valid, parts=3):
    rows = [(i, int(y[i]), bool(valid[i]), float(w[i]), [float(v) for v in x[i]]) for i in range(len(x))]
    df = spark.createDataFrame(rows, f"{ACCOUNT} long, CHURN int, is_valid boolean, weight double, x array<double>")
    return df.select(ACCOUNT, "CHURN", "is_valid", "weight", array_to_vector("x").alias("features")).repartition(parts)


@pytest.fixture(scope="module")
def table(spark):
    d = data()
    return d, frame(spark, *d).cache()


def plain_split(x, g, h, rows, p, edges):
    def score(G, H):
        return max(abs(G) - p.lambda_l1, 0) ** 2 / (H + p.lambda_l2)

    best, G, H = None, g[rows].sum(), h[rows].sum()
    for j, borders in enumerate(edges):
        for k, e in enumerate(borders + [math.inf]):
            left = rows[x[rows, j] <= e]
            right = np.setdiff1d(rows, left)
            if min(len(left), len(right)) < max(p.min_child_samples, 1) or min(h[left].sum(), h[right].sum()) < 1e-3:
                continue
            gain = score(g[left].sum(), h[left].sum()) + score(g[right].sum(), h[right].sum()) - score(G, H)
            if gain > 1e-9 and (best is None or gain > best[0] + 1e-7):
                best = (gain, j, k, left, right)
    return best


def plain_fit(d, p, edges, rounds):
    """Margins after each round of all rows, splitting the leaf with the largest gain each time."""
    x, y, w, valid = d
    train = np.flatnonzero(~valid)
    share = (w[train] * y[train]).sum() / w[train].sum()
    m = np.full(len(x), math.log(share / (1 - share)))
    out, sizes = [], []
    for _ in range(rounds):
        prob = 1 / (1 + np.exp(-m))
        g, h = w * (prob - y), w * prob * (1 - prob)
        leaves = [(plain_split(x, g, h, train, p, edges), train, np.arange(len(x)), 0)]
        while len(leaves) < p.num_leaves:
            can = [i for i, (s, _, _, depth) in enumerate(leaves) if s and depth < p.max_depth]
            if not can:
                break
            s, _, every, depth = leaves.pop(max(can, key=lambda i: leaves[i][0][0]))
            _, j, k, left, right = s
            e = (edges[j] + [math.inf])[k]
            for rows, mine in ((left, every[x[every, j] <= e]), (right, every[~(x[every, j] <= e)])):
                leaves.append((plain_split(x, g, h, rows, p, edges), rows, mine, depth + 1))
        if len(leaves) > 1:
            for _, rows, every, _ in leaves:
                G, H = g[rows].sum(), h[rows].sum()
                m[every] -= p.learning_rate * np.sign(G) * max(abs(G) - p.lambda_l1, 0) / (H + p.lambda_l2)
        out.append(m.copy())
        sizes.append(len(leaves))
    return out, sizes


PARAMS = [
    LeafParams(num_leaves=6, learning_rate=0.3, max_depth=5, min_child_samples=10),
    LeafParams(num_leaves=4, learning_rate=0.2, max_depth=3, min_child_samples=5, lambda_l1=3.0, lambda_l2=7.0),
    LeafParams(num_leaves=40, learning_rate=0.5, max_depth=2, min_child_samples=60, lambda_l2=1.0),
]


def plain_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return (np.sum(pos[:, None] > neg[None]) + 0.5 * np.sum(pos[:, None] == neg[None])) / (len(pos) * len(neg))


def test_several_fits_in_the_same_jobs_equal_plain_ones(table):
    d, df = table
    with Boosting(df, COLS, PARAMS, bins=8) as b:
        b.advance(3)
        for t, p in zip(b.trials, PARAMS, strict=True):
            margins, sizes = plain_fit(d, p, b.edges, 3)
            for r in range(3):
                assert np.allclose(b.model(t, r + 1).margins(d[0]), margins[r], atol=1e-6)
                assert abs(t.aucs[r] - plain_auc(d[1][d[3]], margins[r][d[3]])) < 1e-12
            assert [tr.leaves for tr in t.trees] == sizes
        assert {tr.leaves for tr in b.trials[0].trees} == {6}


def test_a_fit_goes_on_where_it_stands_and_partitions_change_nothing(spark, table):
    d, df = table
    p = LeafParams(num_leaves=5, learning_rate=0.2, max_depth=3, subsample=0.7, colsample_bytree=0.6)
    with Boosting(df, COLS, [p], bins=8) as b:
        b.advance(2)
        b.advance(2)
        first = b.trials[0]
    with Boosting(frame(spark, *d, parts=1), COLS, [p], bins=8) as b:
        b.advance(4)
        assert b.trials[0].trees == first.trees and b.trials[0].aucs == first.aucs
    assert any(len({f for f in t.feature if f >= 0}) < 3 for t in first.trees)


def test_patience_ends_a_fit_at_its_best_round(table):
    d, df = table
    model, trial = boost.fit(df, COLS, LeafParams(num_leaves=12, learning_rate=0.9, max_depth=4, min_child_samples=1), 60, 3, bins=8)
    assert len(trial.trees) < 60 and len(model.trees) == trial.best_round <= len(trial.trees) - 3
    assert trial.aucs[trial.best_round - 1] == max(trial.aucs) > 0.8
    assert abs(plain_auc(d[1][d[3]], model.margins(d[0][d[3]])) - trial.auc) < 1e-12


def test_refit_uses_every_row_and_scores_are_probabilities(spark, table, tmp_path):
    d, df = table
    model = boost.refit(df, COLS, PARAMS[0], 2, bins=8)
    everyone = (d[0], d[1], d[2], np.zeros(len(d[0]), bool))
    edges = boost.bin_edges(df, len(COLS), 8)
    assert np.allclose(model.margins(d[0]), plain_fit(everyone, PARAMS[0], edges, 2)[0][-1], atol=1e-6)
    model.save(spark, str(tmp_path / "m"))
    again = trees.BoostedTrees.load(spark, str(tmp_path / "m"))
    assert again == model
    scores = {r[ACCOUNT]: r["p"] for r in again.score(df, "p").collect()}
    assert np.allclose([scores[i] for i in range(len(d[0]))], 1 / (1 + np.exp(-model.margins(d[0]))))
    gains = {r["feature"]: r["gain"] for r in model.gains(spark).collect()}
    assert gains["a"] > 0 and gains["e"] == 0.0 and set(gains) == set(COLS)


def test_without_validation_rows_or_anything_to_split(spark):
    d = data(60)
    df = frame(spark, d[0], d[1], d[2], np.zeros(60, bool))
    with Boosting(df, COLS, [LeafParams(min_child_samples=40)], bins=4) as b:
        b.advance(2, patience=1)
        t = b.trials[0]
        assert len(t.trees) == 2 and t.best_round == 2 and math.isnan(t.auc) and {x.leaves for x in t.trees} == {1}
    one = frame(spark, d[0], np.ones(60, int), d[2], d[3])
    with Boosting(one, COLS, [LeafParams()], bins=4) as b:
        b.advance(1)
        assert math.isnan(b.trials[0].auc) and np.isfinite(b.base)


# ------------------------------------------------------------------ attribution


def expectation(tree, x, known, node=0):
    """The tree's value when only the features in ``known`` are seen: branches weighted by their rows otherwise."""
    if tree.left[node] < 0:
        return tree.value[node]
    f, sides = tree.feature[node], (tree.left[node], tree.right[node])
    if f in known:
        return expectation(tree, x, known, sides[0] if x[f] <= tree.threshold[node] else sides[1])
    return sum(tree.count[c] / tree.count[node] * expectation(tree, x, known, c) for c in sides)


def plain_shapley(tree, x, n):
    out = np.zeros(n)
    for i in range(n):
        others = [j for j in range(n) if j != i]
        for size in range(n):
            weight = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
            for known in itertools.combinations(others, size):
                out[i] += weight * (expectation(tree, x, {*known, i}) - expectation(tree, x, set(known)))
    return out


def test_contributions_are_the_shapley_values_over_all_subsets(spark, table):
    d, df = table
    model, _ = boost.fit(df, COLS, LeafParams(num_leaves=9, learning_rate=0.4, max_depth=5, min_child_samples=5), 3, 50, bins=8)
    rows = [0, 1, 2, 3, *np.flatnonzero(np.isnan(d[0][:, 3]))[:4].tolist()]
    got = {r[ACCOUNT]: r for r in trees.attribute(model, df.where(F.col(ACCOUNT).isin(rows))).collect()}
    for i in rows:
        expected = sum(plain_shapley(t, d[0][i], len(COLS)) for t in model.trees)
        assert np.allclose(got[i]["contributions"], expected, atol=1e-12)
    base = model.base + sum(expectation(t, d[0][0], set()) for t in model.trees)
    assert abs(base - got[0]["base"]) < 1e-12


def test_contributions_add_up_to_the_margin(spark, table):
    d, df = table
    model, _ = boost.fit(df, COLS, LeafParams(num_leaves=15, max_depth=8, min_child_samples=3, learning_rate=0.3), 5, 50, bins=16)
    found = trees.attribute(model, df)
    worst = found.selectExpr("max(abs(base + aggregate(contributions, 0D, (s, x) -> s + x) - margin)) AS d").first()["d"]
    assert worst < 1e-9 and found.count() == len(d[0])
    top = trees.mean_contributions(found, COLS, 3).collect()
    assert len(top) == 3 and top[0]["mean_abs_contribution"] >= top[1]["mean_abs_contribution"] > 0


# ------------------------------------------------------------------ search


def test_halving_keeps_the_best_and_goes_on_with_them(spark, table):
    d, df = table
    params = [search.draw_params(7, i, (0.1, 0.5)) for i in range(5)]
    params = [LeafParams(**{**p.to_dict(), "min_child_samples": 5 + i, "max_depth": 2, "num_leaves": 4}) for i, p in enumerate(params)]
    found = search.successive_halving(df, COLS, params, 2, 12, 4, seed=7, eta=2, bins=8)
    rows = found.table(spark).toPandas()  # noqa: F841
    again = duckdb.sql("""
        SELECT rung, trial, row_number() OVER (PARTITION BY rung ORDER BY auc DESC, trial)
               <= CASE WHEN count(*) OVER (PARTITION BY rung) = 1 THEN 1 ELSE ceil(count(*) OVER (PARTITION BY rung) / 2) END AS kept
        FROM rows ORDER BY rung, trial""").fetchall()
    assert [(r.rung, r.trial, r.kept) for r in rows.sort_values(["rung", "trial"]).itertuples()] == [tuple(x) for x in again]
    for rung in range(1, rows.rung.max() + 1):
        assert set(rows[rows.rung == rung].trial) == set(rows[(rows.rung == rung - 1) & rows.kept].trial)
    assert rows.rounds.groupby(rows.rung).max().tolist()[:3] == [2, 4, 8]
    last = rows[rows.rung == rows.rung.max()]
    assert len(last) == 1 and last.trial.iloc[0] == found.trial and last.auc.iloc[0] == found.auc
    # a survivor's model is the one that an uninterrupted fit of its own gives
    with Boosting(df, COLS, [params[found.trial]], seed=7, bins=8) as b:
        b.trials[0].number = found.trial
        b.advance(found.rounds)
        assert b.model(b.trials[0], found.rounds).trees == found.model.trees


def test_draws_lie_in_the_published_ranges():
    for i in range(200):
        p = search.draw_params(42, i)
        assert 31 <= p.num_leaves <= 255 and 4 <= p.max_depth <= 14 and 20 <= p.min_child_samples <= 500
        assert 0.6 <= p.subsample <= 1 and 0.6 <= p.colsample_bytree <= 1 and 0 <= p.lambda_l1 <= 5 and 0 <= p.lambda_l2 <= 10
        assert 0.005 <= p.learning_rate <= 0.08
    assert search.draw(1, 2, "x") == int(hashlib.md5(b"1|2|x").hexdigest()[:8], 16) / 2**32


def test_pruning_never_changes_the_tree():
    rng = np.random.default_rng(1)
    for _ in range(300):
        full = {}
        stack = [0]
        while stack:
            n = stack.pop()
            if n < 63 and rng.random() < 0.8:
                full[n] = boost.Split(0, 0, float(rng.integers(1, 30)), (0, 0, 1), (0, 0, 1))
                stack += [2 * n + 1, 2 * n + 2]
        leaves = int(rng.integers(2, 12))
        known, level = {}, [0]
        while level:
            fresh = {n: full[n] for n in level if n in full}
            known.update(fresh)
            level = [c for n in boost._reachable(known, sorted(fresh), leaves) for c in (2 * n + 1, 2 * n + 2)] if known else []
        assert boost.grow(known, leaves) == boost.grow(full, leaves)
