"""Forests of all locations at once, against a plain tree learner."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalgrid.operators import attach, federated, keyed_trees
from vitalgrid.operators.keyed_trees import Forest

SCHEMA = "location string, key long, y int, x array<double>"


def sample(sizes, features=4, seed=0):
    r = np.random.default_rng(seed)
    rows = []
    for s, n in sizes.items():
        x = np.round(r.normal(size=(n, features)), 3)
        x[:, -1] = r.integers(0, 2, n)
        y = (x[:, 0] + 0.5 * x[:, 1] + 0.3 * r.normal(size=n) > 0.2).astype(int)
        rows += [(s, len(rows) + i, int(y[i]), x[i].tolist()) for i in range(n)]
    return rows


def plain_edges(values, bins):
    size = np.floor(np.log1p(np.abs(values)) * keyed_trees.CELLS + 0.37)
    cells = np.where(values < 0, -size, size)
    edges, before = [], 0
    for c in np.unique(cells):
        n = int((cells == c).sum())
        if (before + n) * bins // len(values) > before * bins // len(values) and before + n < len(values):
            edges.append(float(values[cells == c].max()))
        before += n
    return edges


def plain_tree(x, y, w, edges, depth, tree, forest, node=1, out=None):
    """node -> (feature, threshold, n, positives, left_n, left_positives, gain), grown depth first."""
    out = {} if out is None else out
    if not depth or not w.sum():
        return out

    def gini(n, p):
        return 2 * p / n * (1 - p / n) if n else 0.0

    n, p = int(w.sum()), int((w * y).sum())
    best = None
    size = forest.subset or max(1, round(len(edges) ** 0.5))
    for f in keyed_trees.node_features(np.array([node]), tree, len(edges), size, forest.seed)[0]:
        for b, e in enumerate(edges[f]):
            left = x[:, f] <= e
            ln, lp = int(w[left].sum()), int((w * y)[left].sum())
            if min(ln, n - ln) < forest.least or not (w[(x[:, f] <= e) & (x[:, f] > (edges[f][b - 1] if b else -np.inf))]).any():
                continue
            gain = round(gini(n, p) - (ln * gini(ln, lp) + (n - ln) * gini(n - ln, p - lp)) / n, 12)
            if gain > keyed_trees.LEAST_GAIN and (best is None or gain > best[0]):
                best = (gain, int(f), e, ln, lp)
    if best:
        gain, f, e, ln, lp = best
        out[node] = (f, e, n, p, ln, lp, gain)
        left = x[:, f] <= e
        for side, child in ((left, 2 * node), (~left, 2 * node + 1)):
            plain_tree(x[side], y[side], w[side], edges, depth - 1, tree, forest, child, out)
    return out


@pytest.mark.parametrize("forest", [
    Forest(trees=1, depth=1, subset=4, bootstrap=False), Forest(trees=3, depth=4, bins=8), Forest(trees=9, depth=3, subset=4, least=5),
])
@pytest.mark.parametrize("part_rows", [1 << 16, 40])
def test_splits_equal_a_plain_learner(spark, monkeypatch, forest, part_rows):
    monkeypatch.setattr(keyed_trees, "PART_ROWS", part_rows)
    rows = sample({"A": 300, "B": 90})
    found = keyed_trees.fit_forests(spark.createDataFrame(rows, SCHEMA).repartition(5), forest).collect()
    got = {}
    for r in found:
        got[r["location"], r["tree"], r["node"]] = tuple(r[c] for c in ("feature", "threshold", "n", "positives", "left_n", "left_positives", "gain"))
    want = {}
    for s in ("A", "B"):
        own = [r for r in rows if r[0] == s]
        x, y = np.array([r[3] for r in own]), np.array([r[2] for r in own])
        edges = [plain_edges(x[:, f], forest.bins) for f in range(4)]
        for t in range(forest.trees):
            w = keyed_trees.draws(np.array([r[1] for r in own]), t, forest.seed) if forest.bootstrap else np.ones(len(own), int)
            want |= {(s, t, n): v for n, v in plain_tree(x, y, w, edges, forest.depth, t, forest).items()}
    assert {k: v[:6] for k, v in got.items()} == {k: v[:6] for k, v in want.items()}
    assert all(got[k][6] == pytest.approx(want[k][6], abs=2e-12) for k in want)


def test_scores_follow_the_splits(spark):
    rows = sample({"A": 250, "B": 80})
    forest = Forest(trees=5, depth=3)
    design = spark.createDataFrame(rows, SCHEMA)
    splits = keyed_trees.fit_forests(design, forest)
    tree = {(r["location"], r["tree"], r["node"]): r for r in splits.collect()}
    got = {r["key"]: r for r in keyed_trees.score(design, splits, forest).collect()}
    assert len(got) == len(rows)
    for s, key, y, x in rows:
        total = 0
        for t in range(5):
            node, value = 1, None
            while (s, t, node) in tree:
                r = tree[s, t, node]
                left = x[r["feature"]] <= r["threshold"]
                n, p = (r["left_n"], r["left_positives"]) if left else (r["n"] - r["left_n"], r["positives"] - r["left_positives"])
                node, value = 2 * node + (not left), p / n
            total += value
        assert got[key]["score"] == pytest.approx(total / 5) and got[key]["prediction"] == int(total / 5 > 0.5)
    right = sum(r["prediction"] == r["y"] for r in got.values())
    assert right > 0.8 * len(rows)


def test_importances_are_shares_of_the_gains(spark):
    splits = keyed_trees.fit_forests(spark.createDataFrame(sample({"A": 200, "B": 60}), SCHEMA), Forest(trees=4, depth=3))
    gains = {}
    for r in splits.collect():
        tree = gains.setdefault(r["location"], {}).setdefault(r["tree"], [0.0] * 4)
        tree[r["feature"]] += r["n"] * r["gain"]
    got = {(r["location"], r["idx"]): r["value"] for r in keyed_trees.importances(splits, 4).collect()}
    assert len(got) == 8
    for s, trees in gains.items():
        shares = np.array([np.array(t) / sum(t) for t in trees.values()]).sum(axis=0)
        assert [got[s, i] for i in range(4)] == pytest.approx(shares / shares.sum())


def jobs_of(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_jobs_do_not_depend_on_the_sites(spark):
    forest = Forest(trees=2, depth=2)
    tables = [
        spark.createDataFrame(sample({f"s{i}": 12 for i in range(n)}, seed=n), SCHEMA).repartition(4) for n in (3, 300)
    ]
    few, many = (jobs_of(spark, f"sites-{k}", lambda t=t: keyed_trees.fit_forests(t, forest).count()) for k, t in enumerate(tables))
    assert abs(few - many) <= 3  # adaptive execution may run an exchange as a job of its own
    assert keyed_trees.fit_forests(tables[1], forest).select("location").distinct().count() > 250


def test_values_by_shuffle_give_the_same_forest(spark, monkeypatch):
    design = spark.createDataFrame(sample({"A": 120, "B": 50}), SCHEMA)
    small = sorted(map(tuple, keyed_trees.fit_forests(design, Forest(trees=2, depth=2)).collect()))
    monkeypatch.setattr(attach, "BROADCAST_VALUES", 0)
    assert sorted(map(tuple, keyed_trees.fit_forests(design, Forest(trees=2, depth=2)).collect())) == small


def test_no_gain_and_no_rows(spark):
    same = spark.createDataFrame([("A", i, 1, [float(i), 0.0]) for i in range(20)], SCHEMA)
    forest = Forest(trees=2, depth=2)
    splits = keyed_trees.fit_forests(same, forest)
    assert splits.count() == 0
    assert {r["score"] for r in keyed_trees.score(same, splits, forest).collect()} == {0.0}
    none = spark.createDataFrame([], SCHEMA)
    assert keyed_trees.fit_forests(none, forest).count() == 0


def test_bootstrap_draws_have_mean_and_variance_one():
    w = keyed_trees.draws(np.arange(200_000), 3, 42)
    assert w.mean() == pytest.approx(1, abs=0.02) and w.var() == pytest.approx(1, abs=0.03)
    assert (w != keyed_trees.draws(np.arange(200_000), 4, 42)).mean() > 0.5
