"""Random forests of every location at once: all trees of all sites grow level by level in the same passes.

A site is a key, never a loop or a job of its own, so the number of jobs depends on the depth alone.

1. **Edges.** Values of a feature are counted per site and cell (`cell`); the largest values of the cells where another
   share of 1 / `bins` of the rows ends are the edges of the feature's bins. Counts combine map-side.
2. **Parts.** Rows become bin numbers once and are dealt, by a hash of their key, to parts of about `PART_ROWS` rows of
   one site; a hot site only has more parts. A part meets blocks of `BLOCK` trees, so a task holds a bounded
   number of rows and of histogram cells.
3. **Levels.** For each part and block NumPy walks the rows down the splits so far and counts rows and positives per
   (tree, node, feature, bin). The counts of all parts are summed by Spark, and the split with the largest Gini gain
   is chosen per (site, tree, node) from running sums over its bins, at most features x bins rows a group.

Bootstrap weights, feature subsets and parts come from hashes of the row key, tree and node, so a task that runs again
does the same, and the counts are whole numbers: the forest does not depend on how rows are dealt.
"""

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path, written
from .attach import BROADCAST_VALUES, attach

PART_ROWS = 1 << 16
BLOCK = 8
# nodes of a tree are numbered like a heap and kept in arrays of two to this power
DEEPEST = 16
# cells of a value per unit of ln(1 + |value|); meant for scaled features
CELLS = 64
LEAST_GAIN = 1e-12
SPLITS = "location string, tree int, node long, feature int, bin int, n long, positives long, left_n long, left_positives long, gain double"
# cumulative probabilities of 0, 1, 2 .. draws of a row in a bootstrap sample of its own size
_DRAWS = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


@dataclass(frozen=True)
class Forest:
    """Settings: a depth of 1 is one split; `subset` features (None: the square root of their number) per node."""

    trees: int = 100
    depth: int = 10
    bins: int = 32
    least: int = 1
    subset: int | None = None
    bootstrap: bool = True
    seed: int = 42


def cell(value: Column, per_unit: int = CELLS) -> Column:
    """A whole number that does not fall when the value rises."""
    size = F.floor(F.log1p(F.abs(value)) * per_unit + 0.37)
    return F.when(value < 0, -size).otherwise(size)


def feature_edges(design: DataFrame, bins: int) -> DataFrame:
    """location, feature, edges: rising upper edges of all bins but the last; features with one cell have no row."""
    values = design.select("location", F.posexplode("x").alias("feature", "value"))
    cells = values.groupBy("location", "feature", cell(F.col("value")).alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("top")
    )
    group = Window.partitionBy("location", "feature")
    upto = F.sum("n").over(group.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0))
    counted = cells.select("location", "feature", "top", "n", upto.alias("upto"), F.sum("n").over(group).alias("all"))

    def shares(n):
        return F.floor(n * bins / F.col("all"))

    ends = (shares(F.col("upto")) > shares(F.col("upto") - F.col("n"))) & (F.col("upto") < F.col("all"))
    return counted.filter(ends).groupBy("location", "feature").agg(F.array_sort(F.collect_list("top")).alias("edges"))


def _site_edges(edges: DataFrame) -> DataFrame:
    """location, edges: a map from feature to its edges."""
    return edges.groupBy("location").agg(F.map_from_entries(F.collect_list(F.struct("feature", "edges"))).alias("edges"))


def parted(rows: DataFrame) -> DataFrame:
    """The rows with `part`, which holds about PART_ROWS rows of one location."""
    parts = rows.groupBy("location").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).alias("parts"))
    return attach(rows, parts, ["location"]).withColumn("part", F.pmod("key", "parts").cast("int")).drop("parts")


def binned(design: DataFrame, edges: DataFrame) -> DataFrame:
    """location, part, key, y and bins, the bin number of every feature as a byte."""
    with_edges = attach(design, _site_edges(edges), ["location"])

    def place(value, i):
        own = F.coalesce(F.try_element_at("edges", i), F.array().cast("array<double>"))
        return F.size(F.filter(own, lambda e: value > e))

    codes = F.transform("x", place)
    return parted(with_edges.select("location", "key", "y", codes.alias("bins"))).select("location", "part", "key", "y", "bins")


# --- in tasks ----------------------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX1
    x = (x ^ (x >> np.uint64(33))) * _MIX2
    return x ^ (x >> np.uint64(33))


def _salt(*numbers: int) -> np.uint64:
    out = np.zeros(1, np.uint64)
    for number in numbers:
        out = _mixed(out * np.uint64(31) + np.uint64(number + 1))
    return out[0]


def draws(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is in the tree's bootstrap sample: Poisson with mean 1, by hash."""
    share = (_mixed(keys.view(np.uint64) ^ _salt(seed, tree)) >> np.uint64(11)) / float(1 << 53)
    return np.searchsorted(_DRAWS, share, "right")


def node_features(nodes: np.ndarray, tree: int, features: int, size: int, seed: int) -> np.ndarray:
    """`size` different features for every node, one row per node, by hash."""
    if size >= features:
        return np.broadcast_to(np.arange(features), (len(nodes), features))
    salt = nodes.astype(np.uint64)[:, None] * np.uint64(1 << 20) + np.arange(features, dtype=np.uint64)
    return np.sort(np.argsort(_mixed(salt ^ _salt(seed, tree, 7)), axis=1)[:, :size], axis=1)


def _lists(column, kind) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(len(column), -1)


def _step(node: np.ndarray, feature: np.ndarray, cut: np.ndarray, right) -> np.ndarray:
    """Child of the node of every row, 0 where there is none; `right(rows, feature, cut)` says who goes right."""
    at = np.flatnonzero(node > 0)
    at = at[feature[node[at]] >= 0]
    parent = node[at]
    out = np.zeros_like(node)
    out[at] = 2 * parent + right(at, feature[parent], cut[parent])
    return out


def _dense(table: pa.Table, depth: int, cut: str) -> dict:
    """tree -> feature and cut of every node of a level below `depth`, -1 where there is no split."""
    out = {}
    trees = table["tree"].to_numpy()
    for tree in np.unique(trees).tolist():
        own = trees == tree
        node = table["node"].to_numpy()[own]
        feature, limit = np.full(2 << depth, -1, np.int64), np.zeros(2 << depth)
        feature[node], limit[node] = table["feature"].to_numpy()[own], table[cut].to_numpy()[own]
        out[tree] = feature, limit
    return out


def _histograms(forest: Forest, depth: int):
    """Of one part and block: rows (location, tree, node, feature, bin, n, positives) of the nodes at `depth`."""

    def run(rows: pa.Table, splits: pa.Table) -> pa.Table:
        found = [np.empty((0, 6), np.int64)]
        if rows.num_rows:
            codes, keys, y = _lists(rows["bins"], np.int64), rows["key"].to_numpy(), rows["y"].to_numpy()
            features = codes.shape[1]
            size = forest.subset or max(1, round(math.sqrt(features)))
            first, block = 1 << depth, rows["block"][0].as_py()
            made = _dense(splits, depth, "bin")
            for tree in range(block * BLOCK, min((block + 1) * BLOCK, forest.trees)):
                node = np.full(len(keys), int(depth == 0 or tree in made), np.int64)
                for _ in range(depth if tree in made else 0):
                    node = _step(node, *made[tree], lambda at, f, b: codes[at, f] > b)
                weight = draws(keys, tree, forest.seed) if forest.bootstrap else np.ones(len(keys), np.int64)
                at = np.flatnonzero((node > 0) & (weight > 0))
                nodes, of = np.unique(node[at], return_inverse=True)
                if not len(nodes):
                    continue
                chosen = node_features(nodes, tree, features, size, forest.seed)[of]
                where = ((of[:, None] * features + chosen) * forest.bins + codes[at[:, None], chosen]).ravel()
                weights = np.repeat(weight[at], chosen.shape[1])
                n = np.bincount(where, weights)
                positives = np.bincount(where, weights * np.repeat(y[at], chosen.shape[1]))
                filled = np.flatnonzero(n)
                found.append(np.stack([
                    np.full(len(filled), tree), nodes[filled // (features * forest.bins)],
                    filled // forest.bins % features, filled % forest.bins, n[filled], positives[filled],
                ], axis=1).astype(np.int64))
        all_ = np.concatenate(found)
        location = pa.array([rows["location"][0].as_py()] * len(all_) if len(all_) else [], pa.string())
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        columns = [pa.array(all_[:, i]).cast(k) for i, k in enumerate(kinds)]
        return pa.table([location, *columns], names=["location", "tree", "node", "feature", "bin", "n", "positives"])

    return run


# --- levels ------------------------------------------------------------------------------------


def gini(n: Column, positives: Column) -> Column:
    share = positives / n
    return 2 * share * (1 - share)


def best_splits(histograms: DataFrame, least: int) -> DataFrame:
    """The split with the largest gain of every (location, tree, node); ties go to the first feature and bin."""
    node = ["location", "tree", "node"]
    sums = histograms.groupBy(*node, "feature", "bin").agg(F.sum("n").alias("n"), F.sum("positives").alias("positives"))
    # one deal serves the running sums and the choice: a node has at most features x bins rows by now
    sums = sums.repartition(*node)
    group = Window.partitionBy(*node, "feature")
    upto = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sides = sums.select(
        *node, "feature", "bin", F.sum("n").over(upto).alias("left_n"), F.sum("positives").over(upto).alias("left_positives"),
        F.sum("n").over(group).alias("n"), F.sum("positives").over(group).alias("positives"),
    )
    right_n, right_positives = F.col("n") - F.col("left_n"), F.col("positives") - F.col("left_positives")
    gain = gini(F.col("n"), F.col("positives")) - (
        F.col("left_n") * gini(F.col("left_n"), F.col("left_positives")) + right_n * gini(right_n, right_positives)
    ) / F.col("n")
    good = sides.filter((F.col("left_n") >= least) & (right_n >= least)).withColumn("gain", F.round(gain, 12))
    order = F.struct("gain", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"))
    row = F.struct("feature", "bin", "n", "positives", "left_n", "left_positives", "gain")
    best = good.filter(F.col("gain") > LEAST_GAIN).groupBy(*node).agg(F.max_by(row, order).alias("best"))
    return best.select(*node, "best.*")


def _spread(splits: DataFrame, rows: DataFrame) -> DataFrame:
    """The splits once for every part of their location."""
    # columns of their own names, so that a cogroup with the rows can tell them apart
    parts = rows.select(F.col("location").alias("location"), F.col("part").alias("part")).distinct()
    return attach(splits, parts, ["location"], "inner")


def grow(rows: DataFrame, forest: Forest) -> DataFrame:
    """The splits of all trees of all locations of `rows` (location, part, key, y, bins), as written tables."""
    spark = rows.sparkSession
    last = -(-forest.trees // BLOCK) - 1
    blocks = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(last))))
    key = ["location", "part", "block"]
    parts = written(rows.select("location", F.col("part").alias("part")).distinct(), "parts")
    if parts.count() * len(parts.columns) <= BROADCAST_VALUES:
        parts = F.broadcast(parts)
    levels = [scratch_path(spark, "splits")]
    spark.createDataFrame([], SPLITS).write.parquet(levels[0])
    for depth in range(forest.depth):
        made = spark.read.schema(SPLITS).parquet(*levels)
        known = made.join(parts, "location").withColumn("block", F.floor(F.col("tree") / BLOCK).cast("int"))
        histograms = blocks.groupBy(*key).cogroup(known.groupBy(*key)).applyInArrow(
            _histograms(forest, depth), "location string, tree int, node long, feature int, bin int, n long, positives long"
        )
        levels.append(scratch_path(spark, "splits"))
        best_splits(histograms, forest.least).write.parquet(levels[-1])
        if spark.read.schema(SPLITS).parquet(levels[-1]).isEmpty():
            break
    return spark.read.schema(SPLITS).parquet(*levels)


def fit_forests(design: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """Splits, with their threshold, of a forest per location.

    `design`: location, key (a number that tells rows apart), y (0 or 1) and x (array of scaled features). A row goes
    left where x[feature] <= threshold. A location of which no split gains anything has no rows.
    """
    rows = written(design.select("location", "key", F.col("y").cast("int").alias("y"), "x"), "design")
    edges = written(feature_edges(rows, forest.bins), "edges")
    splits = grow(written(binned(rows, edges), "binned"), forest)
    limits = edges.select("location", "feature", F.posexplode("edges").alias("bin", "threshold"))
    return written(attach(splits, limits, ["location", "feature", "bin"]), "forest")


def importances(splits: DataFrame, features: int) -> DataFrame:
    """location, idx, value: the gains of a feature, weighted by rows, as a share per tree, averaged over the trees."""
    gained = splits.groupBy("location", "tree", "feature").agg(F.sum(F.col("n") * F.col("gain")).alias("g"))
    share = F.col("g") / F.sum("g").over(Window.partitionBy("location", "tree"))
    found = gained.select("location", "feature", share.alias("s")).groupBy("location", "feature").agg(F.sum("s").alias("s"))
    total = F.sum("s").over(Window.partitionBy("location"))
    found = found.select("location", F.col("feature").alias("idx"), (F.col("s") / total).alias("value"))
    every = splits.select("location").distinct().select("location", F.explode(F.sequence(F.lit(0), F.lit(features - 1))).alias("idx"))
    return every.join(found, ["location", "idx"], "left").select("location", "idx", F.coalesce("value", F.lit(0.0)).alias("value"))


def _scores(depth: int, trees: int):
    def run(rows: pa.Table, splits: pa.Table) -> pa.Table:
        total = np.zeros(rows.num_rows)
        if rows.num_rows and splits.num_rows:
            x = _lists(rows["x"], float)
            made = _dense(splits, depth, "threshold")
            tree, node = splits["tree"].to_numpy(), splits["node"].to_numpy()
            n, p, left_n, left_p = (splits[c].to_numpy() for c in ("n", "positives", "left_n", "left_positives"))
            for t in range(trees):
                value = np.full(2 << depth, np.nan)
                own = tree == t
                value[2 * node[own]] = left_p[own] / left_n[own]
                value[2 * node[own] + 1] = (p - left_p)[own] / (n - left_n)[own]
                # rows whose tree has no split get the share of all rows, as any tree's root shows it
                last = np.full(rows.num_rows, (p[node == 1] / n[node == 1]).mean())
                at = np.full(rows.num_rows, int(t in made), np.int64)
                while at.any():
                    at = _step(at, *made[t], lambda r, f, b: x[r, f] > b)
                    last = np.where(at > 0, value[at], last)
                total += last / trees
        names = ("location", "key", "y")
        return pa.table([*(rows[c] for c in names), pa.array(total)], names=[*names, "score"])

    return run


def score(design: DataFrame, splits: DataFrame, forest: Forest) -> DataFrame:
    """location, key, y, score (mean share of positives of the trees' leaves) and prediction; no splits score 0."""
    rows = parted(design.select("location", "key", F.col("y").cast("int").alias("y"), "x"))
    key = ["location", "part"]
    found = rows.groupBy(*key).cogroup(_spread(splits, rows).groupBy(*key)).applyInArrow(
        _scores(forest.depth, forest.trees), "location string, key long, y int, score double"
    )
    return found.withColumn("prediction", (F.col("score") > 0.5).cast("int"))
