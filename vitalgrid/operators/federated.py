"""Federated averaging inside Spark: locations are keys, parameters are rows.

A round is: fit per location, export parameters as rows (location, param, idx, value, n),
average them weighted by n, score every location's test rows with the average, and average
the metrics weighted by their rows.
"""

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import core
from ..session import cut_lineage, scratch_path, written
from . import features, metrics
from .attach import attach
from .keyed_trees import DEEPEST, Forest, fit_forests, importances, score
from .models import DEFAULTS, HealthModel, labeled_only
from .ordered import share_cut

METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc")
MIN_CLIENTS = 2
# sites whose models are fitted or scored at a time
PARALLEL_SITES = 3
SCORED_ROWS = "location string, health_risk int, prediction int, score double, part string, site int"


# ---- aggregates ----------------------------------------------------------


def average_parameters(parameters: DataFrame) -> DataFrame:
    """Rows (param, idx, value): the mean over locations, weighted by n."""
    weight = F.sum("n").cast("double")
    return parameters.groupBy("param", "idx").agg(
        (F.sum(F.col("n") * F.col("value")) / F.nullif(weight, F.lit(0.0))).alias("value")
    )


def average_metrics(client_metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Metrics over clients weighted by their rows; a missing metric counts as 0, no rows give 0."""
    total = F.sum("n")

    def mean(value):
        weighted = F.sum(F.col("n") * F.coalesce(value, F.lit(0.0)))
        return F.when(total > 0, weighted / F.nullif(total, F.lit(0))).otherwise(F.lit(0.0))

    present = [m for m in METRICS if m in client_metrics.columns]
    absent = [F.lit(0.0).alias(m) for m in METRICS if m not in present]
    return client_metrics.groupBy(*by).agg(
        *[mean(F.col(m)).alias(m) for m in present],
        *absent,
        mean(1 - F.col("accuracy")).alias("loss"),
        F.coalesce(total, F.lit(0)).alias("total_samples"),
        F.count(F.lit(1)).alias("num_clients"),
    )


# ---- participation -------------------------------------------------------


def participants(rows: DataFrame, fraction: float = 1.0, minimum: int = MIN_CLIENTS) -> DataFrame:
    """Locations that take part: all with rows, or a `fraction` of them chosen by hash."""
    sites = rows.select("location").distinct()
    present = sites.count()
    if present < minimum:
        raise ValueError(f"a round needs {minimum} locations with rows, found {present}")
    if fraction >= 1:
        return sites
    key = core.hash_key("location")
    cut = share_cut(sites, key, fraction, [], F.floor, at_least=minimum)
    return sites.filter(key <= cut.select("cut").scalar())


def local_split(rows: DataFrame, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    return features.stratified_split(rows, test_size, seed, by=["location", "health_risk"])


def scaler_parameters(stats: DataFrame, names: Sequence[str]) -> DataFrame:
    """The scaler of each location as parameter rows."""
    values = [
        F.struct(F.lit(param).alias("param"), F.lit(i).alias("idx"), F.col(f"{prefix}_{n}").alias("value"))
        for i, n in enumerate(names) for param, prefix in (("scaler_mean", "mean"), ("scaler_scale", "scale"))
    ]
    return stats.select("location", "n", F.inline(F.array(*values)))


# ---- logistic regression per location ------------------------------------


def design_rows(rows: DataFrame, stats: DataFrame, names: Sequence[str], by=("location",)) -> DataFrame:
    """(location, is_test, y, x) with x scaled and led by the intercept's 1."""
    z = features.scaled(rows, stats, names, by)
    x = F.array(F.lit(1.0), *[F.col(n) for n in names])
    return z.select("location", "is_test", F.col("health_risk").cast("double").alias("y"), x.alias("x"))


def _partial_sums(dimension: int, flush_at: int = 500):
    """A mapInPandas function: per-location sums of gradient and curvature over one partition."""

    def sums(batches):
        upper = np.triu_indices(dimension)
        held = {}

        def rows():
            for location, vector in held.items():
                yield pd.DataFrame({"location": location, "idx": np.arange(len(vector)), "value": vector})

        for batch in batches:
            for location, part in batch.groupby("location", sort=False):
                x = np.stack(part["x"].to_numpy())
                theta = np.asarray(part["theta"].iloc[0])
                y = part["y"].to_numpy()
                p = 1.0 / (1.0 + np.exp(-np.clip(x @ theta, -500, 500)))
                gradient = x.T @ (p - y)
                curvature = (x * (p * (1 - p))[:, None]).T @ x
                vector = np.concatenate([gradient, curvature[upper]])
                held[location] = held[location] + vector if location in held else vector
            if len(held) >= flush_at:
                yield from rows()
                held.clear()
        yield from rows()

    return sums


def _newton_step(dimension: int, penalty: float):
    """An applyInPandas function on one location's sums: a handful of numbers, never its rows."""

    def step(group):
        values = group.sort_values("idx")["value"].to_numpy()
        theta = np.asarray(group["theta"].iloc[0], dtype=float)
        upper = np.triu_indices(dimension)
        weights = np.full(dimension, penalty)
        weights[0] = 0.0
        gradient = values[:dimension] + weights * theta
        half = np.zeros((dimension, dimension))
        half[upper] = values[dimension:]
        curvature = half + np.triu(half, 1).T + np.diag(weights)
        delta = np.linalg.lstsq(curvature, gradient, rcond=None)[0]
        largest = float(np.max(np.abs(delta)))
        # far from the optimum a full step may overshoot
        delta = delta * min(1.0, 5.0 / largest) if largest > 0 else delta
        return pd.DataFrame({
            "location": [group["location"].iloc[0]], "theta": [theta - delta], "step": [float(np.max(np.abs(delta)))],
        })

    return step


def site_sums(located: DataFrame, dimension: int) -> DataFrame:
    """Rows (location, idx, value): gradient, then the upper triangle of the curvature, at `theta` or zero."""
    if "theta" not in located.columns:
        located = located.withColumn("theta", F.array_repeat(F.lit(0.0), dimension))
    sums = located.select("location", "x", "y", "theta").mapInPandas(
        _partial_sums(dimension), "location string, idx int, value double"
    )
    return sums.groupBy("location", "idx").agg(F.sum("value").alias("value"))


def fit_logistic(
    design: DataFrame,
    dimension: int,
    start: DataFrame | None = None,
    steps: int = 100,
    tolerance: float = 1e-8,
    penalty: float = 1.0,
    converge: bool = True,
) -> DataFrame:
    """L2-penalised logistic regression of every location at once: rows (location, theta).

    Newton steps on the summed loss plus penalty/2 * |w|^2, intercept free. Rows stay where
    they are; per step only d(d+3)/2 sums per location and partition are shuffled, and the
    driver sees one number. Each step's parameters are checkpointed, so the plan stays short.
    A fit that is still moving after `steps` is an error, unless `converge=False` asks for just
    that many steps.
    """
    if start is None:
        zero = F.array_repeat(F.lit(0.0), dimension)
        start = design.select("location").distinct().withColumn("theta", zero)
    theta = cut_lineage(start.select("location", "theta"))
    largest = 0.0
    for _ in range(steps):
        located = attach(design.select("location", "x", "y"), theta, ["location"], "inner", dimension, computed=True)
        moved = site_sums(located, dimension).join(theta, "location").groupBy("location").applyInPandas(
            _newton_step(dimension, penalty), "location string, theta array<double>, step double"
        )
        moved = cut_lineage(moved)
        theta = moved.select("location", "theta")
        largest = moved.agg(F.max("step")).first()[0] or 0.0
        if largest < tolerance:
            return theta
    if converge:
        raise RuntimeError(f"no convergence in {steps} steps: the last one moved a parameter by {largest:.3g}")
    return theta


def logistic_parameters(theta: DataFrame, sizes: DataFrame, dimension: int) -> DataFrame:
    """Export: the intercept and the coefficients as parameter rows."""
    values = [
        F.struct(F.lit("intercept" if i == 0 else "coef").alias("param"), F.lit(max(i - 1, 0)).alias("idx"),
                 F.col("theta")[i].alias("value"))
        for i in range(dimension)
    ]
    return theta.join(sizes, "location").select("location", "n", F.inline(F.array(*values)))


def as_theta(average: DataFrame) -> DataFrame:
    """Import: averaged parameter rows back into one vector."""
    position = F.when(F.col("param") == "intercept", 0).otherwise(F.col("idx") + 1)
    vector = F.transform(
        F.array_sort(F.collect_list(F.struct(position.alias("i"), "value"))), lambda s: s["value"]
    )
    return average.filter(F.col("param").isin("intercept", "coef")).agg(vector.alias("theta"))


def linear_scores(design: DataFrame) -> DataFrame:
    """Score rows that carry `theta`: probability and class."""
    margin = F.aggregate(F.zip_with("x", "theta", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    scored = design.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)))
    return scored.select(
        "location", F.col("y").cast("int").alias("health_risk"), "score",
        (margin > 0).cast("int").alias("prediction"),
    )


def federated_logistic(
    rows: DataFrame,
    names: Sequence[str],
    rounds: int = 10,
    warm_start: bool = False,
    local_steps: int = 1,
    scaler: str = "local",
    fraction: float = 1.0,
) -> DataFrame:
    """Metrics of every round of federated logistic regression.

    As in the plain scheme, a client refits from scratch each round, so every round gives the
    same parameters: one fit and one average serve all of them. warm_start=True instead starts
    `local_steps` steps from the last average, which is federated averaging proper.
    scaler="local" keeps each location's own scaling, "global" uses one for all.
    """
    if scaler not in ("local", "global"):
        raise ValueError(f"scaler must be 'local' or 'global', not {scaler!r}")
    rows = labeled_only(rows)
    split = local_split(rows.join(participants(rows, fraction), "location", "left_semi"))
    by = ["location"] if scaler == "local" else []
    train = split.filter(~F.col("is_test"))
    stats = features.scaler_stats(train, names, by)
    design = written(design_rows(split, stats, names, by), "design")
    fit_rows, test_rows = design.filter(~F.col("is_test")), design.filter("is_test")
    sizes = fit_rows.groupBy("location").agg(F.count(F.lit(1)).alias("n"))
    dimension = len(names) + 1

    def one_round(theta):
        average = cut_lineage(average_parameters(logistic_parameters(theta, sizes, dimension)))
        shared = as_theta(average)
        scored = linear_scores(test_rows.withColumn("theta", shared.scalar()))
        fitted = linear_scores(attach(fit_rows, theta, ["location"], "inner", dimension, computed=True))
        client = metrics.evaluate(scored, ["location"])
        trained = metrics.confusion_metrics(fitted, ["location"])
        return shared, average_metrics(client), average_fit(trained)

    if not warm_start:
        _, evaluated, trained = one_round(fit_logistic(fit_rows, dimension))
        result = cut_lineage(_with_fit(evaluated, trained))
        return result.select(F.explode(F.sequence(F.lit(1), F.lit(rounds))).alias("round"), *result.columns)

    start, parts = None, []
    for number in range(1, rounds + 1):
        theta = fit_logistic(fit_rows, dimension, start, steps=local_steps, converge=False)
        shared, evaluated, trained = one_round(theta)
        result = _with_fit(evaluated, trained).select(F.lit(number).alias("round"), "*")
        parts.append(cut_lineage(result))
        start = sizes.select("location").withColumn("theta", shared.scalar())
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def average_fit(trained: DataFrame) -> DataFrame:
    """Training accuracy and F1 over clients, weighted by their rows."""
    n = F.sum("n").cast("double")
    return trained.agg(
        (F.sum(F.col("n") * F.col("accuracy")) / n).alias("train_accuracy"),
        (F.sum(F.col("n") * F.col("f1")) / n).alias("train_f1"),
    )


def _with_fit(evaluated: DataFrame, trained: DataFrame) -> DataFrame:
    return evaluated.withColumns({
        c: trained.select(c).scalar() for c in ("train_accuracy", "train_f1")
    })


# ---- tree models per location --------------------------------------------


def keyed_design(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """(location, key, y, x): what the keyed learner takes, from scaled rows."""
    return rows.select(
        "location", F.xxhash64("location", "timestamp").alias("key"), F.col("health_risk").cast("int").alias("y"),
        F.array(*[F.col(n) for n in names]).alias("x"),
    )


def shared_scaling(average: DataFrame, names: Sequence[str]) -> DataFrame:
    """The averaged scaler as one row of statistics."""

    def value(param, i):
        return F.max(F.when((F.col("param") == param) & (F.col("idx") == i), F.col("value")))

    return average.agg(*[
        value(param, i).alias(f"{prefix}_{n}")
        for i, n in enumerate(names) for param, prefix in (("scaler_mean", "mean"), ("scaler_scale", "scale"))
    ])


def federated_forest(
    rows: DataFrame, names: Sequence[str], rounds: int = 10, settings=None
) -> tuple[DataFrame, DataFrame]:
    """(metrics per round, averaged parameters) of federated random forests.

    The forests of all locations grow in the same jobs, so neither the driver nor the number of jobs knows how
    many there are. A depth without limit means DEEPEST, the most that the keyed learner grows.
    """
    chosen = {**DEFAULTS["random_forest"], **(settings or {})}
    forest = Forest(
        trees=chosen["n_estimators"], depth=chosen["max_depth"] or DEEPEST, bins=chosen.get("max_bins", Forest.bins),
        seed=chosen["random_state"],
    )
    if forest.depth > DEEPEST:
        raise ValueError(f"a keyed forest is at most {DEEPEST} deep, not {forest.depth}")
    rows = labeled_only(rows)
    participants(rows)
    split = written(local_split(rows), "split")
    train, test = split.filter(~F.col("is_test")), split.filter("is_test")
    stats = written(features.scaler_stats(train, names, ["location"]), "stats")
    fitted = keyed_design(features.scaled(train, stats, names, ["location"]), names)
    splits = fit_forests(fitted, forest)
    shares = importances(splits, len(names)).join(stats.select("location", "n"), "location")
    exported = shares.select("location", "n", F.lit("importance").alias("param"), "idx", "value")
    average = cut_lineage(average_parameters(exported.unionByName(scaler_parameters(stats, names))))

    shared = keyed_design(features.scaled(test, shared_scaling(average, names), names, []), names)
    scored, trained = (score(d, splits, forest).withColumnRenamed("y", "health_risk") for d in (shared, fitted))
    evaluated = average_metrics(metrics.evaluate(written(scored, "scored"), ["location"]))
    result = cut_lineage(_with_fit(evaluated, average_fit(metrics.confusion_metrics(trained, ["location"]))))
    per_round = result.select(F.explode(F.sequence(F.lit(1), F.lit(rounds))).alias("round"), *result.columns)
    return per_round, average


def fit_trees(rows: DataFrame, names: Sequence[str], model_type: str, settings=None, parallel: int = PARALLEL_SITES):
    """One distributed fit per location, a few at a time: {location: model}.

    Trees are grown per location and never averaged, so there is one model per client; the
    clients are sites, not rows.
    """
    chosen = [r["location"] for r in participants(rows).orderBy("location").collect()]

    def fit(location):
        model = HealthModel(model_type, dict(settings or {}), list(names))
        return location, model.fit(rows.filter(F.col("location") == location))

    with ThreadPoolExecutor(parallel) as pool:
        return dict(pool.map(fit, chosen))


def tree_parameters(models: dict, stats: DataFrame, names: Sequence[str]) -> DataFrame:
    """Export: importances, scaler means and scaler deviations of each location."""
    spark = stats.sparkSession
    rows = [
        (location, "importance", i, float(v))
        for location, model in models.items() for i, v in enumerate(model.model.featureImportances.toArray())
    ]
    importances = spark.createDataFrame(rows, "location string, param string, idx int, value double")
    sized = importances.join(stats.select("location", "n"), "location")
    return sized.select("location", "n", "param", "idx", "value").unionByName(scaler_parameters(stats, names))


def uniform_parameters(sizes: DataFrame, names: Sequence[str]) -> DataFrame:
    """What a client without importances exports: equal weights."""
    index = F.explode(F.sequence(F.lit(0), F.lit(len(names) - 1)))
    return sizes.select("location", "n", F.lit("importance").alias("param"), index.alias("idx")).withColumn(
        "value", F.lit(1.0 / len(names))
    )


def federated_trees(
    rows: DataFrame, names: Sequence[str], model_type: str = "random_forest", rounds: int = 10, settings=None
) -> tuple[DataFrame, DataFrame]:
    """(metrics per round, averaged parameters) of federated tree models.

    Each location keeps its own trees and scores its test rows behind the averaged scaling.
    Seeds are fixed and every round refits from scratch, so one fit serves all rounds. Boosted trees have one
    library fit per location; forests grow for all locations at once.
    """
    if model_type not in DEFAULTS or model_type == "logistic_regression":
        raise ValueError(f"not a tree model: {model_type!r}")
    if model_type == "random_forest":
        return federated_forest(rows, names, rounds, settings)
    split = written(local_split(labeled_only(rows)), "split", ["location"])
    train, test = split.filter(~F.col("is_test")), split.filter("is_test")
    stats = written(features.scaler_stats(train, names, ["location"]), "stats")
    models = fit_trees(train, names, model_type, settings)
    average = cut_lineage(average_parameters(tree_parameters(models, stats, names)))
    shared = {(r["param"], r["idx"]): r["value"] for r in average.collect()}
    scaling = {n: (shared["scaler_mean", i], shared["scaler_scale", i]) for i, n in enumerate(names)}

    # every site writes its folders of one table, so the plan does not grow with their number
    path = scratch_path(rows.sparkSession, "scored-trees")

    def score(number, location, model):
        here = F.col("location") == location
        for part, table, scorer in (("test", test, model.rescaled(scaling)), ("train", train, model)):
            found = scorer.predict(table.filter(here)).select("location", "health_risk", "prediction", "score")
            found.write.parquet(f"{path}/part={part}/site={number}")

    with ThreadPoolExecutor(PARALLEL_SITES) as pool:
        list(pool.map(score, range(len(models)), models.keys(), models.values()))
    both = rows.sparkSession.read.schema(SCORED_ROWS).parquet(path)
    scored, fitted = both.filter("part = 'test'"), both.filter("part = 'train'")
    evaluated = average_metrics(metrics.evaluate(scored, ["location"]))
    result = cut_lineage(_with_fit(evaluated, average_fit(metrics.confusion_metrics(fitted, ["location"]))))
    per_round = result.select(F.explode(F.sequence(F.lit(1), F.lit(rounds))).alias("round"), *result.columns)
    return per_round, average
