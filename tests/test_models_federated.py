"""Model jobs: floors and round trips; federated fits against a dense solver."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalgrid.operators import attach, federated, models
from vitalgrid.session import scratch_path

T0 = dt.datetime(2024, 1, 1)
NAMES = ["a", "b", "c"]


def table(spark, sizes):
    rng = np.random.default_rng(0)
    rows = []
    for site, n in sizes.items():
        x = rng.normal(size=(n, 3)) * [1, 5, 0.1] + [0, 10, 1]
        y = (x[:, 0] + 0.2 * (x[:, 1] - 10) + rng.normal(scale=0.7, size=n) > 0.3).astype(int)
        rows += [
            (site, T0 + dt.timedelta(hours=i), int(y[i]), *[float(v) for v in x[i]]) for i in range(n)
        ]
    return spark.createDataFrame(
        rows, "location string, timestamp timestamp_ntz, health_risk int, a double, b double, c double"
    )


@pytest.fixture(scope="module")
def rows(spark):
    return table(spark, {"A": 260, "B": 120, "C": 60}).persist()


def dense_logistic(x, y, penalty=1.0):
    x = np.hstack([np.ones((len(x), 1)), x])
    weights = np.array([0.0] + [penalty] * (x.shape[1] - 1))
    theta = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-x @ theta))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(weights)
        theta = theta - np.linalg.solve(h, x.T @ (p - y) + weights * theta)
    return theta


def test_unknown_model_type():
    with pytest.raises(ValueError, match="nearest"):
        models.HealthModel("nearest")


def test_settings_override():
    assert models.HealthModel("random_forest", {"n_estimators": 5}).settings["n_estimators"] == 5
    assert models.HealthModel("random_forest").settings["max_depth"] == 10


@pytest.mark.parametrize("kind, settings", [
    ("logistic_regression", {}), ("random_forest", {"n_estimators": 20}), ("gradient_boosting", {"n_estimators": 5}),
])
def test_model_floor_and_round_trip(spark, rows, kind, settings):
    model = models.HealthModel(kind, settings, NAMES).fit(rows)
    got = model.evaluate(rows).first()
    assert got["n"] == 440 and got["accuracy"] > 0.75 and got["roc_auc"] > 0.8
    path = scratch_path(spark, kind)
    model.save(path)
    loaded = models.HealthModel.load(path, kind)
    assert loaded.names == NAMES
    assert loaded.evaluate(rows).first() == got
    assert model.importances().count() == 3


def test_logistic_matches_dense_solver(rows):
    pdf = rows.toPandas()
    x = pdf[NAMES].to_numpy()
    z = (x - x.mean(0)) / x.std(0)
    want = dense_logistic(z, pdf["health_risk"].to_numpy())
    model = models.HealthModel("logistic_regression", {}, NAMES).fit(rows).model
    assert model.intercept == pytest.approx(want[0], abs=1e-3)
    assert model.coefficients.toArray() == pytest.approx(want[1:], abs=1e-3)


def test_keyed_logistic_matches_dense_solver_per_site(rows):
    from vitalgrid.operators import features

    marked = rows.withColumn("is_test", F.lit(False))
    stats = features.scaler_stats(marked, NAMES, ["location"])
    design = federated.design_rows(marked, stats, NAMES)
    got = {r["location"]: np.array(r["theta"]) for r in federated.fit_logistic(design, 4).collect()}
    pdf = rows.toPandas()
    for site, part in pdf.groupby("location"):
        x = part[NAMES].to_numpy()
        want = dense_logistic((x - x.mean(0)) / x.std(0), part["health_risk"].to_numpy())
        assert got[site] == pytest.approx(want, abs=1e-6)


def test_salted_join_gives_the_same_fit_as_the_broadcast(rows, monkeypatch):
    from vitalgrid.operators import features

    marked = rows.withColumn("is_test", F.lit(False))
    design = federated.design_rows(marked, features.scaler_stats(marked, NAMES, ["location"]), NAMES)

    def fit():
        return {r["location"]: r["theta"] for r in federated.fit_logistic(design, 4, steps=3, converge=False).collect()}

    small = fit()
    monkeypatch.setattr(attach, "BROADCAST_VALUES", 0)
    for site, theta in fit().items():
        assert theta == pytest.approx(small[site], abs=1e-9)


def test_average_of_equal_parameters_is_identity(spark):
    same = spark.sql("SELECT * FROM VALUES ('A', 10, 'coef', 0, 0.7D), ('B', 1, 'coef', 0, 0.7D) t(location, n, param, idx, value)")
    assert federated.average_parameters(same).first()["value"] == pytest.approx(0.7)


def test_metric_average(spark):
    clients = spark.sql("SELECT * FROM VALUES (30, 0.5D, CAST(NULL AS DOUBLE)), (10, 0.9D, 1D) t(n, accuracy, f1)")
    got = federated.average_metrics(clients).first()
    assert got["accuracy"] == pytest.approx(0.6) and got["f1"] == pytest.approx(0.25)
    assert got["loss"] == pytest.approx(0.4) and got["recall"] == 0.0
    assert (got["total_samples"], got["num_clients"]) == (40, 2)
    empty = federated.average_metrics(clients.withColumn("n", F.lit(0))).first()
    assert (empty["accuracy"], empty["total_samples"]) == (0.0, 0)


def test_participation(spark, rows):
    assert federated.participants(rows).count() == 3
    assert federated.participants(rows, fraction=0.4).count() == 2
    with pytest.raises(ValueError, match="2 locations"):
        federated.participants(rows.filter("location = 'A'"))


def test_rounds_repeat_without_warm_start(rows):
    got = federated.federated_logistic(rows, NAMES, rounds=3).orderBy("round").collect()
    assert [r["round"] for r in got] == [1, 2, 3]
    assert len({r["accuracy"] for r in got}) == 1 and got[0]["accuracy"] > 0.7
    assert got[0]["num_clients"] == 3 and got[0]["total_samples"] >= 88


def test_warm_start_moves_between_rounds(rows):
    got = federated.federated_logistic(rows, NAMES, rounds=2, warm_start=True, scaler="global").orderBy("round").collect()
    assert [r["round"] for r in got] == [1, 2] and got[1]["roc_auc"] > 0.7
    with pytest.raises(ValueError):
        federated.federated_logistic(rows, NAMES, scaler="none")


def test_federated_trees(rows):
    per_round, average = federated.federated_trees(rows, NAMES, rounds=2, settings={"n_estimators": 10})
    assert per_round.count() == 2 and per_round.first()["accuracy"] > 0.6
    params = {(r["param"], r["idx"]): r["value"] for r in average.collect()}
    assert len(params) == 9
    assert sum(params["importance", i] for i in range(3)) == pytest.approx(1.0)
    with pytest.raises(ValueError):
        federated.federated_trees(rows, NAMES, "logistic_regression")


def test_uniform_parameters(spark):
    sizes = spark.sql("SELECT 'A' location, 5 n")
    assert [r["value"] for r in federated.uniform_parameters(sizes, NAMES).collect()] == pytest.approx([1 / 3] * 3)


def test_unlabeled_rows_are_left_out(spark, rows):
    some = rows.withColumn("health_risk", F.when(F.hour("timestamp") > 0, F.col("health_risk")))
    model = models.HealthModel("logistic_regression", {}, NAMES).fit(some)
    assert model.evaluate(some).first()["n"] == some.filter("health_risk is not null").count()
    found = federated.federated_logistic(some, NAMES, rounds=1).first()
    assert found["num_clients"] == 3


def test_a_fit_that_has_not_converged_says_so(rows):
    split = federated.local_split(rows)
    stats = federated.features.scaler_stats(split, NAMES, ["location"])
    design = federated.design_rows(split, stats, NAMES)
    with pytest.raises(RuntimeError, match="no convergence in 1 steps"):
        federated.fit_logistic(design, 4, steps=1)
    assert federated.fit_logistic(design, 4, steps=1, converge=False).count() == 3
