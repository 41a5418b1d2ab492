import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalgrid.operators import drift, features, metrics

T0 = dt.datetime(2024, 1, 1)


def rows_frame(spark):
    rows = [
        ("A", T0, 1, "Good", "x", 1.0, None), ("A", T0 + dt.timedelta(hours=1), 0, "Sensitive", "y", 3.0, 2.0),
        ("B", T0, 0, None, "x", 5.0, 4.0), ("B", T0 + dt.timedelta(hours=1), 1, "elsewhere", None, 5.0, 4.0),
    ]
    return spark.createDataFrame(
        rows, "location string, timestamp timestamp_ntz, health_risk int, aqi_category string, kind string, a double, b double"
    )


def test_prepare_features_encodes_sorts_and_fills(spark):
    prepared, names = features.prepare_features(rows_frame(spark))
    assert names == sorted(names)
    assert {"kind_x", "kind_y", "aqi_category_Good", "aqi_category_Hazardous", "a", "b"} <= set(names)
    got = {(r["location"], r["timestamp"].hour): r for r in prepared.collect()}
    assert got["A", 0]["aqi_category_Good"] == 1.0 and got["A", 0]["b"] == 0.0
    assert sum(got["B", 0][n] for n in names if n.startswith("aqi_category_")) == 0
    assert sum(got["B", 1][n] for n in names if n.startswith(("aqi_category_", "kind_"))) == 0


def test_alignment_adds_and_drops(spark):
    prepared, names = features.prepare_features(rows_frame(spark), names=["b", "new", "a"], missing={"b": -1.0})
    assert names == ["b", "new", "a"] and prepared.columns[-3:] == names
    assert {r["new"] for r in prepared.collect()} == {0.0}
    assert -1.0 in {r["b"] for r in prepared.collect()}


def test_vocabulary(spark):
    got = features.collect_vocabulary(rows_frame(spark), ["aqi_category", "kind"])
    assert got == {"aqi_category": ["Good", "Sensitive", "elsewhere"], "kind": ["x", "y"]}


def test_scaler_uses_population_deviation(spark):
    table = rows_frame(spark)
    stats = features.scaler_stats(table, ["a"], ["location"])
    got = {r["location"]: (r["mean_a"], r["scale_a"]) for r in stats.collect()}
    assert got == {"A": (2.0, 1.0), "B": (5.0, 1.0)}
    z = features.scaled(table.select("location", "timestamp", "a"), stats, ["a"], ["location"])
    assert sorted(r["a"] for r in z.collect()) == [-1.0, 0.0, 0.0, 1.0]
    overall = features.scaler_stats(table, ["a"])
    z = features.scaled(table.select("timestamp", "a"), overall, ["a"], [])
    values = np.array([1, 3, 5, 5.0])
    assert sorted(r["a"] for r in z.collect()) == pytest.approx(sorted((values - values.mean()) / values.std()))


def test_split_sizes_and_repeatability(spark):
    df = spark.range(1001).select(
        F.lit("A").alias("location"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("timestamp"),
        (F.col("id") % 3 == 0).cast("int").alias("health_risk"),
    )
    split = features.stratified_split(df)
    counts = {r[0]: r[1] for r in split.filter("is_test").groupBy("health_risk").count().collect()}
    assert counts == {0: -(-667 * 2 // 10), 1: -(-334 * 2 // 10)}
    again = features.stratified_split(df.repartition(7))
    assert split.exceptAll(again.select(*split.columns)).count() == 0
    assert features.random_split(df).filter("is_test").count() == 201


def brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    if not pos or not neg:
        return 0.0
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def scored(spark, groups):
    rows = [(g, y, s, int(s >= 0.5)) for g, pairs in groups.items() for y, s in pairs]
    return spark.createDataFrame(rows, "location string, health_risk int, score double, prediction int")


def test_auc_with_ties_against_all_pairs(spark):
    rng = random.Random(5)
    groups = {
        "hot": [(int(rng.random() < 0.3), round(rng.random(), 2)) for _ in range(300)],
        "small": [(1, 0.9), (0, 0.9), (0, 0.1)],
        "one_class": [(1, 0.2), (1, 0.8)],
    }
    got = {r["location"]: r["roc_auc"] for r in metrics.roc_auc(scored(spark, groups), ["location"]).collect()}
    assert got == pytest.approx({g: brute_auc(p) for g, p in groups.items()})


def test_auc_unchanged_by_monotone_map(spark):
    rng = random.Random(6)
    pairs = [(rng.randrange(2), round(rng.random(), 4)) for _ in range(100)]
    squared = [(y, s * s) for y, s in pairs]
    a, b = (metrics.roc_auc(scored(spark, {"g": p})).first()[0] for p in (pairs, squared))
    assert a == pytest.approx(b) == pytest.approx(brute_auc(pairs))


def test_metrics_guard_empty_denominators(spark):
    got = metrics.evaluate(scored(spark, {"g": [(0, 0.1), (0, 0.2)]})).first()
    assert (got["accuracy"], got["precision"], got["recall"], got["f1"], got["roc_auc"]) == (1.0, 0.0, 0.0, 0.0, 0.0)


def test_confusion_matrix_and_classes(spark):
    table = scored(spark, {"g": [(1, 0.9), (1, 0.1), (0, 0.9), (0, 0.2)]})
    assert metrics.confusion_counts(table).first().asDict() == {"tp": 1, "fp": 1, "fn": 1, "tn": 1}
    assert metrics.confusion_matrix(table).count() == 4
    assert metrics.class_counts(table).first()[0] == 2


def two_windows(spark, a, b):
    def make(values):
        return spark.createDataFrame([(float(v),) for v in values], "x double")

    return make(a), make(b)


def test_drift_against_numpy(spark):
    rng = np.random.default_rng(2)
    a, b = np.round(rng.normal(0, 1, 400), 3), np.round(rng.normal(0.5, 1, 300), 3)
    ref, cur = two_windows(spark, a, b)
    grid = np.unique(np.concatenate([a, b]))
    gaps = [abs((a <= g).mean() - (b <= g).mean()) for g in grid]
    assert drift.kolmogorov_smirnov(ref, cur, ["x"]).first()["ks"] == pytest.approx(max(gaps))
    edges = np.quantile(a, np.arange(1, 10) / 10)
    p, q = (np.maximum(np.bincount(np.searchsorted(edges, v, side="left"), minlength=10) / len(v), 1e-4) for v in (a, b))
    psi = drift.population_stability(ref, cur, ["x"])
    assert psi.first()["psi"] == pytest.approx(((p - q) * np.log(p / q)).sum())
    assert [r["severity"] for r in drift.drift_alerts(psi).collect()] == ["medium" if psi.first()["psi"] <= 0.25 else "high"]


def test_no_drift_between_equal_windows(spark):
    ref, cur = two_windows(spark, range(100), range(100))
    assert drift.population_stability(ref, cur, ["x"]).first()["psi"] == 0.0
    assert drift.kolmogorov_smirnov(ref, cur, ["x"]).first()["ks"] == 0.0


def test_data_quality(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 40D), (1, 60D), (2, CAST(NULL AS DOUBLE)), (3, 190D) t(user_id, heart_rate)")
    got = drift.data_quality(df).collect()
    assert [(r["column"], r["n"], r["nulls"], r["out_of_range"], r["null_share"]) for r in got] == [("heart_rate", 4, 1, 2, 0.25)]
    assert [tuple(r) for r in drift.duplicate_keys(df, ["user_id"]).collect()] == [(1, 2)]
