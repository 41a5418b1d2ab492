"""Hourly aggregate, joins and labels against plain Python on small hand-made tables."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vitalgrid.operators import labels, merge, vitals
from vitalgrid.schemas import MERGED_COLUMNS, WEARABLE

T0 = dt.datetime(2024, 1, 1)
HOUR = dt.timedelta(hours=1)
WEARABLE_SQL = (
    "location string, timestamp timestamp_ntz, user_id string, heart_rate double, steps int, cumulative_steps bigint, "
    "spo2 double, sleep_status int, sleep_quality double"
)
AIR_SQL = "location string, timestamp timestamp_ntz, pm25 double, pm10 double, aqi double, co2 double"
WEATHER_SQL = (
    "location string, timestamp timestamp_ntz, temperature double, humidity double, wind_speed double, "
    "pressure double, precipitation int, rainfall double"
)


def wearable_rows():
    return [
        ("A", T0, "u1", 80.0, 10, 10, 97.0, 0, 0.0),
        ("A", T0, "u2", 100.0, 20, 20, 95.0, 1, 70.0),
        ("A", T0, "u2", None, None, None, None, None, None),
        ("A", T0 + HOUR, "u1", 90.0, 5, 15, 96.0, 0, 0.0),
        ("B", T0, None, None, None, None, None, None, None),
        ("B", None, "u9", 60.0, 1, 1, 99.0, 0, 0.0),
    ]


@pytest.fixture(scope="module")
def wearable(spark):
    return spark.createDataFrame(wearable_rows(), WEARABLE_SQL)


def environment(spark, air_at, weather_at):
    air = spark.createDataFrame([("A", t, 10.0 + i, 20.0, 40.0 + i, 400.0) for i, t in enumerate(air_at)], AIR_SQL)
    weather = spark.createDataFrame([("A", t, 15.0, 50.0, 1.0, 1000.0, 0, 0.0) for t in weather_at], WEATHER_SQL)
    return air, weather


def test_hourly_vitals(wearable):
    rows = {(r["location"], r["timestamp"]): r for r in vitals.hourly_vitals(wearable, distinct_users=True).collect()}
    assert set(rows) == {("A", T0), ("A", T0 + HOUR), ("B", T0)}
    first = rows["A", T0]
    assert (first["heart_rate_mean"], first["heart_rate_max"], first["steps_total"]) == (90.0, 100.0, 30)
    assert first["heart_rate_std"] == pytest.approx(math.sqrt(200))
    assert (first["cumulative_steps_max"], first["spo2_min"], first["sleeping_users_count"]) == (20, 95.0, 1)
    assert (first["active_users_count"], first["distinct_users"]) == (3, 2)
    assert rows["A", T0 + HOUR]["heart_rate_std"] is None
    empty = rows["B", T0]
    assert (empty["steps_total"], empty["sleeping_users_count"], empty["active_users_count"]) == (0, 0, 0)
    assert empty["heart_rate_mean"] is None


def test_missing_measure_becomes_null(wearable):
    rows = vitals.hourly_vitals(wearable.drop("sleep_quality")).collect()
    assert all(r["sleep_quality_mean"] is None for r in rows)
    assert "sleep_quality" in vitals.with_missing_columns(wearable.drop("sleep_quality"), WEARABLE).columns


def test_exact_join_needs_equal_times(spark, wearable):
    shifted = [T0 + dt.timedelta(milliseconds=1), T0 + HOUR + dt.timedelta(milliseconds=1)]
    air, weather = environment(spark, shifted, [T0, T0 + HOUR])
    assert merge.merge_sources(wearable, air, weather).count() == 0
    aligned = merge.merge_sources(wearable, air, weather, align="hour")
    assert aligned.count() == 2
    assert tuple(aligned.columns) == MERGED_COLUMNS
    with pytest.raises(ValueError):
        merge.merge_sources(wearable, air, weather, align="day")


def test_duplicate_environment_rows_multiply(spark, wearable):
    air, weather = environment(spark, [T0, T0, T0 + HOUR], [T0, T0 + HOUR])
    assert merge.merge_sources(wearable, air, weather).count() == 3
    assert merge.merge_sources(wearable, air, weather, align="hour").count() == 2


def test_merge_matches_pandas(spark, wearable):
    air, weather = environment(spark, [T0, T0 + HOUR], [T0, T0 + HOUR])
    got = merge.merge_sources(wearable, air, weather).toPandas().sort_values("timestamp")
    pdf = wearable.filter("location = 'A'").toPandas()
    want = pdf.groupby("timestamp").agg(heart=("heart_rate", "mean"), steps=("steps", "sum")).reset_index()
    want = want.merge(air.toPandas(), on="timestamp")
    assert np.allclose(got["heart_rate_mean"], want["heart"])
    assert list(got["steps_total"]) == list(want["steps"].astype(int))
    assert list(got["aqi_category"]) == list(pd.cut(want["aqi"], [0, 50, 100], labels=["Good", "Moderate"]).astype(str))


def test_union_and_drop_helpers(spark):
    a, b = spark.sql("SELECT 1 AS x, 2 AS location_x"), spark.sql("SELECT 3 AS y")
    both = merge.union_sites([a, b])
    assert both.columns == ["x", "location_x", "y"] and both.count() == 2
    assert merge.drop_matching(a, "location_").columns == ["x"]
    assert merge.drop_matching(a, "nothing").columns == a.columns
    assert merge.with_location(b, "N").first()["location"] == "N"


def scored_frame(spark, scores):
    rows = [(site, T0 + i * HOUR, x) for site, values in scores.items() for i, x in enumerate(values)]
    return spark.createDataFrame(rows, "location string, timestamp timestamp_ntz, risk_score double")


def test_threshold_and_labels_match_numpy(spark):
    rng = np.random.default_rng(1)
    scores = {"A": [round(float(x), 9) for x in rng.random(211)], "B": [0.1, 0.2, 0.2, 0.2, 0.9], "C": [0.3, 0.4]}
    frame = scored_frame(spark, scores)
    for scope in ("node", "global"):
        rows = labels.binary_labels(frame, scope).collect()
        pool = [x for v in scores.values() for x in v]
        for site, values in scores.items():
            limit = np.quantile(values if scope == "node" else pool, 0.7)
            want = sorted((x, int(x >= limit)) for x in values)
            assert sorted((r["risk_score"], r["health_risk"]) for r in rows if r["location"] == site) == want


@pytest.mark.parametrize("n, positives", [(1, 1), (3, 1), (10, 3), (99, 29)])
def test_constant_scores_get_a_fixed_share(spark, n, positives):
    frame = scored_frame(spark, {"A": [0.4] * n, "B": [0.1, 0.5, 0.9, 0.2]})
    rows = labels.binary_labels(frame).collect()
    assert sum(r["health_risk"] for r in rows if r["location"] == "A") == positives
    assert sorted(r["risk_score"] for r in rows if r["location"] == "B" and r["health_risk"]) == [0.9]
    only_a = labels.binary_labels(frame.filter("location = 'A'"), "global")
    assert only_a.agg(F.sum("health_risk")).first()[0] == positives
    direct = labels.constant_labels(frame.filter("location = 'A'"))
    assert direct.agg(F.sum("health_risk")).first()[0] == positives


def test_nearly_constant_scores_count_as_constant(spark):
    close = scored_frame(spark, {"A": [0.4, 0.400003, 0.4], "B": [0.4, 0.40001, 0.4]})
    flat = {r["location"]: r["is_constant"] for r in labels.constant_scopes(close).collect()}
    assert flat == {"A": True, "B": False}


def test_null_scores_stay_unlabeled(spark):
    frame = scored_frame(spark, {"A": [0.1, None, 0.3, 0.9, None], "B": [None, None]})
    rows = labels.binary_labels(frame).collect()
    assert all((r["health_risk"] is None) == (r["risk_score"] is None) for r in rows)
    assert len(rows) == 7


def test_missing_score_input_is_named(spark):
    with pytest.raises(ValueError, match="humidity"):
        labels.with_risk_score(spark.sql("SELECT 1D aqi, 1D heart_rate_mean, 1D spo2_mean, 1D pm25, 1D temperature"))


def test_continuous_labels(spark):
    frame = scored_frame(spark, {"A": [0.0, 0.3, 0.31, 0.61, None]})
    rows = labels.continuous_labels(frame).orderBy("timestamp").collect()
    assert [r["risk_category"] for r in rows] == [None, "Low", "Medium", "High", None]


@pytest.mark.parametrize("heavy_rows", [10**6, 40, 0])
def test_running_steps_with_and_without_heavy_users(spark, heavy_rows):
    rows = []
    for i in range(600):
        user = "hot" if i % 3 else f"u{i % 5}"
        rows.append((user, T0 + dt.timedelta(minutes=17 * (i // 2)), i, i % 11))
    rows.append((None, T0, 600, 5))
    df = spark.createDataFrame(rows, "user_id string, timestamp timestamp_ntz, i int, steps int")
    want = {"daily": {600: None}, "lifetime": {600: None}}
    sums = {}
    for user, at, i, steps in sorted(rows[:-1], key=lambda r: (r[1], r[2])):
        for kind, key in (("daily", (user, at.date())), ("lifetime", user)):
            sums[kind, key] = sums.get((kind, key), 0) + steps
            want[kind][i] = sums[kind, key]
    order = ["timestamp", "i"]
    for kind, total in (("daily", vitals.daily_running_steps), ("lifetime", vitals.lifetime_running_steps)):
        got = total(df, order, heavy_rows=heavy_rows)
        assert got.columns == [*df.columns, "cumulative_steps"]
        assert {r["i"]: r["cumulative_steps"] for r in got.collect()} == want[kind]
