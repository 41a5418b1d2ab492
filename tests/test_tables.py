"""Raw CSV files to tables to panels, end to end."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vitalgrid.operators import reports
from vitalgrid.plans import tables
from vitalgrid.schemas import MERGED_COLUMNS

NODES = ["N1", "N2"]
HOURS = 24 * 9


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    rng = np.random.default_rng(4)
    times = pd.date_range("2024-02-01", periods=HOURS, freq="h")
    for node in NODES:
        readings = [
            pd.DataFrame({
                "timestamp": times, "user_id": f"{node}_user_{u:03d}", "heart_rate": rng.normal(85, 15, HOURS).round(1),
                "steps": rng.integers(0, 500, HOURS), "cumulative_steps": 0, "spo2": rng.normal(95, 2, HOURS).round(1),
                "sleep_status": 0, "sleep_quality": 0.0,
            }) for u in (1, 2, 3)
        ]
        pd.concat(readings).to_csv(folder / f"{node}.csv", index=False)
        pd.DataFrame({
            "timestamp": times, "location": node, "pm25": rng.uniform(0, 90, HOURS).round(2),
            "pm10": rng.uniform(0, 90, HOURS).round(2), "aqi": rng.uniform(0, 250, HOURS).round(1), "co2": 410.0,
        }).to_csv(folder / f"{node}_air_quality.csv", index=False)
        pd.DataFrame({
            "timestamp": times, "location": node, "temperature": rng.uniform(-5, 40, HOURS).round(1), "humidity": 50.0,
            "wind_speed": 3.0, "pressure": 1000.0, "precipitation": 0, "rainfall": 0.0,
        }).to_csv(folder / f"{node}_weather.csv", index=False)
    return str(folder)


@pytest.fixture(scope="module")
def paths(spark, raw, tmp_path_factory):
    return tables.build_tables(spark, raw, str(tmp_path_factory.mktemp("out")), NODES)


def test_all_tables_are_there(spark, paths):
    assert set(paths) == {"merged", "node", "all", "continuous"}
    merged = spark.read.parquet(paths["merged"])
    assert merged.count() == HOURS * len(NODES)
    assert set(merged.columns) == set(MERGED_COLUMNS)
    for name in ("node", "all", "continuous"):
        assert set(spark.read.parquet(paths[name]).columns) == set(tables.LABELED_COLUMNS)


def test_merged_means_match_pandas(spark, raw, paths):
    want = pd.read_csv(f"{raw}/N1.csv", parse_dates=["timestamp"]).groupby("timestamp")["heart_rate"].agg(["mean", "std"])
    got = spark.read.parquet(paths["merged"]).filter("location = 'N1'").orderBy("timestamp").toPandas()
    assert np.allclose(got["heart_rate_mean"], want["mean"], atol=1e-8)
    assert np.allclose(got["heart_rate_std"], want["std"], atol=1e-8)


def test_label_scopes(spark, paths):
    node = spark.read.parquet(paths["node"]).groupBy("location").agg(F.avg("health_risk").alias("share")).collect()
    assert all(0.29 < r["share"] < 0.34 for r in node)
    everything = spark.read.parquet(paths["all"]).agg(F.avg("health_risk")).first()[0]
    assert 0.29 < everything < 0.34
    limits = spark.read.parquet(paths["continuous"]).agg(F.min("health_risk"), F.max("health_risk")).first()
    assert 0 <= limits[0] <= limits[1] <= 0.81


def test_panels(spark, paths):
    node, everything = (spark.read.parquet(paths[n]) for n in ("node", "all"))
    authority = tables.authority_panels(everything, node, NODES, ["2024-02-02", "2024-02-04"])
    assert authority["kpi"].first()["total_records"] == 2 * 72
    assert authority["trends"].count() == 3 and authority["comparison"].count() == 2
    assert authority["comparison"].first()["total_records"] == HOURS
    assert authority["environment"].count() == 4 * 2 * 72
    citizen = tables.citizen_panels(node, "N1")
    assert citizen["daily"].count() == 8 and citizen["status"].count() == 1
    assert {r["location"] for r in citizen["alerts"].collect()} <= {"N1"}
    assert citizen["recommendations"].columns[:2] == ["location", "timestamp"]
    for panels in (authority, citizen):
        panels["rows"].unpersist()


def test_merging_without_labels(spark, raw, tmp_path):
    assert set(tables.build_tables(spark, raw, str(tmp_path), ["N1"], generate_labels=False)) == {"merged"}


def test_coverage_of_expected_nodes(spark, paths):
    merged = spark.read.parquet(paths["merged"])
    expected = spark.createDataFrame([("N1",), ("N2",), ("N3",)], ["location"])
    assert [r["location"] for r in reports.missing_locations(merged, expected).collect()] == ["N3"]
