import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from vitalgrid.operators import vitals
from vitalgrid.plans import stages
from vitalgrid.schemas import AIR_QUALITY, WEARABLE
from vitalgrid.session import cut_lineage, scratch_path, scratch_run, shared_folder, written
from vitalgrid.sources import readers, writers
from vitalgrid.streaming import hourly, run

WEARABLE_CSV = """timestamp,user_id,heart_rate,steps,cumulative_steps,spo2,sleep_status,sleep_quality
2024-01-01 00:00:00,N1_user_001,71.5,10,10,97.1,1,80.0
2024-01-01 01:00:00,N1_user_001,NaN,,12,,1,
"""
AIR_CSV = "timestamp,location,pm25,pm10,aqi,co2\n2024-01-01 00:00:00,{n},10.5,20.0,43.8,410.0\n"
WEATHER_CSV = (
    "timestamp,location,temperature,humidity,wind_speed,pressure,precipitation,rainfall\n"
    "2024-01-01 00:00:00,{n},20.5,50.0,3.0,1010.0,0,0.0\n"
)


@pytest.fixture()
def raw(tmp_path):
    for n in ("N1", "N2"):
        (tmp_path / f"{n}.csv").write_text(WEARABLE_CSV)
        (tmp_path / f"{n}_air_quality.csv").write_text(AIR_CSV.format(n=n))
        (tmp_path / f"{n}_weather.csv").write_text(WEATHER_CSV.format(n=n))
    return str(tmp_path)


def test_read_nodes(spark, raw):
    s = readers.read_nodes(spark, raw, ["N1", "N2"])
    rows = s.wearable.orderBy("location", "timestamp").collect()
    assert [r["location"] for r in rows] == ["N1", "N1", "N2", "N2"]
    assert rows[0]["timestamp"] == dt.datetime(2024, 1, 1) and rows[0]["heart_rate"] == 71.5
    assert rows[1]["heart_rate"] is None and rows[1]["steps"] is None and rows[1]["sleep_quality"] is None
    assert s.air.count() == 2 and s.weather.first()["pressure"] == 1010.0


def test_missing_source_is_an_error(spark, raw):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        readers.read_nodes(spark, raw, ["N1", "N9"])


def test_wrong_header_is_an_error(spark, raw):
    with pytest.raises(Exception, match="header|schema"):
        readers.read_table(spark, f"{raw}/N1_air_quality.csv", WEARABLE).collect()


def test_parquet_table_and_nan(spark):
    path = scratch_path(spark, "air")
    spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00' timestamp, 'A' location, double('NaN') pm25, 1D pm10, 2D aqi, 3D co2").write.parquet(path)
    assert readers.read_table(spark, path, AIR_QUALITY, "parquet").first()["pm25"] is None


def test_write_replaces_only_given_locations(spark):
    path = scratch_path(spark, "by-location")

    def rows(*pairs):
        return spark.createDataFrame([(s, dt.datetime(2024, 1, d), v) for s, d, v in pairs],
                                     "location string, timestamp timestamp_ntz, v int")

    first = rows(("A", 1, 1), ("B", 1, 2), ("B", 2, 3))
    writers.write_by_location(first, path)
    writers.write_by_location(rows(("B", 3, 9)), path)
    back = readers.read_labeled(spark, path, first.schema)
    assert sorted((r["location"], r["v"]) for r in back.collect()) == [("A", 1), ("B", 9)]
    one = readers.read_labeled(spark, path, first.schema, "A")
    assert "PartitionFilters: [isnotnull(location" in one._jdf.queryExecution().toString()
    assert readers.read_labeled(spark, path, first.schema, "nowhere").count() == 0


def test_fallback_to_parts(spark):
    a, b = spark.sql("SELECT 1 AS x"), spark.sql("SELECT 2 AS x")
    assert readers.combined_or_parts(a, [b], a.schema, spark).first()["x"] == 1
    assert readers.combined_or_parts(None, [a, b], a.schema, spark).count() == 2
    assert readers.combined_or_parts(None, [], a.schema, spark).count() == 0


def test_labeled_path():
    assert writers.labeled_path("x", "binary") == "x_labeled"
    assert writers.labeled_path("x", "continuous") == "x_labeled_continuous"
    with pytest.raises(ValueError):
        writers.labeled_path("x", "other")


def test_metrics_log_appends(spark):
    path = scratch_path(spark, "metrics")
    for run_name in ("a", "b"):
        writers.append_metrics(spark.sql("SELECT 1 AS round, 0.5D AS accuracy"), path, run_name)
    assert spark.read.parquet(path).groupBy("run").count().count() == 2


def test_checkpoint_uses_the_shared_folder(spark):
    folder = shared_folder(spark)
    assert spark.sparkContext.getCheckpointDir().rstrip("/").startswith(
        folder.rstrip("/") if "://" in folder else f"file:{folder.rstrip('/')}")
    assert cut_lineage(spark.range(5)).count() == 5


def test_merged_plan_prunes_and_shuffles_once_per_source(spark, smoke_dir):
    plan = stages.merged(spark, smoke_dir)._jdf.queryExecution().executedPlan().toString()
    assert "event_type" not in plan
    assert "SortAggregate" not in plan and "CartesianProduct" not in plan and "BatchEvalPython" not in plan


WEARABLE_SQL = (
    "location string, timestamp timestamp_ntz, user_id string, heart_rate double, steps int, cumulative_steps bigint, "
    "spo2 double, sleep_status int, sleep_quality double"
)


def reading(at, rate):
    return ("A", at, "u", float(rate), 1, 1, 97.0, 0, 0.0)


def test_stream_drops_and_counts_late_rows(spark):
    folder = scratch_path(spark, "late")
    t0 = dt.datetime(2024, 1, 1)

    def arrive(*rows):
        spark.createDataFrame(list(rows), WEARABLE_SQL).coalesce(1).write.mode("append").parquet(folder)

    def drain_again():
        stream = run.file_stream(spark, folder, spark.createDataFrame([], WEARABLE_SQL).schema)
        query = run.start(hourly.stream_vitals(stream), f"{folder}-out", f"{folder}-checkpoint")
        late = run.LateRows()
        late.follow(query)
        return late.total()

    arrive(reading(t0, 60), reading(t0, 80), reading(t0 + dt.timedelta(hours=10), 70))
    assert drain_again() == 0
    # after the watermark passed the first hour, one more reading for it comes too late
    arrive(reading(t0, 100), reading(t0 + dt.timedelta(hours=20), 70))
    assert drain_again() == 1
    out = {r["timestamp"]: r["heart_rate_mean"] for r in spark.read.parquet(f"{folder}-out").collect()}
    assert out == {t0: 70.0, t0 + dt.timedelta(hours=10): 70.0}


def test_stream_equals_batch_on_closed_hours(spark, smoke_dir):
    wearable = stages.sources(spark, smoke_dir).wearable
    folder = scratch_path(spark, "parity")
    wearable.write.parquet(folder)
    streamed, _ = run.drain(hourly.stream_vitals(run.file_stream(spark, folder, wearable.schema)))
    end = wearable.agg(F.max("timestamp")).first()[0] - dt.timedelta(hours=3)
    batch = vitals.hourly_vitals(wearable).filter(F.col("timestamp") <= F.lit(end)).select(*streamed.columns)
    assert streamed.count() == batch.count() and streamed.exceptAll(batch).count() == 0


def test_late_rows_are_counted_over_all_reports():
    class Query:
        recentProgress = []

    late, query = run.LateRows(), Query()
    for batch in range(300):
        query.recentProgress = (query.recentProgress + [{"batchId": batch, "stateOperators": [{"numRowsDroppedByWatermark": 1}]}])[-100:]
        if batch % 50 == 0:
            late.read(query)
    late.read(query)
    assert late.total() == 300
    late.by_batch.pop(150)
    with pytest.raises(RuntimeError, match="dropped"):
        late.total()


def test_a_fourth_site_is_kept(spark, smoke_dir):
    from vitalgrid.plans import catalog

    sites = {r["location"] for r in catalog.QUERIES["all_nodes_merged"](spark, smoke_dir).select("location").distinct().collect()}
    assert sites == {r["location"] for r in stages.merged(spark, smoke_dir).select("location").distinct().collect()}


def test_tables_of_a_run_go_with_it(spark):
    import os

    with scratch_run(spark) as folder:
        table = written(spark.range(3), "some")
        assert table.count() == 3 and os.listdir(folder.removeprefix("file:"))
    assert not os.path.exists(folder.removeprefix("file:"))
    assert "/run-" not in scratch_path(spark, "after")
