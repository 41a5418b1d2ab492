"""Wearable, air-quality and weather views derived from a generic event table."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import environment
from ..operators.vitals import daily_running_steps

EVENT_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


@dataclass(frozen=True)
class Sources:
    wearable: DataFrame
    air: DataFrame
    weather: DataFrame


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENT_SCHEMA).parquet(f"{folder}/events.parquet")


def _base(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id",
        "ts",
        "user_id",
        "try_cast(get_json_object(props, '$.k') AS bigint) AS k",
        "cast(round(value * 100) AS bigint) AS v",
        "CASE user_id % 3 WHEN 0 THEN 'hospital_A' WHEN 1 THEN 'hospital_B' ELSE 'hospital_C' END AS location",
        "cast(date_trunc('hour', ts) AS timestamp_ntz) AS timestamp",
    )


def wearable_view(events: DataFrame, cumulative: bool = True) -> DataFrame:
    """Every event as one reading; `cumulative` adds the running steps of the user's day."""
    readings = _base(events).withColumn("sleep_status", environment.sleep_hour().cast("int")).selectExpr(
        "timestamp",
        "location",
        "user_id",
        "event_id",
        "ts",
        "55 + (v % 700) / 10D AS heart_rate",
        "cast(v % 900 AS int) AS steps",
        "88 + ((v * 31 + k * 17) % 121) / 10D AS spo2",
        "sleep_status",
        "if(sleep_status = 1, k, 0) * 1D AS sleep_quality",
    )
    return daily_running_steps(readings, ["ts", "event_id"]) if cumulative else readings


def _air(rows: DataFrame) -> DataFrame:
    pollutants = rows.selectExpr(
        "location",
        "timestamp",
        "(v % 26000) / 100D AS pm25",
        "k * 3.5D + (v % 100) / 10D AS pm10",
        "cast(400 + k * 6 AS double) AS co2",
    )
    return pollutants.select("location", "timestamp", "pm25", "pm10", environment.aqi().alias("aqi"), "co2")


def _weather(rows: DataFrame) -> DataFrame:
    return rows.selectExpr(
        "location",
        "timestamp",
        "-2 + ((event_id * 37) % 430) / 10D AS temperature",
        "20 + ((event_id * 53) % 801) / 10D AS humidity",
        "(event_id * 29 % 500) / 10D AS wind_speed",
        "980 + (event_id * 13 % 701) / 10D AS pressure",
        "cast(event_id % 5 = 0 AS int) AS precipitation",
        "if(event_id % 5 = 0, (k % 50) / 2D, 0D) AS rainfall",
    )


def _picked(events: DataFrame, pick) -> DataFrame:
    """One event per location and hour. Numeric buffers only, so a hash aggregate combines them."""
    columns = [pick(c, "event_id").alias(c) for c in ("event_id", "v", "k")]
    return _base(events).groupBy("location", "timestamp").agg(*columns)


def air_view(events: DataFrame) -> DataFrame:
    """The lowest event of each location and hour, as an air-quality reading."""
    return _air(_picked(events, F.min_by))


def weather_view(events: DataFrame) -> DataFrame:
    """The highest event of each location and hour, as a weather reading."""
    return _weather(_picked(events, F.max_by))


def air_readings(events: DataFrame) -> DataFrame:
    """Every event as an air-quality reading at its own time."""
    return _air(_base(events).withColumn("timestamp", F.col("ts")))


def weather_readings(events: DataFrame) -> DataFrame:
    """Every event as a weather reading at its own time."""
    return _weather(_base(events).withColumn("timestamp", F.col("ts")))


def event_sources(spark: SparkSession, folder: str, cumulative: bool = True) -> Sources:
    events = read_events(spark, folder)
    return Sources(wearable_view(events, cumulative), air_view(events), weather_view(events))
