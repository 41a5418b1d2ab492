"""Summaries, trends, latest rows and series over the labeled hourly table."""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import core, environment, risk
from .attach import attach

ENVIRONMENT_SERIES = ("aqi", "pm25", "temperature", "humidity")
VITALS_SERIES = ("heart_rate_mean", "spo2_mean")
DAILY_HEALTH = ("heart_rate_mean", "spo2_mean", "active_users_count")
DETAIL_COLUMNS = (
    "timestamp", "location", "health_risk", "aqi", "pm25", "temperature", "heart_rate_mean", "spo2_mean",
)
_AVERAGES = {"aqi": "avg_aqi", "pm25": "avg_pm25", "temperature": "avg_temperature",
             "heart_rate_mean": "avg_heart_rate"}


def _mean_or_zero(df: DataFrame, name: str):
    return F.avg(name) if name in df.columns else F.lit(0.0)


def _percentage(part, whole):
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / F.nullif(whole, F.lit(0)) * 100)


# ---- filters -------------------------------------------------------------


def in_regions(df: DataFrame, regions: Sequence[str]) -> DataFrame:
    """Rows of the selected locations; selecting none gives none."""
    return df.filter(F.col("location").isin(*regions) if regions else F.lit(False))


def in_date_range(df: DataFrame, dates: Sequence[dt.date | str]) -> DataFrame:
    """Both days included; anything but two dates leaves the rows as they are.

    Written as a range on the timestamp itself, so it reaches the Parquet scan.
    """
    if len(dates) != 2:
        return df
    first, last = (d if isinstance(d, dt.date) else dt.date.fromisoformat(d) for d in dates)
    start = dt.datetime.combine(first, dt.time())
    end = dt.datetime.combine(last + dt.timedelta(days=1), dt.time())
    ts = F.col("timestamp")
    return df.filter((ts >= F.lit(start).cast("timestamp_ntz")) & (ts < F.lit(end).cast("timestamp_ntz")))


def last_days(df: DataFrame, days: int = 7, by: Sequence[str] = ("location",)) -> DataFrame:
    """Rows from `days` before each group's last day up to that day."""
    ends = df.groupBy(*by).agg(F.max("timestamp").alias("_last"))
    start = F.date_sub(F.to_date("_last"), days).cast("timestamp_ntz")
    return attach(df, ends, by, "inner").filter(F.col("timestamp") >= start).drop("_last")


def trailing_day(df: DataFrame, by: Sequence[str] = ("location",)) -> DataFrame:
    """Rows of each group's last 24 hours, counted back from its own latest row, ends included."""
    ends = df.groupBy(*by).agg(F.max("timestamp").alias("_last"))
    recent = F.col("timestamp") >= F.col("_last") - F.expr("INTERVAL 24 HOURS")
    return attach(df, ends, by, "inner").filter(recent).drop("_last")


def existing(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    return [c for c in wanted if c in df.columns]


# ---- aggregates ----------------------------------------------------------


def node_summary(labeled: DataFrame) -> DataFrame:
    """One row per location; a location without rows has none."""
    n = F.count(F.lit(1))
    at_risk = F.sum("health_risk") if "health_risk" in labeled.columns else F.lit(0.0)
    return labeled.groupBy(F.col("location").alias("node_name")).agg(
        n.alias("total_records"),
        F.min("timestamp").alias("date_from"),
        F.max("timestamp").alias("date_to"),
        _percentage(F.coalesce(at_risk, F.lit(0)), n).alias("high_risk_percentage"),
        *[_mean_or_zero(labeled, c).alias(name) for c, name in _AVERAGES.items()],
    )


def regional_comparison(labeled: DataFrame, regions: Sequence[str]) -> DataFrame:
    """Node summaries of the selected regions, from one aggregate over all of them."""
    return node_summary(in_regions(labeled, regions))


def daily_risk_trends(labeled: DataFrame, by: Sequence[str] = (), node: str | None = None) -> DataFrame:
    daily = labeled.groupBy(*by, core.day_of().alias("date")).agg(
        F.coalesce(F.sum("health_risk"), F.lit(0)).alias("high_risk_count"),
        F.count("health_risk").alias("total_count"),
        (F.avg("health_risk") * 100).alias("risk_percentage"),
        *[F.avg(c).alias(name) for c, name in _AVERAGES.items()],
    )
    return daily.withColumn("node", F.lit(node)) if node else daily


def citizen_daily(labeled: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    means = ("health_risk", "aqi", "pm25", "temperature", "heart_rate_mean", "spo2_mean")
    daily = labeled.groupBy(*by, core.day_of().alias("date")).agg(*[F.avg(c).alias(c) for c in means])
    return daily.withColumn("risk_percentage", F.col("health_risk") * 100)


def daily_health(labeled: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    metrics = existing(labeled, DAILY_HEALTH)
    return labeled.groupBy(*by, core.day_of().alias("date")).agg(*[F.avg(c).alias(c) for c in metrics])


def kpi_overview(labeled: DataFrame) -> DataFrame:
    n, at_risk = F.count(F.lit(1)), F.coalesce(F.sum("health_risk"), F.lit(0))
    totals = labeled.agg(
        n.alias("total_records"),
        at_risk.alias("total_high_risk"),
        _percentage(at_risk, n).alias("risk_percentage"),
        _mean_or_zero(labeled, "aqi").alias("avg_aqi"),
        _mean_or_zero(labeled, "pm25").alias("avg_pm25"),
    )
    return totals.withColumn("aqi_status", environment.aqi_status("avg_aqi"))


def time_extent(df: DataFrame, by: Sequence[str] = ("location",)) -> DataFrame:
    return df.groupBy(*by).agg(F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"))


def source_summary(air: DataFrame, weather: DataFrame) -> DataFrame:
    """Readings and mean levels of the environment sources per location."""
    count = F.count(F.lit(1))
    of_air = air.groupBy("location").agg(
        count.alias("air_rows"), F.avg("aqi").alias("avg_aqi"), F.avg("pm25").alias("avg_pm25")
    )
    of_weather = weather.groupBy("location").agg(
        count.alias("weather_rows"),
        F.avg("temperature").alias("avg_temperature"),
        F.avg("humidity").alias("avg_humidity"),
    )
    return of_air.join(of_weather, "location", "full")


def recent_risk_rate(labeled: DataFrame, by: Sequence[str] = ("location",)) -> DataFrame:
    return trailing_day(labeled, by).groupBy(*by).agg(F.avg("health_risk").alias("recent_risk_rate"))


# ---- coverage ------------------------------------------------------------


def input_coverage(df: DataFrame, expected: DataFrame) -> DataFrame:
    """Every expected location with its row count, 0 when nothing arrived."""
    present = df.groupBy("location").agg(F.count(F.lit(1)).alias("n"))
    counted = expected.select("location").distinct().join(present, "location", "left")
    n = F.coalesce("n", F.lit(0))
    return counted.select("location", n.alias("n"), (n > 0).alias("present"))


def missing_locations(df: DataFrame, expected: DataFrame) -> DataFrame:
    return expected.select("location").distinct().join(df.select("location").distinct(), "location", "left_anti")


# ---- latest rows ---------------------------------------------------------


def latest_rows(labeled: DataFrame, by: Sequence[str] = ("location",)) -> DataFrame:
    """The newest row of each group; of several with that time the last by location, then by a hash.

    The newest time combines map-side, and only the rows that have it are sorted.
    """
    newest = labeled.filter(F.col("timestamp").isNotNull()).groupBy(*by).agg(F.max("timestamp").alias("_newest"))
    rows = attach(labeled, newest, by, how="inner").filter(F.col("timestamp") == F.col("_newest"))
    order = Window.partitionBy(*by).orderBy(F.desc("location"), F.xxhash64(*labeled.columns))
    return rows.withColumn("_place", F.row_number().over(order)).filter("_place = 1").select(*labeled.columns)


def latest_status(labeled: DataFrame) -> DataFrame:
    return latest_rows(labeled).select(
        "location",
        "timestamp",
        core.display_time().alias("updated"),
        "health_risk",
        risk.display_category().alias("current_risk"),
        "aqi",
        environment.aqi_status().alias("aqi_status"),
        "temperature",
        environment.temperature_status().alias("temperature_status"),
        "pm25",
        environment.pm25_status().alias("pm25_status"),
    )


# ---- series and tables ---------------------------------------------------


def long_series(df: DataFrame, metrics: Sequence[str], ordered: bool = False) -> DataFrame:
    """One row per location, time and metric, for those metrics the table has."""
    present = existing(df, metrics)
    doubles = [F.col(c).cast("double").alias(c) for c in present]
    series = df.select("location", "timestamp", *doubles).unpivot(
        ["location", "timestamp"], present, "metric", "value"
    )
    return series.orderBy("location", "timestamp", "metric") if ordered else series


def detail_table(df: DataFrame, columns: Sequence[str] = DETAIL_COLUMNS) -> DataFrame:
    """Newest first; only columns the table has."""
    return df.select(*existing(df, columns)).orderBy(F.desc("timestamp"), "location")
