"""Join of vitals and environment, and the derived hourly features."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import core
from ..schemas import AIR_COLUMNS, AQI_BINS, MERGED_COLUMNS, TEMPERATURE_BINS, WEATHER_COLUMNS
from .vitals import hourly_vitals

KEYS = ["location", "timestamp"]


def hour_aligned(environment: DataFrame, measures: Sequence[str]) -> DataFrame:
    """One row per location and hour, so that readings off the full hour still meet."""
    hourly = environment.withColumn("timestamp", F.date_trunc("hour", "timestamp").cast("timestamp_ntz"))
    flags = {"precipitation"}
    return hourly.groupBy(*KEYS).agg(*[
        (F.max(m) if m in flags else core.stable(F.avg(m))).alias(m) for m in measures if m in environment.columns
    ])


def join_environment(vitals: DataFrame, air: DataFrame, weather: DataFrame) -> DataFrame:
    """Inner join on location and exact timestamp; duplicate readings multiply.

    No broadcast hint: both sides grow with locations and hours. The vitals arrive already
    partitioned on the join keys by their aggregate, so only the environment rows move,
    and adaptive execution broadcasts them when they turn out to be small.
    """
    return vitals.join(air, KEYS, "inner").join(weather, KEYS, "inner")


def with_derived_features(merged: DataFrame) -> DataFrame:
    """Calendar, category and flag columns."""
    return merged.withColumns({
        "hour": core.hour_of(),
        "day_of_week": core.monday_first_weekday(),
        "month": F.month("timestamp"),
        "is_weekend": core.weekend_flag(),
        "aqi_category": core.right_closed_bin("aqi", AQI_BINS),
        "temp_category": core.right_closed_bin("temperature", TEMPERATURE_BINS),
        "high_heart_rate": core.flag(F.col("heart_rate_mean") > 90),
        "low_spo2": core.flag(F.col("spo2_mean") < 95),
        "high_pollution": core.flag(F.col("aqi") > 100),
    })


def merge_sources(wearable: DataFrame, air: DataFrame, weather: DataFrame, align: str = "exact") -> DataFrame:
    """The merged hourly table of all locations.

    align="exact" joins equal timestamps; align="hour" truncates every source to the hour.
    """
    if align == "hour":
        wearable = wearable.withColumn("timestamp", F.date_trunc("hour", "timestamp").cast("timestamp_ntz"))
        air, weather = hour_aligned(air, AIR_COLUMNS), hour_aligned(weather, WEATHER_COLUMNS)
    elif align != "exact":
        raise ValueError(f"align must be 'exact' or 'hour', not {align!r}")
    joined = join_environment(hourly_vitals(wearable), air, weather)
    return with_derived_features(joined).select(*MERGED_COLUMNS)


def with_location(df: DataFrame, location: str) -> DataFrame:
    """Name the one location a file or stream stands for."""
    return df.withColumn("location", F.lit(location))


def drop_matching(df: DataFrame, text: str) -> DataFrame:
    """Drop the columns whose name contains `text`; none is fine."""
    return df.drop(*[c for c in df.columns if text in c])


def union_sites(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column one site lacks becomes NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
