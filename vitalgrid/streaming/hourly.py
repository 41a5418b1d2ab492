"""Windowed vitals, environment join, labels and alerts on streams."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import core
from ..operators import labels, rules
from ..operators.attach import attach
from ..operators.merge import with_derived_features
from ..operators.vitals import hourly_vitals
from ..schemas import AIR_COLUMNS, WEATHER_COLUMNS

WATERMARK = "2 hours"


def event_time(stream: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Watermarks need an instant: a zone-free timestamp counts as session time (UTC)."""
    return stream.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", watermark)


def _hour(df: DataFrame) -> DataFrame:
    """The window's start as the plain timestamp the batch tables carry."""
    return df.withColumn("timestamp", F.col("window.start").cast("timestamp_ntz")).drop("window")


def _hourly(wearable: DataFrame, watermark: str) -> DataFrame:
    window = F.window("timestamp", "1 hour").alias("window")
    return hourly_vitals(event_time(wearable, watermark), keys=["location", window])


def stream_vitals(wearable: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """The hourly aggregate over tumbling windows; an hour comes out when the watermark passes it."""
    return _hour(_hourly(wearable, watermark))


def _environment(stream: DataFrame, measures, watermark: str) -> DataFrame:
    """One row per location and hour, as in the batch join on the hour, however often a site reports."""
    window = F.window("timestamp", "1 hour").alias("window")
    return event_time(stream, watermark).groupBy("location", window).agg(*[
        (F.max(m) if m == "precipitation" else core.stable(F.avg(m))).alias(m) for m in measures
    ])


def stream_environment(wearable: DataFrame, air: DataFrame, weather: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Hourly vitals joined with both environment streams on location and hour."""
    keys = ["location", "window"]
    joined = (
        _hourly(wearable, watermark)
        .join(_environment(air, AIR_COLUMNS, watermark), keys)
        .join(_environment(weather, WEATHER_COLUMNS, watermark), keys)
    )
    return with_derived_features(_hour(joined))


def stream_labels(merged: DataFrame, limits: DataFrame) -> DataFrame:
    """Binary labels against the thresholds of the last batch run: a quantile needs all rows,
    a stream has only the ones so far."""
    scored = attach(labels.with_risk_score(merged), limits.select("location", "threshold"), ["location"], "inner")
    return scored.withColumn("health_risk", (F.col("risk_score") >= F.col("threshold")).cast("int")).drop("threshold")


def stream_row_alerts(merged: DataFrame) -> DataFrame:
    """Environment alerts of each arriving row: no state."""
    return rules.row_alerts(merged)


def stream_risk_alerts(
    labeled: DataFrame, threshold: float = rules.HIGH_RISK_RATE, watermark: str = WATERMARK
) -> DataFrame:
    """High-risk alerts over the last 24 hours, sliding by the hour."""
    window = F.window("timestamp", "24 hours", "1 hour").alias("window")
    rate = event_time(labeled, watermark).groupBy("location", window).agg(
        F.avg("health_risk").alias("value"), F.count("health_risk").alias("n")
    )
    return rate.filter(F.col("value") > threshold).select(
        "location",
        F.col("window.end").cast("timestamp_ntz").alias("until"),
        "n",
        "value",
        F.lit("high_risk").alias("type"),
        F.when(F.col("value") > 0.5, "high").otherwise("medium").alias("severity"),
    )
