"""Wearable readings: hourly aggregate and running step totals."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import stable
from .ordered import HEAVY_ROWS, running_totals_by_size

KEYS = ("location", "timestamp")


def with_missing_columns(df: DataFrame, schema) -> DataFrame:
    """Add the schema's absent columns as typed NULLs."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns}
    return df.withColumns(missing) if missing else df


def hourly_vitals(wearable: DataFrame, keys=KEYS, distinct_users: bool = False) -> DataFrame:
    """One row per location and timestamp.

    Every measure combines map-side, so a hot location only adds partial rows. A sum over
    nothing is 0; the deviation of one reading is NULL; users are counted per row.
    """
    measures = ("heart_rate", "steps", "cumulative_steps", "spo2", "sleep_status", "sleep_quality", "user_id")
    absent = {m: F.lit(None).cast("double") for m in measures if m not in wearable.columns}
    readings = wearable.withColumns(absent) if absent else wearable
    zero = F.lit(0).cast("long")
    extra = [F.countDistinct("user_id").alias("distinct_users")] if distinct_users else []
    return readings.filter(F.col("timestamp").isNotNull()).groupBy(*keys).agg(
        stable(F.avg("heart_rate")).alias("heart_rate_mean"),
        stable(F.stddev_samp("heart_rate")).alias("heart_rate_std"),
        F.max("heart_rate").alias("heart_rate_max"),
        F.coalesce(F.sum("steps"), zero).alias("steps_total"),
        F.max("cumulative_steps").alias("cumulative_steps_max"),
        stable(F.avg("spo2")).alias("spo2_mean"),
        F.min("spo2").alias("spo2_min"),
        F.coalesce(F.sum("sleep_status"), zero).alias("sleeping_users_count"),
        stable(F.avg("sleep_quality")).alias("sleep_quality_mean"),
        F.count("user_id").alias("active_users_count"),
        *extra,
    )


def daily_running_steps(
    wearable: DataFrame, order, name: str = "cumulative_steps", heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """Steps summed from midnight to each reading of one user; busy days are cut by minute and second."""
    days = wearable.withColumn("_day", F.to_date("timestamp"))
    cells = {"_cell": F.date_trunc("minute", order[0]), "_second": F.date_trunc("second", order[0])}
    summed = running_totals_by_size(days, ["user_id", "_day"], order, ["steps"], cells, heavy_rows)
    return summed.withColumnRenamed("running_steps", name).drop("_day")


def lifetime_running_steps(
    wearable: DataFrame, order, name: str = "cumulative_steps", heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """Steps summed over all readings of one user; busy users are cut by day, minute and second."""
    cells = {
        "_day": F.to_date(order[0]), "_cell": F.date_trunc("minute", order[0]), "_second": F.date_trunc("second", order[0])
    }
    summed = running_totals_by_size(wearable, ["user_id"], order, ["steps"], cells, heavy_rows)
    return summed.withColumnRenamed("running_steps", name)
