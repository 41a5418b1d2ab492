"""Hourly spine, gaps and expected environment levels."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import environment
from ..schemas import CLIMATE_BASE, CLIMATE_DEFAULT, POLLUTION_BASE, POLLUTION_DEFAULT


def hourly_spine(readings: DataFrame, include_end: bool = True) -> DataFrame:
    """Every hour from each location's first to its last reading.

    Days are exploded first and hours second, so no array grows with the time span in hours.
    """
    span = readings.groupBy("location").agg(
        F.min("timestamp").alias("_from"), F.max("timestamp").alias("_to")
    )
    days = span.select(
        "*", F.explode(F.sequence(F.to_date("_from"), F.to_date("_to"))).alias("_day")
    )
    hour = F.explode(F.sequence(F.lit(0), F.lit(23)))
    offset = F.col("_from") - F.date_trunc("day", "_from").cast("timestamp_ntz")
    # hours keep the minute of the first reading, as the spine starts there
    ts = F.col("_day").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("_hour")) + (
        offset - F.make_dt_interval(F.lit(0), F.hour("_from"))
    )
    hours = days.select("*", hour.alias("_hour")).select("location", ts.alias("timestamp"), "_from", "_to")
    inside = F.col("timestamp") <= F.col("_to") if include_end else F.col("timestamp") < F.col("_to")
    return hours.filter((F.col("timestamp") >= F.col("_from")) & inside).select("location", "timestamp")


def time_gaps(readings: DataFrame) -> DataFrame:
    """Spine hours without a reading: the hours an inner join drops silently."""
    return hourly_spine(readings).join(
        readings.select("location", "timestamp").distinct(), ["location", "timestamp"], "left_anti"
    )


def _lookup(df: DataFrame, table: Mapping[str, Sequence[float]], default, names) -> DataFrame:
    """Attach per-location constants, with a default for locations the table lacks.

    The table is a constant of this package, so its broadcast cannot grow with the data.
    """
    rows = [(location, *[float(v) for v in values]) for location, values in table.items()]
    dimension = df.sparkSession.createDataFrame(rows, ["location", *[f"_{n}" for n in names]])
    joined = df.join(F.broadcast(dimension), "location", "left")
    filled = {n: F.coalesce(F.col(f"_{n}"), F.lit(float(d))) for n, d in zip(names, default)}
    return joined.withColumns(filled).drop(*[f"_{n}" for n in names])


def expected_pollution(air: DataFrame) -> DataFrame:
    """Expected PM levels from the location's base and the time of day, and what is left over."""
    based = _lookup(air, POLLUTION_BASE, POLLUTION_DEFAULT, ["pm25_base", "pm10_base"])
    factor = environment.pollution_factor()
    return based.withColumns({
        "traffic_band": environment.traffic_band(),
        "expected_pm25": F.col("pm25_base") * factor,
        "expected_pm10": F.col("pm10_base") * factor,
    }).withColumns({
        "pm25_residual": F.col("pm25") - F.col("expected_pm25"),
        "pm10_residual": F.col("pm10") - F.col("expected_pm10"),
    }).drop("pm25_base", "pm10_base")


def expected_temperature(weather: DataFrame) -> DataFrame:
    based = _lookup(weather, CLIMATE_BASE, CLIMATE_DEFAULT, ["temp_base", "temp_range"])
    expected = environment.expected_temperature("temp_base", "temp_range")
    return based.withColumn("expected_temperature", expected).withColumn(
        "temperature_residual", F.col("temperature") - F.col("expected_temperature")
    ).drop("temp_base", "temp_range")


def activity_profile(wearable: DataFrame) -> DataFrame:
    """Readings and mean heart rate per location and part of the day."""
    return wearable.groupBy("location", environment.activity_band().alias("activity_band")).agg(
        F.count(F.lit(1)).alias("readings"),
        F.avg("heart_rate").alias("avg_heart_rate"),
        F.sum(environment.sleep_hour().cast("int")).alias("sleep_hour_readings"),
    )


def with_user_key(df: DataFrame, node="location", number="user_id") -> DataFrame:
    """Readable row key: <location>_user_<three-digit number>."""
    return df.withColumn("user_key", F.format_string("%s_user_%03d", F.col(node), F.col(number)))
