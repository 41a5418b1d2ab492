"""Air-quality index, day bands and expected environment levels."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import INDEX_RANGE, PM10_INDEX, PM25_INDEX
from .core import clamp, col, first_match, hour_of, weekend_flag


def _index(c, table) -> Column:
    c = col(c)
    lines = [
        (high, F.lit(float(index_low)) + ((c - F.lit(float(low))) / F.lit(float(high) - float(low)))
         * F.lit(float(index_high - index_low)))
        for low, high, index_low, index_high in table
    ]
    rules = [(c <= F.lit(float(high)), value) for high, value in lines[:-1]]
    return first_match(rules, lines[-1][1])


def aqi(pm25="pm25", pm10="pm10") -> Column:
    """Air-quality index: the worse of the two pollutant indices, limited to 0..500."""
    return clamp(F.greatest(_index(pm25, PM25_INDEX), _index(pm10, PM10_INDEX)), *INDEX_RANGE)


def traffic_band(ts="timestamp") -> Column:
    hour = hour_of(ts)
    return first_match(
        [(hour.between(7, 9) | hour.between(17, 19), "rush"), (hour.between(10, 16), "daytime"),
         (hour.isNotNull(), "night")]
    )


def activity_band(ts="timestamp") -> Column:
    hour = hour_of(ts)
    return first_match(
        [(hour.between(2, 6), "night"), (hour.between(7, 10), "morning"),
         (hour.between(11, 18), "day"), (hour.isNotNull(), "evening")]
    )


def sleep_hour(ts="timestamp") -> Column:
    hour = hour_of(ts)
    return (hour >= 23) | (hour < 7)


def pollution_factor(ts="timestamp") -> Column:
    """Time-of-day, weekend and daily-cycle multiplier on a location's base level."""
    band = traffic_band(ts)
    time_factor = first_match([(band == "rush", 1.3), (band == "daytime", 1.1), (band == "night", 0.9)])
    day_factor = F.when(weekend_flag(ts) == 1, 0.85).otherwise(1.0)
    cycle = F.lit(1.0) + F.sin(F.lit(2 * math.pi) * hour_of(ts) / F.lit(24.0)) * F.lit(0.1)
    return time_factor * day_factor * cycle


def expected_temperature(base, daily_range, ts="timestamp") -> Column:
    two_pi = F.lit(2 * math.pi)
    daily = F.sin(two_pi * (hour_of(ts) - 4) / F.lit(24.0)) * col(daily_range)
    seasonal = F.sin(two_pi * F.dayofyear(col(ts)) / F.lit(365.0)) * F.lit(5.0)
    return col(base) + daily + seasonal


# ---- display status ------------------------------------------------------


def aqi_status(c="aqi") -> Column:
    c = col(c)
    return first_match([(c < 50, "Good"), (c < 100, "Moderate")], "Unhealthy")


def pm25_status(c="pm25") -> Column:
    c = col(c)
    return first_match([(c < 25, "Safe"), (c < 50, "Moderate")], "Unhealthy")


def temperature_status(c="temperature") -> Column:
    c = col(c)
    return first_match([(c.between(15, 30), "Comfortable")], "Extreme")
