"""Clamp, bins, stable rounding, calendar and text helpers."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Means are rounded once, to this many places, before any threshold is applied:
# a distributed sum depends on task order in its last bits, a rounded one does not.
STABLE_DIGITS = 9


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stable(c) -> Column:
    return F.round(col(c), STABLE_DIGITS)


def clamp(c, low, high) -> Column:
    """Limit to [low, high]. NULL stays NULL (greatest and least would skip it)."""
    c = col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(float(low))), F.lit(float(high))))


def no_nan(c) -> Column:
    """NaN to NULL: Spark orders NaN above every number, so it would pass `>` rules."""
    c = col(c)
    return F.when(~F.isnan(c), c)


def first_match(rules, otherwise=None) -> Column:
    """CASE over (condition, value) pairs; a NULL condition falls through."""
    head, *rest = [(cond, v if isinstance(v, Column) else F.lit(v)) for cond, v in rules]
    chain = reduce(lambda acc, rule: acc.when(*rule), rest, F.when(*head))
    return chain.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def right_closed_bin(c, bins) -> Column:
    """Label of the bin (lower, upper] that holds the value; NULL outside all of them."""
    c = col(c)
    lowest = bins[0][0]
    return first_match(
        [(c <= F.lit(float(lowest)), None)]
        + [(c <= F.lit(float(upper)), label) for _, upper, label in bins]
    )


def flag(condition: Column) -> Column:
    """1 when true, else 0, also for NULL."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def hour_of(ts="timestamp") -> Column:
    return F.hour(col(ts))


def monday_first_weekday(ts="timestamp") -> Column:
    return F.weekday(col(ts))


def weekend_flag(ts="timestamp") -> Column:
    return (monday_first_weekday(ts) >= 5).cast("int")


def day_of(ts="timestamp") -> Column:
    return F.to_date(col(ts))


def display_time(ts="timestamp") -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd HH:mm")


def hash_key(*parts) -> Column:
    """Non-negative 60-bit integer from the md5 of the parts; uniform, the same on every run."""
    text = F.concat_ws("|", *[col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
