"""Alerts and recommendations: rule tables over the latest row of each location."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import core
from .reports import in_regions, latest_rows, recent_risk_rate

HIGH_RISK_RATE = 0.3


def _rule(order, condition, value, **texts):
    """A struct when the condition holds, else NULL."""
    fields = [F.lit(order).alias("rule"), value.cast("double").alias("value")]
    fields += [(v if hasattr(v, "alias") else F.lit(v)).alias(k) for k, v in texts.items()]
    return F.when(condition, F.struct(*fields))


def _fire(df: DataFrame, rules, keep: Sequence[str]) -> DataFrame:
    """One row per rule that holds, in rule order."""
    fired = F.filter(F.array(*rules), lambda r: r.isNotNull())
    return df.select(*keep, F.inline(fired))


def _grade(value, cut):
    return F.when(value > cut, "high").otherwise("medium")


def _whole(value):
    """A number's whole part as text, which every engine prints alike."""
    return F.floor(value).cast("string")


def _environment_alerts(df: DataFrame) -> list:
    """The rules on one row; a column the table lacks has no rule."""
    rules = []
    if "aqi" in df.columns:
        aqi = F.col("aqi")
        rules.append(_rule(2, aqi > 150, aqi, type="air_quality", severity=_grade(aqi, 200),
                           message=F.concat(F.lit("Air quality index at "), _whole(aqi))))
    if "pm25" in df.columns:
        pm25 = F.col("pm25")
        rules.append(_rule(3, pm25 > 50, pm25, type="pm25", severity=_grade(pm25, 75),
                           message=F.concat(F.lit("Fine particles at "), _whole(pm25))))
    if "temperature" in df.columns:
        t = F.col("temperature")
        rules.append(_rule(4, t > 35, t, type="temperature", severity="medium",
                           message=F.concat(F.lit("Heat: "), _whole(t), F.lit(" degrees"))))
        rules.append(_rule(5, t < 5, t, type="temperature", severity="medium",
                           message=F.concat(F.lit("Cold: "), _whole(t), F.lit(" degrees"))))
    return rules


def row_alerts(df: DataFrame) -> DataFrame:
    """Environment alerts of every row by itself: the form a stream can use."""
    return _fire(df, _environment_alerts(df), ["location", "timestamp"])


def alerts(labeled: DataFrame, threshold_high_risk: float = HIGH_RISK_RATE) -> DataFrame:
    """Alerts of every location from its latest row and its risk rate over the last 24 hours."""
    latest = latest_rows(labeled)
    rated = latest.join(recent_risk_rate(labeled), "location", "left")
    rate = F.col("recent_risk_rate")
    message = F.concat(F.lit("High-risk hours of the last day: "), _whole(rate * 100), F.lit(" percent"))
    high_risk = _rule(1, rate > threshold_high_risk, rate, type="high_risk", severity=_grade(rate, 0.5),
                      message=message)
    return _fire(rated, [high_risk, *_environment_alerts(labeled)], ["location", "timestamp"])


def region_alerts(labeled: DataFrame, regions: Sequence[str], **options) -> DataFrame:
    """Alerts of the selected regions; `rule` gives the order within a region."""
    return alerts(in_regions(labeled, regions), **options)


def alerts_for(alert_rows: DataFrame, region: str) -> DataFrame:
    """The alerts a citizen of one region sees; an alert without a location counts as theirs."""
    return alert_rows.filter(F.coalesce("location", F.lit(region)) == region)


def alert_display(alert_rows: DataFrame) -> DataFrame:
    return alert_rows.withColumns({"title": F.upper("type"), "time": core.display_time()})


def recommendations(labeled: DataFrame) -> DataFrame:
    """Advice per location from its latest row; a column the table lacks gives none."""
    aqi, pm25, t, risk = F.col("aqi"), F.col("pm25"), F.col("temperature"), F.col("health_risk")

    def advice(order, column, condition, priority, title, *message):
        value = F.col(column)
        return column, _rule(order, condition, value, priority=priority, title=title, message=F.concat(*message))

    rules = [
        advice(1, "aqi", aqi > 100, _grade(aqi, 150), "Air Quality Alert",
               F.lit("The air quality index is "), _whole(aqi), F.lit(": stay inside or wear a mask.")),
        advice(2, "pm25", pm25 > 50, _grade(pm25, 75), "High PM2.5",
               F.lit("Fine particles are at "), _whole(pm25), F.lit(": avoid effort outside.")),
        advice(3, "temperature", t > 35, F.lit("medium"), "High Temperature",
               F.lit("It has "), _whole(t), F.lit(" degrees: drink water and seek shade.")),
        advice(4, "temperature", t < 5, F.lit("medium"), "Low Temperature",
               F.lit("It has "), _whole(t), F.lit(" degrees: keep warm.")),
        advice(5, "health_risk", risk > 0.4, _grade(risk, 0.7), "Elevated Health Risk",
               F.lit("Signs of raised health risk here: watch how you feel.")),
    ]
    present = [rule for column, rule in rules if column in labeled.columns]
    return _fire(latest_rows(labeled), present, ["location", "timestamp"])
