"""Risk components, the weighted score and its categories."""

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import RISK_BINS, RISK_WEIGHTS
from .core import clamp, col, first_match, flag, right_closed_bin, stable


def _steps(c, cuts, below=False) -> Column:
    """Value of the first cut that is passed, else 0; NULL passes none."""
    c = col(c)
    return first_match([((c < cut) if below else (c > cut), float(v)) for cut, v in cuts], 0.0)


def aqi_risk(c="aqi") -> Column:
    return _steps(c, [(150, 0.8), (100, 0.5), (50, 0.2)])


def heart_rate_risk(c="heart_rate_mean") -> Column:
    c = col(c)
    return F.when(c > 110, F.lit(0.9)).otherwise(clamp((c - 60) / F.lit(50.0), 0, 1) * F.lit(0.6))


def spo2_risk(c="spo2_mean") -> Column:
    return _steps(c, [(90, 1.0), (94, 0.7), (96, 0.35)], below=True)


def pm25_risk(c="pm25") -> Column:
    return _steps(c, [(55, 0.7), (35, 0.4), (12, 0.15)])


def weather_risk(temperature="temperature", humidity="humidity") -> Column:
    t, h = col(temperature), col(humidity)
    heat_or_cold = first_match([((t > 35) | (t < 5), 0.3), ((t > 30) | (t < 10), 0.15)], 0.0)
    damp_or_dry = first_match([(h > 85, 0.2), (h < 30, 0.1)], 0.0)
    return clamp(heat_or_cold + damp_or_dry, 0, 1)


def combined_risk(aqi="aqi", heart_rate="heart_rate_mean", spo2="spo2_mean") -> Column:
    joint = (
        flag(col(aqi) > 100) * F.lit(0.3)
        + flag(col(heart_rate) > 90) * F.lit(0.2)
        + flag(col(spo2) < 95) * F.lit(0.3)
    )
    return clamp(joint, 0, 1)


COMPONENTS = {
    "aqi_risk": aqi_risk,
    "heart_rate_risk": heart_rate_risk,
    "spo2_risk": spo2_risk,
    "pm25_risk": pm25_risk,
    "weather_risk": weather_risk,
    "combined_risk": combined_risk,
}


def weighted_score(component_columns=None) -> Column:
    """Weighted sum in [0, 1]; NULL when a component is NULL."""
    columns = component_columns or {name: make() for name, make in COMPONENTS.items()}
    terms = [F.lit(weight) * col(columns[name]) for name, weight in RISK_WEIGHTS.items()]
    return stable(clamp(reduce(add, terms), 0, 1))


def score_category(c="health_risk") -> Column:
    return right_closed_bin(c, RISK_BINS)


def binary_category(c="health_risk") -> Column:
    c = col(c)
    return first_match([(c == 0, "Low"), (c == 1, "High")])


def display_category(c="health_risk") -> Column:
    c = col(c)
    return first_match([(c >= 0.7, "High Risk"), (c >= 0.4, "Medium Risk")], "Low Risk")
