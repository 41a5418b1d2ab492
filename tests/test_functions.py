"""Every threshold at value - e, value and value + e, and NULL."""

import pytest
from pyspark.sql import functions as F

from vitalgrid.functions import core, environment, risk
from vitalgrid.schemas import AQI_BINS, TEMPERATURE_BINS

E = 0.1


def evaluate(spark, make, values):
    rows = [(i, None if v is None else float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, x double").coalesce(1)
    return [r["y"] for r in df.select("i", make("x").alias("y")).orderBy("i").collect()]


def check(spark, make, cases):
    got = evaluate(spark, make, [v for v, _ in cases])
    assert got == [want if want is None or isinstance(want, str) else pytest.approx(want, abs=1e-12) for _, want in cases]


def test_aqi_category_is_right_closed(spark):
    check(spark, lambda c: core.right_closed_bin(c, AQI_BINS), [
        (-1, None), (0, None), (E, "Good"), (50, "Good"), (50 + E, "Moderate"), (100, "Moderate"),
        (100 + E, "Sensitive"), (150, "Sensitive"), (150 + E, "Unhealthy"), (200, "Unhealthy"),
        (200 + E, "Very_Unhealthy"), (300, "Very_Unhealthy"), (300 + E, "Hazardous"), (500, "Hazardous"),
        (501, None), (None, None),
    ])


def test_temperature_category_is_right_closed(spark):
    check(spark, lambda c: core.right_closed_bin(c, TEMPERATURE_BINS), [
        (-999, None), (5, "Cold"), (10, "Cold"), (10 + E, "Mild"), (20, "Mild"), (20 + E, "Warm"),
        (30, "Warm"), (30 + E, "Hot"), (None, None),
    ])


def test_score_category_drops_zero(spark):
    check(spark, risk.score_category, [
        (0, None), (E, "Low"), (0.3, "Low"), (0.31, "Medium"), (0.6, "Medium"), (0.61, "High"), (1, "High"), (None, None),
    ])


def test_component_steps(spark):
    check(spark, risk.aqi_risk, [(50, 0), (50 + E, 0.2), (100, 0.2), (100 + E, 0.5), (150, 0.5), (150 + E, 0.8), (None, 0)])
    check(spark, risk.spo2_risk, [(90 - E, 1), (90, 0.7), (94 - E, 0.7), (94, 0.35), (96 - E, 0.35), (96, 0), (None, 0)])
    check(spark, risk.pm25_risk, [(12, 0), (12 + E, 0.15), (35, 0.15), (35 + E, 0.4), (55, 0.4), (55 + E, 0.7), (None, 0)])
    check(spark, risk.heart_rate_risk, [
        (40, 0), (60, 0), (85, 0.3), (110, 0.6), (110 + E, 0.9), (None, None),
    ])


def test_weather_risk(spark):
    def by_temperature(c):
        return risk.weather_risk(F.col(c), F.lit(50.0))

    def by_humidity(c):
        return risk.weather_risk(F.lit(20.0), F.col(c))

    check(spark, by_temperature, [
        (35 + E, 0.3), (35, 0.15), (30 + E, 0.15), (30, 0), (10, 0), (10 - E, 0.15), (5, 0.15), (5 - E, 0.3), (None, 0),
    ])
    check(spark, by_humidity, [(85, 0), (85 + E, 0.2), (30, 0), (30 - E, 0.1), (None, 0)])


def test_combined_risk(spark):
    check(spark, lambda c: risk.combined_risk(F.col(c), F.lit(90.1), F.lit(94.9)), [(100, 0.5), (100 + E, 0.8), (None, 0.5)])


def test_score_stays_null_when_heart_rate_is_missing(spark):
    row = spark.sql(
        "SELECT 120D aqi, CAST(NULL AS DOUBLE) heart_rate_mean, 93D spo2_mean, 40D pm25, 20D temperature, 50D humidity"
    )
    assert row.select(risk.weighted_score()).first()[0] is None


def test_score_maximum(spark):
    row = spark.sql("SELECT 500D aqi, 120D heart_rate_mean, 80D spo2_mean, 99D pm25, 40D temperature, 90D humidity")
    assert row.select(risk.weighted_score()).first()[0] == pytest.approx(0.81)


def plain_index(pm25, pm10):
    def line(x, table):
        for low, high, a, b in table[:-1]:
            if x <= high:
                return a + (x - low) / (high - low) * (b - a)
        low, high, a, b = table[-1]
        return a + (x - low) / (high - low) * (b - a)

    fine = line(pm25, [(0, 12, 0, 50), (12, 35.4, 50, 100), (35.4, 55.4, 100, 150), (55.4, 150.4, 150, 250), (150.4, 250.4, 250, 400)])
    coarse = line(pm10, [(0, 54, 0, 50), (54, 154, 50, 100), (154, 254, 100, 150), (254, 354, 150, 250), (354, 424, 250, 400)])
    return min(500.0, max(0.0, fine, coarse))


def test_aqi_against_plain_python(spark):
    fine = [-5, 0, 6, 12, 12.1, 35.4, 35.5, 55.4, 56, 150.4, 151, 250, 400]
    coarse = [0, 54, 54.1, 154, 155, 254, 255, 354, 355, 424, 600]
    pairs = [(float(a), float(b)) for a in fine for b in coarse]
    rows = spark.createDataFrame(pairs, "pm25 double, pm10 double").withColumn("aqi", environment.aqi()).collect()
    for r in rows:
        assert r["aqi"] == pytest.approx(plain_index(r["pm25"], r["pm10"]), abs=1e-9)


def test_aqi_with_missing_pollutants(spark):
    rows = spark.createDataFrame([(None, 54.0), (12.0, None), (None, None)], "pm25 double, pm10 double")
    assert [r[0] for r in rows.select(environment.aqi()).collect()] == [50.0, 50.0, None]


def test_status_texts(spark):
    check(spark, environment.aqi_status, [(50 - E, "Good"), (50, "Moderate"), (100, "Unhealthy")])
    check(spark, environment.pm25_status, [(25 - E, "Safe"), (25, "Moderate"), (50, "Unhealthy")])
    check(spark, environment.temperature_status, [(15 - E, "Extreme"), (15, "Comfortable"), (30, "Comfortable"), (30 + E, "Extreme")])
    check(spark, risk.display_category, [(0.7, "High Risk"), (0.69, "Medium Risk"), (0.4, "Medium Risk"), (0.39, "Low Risk"), (None, "Low Risk")])


def test_calendar_and_bands(spark):
    df = spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ'2024-01-01 00:00:00', TIMESTAMP_NTZ'2024-01-07 23:00:00', INTERVAL 1 HOUR)) AS timestamp")
    rows = df.select(
        "timestamp", core.monday_first_weekday().alias("d"), core.weekend_flag().alias("w"), core.hour_of().alias("h"),
        environment.traffic_band().alias("t"), environment.activity_band().alias("a"), environment.sleep_hour().alias("s"),
    ).collect()
    assert len(rows) == 168
    for r in rows:
        hour = r["timestamp"].hour
        assert (r["d"], r["h"], r["w"]) == (r["timestamp"].weekday(), hour, int(r["timestamp"].weekday() >= 5))
        assert r["t"] == ("rush" if hour in (7, 8, 9, 17, 18, 19) else "daytime" if 10 <= hour <= 16 else "night")
        assert r["a"] == ("night" if 2 <= hour <= 6 else "morning" if 7 <= hour <= 10 else "day" if 11 <= hour <= 18 else "evening")
        assert r["s"] == (hour >= 23 or hour < 7)


def test_clamp_keeps_null(spark):
    check(spark, lambda c: core.clamp(c, 0, 1), [(-1, 0), (0.5, 0.5), (2, 1), (None, None)])


def test_display_time(spark):
    row = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-09 07:05:59' AS timestamp")
    assert row.select(core.display_time()).first()[0] == "2024-03-09 07:05"
