"""Reports and rules on hand-made labeled rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vitalgrid.operators import reports, rules, spine
from vitalgrid.plans import stages

T0 = dt.datetime(2024, 1, 10)
HOUR = dt.timedelta(hours=1)
SCHEMA = (
    "location string, timestamp timestamp_ntz, health_risk int, aqi double, pm25 double, temperature double, "
    "heart_rate_mean double, spo2_mean double, active_users_count bigint"
)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def row(location="A", at=T0, risk=0, aqi=40.0, pm25=10.0, temperature=20.0):
    return (location, at, risk, aqi, pm25, temperature, 80.0, 97.0, 3)


@pytest.mark.parametrize("values, fired", [
    (dict(aqi=150.0), []),
    (dict(aqi=150.1), [("air_quality", "medium")]),
    (dict(aqi=200.0), [("air_quality", "medium")]),
    (dict(aqi=200.1), [("air_quality", "high")]),
    (dict(pm25=50.0), []),
    (dict(pm25=50.1), [("pm25", "medium")]),
    (dict(pm25=75.1), [("pm25", "high")]),
    (dict(temperature=35.0), []),
    (dict(temperature=35.1), [("temperature", "medium")]),
    (dict(temperature=5.0), []),
    (dict(temperature=4.9), [("temperature", "medium")]),
    (dict(aqi=300.0, pm25=80.0, temperature=40.0),
     [("air_quality", "high"), ("pm25", "high"), ("temperature", "medium")]),
    (dict(aqi=None, pm25=None, temperature=None), []),
])
def test_environment_alert_edges(spark, values, fired):
    got = rules.alerts(frame(spark, [row(at=T0 - HOUR, aqi=999.0), row(**values)])).collect()
    assert [(r["type"], r["severity"]) for r in got] == fired


@pytest.mark.parametrize("risks, severity", [
    ([0] * 7 + [1] * 3, None), ([0] * 6 + [1] * 4, "medium"), ([0, 1], "medium"), ([0] * 4 + [1] * 6, "high"),
])
def test_high_risk_rate_edges(spark, risks, severity):
    got = rules.alerts(frame(spark, [row(at=T0 + i * HOUR, risk=r) for i, r in enumerate(risks)])).collect()
    assert [(r["type"], r["severity"]) for r in got] == ([("high_risk", severity)] if severity else [])


def test_trailing_day_includes_the_row_24_hours_back(spark):
    second = dt.timedelta(seconds=1)
    rows = [row(at=T0), row(at=T0 - 24 * HOUR, risk=1), row(at=T0 - 24 * HOUR - second, risk=1),
            row("B", at=T0 - 100 * HOUR, risk=1)]
    assert reports.trailing_day(frame(spark, rows)).count() == 3
    rates = {r["location"]: r["recent_risk_rate"] for r in reports.recent_risk_rate(frame(spark, rows)).collect()}
    assert rates == {"A": 0.5, "B": 1.0}


def test_alert_message_and_display(spark):
    got = rules.alert_display(rules.alerts(frame(spark, [row(aqi=160.4)]))).first()
    assert got["message"] == "Air quality index at 160"
    assert (got["title"], got["time"]) == ("AIR_QUALITY", "2024-01-10 00:00")


def test_alerts_without_a_sensor_column(spark):
    table = frame(spark, [row(pm25=99.0, temperature=50.0)]).drop("temperature")
    assert [r["type"] for r in rules.alerts(table).collect()] == ["pm25"]


def test_region_and_citizen_filters(spark):
    table = frame(spark, [row("A", aqi=160.0), row("B", aqi=260.0)])
    assert [r["location"] for r in rules.region_alerts(table, ["B"]).collect()] == ["B"]
    assert rules.region_alerts(table, []).count() == 0
    without = rules.alerts(table).withColumn("location", F.when(F.col("location") == "B", F.lit("B")))
    assert rules.alerts_for(without, "A").count() == 1


@pytest.mark.parametrize("values, fired", [
    (dict(aqi=100.0), []), (dict(aqi=100.1), [("Air Quality Alert", "medium")]),
    (dict(aqi=150.1), [("Air Quality Alert", "high")]),
    (dict(pm25=50.1), [("High PM2.5", "medium")]), (dict(pm25=75.1), [("High PM2.5", "high")]),
    (dict(temperature=36.0), [("High Temperature", "medium")]), (dict(temperature=4.0), [("Low Temperature", "medium")]),
    (dict(risk=1), [("Elevated Health Risk", "high")]),
])
def test_recommendations(spark, values, fired):
    got = rules.recommendations(frame(spark, [row(**values)])).collect()
    assert [(r["title"], r["priority"]) for r in got] == fired


def test_medium_risk_recommendation_on_scores(spark):
    table = frame(spark, [row()]).withColumn("health_risk", F.lit(0.5))
    assert [(r["title"], r["priority"]) for r in rules.recommendations(table).collect()] == [
        ("Elevated Health Risk", "medium")
    ]


def test_summary_of_nothing_is_empty(spark):
    empty = frame(spark, [])
    assert reports.node_summary(empty).count() == 0
    assert reports.regional_comparison(empty, ["A"]).columns[0] == "node_name"
    kpi = reports.kpi_overview(empty).first()
    assert (kpi["total_records"], kpi["total_high_risk"], kpi["risk_percentage"]) == (0, 0, 0.0)
    assert rules.alerts(empty).count() == 0


def test_summary_without_optional_columns(spark):
    table = frame(spark, [row()]).drop("aqi", "pm25", "health_risk")
    got = reports.node_summary(table).first()
    assert (got["avg_aqi"], got["avg_pm25"], got["high_risk_percentage"], got["avg_temperature"]) == (0.0, 0.0, 0.0, 20.0)


def test_trends_count_only_labeled_rows(spark):
    got = reports.daily_risk_trends(frame(spark, [row(risk=1), row(at=T0 + HOUR, risk=None)]), node="A").first()
    assert (got["high_risk_count"], got["total_count"], got["risk_percentage"], got["node"]) == (1, 1, 100.0, "A")


def test_date_filters(spark):
    days = [row(at=T0 + dt.timedelta(days=d, hours=23)) for d in range(-9, 3)]
    table = frame(spark, days)
    assert reports.in_date_range(table, ["2024-01-10", "2024-01-11"]).count() == 2
    assert reports.in_date_range(table, ["2024-01-10"]).count() == 12
    assert reports.last_days(table).count() == 8
    plan = reports.in_date_range(table, ["2024-01-10", "2024-01-11"])._jdf.queryExecution().toString()
    assert "to_date" not in plan


def test_series_and_detail_take_existing_columns(spark):
    table = frame(spark, [row(), row(at=T0 + HOUR)])
    series = reports.long_series(table, reports.ENVIRONMENT_SERIES, ordered=True).collect()
    assert [r["metric"] for r in series] == ["aqi", "pm25", "temperature"] * 2
    detail = reports.detail_table(table.drop("pm25"))
    assert "pm25" not in detail.columns and detail.first()["timestamp"] == T0 + HOUR


def test_spine_and_gaps(spark):
    start = dt.datetime(2024, 1, 1, 22, 30)
    rows = [("A", start), ("A", start + 4 * HOUR), ("A", start + HOUR), ("B", start)]
    table = spark.createDataFrame(rows, "location string, timestamp timestamp_ntz")
    full = spine.hourly_spine(table).collect()
    assert sorted(r["timestamp"] for r in full if r["location"] == "A") == [start + i * HOUR for i in range(5)]
    assert spine.hourly_spine(table, include_end=False).count() == 4
    assert sorted(r["timestamp"] for r in spine.time_gaps(table).collect()) == [start + 2 * HOUR, start + 3 * HOUR]


def test_unknown_location_uses_default_base(spark):
    air = spark.sql("SELECT 'elsewhere' location, TIMESTAMP_NTZ'2024-01-01 12:00:00' timestamp, 40D pm25, 60D pm10")
    got = spine.expected_pollution(air).first()
    assert got["expected_pm25"] == pytest.approx(30 * 1.1)
    assert got["pm10_residual"] == pytest.approx(60 - 45 * 1.1)


def test_user_key(spark):
    df = spark.sql("SELECT 'N' location, 7 user_id UNION ALL SELECT 'N', 1234")
    assert {r["user_key"] for r in spine.with_user_key(df).collect()} == {"N_user_007", "N_user_1234"}


def test_latest_rows_are_found_without_a_sorted_aggregate(spark, smoke_dir):
    for found in (reports.latest_status, rules.recommendations, rules.alerts):
        plan = found(stages.labeled_once(spark, smoke_dir))._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan


def test_recommendations_without_some_columns(spark):
    df = spark.createDataFrame([("A", dt.datetime(2024, 1, 1), 160.0)], "location string, timestamp timestamp_ntz, aqi double")
    assert [(r["rule"], r["priority"]) for r in rules.recommendations(df).collect()] == [(1, "high")]
