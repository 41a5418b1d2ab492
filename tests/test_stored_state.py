"""Sketches, committed metrics, repairable hours, following limits and the incremental table."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from vitalgrid.operators import labels, merge, sketches
from vitalgrid.operators.vitals import hourly_vitals
from vitalgrid.plans import stages
from vitalgrid.plans.incremental import IncrementalTable
from vitalgrid.session import scratch_path
from vitalgrid.sources import committed, writers
from vitalgrid.sources.events import Sources
from vitalgrid.streaming import run, stored

T0 = dt.datetime(2024, 1, 1)


# --- sketches ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def values(spark):
    r = random.Random(4)
    rows = [(s, T0.date() + dt.timedelta(days=d), r.choice([r.random(), 0.5, round(r.random(), 2)]))
            for s in "AB" for d in range(6) for _ in range(r.randint(1, 60))]
    return spark.createDataFrame(rows + [("A", T0.date(), None), ("N", T0.date(), None)], "location string, day date, v double").repartition(7)


def test_merged_sketches_equal_the_sketch_of_all(values):
    daily = sketches.quantile_sketches(values, "v", ["location", "day"])
    whole = sketches.quantile_sketches(values, "v", ["location"])
    pairs = sketches.merged_sketches(daily.withColumn("half", F.day("day") % 2), ["location", "half"])
    for way in (sketches.merged_sketches(daily, ["location"]), sketches.merged_sketches(pairs, ["location"])):
        assert sorted(map(tuple, way.collect())) == sorted(map(tuple, whole.collect()))


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.7, 1.0])
@pytest.mark.parametrize("step", [1 / 4096, 0.1, 5.0])
def test_bounds_hold_the_exact_quantile(values, q, step):
    found = sketches.sketch_quantiles(sketches.quantile_sketches(values, "v", ["location"], step), {"x": q})
    exact = {r["location"]: r["e"] for r in values.filter("v is not null").groupBy("location").agg(F.percentile("v", q).alias("e")).collect()}
    rows = {r["location"]: r for r in found.collect()}
    assert set(rows) == set(exact) == {"A", "B"}
    all_rows = [(r["location"], r["v"]) for r in values.collect() if r["v"] is not None]
    for site, row in rows.items():
        assert row["x_low"] - 1e-12 <= exact[site] <= row["x_high"] + 1e-12
        own = [v for s, v in all_rows if s == site]
        between = sum(row["x_low"] <= v <= row["x_high"] for v in own)
        assert between / len(own) <= row["x_rank_error"] + 1e-12


def test_ranges_read_sketches_only(spark, values):
    daily = sketches.quantile_sketches(values, "v", ["location", "day"])
    ranges = spark.createDataFrame(
        [("all", T0.date(), T0.date() + dt.timedelta(days=5)), ("none", dt.date(2030, 1, 1), dt.date(2030, 1, 2))],
        "name string, first date, last date",
    )
    found = sketches.range_quantiles(daily, ranges, {"x": 0.7}).collect()
    assert {(r["location"], r["name"]) for r in found} == {("A", "all"), ("B", "all")}


# --- committed rounds --------------------------------------------------------------------------


def rounds(spark, n, accuracy):
    return spark.createDataFrame([(i, accuracy) for i in range(1, n + 1)], "round int, accuracy double")


def test_first_commit_of_a_round_stays(spark):
    path = scratch_path(spark, "rounds")
    committed.log_rounds(rounds(spark, 2, 0.5), path, "a")
    committed.log_rounds(rounds(spark, 3, 0.9), path, "a")  # repeats two rounds and goes on with a third
    committed.log_rounds(rounds(spark, 1, 0.7), path, "b")
    got = sorted((r["run"], r["round"], r["accuracy"]) for r in committed.read_rounds(spark, path).collect())
    assert got == [("a", 1, 0.5), ("a", 2, 0.5), ("a", 3, 0.9), ("b", 1, 0.7)]


def test_a_killed_run_is_not_seen_and_can_be_repeated(spark):
    path = scratch_path(spark, "rounds")
    committed.stage_rounds(rounds(spark, 2, 0.1), path, "a")
    assert committed.read_rounds(spark, path).count() == 0
    attempt = committed.stage_rounds(rounds(spark, 2, 0.2), path, "a")
    for _ in range(2):  # a commit that is repeated
        committed.commit_rounds(spark, path, "a", attempt)
    assert [r["accuracy"] for r in committed.read_rounds(spark, path).collect()] == [0.2, 0.2]


def test_two_commits_at_once_leave_one(spark):
    """Both writers saw no commit yet: the reader still takes one attempt per round."""
    path = scratch_path(spark, "rounds")
    attempts = [committed.stage_rounds(rounds(spark, 2, a), path, "a") for a in (0.3, 0.4)]
    rows = [("a", i, x, dt.datetime(2024, 1, 1)) for x in attempts for i in (1, 2)]
    spark.createDataFrame(rows, committed.COMMIT).write.parquet(f"{path}/commits")
    got = committed.read_rounds(spark, path).collect()
    assert len(got) == 2 and len({r["accuracy"] for r in got}) == 1


# --- repairable hours --------------------------------------------------------------------------

READINGS = (
    "timestamp timestamp_ntz, location string, user_id long, heart_rate double, steps int, cumulative_steps long, "
    "spo2 double, sleep_status int, sleep_quality double"
)


def readings(spark, hours, seed=0):
    r = random.Random(seed)
    rows = []
    for h in hours:
        for s in "AB":
            for _ in range(r.randint(1, 5)):
                at = T0 + dt.timedelta(hours=h, minutes=r.randrange(60))
                beat = r.choice([None, round(r.uniform(50, 120), 1)])
                rows.append((at, s, r.randrange(9), beat, r.randrange(900), r.randrange(5000), round(r.uniform(88, 100), 1), r.randrange(2), None))
    return spark.createDataFrame(rows, READINGS)


def hourly(table):
    at = table.withColumn("timestamp", F.date_trunc("hour", "timestamp").cast("timestamp_ntz"))
    return sorted(map(tuple, hourly_vitals(at).collect()))


def in_order(found, like):
    return sorted(map(tuple, found.select(*hourly_vitals(like).columns).collect()))


def test_partial_aggregates_of_any_cut_give_the_same_hours(spark):
    table = readings(spark, range(6)).withColumn("timestamp", F.date_trunc("hour", "timestamp").cast("timestamp_ntz"))
    want = hourly(table)
    for parts in (1, 2, 7):
        cut = table.withColumn("part", F.xxhash64("user_id", "steps") % parts)
        partials = stored.partial_vitals(cut, ("part", *stored.KEYS))
        assert in_order(stored.merged_vitals(partials), table) == want


def test_late_readings_are_kept_and_repaired_once(spark):
    store = stored.RepairableHours(scratch_path(spark, "hours"))
    first, late, last = readings(spark, range(10, 20), 1), readings(spark, range(0, 12), 2), readings(spark, range(18, 24), 3)
    for number, part in enumerate((first, late, last)):
        store.absorb(part, number)
        store.absorb(part, number)  # a batch that runs again
    side = store.late_readings(spark, late.schema)
    assert side.filter("batch = 1").count() == late.count()  # all hours before 17:00 were closed
    assert side.filter("batch = 2").count() == 0
    everything = first.union(late).union(last)
    assert in_order(store.hours(spark, late.schema), late) == hourly(first.union(last))
    hit = store.repair(spark, late.schema)
    assert hit.agg(F.sum("late_readings")).first()[0] == late.count()
    assert in_order(store.hours(spark, late.schema), late) == hourly(everything)
    assert store.repair(spark, late.schema).count() == 0  # nothing twice
    assert in_order(store.hours(spark, late.schema), late) == hourly(everything)
    closed = store.hours(spark, late.schema, closed_only=True).agg(F.max("timestamp")).first()[0]
    assert closed <= T0 + dt.timedelta(hours=21)


def test_a_stream_that_is_started_again_goes_on(spark):
    store = stored.RepairableHours(scratch_path(spark, "hours"))
    path, checkpoint = scratch_path(spark, "arrivals"), scratch_path(spark, "checkpoint")
    parts = [readings(spark, range(a, a + 6), a) for a in (0, 6, 12)]
    for part in parts:
        part.write.mode("append").parquet(path)
        for _ in range(2):  # the second call finds nothing new
            stored.run_batches(run.file_stream(spark, path, part.schema), store.absorb, checkpoint)
    whole = parts[0].union(parts[1]).union(parts[2])
    assert in_order(store.hours(spark, whole.schema), whole) == hourly(whole)


# --- following limits --------------------------------------------------------------------------


def test_limits_know_the_batches_before_and_no_others(spark, smoke_dir):
    table = stages.merged(spark, smoke_dir)
    weeks = [table.filter(F.weekofyear("timestamp") == w) for w in (1, 2, 3)]
    limits = stored.FollowingLimits(scratch_path(spark, "limits"))
    for number, week in enumerate(weeks):
        limits.absorb(week, number)
    limits.absorb(weeks[1], 1)  # runs again after a later one: the same limits
    found = limits.labeled(spark)
    assert found.count() == weeks[0].count() + weeks[1].count() + weeks[2].count()
    assert found.filter("batch = 0 and health_risk is not null").count() == 0
    for number in (1, 2):
        before = None
        for week in weeks[:number]:
            before = week if before is None else before.union(week)
        exact = {r["location"]: r["threshold"] for r in labels.thresholds(labels.with_risk_score(before)).collect()}
        used = {(r["location"], r["threshold"]) for r in found.filter(F.col("batch") == number).select("location", "threshold").distinct().collect()}
        assert len(used) == 3
        assert all(abs(exact[site] - t) < 0.05 for site, t in used)
        wrong = found.filter((F.col("batch") == number) & ((F.col("risk_score") >= F.col("threshold")).cast("int") != F.col("health_risk")))
        assert wrong.count() == 0


# --- incremental table -------------------------------------------------------------------------


def files_of(folder):
    out = {}
    for top, _, names in os.walk(folder):
        for name in names:
            if name.endswith(".parquet"):
                pair = "/".join(top.split("/")[-2:])
                out.setdefault(pair, set()).add(name)
    return out


@pytest.fixture(scope="module")
def few_days(spark, smoke_dir):
    s = stages.sources(spark, smoke_dir, cumulative=True)
    return Sources(*[t.filter(F.to_date("timestamp") <= F.lit("2024-01-04").cast("date")) for t in (s.wearable, s.air, s.weather)])


def rows_of(table):
    return sorted(map(tuple, table.select(*sorted(table.columns)).collect()), key=str)


def write_day(rows, path):
    rows.write.mode("append").option("header", True).partitionBy("location").csv(path)


def test_only_touched_partitions_are_written(spark, few_days):
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "table")
    late = (F.col("location") == "hospital_A") & (F.to_date("timestamp") == F.lit("2024-01-03").cast("date"))
    air_columns = ["location", "timestamp", "pm25", "pm10", "aqi", "co2"]
    writers.write_sources_csv(Sources(few_days.wearable, few_days.air.filter(~late), few_days.weather), raw)
    table = IncrementalTable(raw, out)
    first = table.update(spark)
    assert first.filter("hours > 0").count() == spark.read.parquet(f"{out}/merged").select("location", "day").distinct().count()
    before = files_of(f"{out}/merged")
    assert table.update(spark).count() == 0  # nothing changed
    assert files_of(f"{out}/merged") == before

    held_back = few_days.air.filter(late).select(*air_columns)
    assert held_back.count() > 0
    write_day(held_back, f"{raw}/air")
    again = table.update(spark).collect()
    assert [(r["location"], str(r["day"])) for r in again] == [("hospital_A", "2024-01-03")]
    after = files_of(f"{out}/merged")
    pair = "location=hospital_A/day=2024-01-03"
    assert {p: f for p, f in after.items() if p != pair} == {p: f for p, f in before.items() if p != pair}
    full = merge.merge_sources(few_days.wearable, few_days.air, few_days.weather)
    assert rows_of(table.table(spark).select(*full.columns)) == rows_of(full)


def test_removed_files_take_their_days_along(spark, few_days):
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "table")
    writers.write_sources_csv(Sources(few_days.wearable, few_days.air, few_days.weather), raw)
    table = IncrementalTable(raw, out)
    table.update(spark)
    before = files_of(f"{out}/merged")
    gone = f"{raw}/weather/location=hospital_C".removeprefix("file:")
    for name in os.listdir(gone):
        os.remove(f"{gone}/{name}")
    spark.catalog.refreshByPath(f"{raw}/weather")
    found = table.update(spark).collect()
    assert {r["location"] for r in found} == {"hospital_C"} and {r["hours"] for r in found} == {0}
    assert files_of(f"{out}/merged") == {p: f for p, f in before.items() if "hospital_C" not in p}


def test_a_run_that_broke_before_its_manifest_is_made_up_for(spark, few_days, monkeypatch):
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "table")
    writers.write_sources_csv(Sources(few_days.wearable, few_days.air, few_days.weather), raw)
    table = IncrementalTable(raw, out)
    monkeypatch.setattr(IncrementalTable, "_remove", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        table.update(spark)
    monkeypatch.undo()
    assert table.manifest(spark).count() == 0
    assert table.update(spark).count() > 0
    full = merge.merge_sources(few_days.wearable, few_days.air, few_days.weather)
    assert rows_of(table.table(spark).select(*full.columns)) == rows_of(full)
