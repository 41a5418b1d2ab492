"""Distributed order statistics against brute force, with a hot group."""

import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitalgrid.operators import metrics, vitals
from vitalgrid.operators.ordered import UNIT_LEVELS, WIDE_LEVELS, exact_quantiles, magnitude, running_totals, share_cut


def hot_rows(n=3000):
    rng = random.Random(7)
    rows = []
    for i in range(n):
        site = "hot" if i % 3 == 0 else f"s{rng.randrange(4)}"
        value = 0.5 if site == "hot" and i % 2 else round(rng.random(), 9)
        rows.append((site, i, value if rng.random() > 0.02 else None))
    return rows


@pytest.mark.parametrize("levels", [UNIT_LEVELS, WIDE_LEVELS, ()])
def test_quantiles_by_group(spark, levels):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "site string, i int, x double")
    got = exact_quantiles(df, "x", {"low": 0.1, "p70": 0.7, "top": 1.0}, ["site"], levels=levels).collect()
    assert len(got) == 5
    for r in got:
        values = [x for s, _, x in rows if s == r["site"] and x is not None]
        assert r["n"] == len(values)
        for name, p in (("low", 0.1), ("p70", 0.7), ("top", 1.0)):
            assert r[name] == pytest.approx(np.quantile(values, p), abs=1e-12)


def test_quantile_of_everything(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "site string, i int, x double")
    got = exact_quantiles(df, "x", {"p": 0.7}, levels=UNIT_LEVELS).first()
    assert got["p"] == pytest.approx(np.quantile([x for *_, x in rows if x is not None], 0.7), abs=1e-12)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(-10**6, 10**6), min_size=1, max_size=40), p=st.floats(0, 1))
def test_quantile_property(spark, values, p):
    df = spark.createDataFrame([(v / 1000,) for v in values], "x double")
    got = exact_quantiles(df, "x", {"p": p}).first()["p"]
    assert got == pytest.approx(np.quantile([v / 1000 for v in values], p), abs=1e-7)


def test_running_totals_match_plain_sums(spark):
    rng = random.Random(3)
    rows = [("hot" if i % 3 else f"u{i % 7}", rng.randrange(10**6), i, rng.randrange(50)) for i in range(2000)]
    df = spark.createDataFrame(rows, "u string, t int, i int, steps int").withColumns(
        {"coarse": F.expr("t div 100000"), "fine": F.expr("t div 1000")}
    )
    want, totals = {}, {}
    for u, _, i, s in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        totals[u] = totals.get(u, 0) + s
        want[i] = totals[u]
    for cells in ([], ["fine"], ["coarse", "fine"]):
        got = running_totals(df, ["u"], ["t", "i"], ["steps"], cells)
        assert {r["i"]: r["running_steps"] for r in got.collect()} == want


def test_running_totals_of_null_group(spark):
    df = spark.sql("SELECT CAST(NULL AS STRING) u, 1 t, 5 steps")
    row = running_totals(df.withColumn("c", F.col("t")), ["u"], ["t"], ["steps"], ["c"]).first()
    assert row["running_steps"] is None


def test_share_cut_takes_exact_share(spark):
    from vitalgrid.functions.core import hash_key

    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise("rest").alias("g"))
    cut = share_cut(df, hash_key("id"), 0.2, ["g"], F.ceil)
    counts = df.join(cut, "g").filter(hash_key("id") <= F.col("cut")).groupBy("g").count().collect()
    assert {r["g"]: r["count"] for r in counts} == {"hot": 67, "rest": 134}


def test_share_cut_keeps_copies_together(spark):
    from vitalgrid.functions.core import hash_key

    df = spark.range(300).select((F.col("id") % 3).alias("k"), F.lit("g").alias("g"))
    cut = share_cut(df, hash_key("k"), 0.2, ["g"], F.ceil)
    chosen = df.join(cut, "g").filter(hash_key("k") <= F.col("cut")).groupBy("k").count().collect()
    assert [r["count"] for r in chosen] == [100]


@pytest.mark.parametrize("limit", [0, 10**6])
def test_attach_keeps_every_row(spark, monkeypatch, limit):
    from vitalgrid.operators import attach

    monkeypatch.setattr(attach, "BROADCAST_VALUES", limit)
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("k"))
    values = spark.sql("SELECT * FROM VALUES ('hot', 1), ('1', 2), ('2', 3) t(k, v)")
    got = {r["id"]: r["v"] for r in attach.attach(rows, values, ["k"]).collect()}
    assert len(got) == 3000
    for i, v in got.items():
        assert v == (1 if i % 3 == 0 else {1: 2, 2: 3}.get(i % 7))
    assert attach.attach(rows, values, ["k"], "inner").count() == sum(v is not None for v in got.values())


def test_quantiles_of_any_magnitude(spark):
    rng = random.Random(9)
    values = [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-12, 12) for _ in range(500)] + [1e10, -1e10, 0.0, 1e300, 1e-10, 2e-10]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = exact_quantiles(df, "x", {f"p{i}": i / 7 for i in range(8)}).first()
    for i in range(8):
        assert got[f"p{i}"] == pytest.approx(np.quantile(values, i / 7), rel=1e-12)


def test_magnitude_never_falls(spark):
    values = sorted({s * m * 10.0**e for s in (-1, 1) for m in (1, 1.0000001, 3) for e in range(-20, 300, 7)} | {0.0})
    df = spark.createDataFrame([(v,) for v in values], "x double").coalesce(1)
    found = [r[0] for r in df.select(magnitude(F.col("x"))).collect()]
    assert found == sorted(found)


def test_area_of_close_scores(spark):
    """Scores that differ far behind the ninth decimal, and scores beyond one, are told apart."""
    df = spark.createDataFrame([(1e-10, 0), (2e-10, 1), (1e12, 1)], "score double, health_risk int")
    assert metrics.roc_auc(df).first()["roc_auc"] == 1.0


@pytest.mark.parametrize("heavy_rows", [0, 10**6])
def test_running_steps_of_rows_without_a_time(spark, heavy_rows):
    rows = [("u", None, 1, 7), ("u", dt.datetime(2024, 1, 1, 1), 2, 5), ("u", dt.datetime(2024, 1, 1, 2), 3, 2)]
    df = spark.createDataFrame(rows, "user_id string, timestamp timestamp_ntz, event_id int, steps int")
    found = vitals.lifetime_running_steps(df, ["timestamp", "event_id"], heavy_rows=heavy_rows)
    assert {r["event_id"]: r["cumulative_steps"] for r in found.collect()} == {1: 7, 2: 12, 3: 14}
