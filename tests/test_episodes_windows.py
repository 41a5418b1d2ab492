"""Episodes and gaps on streams, drift of any two windows, correlations between sites."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalgrid.operators import drift, similarity, window_drift
from vitalgrid.session import scratch_path
from vitalgrid.streaming import episodes, run

T0 = dt.datetime(2024, 1, 1)
HOURS = "location string, timestamp timestamp_ntz, aqi double, pm25 double, temperature double"


def merged(spark, rows):
    """(site, hour, aqi) with the other measures quiet."""
    return spark.createDataFrame([(s, T0 + dt.timedelta(hours=h), a, 10.0, 20.0) for s, h, a in rows], HOURS)


def streamed(spark, parts, make):
    """What a stream gives whose parts arrive one after another, with a start of the query for each."""
    path, checkpoint, out = (scratch_path(spark, n) for n in ("hours", "checkpoint", "out"))
    for part in parts:
        part.write.mode("append").parquet(path)
        stream = make(run.file_stream(spark, path, part.schema))
        run.start(stream, out, checkpoint).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def plain_episodes(hours, silence):
    """Events of one site from (hour, value) in order, where the value is None without the condition."""
    out, open_, last = [], None, None
    for at, value in hours:
        if open_ and at - last > silence:
            out.append(("end", last, *open_))
            open_ = None
        if value is None:
            if open_:
                out.append(("end", at, *open_))
            open_ = None
        elif open_:
            open_ = (open_[0] + 1, max(open_[1], value))
        else:
            open_ = (1, value)
            out.append(("onset", at, *open_))
        last = at
    return out


@pytest.mark.parametrize("cuts", [[60], [20, 41, 60], [7, 9, 30, 31, 60]])
def test_episodes_do_not_depend_on_the_batches(spark, cuts):
    r = random.Random(2)
    rows = [(s, h, r.choice([100.0, 160.0, 210.0])) for s in "AB" for h in range(60) if r.random() < 0.8 and not 33 < h < 44]
    parts, before = [], 0
    for cut in cuts:
        part = [x for x in rows if before <= x[1] < cut]
        r.shuffle(part)  # out of order inside a part
        parts.append(merged(spark, part))
        before = cut
    found = streamed(spark, parts, episodes.stream_episodes)
    got = sorted((x["location"], x["event"], x["timestamp"], x["hours"], x["peak"]) for x in found.collect())
    passed = max(x[1] for x in rows) - 2
    want = []
    for s in "AB":
        own = [(h, a if a > 150 else None) for site, h, a in rows if site == s and h < passed]
        want += [(s, e, T0 + dt.timedelta(hours=h), n, p) for e, h, n, p in plain_episodes(own, episodes.SILENCE_HOURS)]
    assert got == sorted(want) and len(got) > 10
    assert {x["type"] for x in found.collect()} == {"air_quality"}


def test_hours_in_disorder_across_batches(spark):
    """Hours inside the delay may arrive after later ones."""
    first = merged(spark, [("A", 0, 100.0), ("A", 3, 100.0)])
    second = merged(spark, [("A", 2, 200.0), ("A", 9, 100.0)])
    found = streamed(spark, [first, second], episodes.stream_episodes).orderBy("timestamp").collect()
    assert [(x["event"], x["timestamp"].hour, x["hours"]) for x in found] == [("onset", 2, 1), ("end", 3, 1)]


def test_gaps_of_several_batches(spark):
    kept = [h for h in range(50) if h not in (4, 5, 6, 20, 47)]
    parts = [merged(spark, [(s, h, 1.0) for s in "AB" for h in kept if a <= h < b]) for a, b in ((0, 5), (5, 21), (21, 50))]
    found = streamed(spark, parts, episodes.stream_gaps).collect()
    got = sorted((x["location"], (x["timestamp"] - T0) // dt.timedelta(hours=1)) for x in found)
    assert got == [(s, h) for s in "AB" for h in (4, 5, 6, 20)]  # the 47th hour is not passed


# --- drift of windows --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def month(spark):
    r = np.random.default_rng(3)
    rows = [(T0 + dt.timedelta(hours=int(h)), float(r.normal(50 + d / 3, 5)), float(r.integers(0, 3)) if d % 4 else None)
            for d in range(20) for h in range(24 * d, 24 * d + 24)]
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, a double, b double")


def window(month, first, last):
    day = F.to_date("timestamp")
    return month.filter(day.between(F.lit(first), F.lit(last)))


def test_window_drift_bounds_and_index(spark, month):
    d = [T0.date() + dt.timedelta(days=i) for i in range(30)]
    asked = [("early", d[0], d[5], d[6], d[9]), ("over", d[0], d[12], d[5], d[19]), ("same", d[2], d[8], d[2], d[8]), ("none", d[0], d[5], d[25], d[29])]
    running = window_drift.running_histograms(month, ["a", "b"])
    found = {(r["name"], r["feature"]): r for r in window_drift.window_drift(running, spark.createDataFrame(asked, window_drift.WINDOWS)).collect()}
    assert set(found) == {(n, f) for n in ("early", "over", "same") for f in "ab"}
    for name, *days in asked[:3]:
        ref, cur = window(month, *days[:2]), window(month, *days[2:])
        exact = {r["feature"]: r for r in drift.kolmogorov_smirnov(ref, cur, ["a", "b"]).collect()}
        index = {r["feature"]: r["psi"] for r in drift.population_stability(ref, cur, ["a", "b"]).collect()}
        for f in "ab":
            row = found[name, f]
            assert (row["n_ref"], row["n_cur"]) == (exact[f]["n_ref"], exact[f]["n_cur"])
            assert row["ks_low"] - 1e-9 <= exact[f]["ks"] <= row["ks_high"] + 1e-9
            assert row["ks_high"] - row["ks_low"] < 0.1 or f == "b"
        assert found[name, "a"]["psi"] == pytest.approx(index["a"], abs=0.15 + 0.3 * index["a"])
    assert found["same", "a"]["psi"] == 0 and found["same", "a"]["ks_low"] == 0


def test_alerts_of_the_distance(spark):
    rows = spark.createDataFrame([("a", 100, 100, 0.5), ("b", 100, 100, 0.2), ("c", 100, 100, 0.1)], "feature string, n_ref long, n_cur long, ks double")
    got = {r["feature"]: (r["severity"], round(r["critical"], 3)) for r in drift.ks_alerts(rows).collect()}
    assert got == {"a": ("high", 0.192), "b": ("medium", 0.192)}


# --- correlations between sites ----------------------------------------------------------------


@pytest.mark.parametrize("block", [64, 3, 1])
def test_correlations_of_all_pairs(spark, block):
    r = np.random.default_rng(9)
    rows = [(f"s{i}", T0 + dt.timedelta(hours=h), float(x) if r.random() < 0.9 else None, 1000 + float(y), 5.0)
            for i in range(8) for h, (x, y) in enumerate(r.normal(size=(60, 2))) if r.random() < 0.8]
    table = spark.createDataFrame(rows, "location string, timestamp timestamp_ntz, x double, y double, flat double")
    found = similarity.site_correlations(table, ["x", "y", "flat"], block).collect()
    got = {(q["measure"], q["a"], q["b"]): (q["n"], q["corr"]) for q in found}
    assert len(got) == len(found) == 3 * 28
    pdf = table.toPandas()
    for measure in ("x", "y", "flat"):
        wide = pdf.pivot(index="timestamp", columns="location", values=measure)
        for a, b in ((a, b) for a in wide for b in wide if a < b):
            both = wide[[a, b]].dropna()
            n, corr = got[measure, a, b]
            assert n == len(both)
            assert corr is None if measure == "flat" else corr == pytest.approx(both[a].corr(both[b]), abs=1e-9)


def test_correlations_of_nothing(spark):
    none = spark.createDataFrame([], "location string, timestamp timestamp_ntz, x double")
    assert similarity.site_correlations(none, ["x"]).count() == 0
    one = spark.createDataFrame([("A", T0, 1.0), (None, T0, 2.0)], none.schema)
    assert similarity.site_correlations(one, ["x"]).count() == 0
