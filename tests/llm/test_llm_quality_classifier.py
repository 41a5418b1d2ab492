"""Quality classifier: statistics, sums and calibration against plain Python, and held-out accuracy."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import SCHEMA, prose
from vitalgrid.llm import quality_classifier as qc
from vitalgrid.llm import queries

LABELS = "doc_id long, quality int, toxic int, text string"


def plain_statistics(text):
    """Some of the statistics, by other means."""
    text = text or ""
    w = brute.words(text)
    counts = Counter(w)
    n, chars = max(len(w), 1), max(len(text), 1)
    letters = sum(c.isalpha() for c in text)
    mean = sum(map(len, w)) / n
    twos = Counter(zip(w, w[1:]))
    return {
        "log_words": math.log2(1 + len(w)),
        "log_chars": math.log2(1 + len(text)),
        "upper": sum(c.isupper() for c in text) / max(letters, 1),
        "stops": sum(c in ".!?" for c in text) / n,
        "lines": text.count("\n") / n,
        "digits": sum(c.isdecimal() for c in text) / chars,
        "beyond_ascii": sum(ord(c) > 127 for c in text) / chars,
        "word_length": math.log2(1 + mean),
        "word_length_spread": math.log2(1 + math.sqrt(sum((len(x) - mean) ** 2 for x in w) / n)),
        "longest_word": math.log2(1 + max(map(len, w), default=0)),
        "short_words": sum(len(x) <= 3 for x in w) / n,
        "distinct_words": len(counts) / n,
        "top_word": max(counts.values(), default=0) / n,
        "entropy": -sum(c / n * math.log2(c / n) for c in counts.values()),
        "repeated_twos": sum(c for c in twos.values() if c > 1) / max(len(w) - 1, 1),
        "same_as_before": sum(a == b for a, b in zip(text, text[1:])) / chars,
    }


def labels_table(spark, rows):
    return spark.createDataFrame([(i, q, 0, "x") for i, q in rows], LABELS)


def document_table(spark, texts):
    return spark.createDataFrame([(i, t, "en", "a", 0, True, 7, "x") for i, t in texts], SCHEMA).repartition(6)


def fold(i):
    return zlib.crc32(str("" if i is None else i).encode()) % 5


@pytest.fixture(scope="module")
def learnable(spark):
    """Plain prose is good, prose with symbols or in capitals is not."""
    texts = []
    for i in range(300):
        text = prose(i, 20 + i % 50)
        texts.append((i, text if i % 3 else text.replace(" ", " ## ") if i % 2 else text.upper()))
    return document_table(spark, texts), labels_table(spark, [(i, int(i % 3 > 0)) for i in range(300)])


def test_statistics_equal_plain_ones(texts):
    values = qc.text_statistics(pa.array(list(texts.values())))
    for row, text in zip(values, texts.values()):
        for name, want in plain_statistics(text).items():
            assert row[qc.STATISTICS.index(name)] == pytest.approx(want * qc.GRID, abs=0.51), name
    assert not qc.text_statistics(pa.array([None, ""], pa.string())).any()


def test_sums_do_not_depend_on_the_partitions(spark, learnable):
    docs, labels = learnable
    rows = qc.labelled(qc.statistics(docs), labels)
    mean, spread = qc._standard(rows)
    x = np.array([r["x"] for r in rows.collect()])
    assert np.allclose(mean, x.mean(axis=0)) and np.allclose(spread, np.where(x.std(axis=0) > 0, x.std(axis=0), 1))
    one = qc.normal_equations(rows.coalesce(1), mean, spread)
    many = qc.normal_equations(rows.repartition(7, "doc_id"), mean, spread)
    assert set(one) == set(many) == {1, 2, 3, 4}
    assert all((one[f] == many[f]).all() for f in one)
    own = [r for r in rows.collect() if r["fold"] == 2]
    waves = qc.fourier(np.array([r["x"] for r in own]), mean, spread)
    assert (one[2][:, :-1] == waves.T @ waves).all()
    assert (one[2][:, -1] == waves.T @ [r["m"] for r in own]).all()


def test_ridge_solves_the_normal_equations():
    r = np.random.default_rng(0)
    waves = np.column_stack([np.rint(r.uniform(-1, 1, (900, qc.FEATURES)) * qc.GRID), np.full(900, qc.GRID)])
    y = r.integers(0, 2, 900)
    w = qc.ridge(np.column_stack([waves.T @ waves, waves.T @ y]).astype(np.int64)) * qc.GRID
    f = waves / qc.GRID
    gradient = f.T @ (f @ w - y) + qc.PENALTY * 900 * np.append(w[:-1], 0)
    assert np.abs(gradient).max() < 1e-6


def test_products_approximate_a_gaussian_kernel():
    r = np.random.default_rng(1)
    z = r.standard_normal((40, len(qc.STATISTICS)))
    waves = qc.fourier(z, np.zeros(z.shape[1]), np.ones(z.shape[1]))[:, :-1] / qc.GRID
    distance = ((z[:, None] - z) ** 2).sum(axis=2)
    kernel = np.exp(-distance / (2 * z.shape[1]))
    assert np.abs(2 / qc.FEATURES * waves @ waves.T - kernel).mean() < 0.06


def test_isotonic_fit():
    """Against the definition: the largest mean over starts before of the smallest mean over ends after."""
    r = np.random.default_rng(2)
    n = r.integers(1, 6, 60)
    m = r.binomial(n, np.linspace(0.1, 0.9, 60))
    value = np.arange(60.0)
    centre, share = qc.isotonic(value, n, m)
    want = [
        max(min(m[i : j + 1].sum() / n[i : j + 1].sum() for j in range(k, 60)) for i in range(k + 1)) for k in range(60)
    ]
    assert (np.diff(share) > 0).all()
    assert np.allclose(sorted(set(np.round(want, 12))), share)
    assert np.average(share, weights=[n[np.isclose(want, s)].sum() for s in share]) == pytest.approx(m.sum() / n.sum())


def test_scores_of_held_out_rows(spark, learnable):
    docs, labels = learnable
    found = {r["doc_id"]: r for r in qc.quality_scores(docs, labels).collect()}
    assert len(found) == 300
    for i, row in found.items():
        assert row["held_out"] == (fold(i) == 0) and row["predicted"] == int(row["score"] >= 0.3)
    held = [i for i in found if fold(i) == 0]
    assert len(held) > 40
    assert sum(found[i]["predicted"] == int(i % 3 > 0) for i in held) >= 0.95 * len(held)


def test_held_out_labels_and_other_columns_change_nothing(spark, learnable):
    docs, labels = learnable
    before = sorted(map(tuple, qc.quality_scores(docs, labels).collect()))
    flipped = labels.collect()
    flipped = labels_table(spark, [(r["doc_id"], 1 - r["quality"] if fold(r["doc_id"]) == 0 else r["quality"]) for r in flipped])
    other = docs.withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit("z")).repartition(3)
    assert sorted(map(tuple, qc.quality_scores(other, flipped).collect())) == before


def test_odd_rows(spark, odd_docs, learnable):
    odd = labels_table(spark, [(1, 1), (1, 0), (2, None), (None, 1), (3, 7), (31, 0), (32, 0), (5, 1), (999, 0)])
    found = qc.quality_scores(odd_docs, odd).collect()
    assert len(found) == odd_docs.count()
    assert all(0 <= r["score"] <= 1 for r in found)
    same = {}
    for r in odd_docs.join(qc.quality_scores(odd_docs, odd), "doc_id").select("text", "score").collect():
        same.setdefault(r["text"] or "", set()).add(r["score"])
    assert all(len(scores) == 1 for text, scores in same.items() if text == "")


@pytest.mark.parametrize("labels, want", [([], 0.5), ([(i, 1) for i in range(20)], 1.0), ([(i, 0) for i in range(20)], 0.0)])
def test_no_labels_or_one_kind(spark, docs, labels, want):
    assert {r["score"] for r in qc.quality_scores(docs, labels_table(spark, labels)).collect()} == {want}


def test_empty_table(spark, no_docs):
    assert qc.quality_scores(no_docs, labels_table(spark, [])).count() == 0


def test_query_on_held_out_rows(spark, smoke_dir):
    folder = smoke_dir.replace("sf0.001", "sf0.01")
    found = queries.QUERIES["op11_quality_classifier"](spark, folder)
    rows = found.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert len(rows) > 50
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    assert sum(a > b for a in good for b in bad) >= 0.97 * len(good) * len(bad)
