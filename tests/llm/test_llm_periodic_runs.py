"""Periodic runs against plain Python, and the transform against direct sums."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import brute
from vitalgrid.llm import periodic_runs, queries


def plain_runs(words, least=12):
    """(start, length, period) of all runs, by comparing every pair of words at every distance."""
    found = {}
    n = len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in found.items())


def plain_row(doc_id, text):
    w = brute.words(text)
    h = zlib.crc32(str("" if doc_id is None else doc_id).encode())
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    drop = {i for a, length, q in runs for i in range(a + q, a + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    lines = "".join(f"{a},{length},{q}\n" for a, length, q in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in drop)
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


def array_runs(texts, least=12):
    """Runs of several word lists at once, as the tasks find them."""
    numbers = {}
    ids = np.array([numbers.setdefault((t, w), len(numbers)) for t, ws in enumerate(texts) for w in ws], np.int64)
    lengths = np.array([len(ws) for ws in texts for _ in ws], np.int64)
    start, end, period = periodic_runs.find_runs(ids, lengths, least)
    edges = np.cumsum([0, *map(len, texts)])
    return [
        [(int(s - a), int(e - s), int(q)) for s, e, q in zip(start, end, period) if a <= s < b]
        for a, b in zip(edges, edges[1:])
    ]


@pytest.mark.parametrize("size, places", [(1, 1), (4, 9), (16, 32), (64, 128)])
def test_squared_differences(size, places):
    r = np.random.default_rng(size)
    blocks = r.integers(0, periodic_runs.PRIME, (5, size)).astype(np.uint64)
    windows = r.integers(0, periodic_runs.PRIME, (5, size + places - 1)).astype(np.uint64)
    windows[2, places - 1 : places - 1 + size] = blocks[2]
    found = periodic_runs.squared_differences(blocks, windows)
    for i in range(5):
        for e in range(places):
            want = sum((int(a) - int(b)) ** 2 for a, b in zip(blocks[i], windows[i, e : e + size]))
            assert int(found[i, e]) == want % periodic_runs.PRIME
    assert found[2, places - 1] == 0


def test_transform_round_trip():
    x = np.random.default_rng(1).integers(0, periodic_runs.PRIME, (3, 256)).astype(np.uint64)
    assert (periodic_runs.restored(periodic_runs.transformed(x)) == x).all()


@pytest.mark.parametrize("least", [2, 5, 12, 40, 100])
def test_runs_of_random_words(least):
    r = random.Random(least)
    texts = []
    for k in range(60):
        piece = [r.choice("ab" if k % 2 else "abcdefgh") for _ in range(r.randint(1, 90))]
        words = [r.choice("ab") for _ in range(r.randint(0, 30))] + piece * r.randint(1, 6)
        words += piece[: r.randint(0, len(piece))] + [r.choice("abc") for _ in range(r.randint(0, 30))]
        if words and k % 5 == 0:
            words[r.randrange(len(words))] = "x"
        texts.append(words)
    assert array_runs(texts, least) == [plain_runs(t, least) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=80), max_size=4))
def test_runs_of_two_words(texts):
    assert array_runs(texts) == [plain_runs(t) for t in texts]


def test_long_periods_and_one_word():
    r = random.Random(7)
    piece = [str(r.randrange(10**6)) for _ in range(1500)]
    assert array_runs([piece * 3 + piece[:700], ["a"] * 5000]) == [[(0, 5200, 1500)], [(0, 5000, 1)]]
    nested = (["a"] * 40 + ["b"]) * 30
    assert array_runs([nested]) == [plain_runs(nested)]


def test_words_that_come_again_without_a_run():
    """Every word of some blocks is found at a distance of their scale, the block itself is not."""
    words = [*range(80), *range(79, -1, -1), *range(200, 300)]
    assert array_runs([words]) == [plain_runs(words)]


def test_chance_zeros_do_not_count(monkeypatch):
    """With wrong zeros among the sums the runs are the same."""
    true = periodic_runs.squared_differences

    def noisy(blocks, windows):
        sums = true(blocks, windows)
        sums[:, ::3] = 0
        return sums

    monkeypatch.setattr(periodic_runs, "squared_differences", noisy)
    r = random.Random(3)
    piece = [r.choice("abcd") for _ in range(150)]
    words = piece * 3 + [r.choice("abcd") for _ in range(200)] + piece * 2
    assert array_runs([words]) == [plain_runs(words)]


def test_operator_equals_plain_python(spark, odd_docs):
    found = {}
    for row in periodic_runs.periodic_runs(odd_docs).collect():
        found.setdefault((row["doc_id"], row["n_words"]), set()).add((tuple(map(tuple, row["runs"])), row["kept"]))
    for row in odd_docs.collect():
        words = brute.words(row["text"])
        if len(words) > 3000:
            continue
        runs = plain_runs(words)
        drop = {i for a, length, q in runs for i in range(a + q, a + length)}
        kept = " ".join(w for i, w in enumerate(words) if i not in drop)
        assert (tuple(runs), kept) in found[row["doc_id"], len(words)]
    assert periodic_runs.periodic_runs(odd_docs).count() == odd_docs.count()


def test_operator_on_an_empty_table(no_docs):
    assert periodic_runs.periodic_runs(no_docs).count() == 0


def test_query_equals_plain_python(spark, smoke_dir):
    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet").collect()
    found = queries.QUERIES["op12_periodic_runs"](spark, smoke_dir)
    kept = [r for r in docs if len(brute.words(r["text"])) < 2500]
    assert len(kept) > 100
    rows = {r["doc_id"]: tuple(r) for r in found.collect()}
    assert len(rows) == len(docs)
    assert [rows[r["doc_id"]] for r in kept] == [plain_row(r["doc_id"], r["text"]) for r in kept]
