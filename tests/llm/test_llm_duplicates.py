"""Jaccard join, components and substring dedup."""

import hashlib
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import brute
from vitalgrid.llm import arrays, components, signature_join, substring_dedup


@given(st.lists(st.text(alphabet="aB \n\t\x0bé\u00a0", max_size=30) | st.none(), max_size=8))
def test_word_hashes_tell_words_apart(texts):
    found = dict(arrays.hashed_words(pa.array(texts, pa.string()), lower=False))
    names = {}
    for i, text in enumerate(texts):
        words = brute.words(text)
        assert len(found[i]) == len(words)
        for w, h in zip(words, found[i].tolist()):
            assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)


def test_components_of_chains_and_stars(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(3, 3)]
    edges += [(r.randint(300, 400), r.randint(300, 400)) for _ in range(70)]
    r.shuffle(edges)
    found = {x["id"]: x["component"] for x in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {v: v for a, b in edges if a != b for v in (a, b)}

    def root(v):
        while want[v] != v:
            v = want[v]
        return v

    for a, b in edges:
        if a == b:
            continue
        x, y = sorted((root(a), root(b)))
        want[y] = x
    assert found == {v: root(v) for v in want}


def test_components_equal_brute_force(docs, texts):
    want = brute.components(texts)
    for row in signature_join.jaccard_components(docs).collect():
        assert row["component_id"] == want[row["doc_id"]]
        assert row["n_shingles"] == len(brute.shingles(texts[row["doc_id"]]))


def variants(seed, families, size):
    """Families of near copies around the threshold, some of which share a frequent passage."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = r.choices(vocabulary, k=30)
    out = {}
    for f in range(families):
        base = r.choices(vocabulary, k=r.randint(40, 90)) + (passage if f % 2 else [])
        for _ in range(size):
            words = list(base)
            for _ in range(r.randint(0, 4)):
                words[r.randrange(len(words))] = r.choice(vocabulary)
            out[len(out)] = " ".join(words)
    return out


@pytest.mark.parametrize("members, frequent", [(2048, 50), (8, 5)])
def test_families_equal_brute_force(spark, monkeypatch, members, frequent):
    """Small limits send blocks through several tasks and order many shingles as frequent."""
    monkeypatch.setattr(signature_join, "MEMBERS", members)
    monkeypatch.setattr(signature_join, "FREQUENT", frequent)
    monkeypatch.setattr(signature_join, "SHINGLES", members * 50)
    texts = variants(5, 12, 9)
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in signature_join.jaccard_components(table).collect()}
    assert found == brute.components(texts)


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10_000))
def test_trees_lose_no_pair(seed):
    """Every linked pair of different clusters is among the pairs that the traversal leaves."""
    r = np.random.default_rng(seed)
    sets = []
    for _ in range(int(r.integers(2, 40))):
        if sets and r.random() < 0.6:
            near = sets[int(r.integers(len(sets)))]
            sets.append(np.unique(np.concatenate([near[r.random(len(near)) < 0.95], r.integers(0, 2**63, 2).astype(np.uint64)])))
        else:
            sets.append(np.unique(r.integers(0, 2**63, int(r.integers(20, 60))).astype(np.uint64)))
    clusters = r.integers(0, max(1, len(sets) // 2), len(sets))
    bits = np.stack([np.frombuffer(signature_join._bitmap(s, 512), np.uint64) for s in sets])
    found = list(signature_join.tree_pairs(np.array([len(s) for s in sets]), clusters, bits))
    left = {frozenset(p) for x, y in found for p in zip(x.tolist(), y.tolist())}
    for a, b in itertools.combinations(range(len(sets)), 2):
        if clusters[a] != clusters[b] and signature_join.linked(arrays.common(sets[a], sets[b]), len(sets[a]), len(sets[b])):
            assert frozenset((a, b)) in left


def test_traversal_prunes():
    r = np.random.default_rng(0)
    sets = [np.unique(r.integers(0, 2**63, 60).astype(np.uint64)) for _ in range(300)]
    bits = np.stack([np.frombuffer(signature_join._bitmap(s, 512), np.uint64) for s in sets])
    assert sum(len(x) for x, _ in signature_join.tree_pairs(np.array([len(s) for s in sets]), np.arange(300), bits)) < 10


def joined_clusters(clusters, pairs):
    """Smallest cluster reachable of every cluster."""
    found = {c: c for c in clusters}
    for a, b in pairs:
        low, high = sorted((found[clusters[a]], found[clusters[b]]))
        found = {c: low if v == high else v for c, v in found.items()}
    return found


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10_000))
def test_joining_links_join_all_and_no_more(seed):
    r = np.random.default_rng(seed)
    sets = []
    for _ in range(int(r.integers(2, 40))):
        near = sets[int(r.integers(len(sets)))] if sets and r.random() < 0.8 else r.integers(0, 2**63, 50).astype(np.uint64)
        sets.append(np.unique(np.concatenate([near[r.random(len(near)) < 0.96], r.integers(0, 2**63, 3).astype(np.uint64)])))
    clusters = r.integers(0, len(sets), len(sets)) * 10
    true = [
        (a, b) for a, b in itertools.combinations(range(len(sets)), 2)
        if signature_join.linked(arrays.common(sets[a], sets[b]), len(sets[a]), len(sets[b]))
    ]
    left, right = signature_join.joining_links(clusters, sets)
    assert {frozenset(p) for p in zip(left, right)} <= {frozenset(p) for p in true}
    assert len(left) < len(set(clusters.tolist()))
    assert joined_clusters(clusters.tolist(), zip(left, right)) == joined_clusters(clusters.tolist(), true)


def test_large_groups_make_as_many_rows_as_members(spark, monkeypatch):
    """Near copies without a common leader, and unlinked documents, under one passage: rows grow with the members."""
    r = random.Random(8)
    passage = [f"p{i}" for i in range(8)]
    texts, chain = {}, [f"c{i}" for i in range(70)]
    for i in range(60):  # each is linked with the next ones, the first and the last are not
        chain[r.randrange(70)] = f"x{i}"
        texts[i] = " ".join(passage + chain)
        texts[1000 + i] = " ".join(passage + [f"u{i}-{k}" for k in range(70)])
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    members = spark.createDataFrame([(7, i, i) for i in texts], "block long, doc long, component long")
    assert signature_join.tree_groups(table, members).count() <= 2 * len(texts)
    links = [tuple(x) for x in signature_join.tree_links(table, members).collect()]
    assert len(links) < len(texts)
    sets = {i: brute.shingles(t) for i, t in texts.items()}
    assert all(100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) for a, b in links)
    ids = sorted(texts)
    found = joined_clusters(ids, [(ids.index(a), ids.index(b)) for a, b in links])
    assert found == brute.components(texts)
    monkeypatch.setattr(signature_join, "SHINGLES", 500)  # through several tasks
    cut = [(ids.index(x["a"]), ids.index(x["b"])) for x in signature_join.tree_links(table, members).collect()]
    assert joined_clusters(ids, cut) == found


def test_one_per_component(docs, odd_docs, no_docs, texts):
    want = brute.components(texts)
    heads = sorted(i for i in want if want[i] == i)
    kept = signature_join.one_per_component(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == heads
    # a doc_id on two rows is one document; rows without one stay
    ids = [r["doc_id"] for r in signature_join.one_per_component(odd_docs).collect()]
    assert ids.count(None) == 2 and ids.count(2) == 1
    assert 7 not in ids  # 5 has the text of 7 as well
    assert signature_join.one_per_component(no_docs).count() == 0


def test_texts_that_share_an_id(spark, texts):
    """Unlike texts of one doc_id stay, a text goes only when it is linked itself, and the rows that stay are the same each time."""
    rows = [(1, texts[1], "a"), (5, texts[5], "a"), (5, texts[1], "a"), (5, texts[6], "a"), (5, texts[6], "b"), (9, texts[6], "a"),
            (7, texts[3], "a"), (7, texts[21], "a"), (7, None, "a"), (None, texts[5], "a")]
    kept = []
    for n in (1, 3):
        table = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(n)
        kept.append(sorted(map(tuple, signature_join.one_per_component(table).collect()), key=str))
    assert kept[0] == kept[1]
    found = [(i, t) for i, t, _ in kept[0]]
    assert len(found) == 6 and {(1, texts[1]), (5, texts[5]), (5, texts[6]), (7, None), (None, texts[5])} <= set(found)
    assert ((7, texts[3]) in found) != ((7, texts[21]) in found)


def digest(df):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest()) for r in df.collect()}


def test_repeats_equal_brute_force(docs, texts):
    assert digest(substring_dedup.without_repeats(docs)) == brute.without_repeats(texts)


@pytest.mark.parametrize("spans", [4096, 2])
def test_repeats_of_families(spark, monkeypatch, spans):
    """A small limit broadcasts shards to several tasks."""
    monkeypatch.setattr(substring_dedup, "SPANS_PER_TASK", spans)
    texts = variants(8, 8, 8)
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert digest(substring_dedup.without_repeats(table)) == brute.without_repeats(texts)


def test_repeats_of_odd_rows(odd_docs, no_docs, texts):
    found = substring_dedup.without_repeats(odd_docs).collect()
    assert len(found) == odd_docs.count()
    assert all(r["n_removed"] == 0 for r in found if r["doc_id"] is None)
    # the text of 7 now also stands at 5, which has a smaller id
    assert [r["n_removed"] for r in found if r["doc_id"] == 7] == [len(brute.words(texts[7]))]
    assert substring_dedup.without_repeats(no_docs).count() == 0


@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=30), st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=12), max_size=4))
def test_matching_statistics(words, spans):
    automaton = substring_dedup.SuffixAutomaton()
    for span in spans:
        automaton.add_span(span)
    inside = {tuple(s[i:j]) for s in spans for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    for k, n in enumerate(automaton.matches(words)):
        assert n == max([0, *(m for m in range(1, k + 2) if tuple(words[k + 1 - m : k + 1]) in inside)])
