"""Language profiles against plain Python: counts, ranks, distances, predictions, ties; many languages."""

import random
import zlib
from collections import Counter

import pytest

from vitalgrid.llm import lang_profiles

LETTERS = {"aa": "abcdéghijklm", "bb": "cdefßpqrstuv", "cc": "xyzabcno"}


def plain_grams(text):
    """One to three letters, words padded with a blank, as strings."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    out = Counter()
    for w in words:
        out.update(w)
    line = " " + " ".join(words) + " "
    if words:
        out.update(line[i : i + 2] for i in range(len(line) - 1))
        # three characters count where the middle one is a letter
        out.update(line[i : i + 3] for i in range(len(line) - 2) if line[i + 1] != " ")
    return out


def code(gram):
    """The number of an n-gram: its place among equally frequent ones."""
    points = [0 if c == " " else ord(c) + 1 for c in gram]
    total = 0
    for p in points:
        total = (total << 21) | p
    return total + {1: 0, 2: 1 << 21, 3: 1 << 42}[len(gram)]


def profile(counts):
    return sorted(counts, key=lambda g: (-counts[g], code(g)))[: lang_profiles.PROFILE]


def plain_prediction(profiles, text):
    own = profile(plain_grams(text or ""))
    if not own or not profiles:
        return "und", 0.0
    found = {}
    for lang, ranks in profiles.items():
        place = {g: i for i, g in enumerate(ranks)}
        found[lang] = sum(abs(place[g] - i) if g in place else lang_profiles.PROFILE for i, g in enumerate(own))
    best = min(sorted(found), key=found.get)
    return best, 1 - found[best] / (lang_profiles.PROFILE * len(own))


def held_out(i):
    return zlib.crc32(str("" if i is None else i).encode()) % 4 == 2


def text_in(lang, seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice(LETTERS[lang]) for _ in range(r.randint(1, 6))) for _ in range(n))


def test_predictions_equal_plain_ones(spark):
    rows = [(i, text_in(lang, i, 5 + i % 40), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 30)]
    rows += [(500, None, "aa"), (501, "12 34", "bb"), (None, "abc cba", "cc"), (502, "qqq www", None), (503, "Äb! CD.ef", None)]
    counts = {}
    for i, text, lang in rows:
        if lang and text and not held_out(i):
            counts.setdefault(lang, Counter()).update(plain_grams(text))
    profiles = {lang: profile(c) for lang, c in counts.items() if c}
    assert min(map(len, counts.values())) > len(profiles["aa"]) == lang_profiles.PROFILE  # the lists are cut
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    found = {(r["doc_id"]): r for r in lang_profiles.identify(table).collect()}
    assert len(found) == len(rows)
    for i, text, _ in rows:
        lang, score = plain_prediction(profiles, text)
        assert (found[i]["lang_pred"], found[i]["held_out"]) == (lang, held_out(i))
        assert found[i]["score"] == pytest.approx(score, abs=1e-12)


def test_ties_go_to_the_first_name(spark):
    profiles = lang_profiles.learn(spark.createDataFrame([("zz", "abc"), ("mm", "abc"), ("aa", "xyz")], "lang string, text string"))
    docs = spark.createDataFrame([(1, False, "abc"), (2, False, "qqq")], "doc_id long, held_out boolean, text string")
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in lang_profiles.predict(docs, profiles).collect()}
    assert found == {1: ("mm", 1.0), 2: ("aa", 0.0)}


def test_lists_are_cut_before_they_meet(spark):
    rows = spark.createDataFrame([("aa", text_in("aa", 1, 500))], "lang string, text string")
    counted = rows.mapInArrow(lang_profiles._count_grams, "lang string, gram long, n long")
    plan = lang_profiles.ranked(counted)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_many_values_of_lang(spark, monkeypatch):
    rows = [(i, text_in("aa", i, 3), f"l{i:04}") for i in range(2000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = lang_profiles.identify(table).collect()
    assert len(found) == 2000
    assert all(r["lang_pred"] <= f"l{r['doc_id']:04}" for r in found if not r["held_out"] and r["score"] == 1)
    monkeypatch.setattr(lang_profiles, "MAX_LANGUAGES", 100)
    with pytest.raises(ValueError, match="values of lang"):
        lang_profiles.identify(table)


def test_held_out_accuracy(spark, smoke_dir):
    docs = spark.read.parquet(smoke_dir.replace("sf0.001", "sf0.01") + "/documents.parquet")
    rows = lang_profiles.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 200
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.98 * len(rows)
