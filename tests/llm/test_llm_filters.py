"""Quality rules, decontamination and mixing."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from vitalgrid.llm import decontaminate, mixing, quality


def test_base_counts(docs, texts):
    for row in quality.quality_report(docs).collect():
        want = brute.base_counts(texts[row["doc_id"]])
        assert {k: row[k] for k in want} == want
        assert not (row["base_failed"] and row["kept"])


def test_quality_keeps_clean_rows_and_columns(docs, texts):
    kept = quality.quality_filter(docs)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert ids >= set(range(20)) | {29, 33, 34}
    assert not ids & {24, 25, 26, 27, 28, 31, 32}


def test_quality_odd_rows(odd_docs, no_docs):
    assert quality.quality_report(odd_docs).count() == odd_docs.count()
    assert quality.quality_report(no_docs).count() == quality.quality_filter(no_docs).count() == 0


def test_buckets_are_close_and_ordered(spark):
    found = spark.range(0, 200_000, 7).select("id", quality.bucket(F.col("id")).alias("b")).collect()
    assert all(r["b"] <= r["id"] <= r["b"] * 1.04 for r in found)
    assert all(r["b"] == r["id"] for r in found if r["id"] < 64)


def test_limits_adapt_to_their_group(spark):
    """A source whose documents all have symbols keeps them; the same text elsewhere goes."""
    plain = "word " * 3 + " ".join(f"w{i}" for i in range(40))
    marked = " ".join(f"w{i} #" for i in range(40))
    rows = [(i, plain, "en", "news") for i in range(300)] + [(300, marked, "en", "news")]
    rows += [(1000 + i, marked, "en", "chat") for i in range(300)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_report(table).collect()}
    assert kept.pop(300) is False
    assert all(kept.values())


def odd_one(measure, i):
    """A text that stands out in one measure only, and passes the base rules."""
    lines = {
        "symbols_per_mille": [f"w{i}x{k} #" if k % 2 else f"w{i}x{k}" for k in range(40)],
        "dup_lines_per_mille": [x for k in range(20) for x in (f"a{i}b{k} c{k}d{i} e{i}f{k} g{k}h{i} i{i}j{k} k{k}l{i}", "yes")],
        "word_length_centi": ["x" * 9 + f"{i}-{k:03}" for k in range(40)],
    }
    return "\n".join(lines[measure]) if measure.startswith("dup") else " ".join(lines[measure])


@pytest.mark.parametrize("measure", sorted(quality.MEASURES))
def test_each_measure_rejects_by_itself(spark, measure):
    """Prose with words of differing lengths, and one text that only one measure finds odd."""
    rows = [(i, " ".join("abcdefgh"[: 3 + (i * k) % 5] + str(k) for k in range(60)), "en", "s") for i in range(200)]
    table = spark.createDataFrame([*rows, (999, odd_one(measure, 7), "en", "s")], "doc_id long, text string, lang string, source string")
    rows = quality.judged(quality._measured_rows(table)).collect()
    odd = next(r for r in rows if r["_doc_id"] == 999)
    value = {
        "symbols_per_mille": odd["n_symbols"] * 1000 // odd["n_words"],
        "dup_lines_per_mille": odd["n_dup_lines"] * 1000 // odd["n_lines"],
        "word_length_centi": odd["word_chars"] * 100 // odd["n_words"],
    }
    assert not odd["base_failed"] and not odd["kept"]
    assert [m for m, v in value.items() if v > odd[f"high_{m}"]] == [measure]
    assert all(r["kept"] for r in rows if r["_doc_id"] != 999)


def test_low_words_are_rejected(spark):
    rows = [(i, " ".join(f"word{k}x{i % 7}" for k in range(50)), "en", "s") for i in range(200)]
    table = spark.createDataFrame([*rows, (999, " ".join("abcdefghijkl"), "en", "s")], "doc_id long, text string, lang string, source string")
    found = quality.judged(quality._measured_rows(table)).collect()
    assert {r["_doc_id"] for r in found if not r["kept"]} == {999}
    assert all(r["low_word_length_centi"] > 0 for r in found)


def test_fences_differ_between_groups_and_have_no_size_switch(spark):
    """The fence of a group moves away from its language's as it grows, in small steps."""
    long_words = [(i, " ".join(f"verylongword{k}x{i % 5}" for k in range(30)), "en", "big") for i in range(400)]
    fences = []
    for n in (1, 50, 199, 200, 201, 800):
        short = [(1000 + i, " ".join(f"w{k}x{i % 5}" for k in range(30)), "en", "own") for i in range(n)]
        table = spark.createDataFrame(long_words + short, "doc_id long, text string, lang string, source string")
        found = quality.limits(quality._measured_rows(table)).collect()
        high = {r["_source_key"]: r["high_word_length_centi"] for r in found}
        assert high["=big"] != high["=own"]
        fences.append(high["=own"])
    assert fences[0] > 0.95 * high["=big"] / 2 and fences[0] > 1.3 * fences[1] > 1.3 * fences[2]
    assert max(fences[2:5]) - min(fences[2:5]) < 0.01 * fences[2]


@pytest.fixture(scope="module")
def benchmark(spark, texts):
    items = {
        1: " ".join(texts[8].split(" ")[10:40]),
        2: " ".join(texts[29].split(" ")[20000:20050]).upper(),
        3: "one two",
        4: " ".join([*texts[9].split(" ")[:25], "x", "y"]),
        5: "not there " * 9,
        6: None,
        7: " ",
        8: " ".join(texts[10].split(" ")[:12] + texts[11].split(" ")[:12]),
    }
    return items, spark.createDataFrame(list(items.items()), "item_id long, text string")


def test_contained_items(docs, texts, benchmark):
    items, table = benchmark
    found = decontaminate.contaminated(docs, table).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == brute.leaks(texts, items)
    assert all(100 * r["n_found"] >= 80 * r["n_item_shingles"] for r in found)


def test_decontaminated_rows(odd_docs, texts, benchmark):
    items, table = benchmark
    gone = {d for d, _ in brute.leaks(texts, items)}
    kept = decontaminate.decontaminated(odd_docs, table)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert set(ids) == set(texts) - gone | {None}
    assert ids.count(None) == 2 and ids.count(2) == 2


def test_decontamination_of_nothing(docs, no_docs, benchmark, spark):
    _, table = benchmark
    assert decontaminate.decontaminated(no_docs, table).count() == 0
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(docs, nothing).count() == 0
    assert decontaminate.decontaminated(docs, nothing).count() == docs.count()


def test_items_without_id(docs, texts, benchmark, spark):
    """An item without item_id is found as any other; several are told apart by their texts."""
    items, _ = benchmark
    table = spark.createDataFrame([(None, items[1]), (None, items[2]), (None, items[2]), (3, items[3])], "item_id long, text string")
    found = [(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, table).collect()]
    want = brute.leaks(texts, {i: items[i] for i in (1, 2, 3)})
    assert sorted(d for d, i in found if i is None) == sorted(d for d, i in want if i != 3)
    assert {d for d, i in found if i == 3} == {d for d, i in want if i == 3}
    kept = {r["doc_id"] for r in decontaminate.decontaminated(docs, table).collect()}
    assert kept == set(texts) - {d for d, _ in want}


def test_raked_weights_meet_targets(spark):
    cells = spark.createDataFrame(
        [("a", "x", "t", 100), ("a", "y", "t", 300), ("b", "x", "t", 500), ("b", "y", "u", 50), ("a", "x", "u", 70)],
        "source string, lang string, topic string, tokens long",
    )
    targets = {
        "source": spark.createDataFrame([("a", 0.4), ("b", 0.6)], "source string, target_source double"),
        "lang": spark.createDataFrame([("x", 0.7), ("y", 0.3)], "lang string, target_lang double"),
        "topic": spark.createDataFrame([("t", 0.9), ("u", 0.1)], "topic string, target_topic double"),
    }
    fitted = mixing.raked(cells, targets).toPandas()
    assert fitted["calibrated"].all()
    for d, want in (("source", {"a": 0.4, "b": 0.6}), ("lang", {"x": 0.7, "y": 0.3}), ("topic", {"t": 0.9, "u": 0.1})):
        assert fitted.groupby(d)["weight"].sum().to_dict() == pytest.approx(want, abs=1e-9)
    expected = mixing.budgeted(mixing.raked(cells, targets), 0.8).toPandas()
    assert (expected["expected"] * expected["tokens"]).sum() == pytest.approx(0.8 * 1020)


def test_contradicting_targets_say_so(spark):
    cells = spark.createDataFrame([("a", "x", "t", 1), ("b", "y", "t", 1)], "source string, lang string, topic string, tokens long")
    targets = {
        "source": spark.createDataFrame([("a", 0.9), ("b", 0.1)], "source string, target_source double"),
        "lang": spark.createDataFrame([("x", 0.5), ("y", 0.5)], "lang string, target_lang double"),
        "topic": spark.createDataFrame([("t", 1.0)], "topic string, target_topic double"),
    }
    assert not mixing.raked(cells, targets).toPandas()["calibrated"].any()


def test_mixture_rows(odd_docs, no_docs):
    found = mixing.mixture(odd_docs).collect()
    assert len(found) == odd_docs.count()
    assert all(r["copies"] == 0 for r in found if r["tokens"] == 0)
    assert all(int(r["expected"]) <= r["copies"] <= int(r["expected"]) + 1 for r in found)
    mixed = mixing.mixed_documents(odd_docs)
    assert mixed.columns == odd_docs.columns
    assert mixed.count() == sum(r["copies"] for r in found)
    assert mixing.mixture(no_docs).count() == mixing.mixed_documents(no_docs).count() == 0


def test_sample_has_the_target_shares(spark):
    rows = [(i, "some words of text here", "en" if i % 4 else "de", "big" if i % 10 else "small") for i in range(20_000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    sample = mixing.mixed_documents(table).toPandas()
    for column in ("lang", "source"):
        before = table.toPandas()[column].value_counts(normalize=True) ** mixing.TEMPER
        assert sample[column].value_counts(normalize=True).to_dict() == pytest.approx((before / before.sum()).to_dict(), abs=0.02)


def test_a_rare_cell_does_not_shrink_the_sample(spark, smoke_dir):
    """One document of a new source is repeated and leaves the rest as it was."""
    rows = [(i, "some words of text here", "en" if i % 4 else "de", "big" if i % 10 else "small") for i in range(20_000)]
    schema = "doc_id long, text string, lang string, source string"
    without = spark.createDataFrame(rows, schema)
    table = spark.createDataFrame([*rows, (20_000, "rare", "en", "new")], schema)
    sample = corpus_pipeline.target_weights(spark, table, smoke_dir)
    assert sample.columns == table.columns
    found = sample.toPandas()
    assert len(found) == pytest.approx(mixing.BUDGET * 20_001, rel=0.02)
    before = mixing.mixed_documents(without).count()
    assert (found["source"] != "new").sum() == pytest.approx(before, rel=0.01)
    assert (found["source"] == "new").sum() > 1
    weight = table.toPandas()["source"].value_counts(normalize=True) ** mixing.TEMPER
    shares = found["source"].value_counts(normalize=True)
    assert shares["small"] == pytest.approx((weight / weight.sum())["small"], abs=0.02)


def test_query_and_stage_draw_alike(spark, smoke_dir):
    rows = [(i if i % 7 else None, f"text number {i % 40}", "en" if i % 4 else "de", "ab"[i % 3 > 0]) for i in range(400)]
    table = spark.createDataFrame([*rows, (3, None, None, "a")], "doc_id long, text string, lang string, source string")
    copies = {}
    for r in mixing.mixture(table).collect():
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + r["copies"]
    stage = corpus_pipeline.target_weights(spark, table, smoke_dir).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in stage} == {i: n for i, n in copies.items() if n}
    assert 0 < copies[None] < 58


def test_topics_and_targets_of_the_caller(spark):
    rows = [(i, f"words about {'cats' if i % 5 else 'dogs'} here", "en", "s") for i in range(4_000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    one = {d: spark.createDataFrame([(v, 1.0)], f"{d} string, target_{d} double") for d, v in (("source", "=s"), ("lang", "=en"))}
    wanted = one | {"topic": spark.createDataFrame([("cats", 0.5), ("dogs", 0.5)], "topic string, target_topic double")}
    animal = lambda text: F.when(F.contains(text, F.lit("cats")), "cats").otherwise("dogs")
    found = mixing.mixture(table, wanted, budget=1.0, topic=animal).groupBy("topic").agg(F.sum("copies").alias("n")).collect()
    assert {r["topic"]: r["n"] for r in found} == pytest.approx({"cats": 2000, "dogs": 2000}, rel=0.05)


def test_rows_without_id_are_drawn_apart(spark):
    """Texts without doc_id are sampled as any others: neither all nor none of a cell."""
    rows = [(None, f"words of text {i}", "en", "big" if i % 20 else "small") for i in range(5_000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["source"]: r["count"] for r in mixing.mixed_documents(table).groupBy("source").count().collect()}
    weight = {"big": 0.95**mixing.TEMPER, "small": 0.05**mixing.TEMPER}
    for source, n in (("big", 4_750), ("small", 250)):
        want = mixing.BUDGET * 5_000 * weight[source] / sum(weight.values())
        assert kept[source] == pytest.approx(want, rel=0.1) and 0 < kept[source] < n


def test_uniform_equals_sql(spark):
    ours = [r[0] for r in spark.range(50).select(mixing.uniform(F.col("id"))).collect()]
    theirs = duckdb.sql("SELECT ('0x' || substr(md5(i::VARCHAR), 1, 13))::BIGINT / pow(2, 52) FROM range(50) t(i)").fetchall()
    assert ours == [r[0] for r in theirs]
