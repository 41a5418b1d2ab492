"""Quality rules whose limits come from the data: quantile sketches per language and source.

A sketch is a histogram with buckets that are exact below 64 and then keep the top six bits
(at most 3 % wide). Two sketches merge by adding counts, in any order and with the same result,
so counts combine map-side, a hot source adds only bucket rows, and a lost executor changes
nothing. The sketch of a language is the sum of those of its sources; the sketch of all
documents is the sum of those of the languages.

Thresholds are quantiles read from these sketches. A group's quantile is the mean of its own and its
language's, weighted by its number of documents and by `PRIOR`; a language's is blended with that of
all documents in the same way. So every group is judged by its own documents as far as it has them,
and there is no size at which the judgement changes.

A document is rejected when the bucket of a measure lies outside the fences of its group: an outer
quantile (`MEASURES`), moved outwards by `FENCE` times its distance from the median. Values that tie
with the quantile stay, so a measure that is nearly always 0 rejects what is above 0, and one
that varies leaves room in proportion.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.attach import attach
from ..session import written
from .text import packed, text_key, unpacked, words

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
FENCE = 5
# documents that a language, or all documents, count for in the quantiles of a group
PRIOR = 50
SYMBOL = r"[#*$%&|<>]"
MEDIAN = 50
# measure -> percents of the outer quantiles, lower (None: low values are fine) and upper; per 1,000
# words or lines, word length in hundredths of a code point. Prose repeats a line now and then,
# so that quantile lies further out.
MEASURES = {
    "symbols_per_mille": (None, 85),
    "dup_lines_per_mille": (None, 99),
    "word_length_centi": (15, 85),
}


def measured(df: DataFrame) -> DataFrame:
    """Add the counts of the base rules to rows that have `_text`.

    Names added: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed.
    NULL text has no words. Windows are compared by 64-bit hashes within one document.
    """
    # each array is a column of its own: several expressions read it and it is made once
    split = df.withColumns({
        "_words": words(F.col("_text")),
        "_lines": F.filter(
            F.coalesce(F.split("_text", "\n"), F.array().cast("array<string>")),
            lambda line: line.rlike(r"[^\x20\x09-\x0D]"),
        ),
    })
    hashed = split.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.concat_ws("", "_words")).cast("long"),
        "n_symbols": (
            F.length("_text") - F.length(F.regexp_replace("_text", SYMBOL, ""))
        ).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
    }).drop("_words", "_lines")
    windows = hashed.withColumn("_windows", F.transform(
        F.slice("_hashes", F.lit(1), F.greatest(F.size("_hashes") - F.lit(WINDOW - 1), F.lit(0))),
        lambda h, i: F.xxhash64(h, *[F.get(F.col("_hashes"), i + F.lit(k)) for k in range(1, WINDOW)]),
    )).drop("_hashes")
    # only documents with a repeated window sort their windows
    sorted_windows = windows.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )).drop("_windows")

    def again(e, k):
        before, after = (F.get(F.col("_sorted"), k + F.lit(d)).getField("h") for d in (-1, 1))
        return F.coalesce(e.getField("h") == before, F.lit(False)) | F.coalesce(e.getField("h") == after, F.lit(False))

    starts = sorted_windows.withColumn("_starts", F.sort_array(
        F.transform(F.filter("_sorted", again), lambda e: e.getField("i"))
    )).drop("_sorted")

    def new_words(start, k):
        gap = F.get(F.col("_starts"), k + F.lit(1)) - start
        return F.least(F.coalesce(gap, F.lit(WINDOW)), F.lit(WINDOW))

    covered = F.aggregate(F.transform("_starts", new_words), F.lit(0).cast("long"), lambda a, n: a + n)
    counted = starts.withColumns({
        "n_repeat_words": F.coalesce(covered, F.lit(0).cast("long")),
        "n_symbols": F.coalesce("n_symbols", F.lit(0).cast("long")),
    }).drop("_starts")
    return counted.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )


def _share(part: str, whole: str, unit: int) -> Column:
    return F.expr(f"{part} * {unit} div greatest({whole}, 1)")


def _measures() -> dict[str, Column]:
    return {
        "symbols_per_mille": _share("n_symbols", "n_words", 1000),
        "dup_lines_per_mille": _share("n_dup_lines", "n_lines", 1000),
        "word_length_centi": _share("word_chars", "n_words", 100),
    }


def bucket(value: Column) -> Column:
    """Lower end of a number's bucket: itself below 64, else its top six bits."""
    bits = F.greatest(F.length(F.bin(value)) - F.lit(6), F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, bits), bits)


def sketches(rows: DataFrame) -> DataFrame:
    """One row per _lang_key, _source_key, measure and bucket with the number of documents in it."""
    named = F.array(*[
        F.struct(F.lit(name).alias("measure"), bucket(value).alias("bucket")) for name, value in _measures().items()
    ])
    return (
        rows.filter(~F.col("base_failed"))
        .select("_lang_key", "_source_key", F.inline(named))
        .groupBy("_lang_key", "_source_key", "measure", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _quantiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Merge sketches to one per group of `by` and read it: by, documents, and <measure>_<percent>."""
    merged = sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "measure")
    ranked = merged.withColumns({
        "upto": F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)),
        "total": F.sum("n").over(group),
    })
    columns = [F.max("total").alias("documents")]
    for name, percents in MEASURES.items():
        for p in (*percents, MEDIAN):
            if p is not None:
                there = (F.col("measure") == name) & (100 * F.col("upto") >= p * F.col("total"))
                columns.append(F.min(F.when(there, F.col("bucket"))).alias(f"{name}_{p}"))
    return ranked.groupBy(*by).agg(*columns)


def limits(rows: DataFrame) -> DataFrame:
    """low_ and high_ fences for every _lang_key and _source_key that has a document which passes the base rules."""
    sketch = written(sketches(rows), "quality-sketch")
    own = _quantiles(sketch, ["_lang_key", "_source_key"])
    of_lang = _quantiles(sketch, ["_lang_key"])
    of_all = _quantiles(sketch.withColumn("_all", F.lit(0)), ["_all"])
    names = [c for c in own.columns if c not in ("_lang_key", "_source_key")]
    joined = own.join(of_lang.select("_lang_key", *[F.col(c).alias(f"lang_{c}") for c in names]), "_lang_key")
    joined = joined.withColumn("all", of_all.select(F.struct(*names)).scalar())

    def blended(name, p):
        quantile = f"{name}_{p}"
        return F.expr(
            f"(documents * {quantile} + {PRIOR} * ((lang_documents * lang_{quantile} + {PRIOR} * all.{quantile})"
            f" div (lang_documents + {PRIOR}))) div (documents + {PRIOR})"
        )

    fences = []
    for name, (low, high) in MEASURES.items():
        middle, upper = blended(name, MEDIAN), blended(name, high)
        fences.append((upper + FENCE * (upper - middle)).alias(f"high_{name}"))
        lower = F.lit(None).cast("long") if low is None else blended(name, low)
        fences.append(F.coalesce(lower - FENCE * (middle - lower), F.lit(0).cast("long")).alias(f"low_{name}"))
    return joined.select("_lang_key", "_source_key", *fences)


def _measured_rows(docs: DataFrame) -> DataFrame:
    rows = packed(docs, "doc_id", "text", "lang", "source")
    keyed = rows.withColumns({"_lang_key": text_key(F.col("_lang")), "_source_key": text_key(F.col("_source"))})
    return measured(keyed).drop("_text", "_lang", "_source")


def judged(rows: DataFrame) -> DataFrame:
    """Add `kept` to measured rows: passes the base rules and lies inside the fences of its group."""
    fenced = attach(rows, limits(rows), ["_lang_key", "_source_key"])
    inside = F.lit(True)
    for name, value in _measures().items():
        inside = inside & bucket(value).between(F.col(f"low_{name}"), F.col(f"high_{name}"))
    return fenced.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False)))


def quality_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    One row per input row, repeated rows included. NULL or blank text has no words and fails the
    base rules; NULL lang or source is a group of its own. An empty table gives an empty result.
    """
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = written(_measured_rows(docs).drop("_row"), "quality")
    return judged(rows).select(F.col("_doc_id").alias("doc_id"), *counts, "kept")


def quality_filter(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that `quality_report` keeps, with the columns of `docs`."""
    rows = written(_measured_rows(docs), "quality")
    return unpacked(judged(rows).filter("kept"), docs.columns)
