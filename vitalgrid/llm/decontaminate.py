"""Benchmark decontamination: short test items inside long documents.

An item is contained in a document when at least `PERCENT` percent of its distinct 5-word shingles
(A-Z lower-cased) occur there; an item of fewer words is one shingle of its own length.

The search compares MinHash sketches of the items, not whole sets. Items are partitioned by size
(powers of two); a partition whose items have at most u shingles keeps of each item the
u * (100 - PERCENT) / 100 + `SPARE` smallest hashes. A document that contains the item misses at most
(100 - PERCENT) percent of its shingles, so it holds all but that many of the sketch: the
threshold on sketch hits loses no contained item, however long the document is. Candidates are
then verified on the words themselves.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.attach import attach
from ..session import written
from .signature_join import _by_id
from .text import ascii_lower, packed, unpacked, words

PERCENT = 80
SHINGLE = 5
SPARE = 4
# machine words that a shingle's text takes, for the size of a broadcast
WORDS_OF_SHINGLE = 6


def _windows(array: str, width: int, join) -> Column:
    """`join` of every `width` consecutive elements of an array column."""
    some = F.slice(F.col(array), F.lit(1), F.greatest(F.size(array) - F.lit(width - 1), F.lit(0)))
    return F.transform(
        some, lambda x, i: join(x, *[F.get(F.col(array), i + F.lit(k)) for k in range(1, width)])
    )


def items(benchmark: DataFrame) -> DataFrame:
    """_item, item_id, width, shingles (distinct texts), n and the sketch (distinct hashes); items without words go.

    `_item` is a key that also tells texts without item_id apart.
    """
    text_hash = F.md5(F.col("text").cast("string").cast("binary"))
    key = F.coalesce(F.concat(F.lit("="), F.col("item_id").cast("string")), F.concat(F.lit("text "), text_hash))
    split = benchmark.select(key.alias("_item"), "item_id", words(ascii_lower(F.col("text").cast("string"))).alias("_words"))
    split = split.filter(F.size("_words") > 0).withColumns({
        "width": F.least(F.size("_words"), F.lit(SHINGLE)),
        "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
    })

    def of_width(array, join):
        found = _windows(array, SHINGLE, join)
        for width in range(1, SHINGLE):
            found = F.when(F.col("width") == width, _windows(array, width, join)).otherwise(found)
        return F.array_distinct(found)

    shingled = split.select(
        "_item", "item_id", "width",
        of_width("_words", lambda *w: F.concat_ws(" ", *w)).alias("shingles"),
        of_width("_hashes", lambda *h: F.xxhash64(*h)).alias("_set"),
    ).withColumn("n", F.size("shingles"))
    upper = F.pow(F.lit(2), F.ceil(F.log2(F.col("n")))).cast("int")
    kept = F.floor(upper * (100 - PERCENT) / 100).cast("int") + SPARE
    sketched = shingled.withColumn("sketch", F.slice(F.sort_array("_set"), F.lit(1), kept))
    missing = F.floor(F.col("n") * (100 - PERCENT) / 100).cast("int")
    return sketched.select(
        "_item", "item_id", "width", "shingles", "n", "sketch", F.greatest(F.size("sketch") - missing, F.lit(1)).alias("least_hits")
    )


def _text_rows(docs: DataFrame) -> DataFrame:
    """Packed rows with a key that also tells texts without doc_id apart."""
    rows = packed(docs, "doc_id", "text")
    return rows.withColumn(
        "_key", F.coalesce(F.col("_doc_id").cast("string"), F.concat(F.lit("text "), F.md5(F.col("_text").cast("binary"))))
    )


def candidates(rows: DataFrame, found: DataFrame) -> DataFrame:
    """_key and _item where a document holds enough of an item's sketch; `rows` has _key and _text."""
    hashed = rows.select("_key", F.transform(words(ascii_lower(F.col("_text"))), lambda w: F.xxhash64(w)).alias("_hashes"))
    index = written(
        found.select("width", "_item", "least_hits", F.explode("sketch").alias("_hash")), "item-sketches"
    )
    parts = []
    for width in sorted(r["width"] for r in index.select("width").distinct().collect()):  # five at most
        mine = index.filter(F.col("width") == width).drop("width")
        each = hashed.select("_key", F.explode(_windows("_hashes", width, lambda *h: F.xxhash64(*h))).alias("_hash"))
        parts.append(attach(each, mine, ["_hash"], how="inner", computed=True))
    if not parts:
        return rows.sparkSession.createDataFrame([], "_key string, _item string")
    hits = parts[0]
    for more in parts[1:]:
        hits = hits.union(more)
    hits = hits.distinct().groupBy("_key", "_item", "least_hits").count()
    return hits.filter(F.col("count") >= F.col("least_hits")).select("_key", "_item")


def _contained(rows: DataFrame, benchmark: DataFrame) -> DataFrame:
    """_key, _doc_id, _item, item_id, n, n_found of every document and item contained in it."""
    found = written(items(benchmark), "items")
    pairs = written(candidates(rows, found), "leak-candidates")
    wanted = pairs.withColumnRenamed("_key", "doc_id")
    texts = _by_id(rows.select(F.col("_key").alias("doc_id"), "_doc_id", "_text"), wanted)
    split = texts.select(
        F.col("doc_id").alias("_key"), "_doc_id", "_item", words(ascii_lower(F.col("_text"))).alias("_words")
    )
    count, shingles = found.agg(F.count(F.lit(1)), F.sum("n")).first()
    width = 4 + WORDS_OF_SHINGLE * (shingles or 0) // max(count, 1)
    both = attach(split, found.select("_item", "item_id", "width", "shingles", "n"), ["_item"], width=width, computed=True)
    own = _windows("_words", SHINGLE, lambda *w: F.concat_ws(" ", *w))
    for width in range(1, SHINGLE):
        own = F.when(F.col("width") == width, _windows("_words", width, lambda *w: F.concat_ws(" ", *w))).otherwise(own)
    counted = both.withColumn("_own", own).select(
        "_key", "_doc_id", "_item", "item_id", "n", F.size(F.array_intersect("shingles", "_own")).alias("n_found")
    )
    return counted.filter(100 * F.col("n_found") >= PERCENT * F.col("n"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_item_shingles, n_found: one row per document and benchmark item contained in it.

    Rows of one doc_id count as one document, with the best of its texts. Rows without doc_id are told
    apart by their text and shown with a NULL doc_id, and so are items without item_id. Items and texts that are NULL or blank contain
    and are contained in nothing. Empty tables give an empty result.
    """
    found = _contained(_text_rows(docs.select("doc_id", "text")), benchmark.select("item_id", "text"))
    best = found.groupBy("_key", "_doc_id", "_item", "item_id").agg(F.max("n").alias("n"), F.max("n_found").alias("n_found"))
    return best.select(
        F.col("_doc_id").alias("doc_id"), "item_id",
        F.col("n").cast("long").alias("n_item_shingles"), F.col("n_found").cast("long").alias("n_found"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that contain no benchmark item, with the columns of `docs`.

    All rows of a doc_id go when one of them contains an item.
    """
    rows = _text_rows(docs)
    gone = written(_contained(rows, benchmark.select("item_id", "text")).select(F.col("_key").alias("doc_id")).distinct(), "leaks")
    kept = _by_id(rows.withColumn("doc_id", F.coalesce("_key", F.lit(""))), gone, "left_anti")
    return unpacked(kept, docs.columns)
