"""The named queries of the subpackage; each reads its whole tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (
    decontaminate,
    html_text,
    lang_profiles,
    mixing,
    periodic_runs,
    quality,
    quality_classifier,
    signature_join,
    substring_dedup,
    token_blocks,
    token_counts,
    url_rules,
    whitening,
)
from .text import words


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_report(_table(spark, folder, "documents"))


def op2_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extracted(_table(spark, folder, "pages"))


def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return signature_join.jaccard_components(_table(spark, folder, "documents"))


def op4_token_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return token_blocks.token_digest(_table(spark, folder, "documents"), scratch_path(spark, "tokens"))


def op5_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixture(_table(spark, folder, "documents"))


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substring_dedup.without_repeats(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judged_urls(_table(spark, folder, "pages"))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, folder, "documents"))


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return lang_profiles.identify(_table(spark, folder, "documents"))


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op11_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.quality_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def looped_words(docs: DataFrame) -> DataFrame:
    """doc_id and text, with every tenth text, by the checksum of its id, made periodic from some word on.

    The checksum of a NULL id is that of an empty text.
    """
    checksum = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g = F.floor(checksum / 10)

    def looped(word, n, begin, period):
        return F.array_join(
            F.transform(
                F.sequence(F.lit(0), n - 1),
                lambda i: F.get(word, F.when(i >= begin, begin + (i - begin) % period).otherwise(i).cast("int")),
            ),
            " ",
        )

    def numbers(word):
        n = F.size(word)
        begin = F.pmod(g, n)
        return F.struct(word.alias("word"), n.alias("n"), begin.alias("begin"),
                        (1 + F.floor((n - begin) / (3 + g % 8))).alias("period"))

    # arrays of one, because a lambda's variable is evaluated once and not again for every word
    found = F.transform(F.array(words(F.col("text"))), numbers)
    found = F.transform(found, lambda x: F.when(x.n > 0, looped(x.word, x.n, x.begin, x.period)).otherwise(""))
    return docs.select(
        "doc_id", F.when(checksum % 10 == 0, F.get(found, F.lit(0))).otherwise(F.col("text")).alias("text")
    )


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.periodic_runs(looped_words(_table(spark, folder, "documents")))
    runs = F.col("runs")
    # the longest run first, then the smallest start and period
    best = F.array_max(F.transform(runs, lambda r: F.struct(r.length.alias("length"), -r.start, -r.period)))
    lines = F.transform(runs, lambda r: F.concat_ws(",", r.start, r.length, F.concat(r.period.cast("string"), F.lit("\n"))))
    best = best.cast("struct<length:long,start:long,period:long>")
    start, length, period = -best.start, best.length, -best.period
    return found.select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), start.alias("start"), length.alias("length"),
        period.alias("period"), F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened_components(_table(spark, folder, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_html_text, op3_jaccard_join, op4_token_blocks, op5_mixture, op6_substring_dedup,
        op7_url_filter, op8_token_counts, op9_language_id, op10_decontamination, op11_quality_classifier,
        op12_periodic_runs, op13_embedding_whitening,
    )
}
