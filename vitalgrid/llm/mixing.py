"""Mix documents to target weights: iterative proportional fitting over source, language and topic.

The tokens of each (source, lang, topic) cell are raked to the three marginals: every sweep scales
the cells of each source, then language, then topic, to its target. The ratio of a cell's fitted to
its own weight says how its documents are to be represented, and a budget, `BUDGET` of the tokens given, how many tokens
the sample is expected to hold: a document is expected budget x ratio times. The whole part of that number is
copied for certain and the fraction is one draw, so the expected tokens have the target shares in all three
dimensions, and one rare cell with a large ratio repeats its own documents without taking anything from the rest.

Only cell totals are fitted, never documents; a hot source adds one row per cell and task. While there
are at most `LOCAL_CELLS` cells they lie in one partition, where sweeps need no shuffle. Each portion
of sweeps is written, so the plan does not grow with their number.
"""

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.attach import attach
from ..session import written
from .text import ascii_lower, packed, text_key, unpacked

# targets are the shares of the data to this power, so that large groups give way to small ones
TEMPER = 0.8
# expected tokens of a sample, as a share of the tokens that it is drawn from
BUDGET = 0.5
SWEEPS = 5
MAX_SWEEPS = 500
TOLERANCE = 1e-12
# beyond this error after the last sweep the targets contradict each other
CALIBRATED = 1e-6
LOCAL_CELLS = 100_000
DIMENSIONS = ("source", "lang", "topic")
# a document's topic is the first of which its text, A-Z lower-cased, holds a phrase and the pattern
TOPICS: tuple[tuple[str, tuple[str, ...], str | None], ...] = (
    ("legal", ("license", "licence", "copyright", "all rights reserved"), None),
    ("contact", ("@",), r"[a-z0-9]@[a-z0-9-]+\.[a-z]"),
    ("figures", (), r"[0-9]"),
)
OTHER_TOPIC = "prose"
WORD = r"[^\x20\x09-\x0D]+"


def topic_of(text: Column, topics: Sequence[tuple[str, tuple[str, ...], str | None]] = TOPICS) -> Column:
    """The topic of a text; phrases are looked for first, as that is much cheaper than a pattern."""
    found = F.lit(OTHER_TOPIC)
    for name, phrases, pattern in reversed(topics):
        holds = reduce(or_, [F.contains(text, F.lit(p)) for p in phrases]) if phrases else F.lit(True)
        holds = holds & text.rlike(pattern) if pattern else holds
        found = F.when(holds, name).otherwise(found)
    return found


def cells(rows: DataFrame) -> DataFrame:
    """source, lang, topic and the tokens of each cell that has any; NULL source and lang are values."""
    totals = rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens"))
    return totals.filter("tokens > 0")


def tempered(cell: DataFrame, power: float = TEMPER) -> dict[str, DataFrame]:
    """For each dimension its values with target shares that sum to 1: (value, target)."""
    out = {}
    for d in DIMENSIONS:
        # values may be as many as hosts: their totals are scalars, never a window over all of them
        total = cell.agg(F.sum("tokens")).scalar()
        raised = cell.groupBy(d).agg(F.pow(F.sum("tokens") / F.first(total), F.lit(power)).alias("raised"))
        out[d] = raised.select(d, (F.col("raised") / raised.agg(F.sum("raised")).scalar()).alias(f"target_{d}"))
    return out


def _sweep(cell: DataFrame) -> DataFrame:
    for d in DIMENSIONS:
        total = F.sum("weight").over(Window.partitionBy(d))
        cell = cell.withColumn("weight", F.col("weight") * F.col(f"target_{d}") / total)
    return cell


def _error(cell: DataFrame) -> float:
    """The largest relative distance of a marginal from its target; the dimension fitted last has none."""
    parts = [
        cell.groupBy(d).agg(F.abs(F.sum("weight") / F.first(f"target_{d}") - 1).alias("e")) for d in DIMENSIONS[:-1]
    ]
    return parts[0].union(parts[1]).agg(F.max("e")).first()[0] or 0.0


def raked(cell: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """Cells with `weight` fitted to the targets, and `calibrated`: whether the fit meets them.

    Targets that no weights can meet (a source whose only language has a smaller target) leave the
    state after `MAX_SWEEPS` sweeps, with `calibrated` false.
    """
    for d in DIMENSIONS:
        cell = attach(cell, targets[d], [d])
    cell = written(cell.withColumn("weight", F.col("tokens").cast("double")), "cells")
    local = cell.count() <= LOCAL_CELLS
    error, done = None, 0
    while error is None or (error > TOLERANCE and done < MAX_SWEEPS):
        fitted = cell.coalesce(1) if local else cell
        for _ in range(SWEEPS):
            fitted = _sweep(fitted)
        cell, done = written(fitted, "cells"), done + SWEEPS
        error = _error(cell)
    return cell.select(*DIMENSIONS, "tokens", "weight", F.lit(error <= CALIBRATED).alias("calibrated"))


def budgeted(fitted: DataFrame, budget: float = BUDGET) -> DataFrame:
    """Fitted cells with `expected`, how often each of their documents is to be in the sample."""
    tokens, weight = fitted.agg(F.sum("tokens"), F.sum("weight")).first()
    scale = F.lit(budget * (tokens or 0) / (weight or 1.0))
    return fitted.withColumn("expected", scale * F.col("weight") / F.col("tokens"))


def uniform(doc_id: Column) -> Column:
    """A number in [0, 1) that depends on the id alone."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def _weighed(docs: DataFrame, topic=topic_of) -> DataFrame:
    """Packed rows with _doc_id, the three dimensions, the number of words and what a row is drawn by."""
    rows = packed(docs, "doc_id", "text", "source", "lang").withColumn("_lower", ascii_lower(F.col("_text")))
    return rows.select(
        "_row", "_doc_id",
        text_key(F.col("_source")).alias("source"), text_key(F.col("_lang")).alias("lang"),
        topic(F.col("_lower")).alias("topic"),
        F.coalesce(F.regexp_count("_text", F.lit(WORD)), F.lit(0)).cast("long").alias("tokens"),
        # texts without doc_id are told apart
        F.coalesce(F.col("_doc_id").cast("string"), F.concat(F.lit("text "), F.md5(F.col("_text").cast("binary")))).alias("_drawn_by"),
    )


def _sampled(rows: DataFrame, targets: dict[str, DataFrame] | None, budget: float) -> DataFrame:
    """Weighed rows with `expected`, `calibrated` and `copies`."""
    totals = written(cells(rows), "cells")
    fitted = budgeted(written(raked(totals, targets or tempered(totals)), "fitted"), budget)
    joined = attach(rows, fitted.select(*DIMENSIONS, "expected", "calibrated"), DIMENSIONS)
    expected = joined.withColumns({
        "expected": F.coalesce(F.when(F.col("tokens") > 0, F.col("expected")), F.lit(0.0)),
        "calibrated": F.coalesce("calibrated", F.lit(False)),
    })
    whole = F.floor("expected")
    drawn = uniform(F.col("_drawn_by")) < F.col("expected") - whole
    return expected.withColumn("copies", (whole + drawn.cast("long")).cast("int"))


def mixture(
    docs: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET, topic=topic_of
) -> DataFrame:
    """doc_id, topic, tokens, expected (six decimals), calibrated and copies of every row.

    `targets` gives for each dimension a table (value, target_<dimension>) with shares that sum to 1;
    values are keyed as `text_key` does. Default: `tempered`. `topic` makes the topic of a lower-cased text; the
    default tells licences, contacts, figures and prose apart. A document without words has no weight and no copy.
    Rows of one doc_id in one cell, and equal texts without doc_id, are drawn together. An empty table gives
    an empty result.
    """
    rows = written(_weighed(docs, topic).drop("_row"), "weighed")  # texts are read once
    return _sampled(rows, targets, budget).select(
        F.col("_doc_id").alias("doc_id"), "topic", "tokens", F.round("expected", 6).alias("expected"), "calibrated", "copies",
    )


def mixed_documents(
    docs: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET, topic=topic_of
) -> DataFrame:
    """The rows of `docs` as often as `mixture` copies them, with the columns of `docs`."""
    chosen = _sampled(written(_weighed(docs, topic), "weighed"), targets, budget).filter("copies > 0")
    return unpacked(chosen.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))), docs.columns)
