"""Language identification by rank-order profiles of character n-grams.

A profile lists the `PROFILE` most frequent n-grams (one to three letters, words padded with a
blank) of a language's training documents, counted over all of their texts. A document's own list is
compared to each profile: an n-gram adds the distance between its two ranks, or `PROFILE` when the
profile lacks it. The language with the smallest sum is predicted; the score is one minus that
sum's share of the largest possible.

Training counts are summed in tasks before the shuffle, and a language's list is cut to `PROFILE` rows before its
n-grams meet in one task, so a language with most documents is no hot key. What reaches the driver and the tasks is
the profiles: `PROFILE` rows for each of at most `MAX_LANGUAGES` languages.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

PROFILE = 400
# more values of lang than this are no languages: an error, not a cut
MAX_LANGUAGES = 20_000
UNKNOWN = "und"
# documents with this remainder of crc32(doc_id) modulo 4 are held out
FOLDS, HELD_OUT = 4, 2
_LETTER: list[np.ndarray] = []  # made once per worker


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def grams(text: str) -> np.ndarray:
    """Codes of all n-grams of a text, in any order; empty without letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    points = np.where(_letters()[points], points + 1, 0)  # 0 is the blank
    points = np.concatenate([[0], points, [0]])
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 0) | (points[:-1] != 0)
    points = points[keep]
    one = points[points > 0]
    two = (points[:-1] << 21) | points[1:]
    three = (points[:-2] << 42) | (points[1:-1] << 21) | points[2:]
    # different lengths have different codes: the first of two or three counts one more
    two = two[(points[:-1] > 0) | (points[1:] > 0)] + (1 << 21)
    three = three[points[1:-1] > 0] + (1 << 42)
    return np.concatenate([one, two, three]) if len(one) else np.empty(0, np.int64)


def most_frequent(codes: np.ndarray, n: int = PROFILE) -> np.ndarray:
    """The n most frequent codes, the most frequent first, ties by code."""
    values, counts = np.unique(codes, return_counts=True)
    return values[np.argsort(-counts, kind="stable")[:n]]


def _count_grams(batches: Iterator[pa.RecordBatch], flush: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    loose: dict[str, list[np.ndarray]] = {}
    size = 0

    def settle(lang):
        values, counts = np.unique(np.concatenate(loose.pop(lang)), return_counts=True)
        parts = [*held.get(lang, []), (values, counts)]
        codes, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        total = np.zeros(len(codes), np.int64)
        np.add.at(total, at, np.concatenate([p[1] for p in parts]))
        held[lang] = [(codes, total)]

    def out():
        for lang, ((codes, total),) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes)), pa.array(codes), pa.array(total)], names=["lang", "gram", "n"]
            )
        held.clear()

    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            codes = grams(text)
            if len(codes):
                loose.setdefault(lang, []).append(codes)
                size += len(codes)
            if size > flush:
                for key in list(loose):
                    settle(key)
                size = 0
                if sum(len(p[0][0]) for p in held.values()) > flush:
                    yield from out()
    for key in list(loose):
        settle(key)
    yield from out()


def ranked(counted: DataFrame) -> DataFrame:
    """lang, gram, rank of the most frequent n-grams of each language; counts (lang, gram, n) may come in parts."""
    summed = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    # compared before anything else, so that each task cuts its part of a language's list
    found = summed.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= PROFILE)
    return found.select("lang", "gram", (F.col("rank") - 1).alias("rank"))


def learn(training: DataFrame) -> DataFrame:
    """lang, gram, rank (0 first): the profiles of `training` (lang, text); rows with a NULL in either are no help."""
    rows = training.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = rows.filter("lang is not null and text is not null")
    counted = rows.mapInArrow(_count_grams, "lang string, gram long, n long")
    return written(ranked(counted), "profiles")


@dataclass(frozen=True)
class Profiles:
    """Languages by name, n-gram codes in order, and per code the languages that have it with its rank there."""

    langs: list[str]
    codes: np.ndarray
    starts: np.ndarray
    lang: np.ndarray
    rank: np.ndarray

    @classmethod
    def of(cls, langs: np.ndarray, codes: np.ndarray, ranks: np.ndarray) -> "Profiles":
        names, lang = np.unique(langs.astype(str), return_inverse=True)
        order = np.lexsort((lang, codes))
        distinct, starts = np.unique(codes[order], return_index=True)
        return cls(
            names.tolist(), distinct, np.append(starts, len(codes)), lang[order].astype(np.int32),
            ranks[order].astype(np.int16),
        )

    def place(self, text: str | None) -> tuple[str, float]:
        """The nearest language and one minus the share of its distance in the largest possible."""
        own = most_frequent(grams(text)) if text else np.empty(0, np.int64)
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.codes, own)
        at[at == len(self.codes)] = 0
        hit = np.flatnonzero(self.codes[at] == own)
        count = self.starts[at[hit] + 1] - self.starts[at[hit]]
        entry = np.arange(count.sum()) + np.repeat(self.starts[at[hit]] - np.cumsum(count) + count, count)
        # an n-gram that a profile lacks is PROFILE away: sum up by how much the others are nearer
        nearer = PROFILE - np.abs(self.rank[entry].astype(np.int64) - np.repeat(hit, count))
        saved = np.bincount(self.lang[entry], nearer, len(self.langs))
        best = int(np.argmax(saved))
        return self.langs[best], float(saved[best] / (PROFILE * len(own)))


def _predict(shared):
    def run(batches):
        place = shared.value.place
        for batch in batches:
            found = [place(text) for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"], batch["held_out"],
                pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
            ], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, profiles: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of `docs` (doc_id, held_out, text)."""
    if profiles.select("lang").distinct().count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} values of lang: not a language column")
    table = profiles.toPandas()
    found = Profiles.of(table["lang"].to_numpy(), table["gram"].to_numpy(np.int64), table["rank"].to_numpy(np.int64))
    shared = docs.sparkSession.sparkContext.broadcast(found)
    return docs.select("doc_id", "held_out", "text").mapInArrow(
        _predict(shared), "doc_id long, held_out boolean, lang_pred string, score double"
    )


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out, predict every row: doc_id, held_out, lang_pred, score.

    Only text and lang of the others are learned from, and only text is looked at in a prediction. NULL
    text, or one without a letter, and any text when no language was learned, is `und` with score 0. A
    NULL doc_id counts as empty for the fold. Ties go to the first language by name. An empty table
    gives an empty result.
    """
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (fold == HELD_OUT).alias("held_out"),
        F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"),
    )
    return predict(rows.drop("lang"), learn(rows.filter("not held_out").select("lang", "text")))
