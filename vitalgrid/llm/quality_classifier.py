"""Quality classifier: ridge scores on random Fourier features of document statistics, calibrated by isotonic regression.

1. **Statistics** of every whole text (`STATISTICS`): shares of character classes, lengths of words, repetition. They
   are kept as whole numbers of 1/4096, so that all sums below are exact and do not depend on how the
   rows are dealt out.
2. **Random features.** Standardised statistics z become cos(W z + b), W normal and b uniform from a fixed seed: their
   products approximate a Gaussian kernel whose width is the square root of the number of statistics. They are
   rounded to 1/4096 too.
3. **Normal equations.** Every task sums the products of its labelled rows per fold; the sums of all tasks are added
   block by block. The driver gets one matrix of `FEATURES` + 1 columns per fold, whatever the number of rows, and
   solves the ridge equations: once for all folds, and once for all but each.
4. **Calibration.** The score of a labelled row by the weights of the other folds is put into one of the `CELLS`
   cells; the counts of labels per cell are pooled until their shares rise (pool adjacent violators). Between the
   centres of the pools the calibrated score runs in straight lines.

All labelled rows count; none is sampled. A row's score depends on its text alone.
"""

import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.attach import attach
from ..session import written
from .arrays import mixed, text_slices, window_hashes, word_bounds, word_hashes

# documents with this remainder of crc32(doc_id) modulo 5 are held out; the other remainders are the folds
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
FEATURES, SEED, PENALTY = 256, 1, 1e-3
GRID = 4096
# cells of the raw score from -1 to 2, where labels are 0 and 1
CELLS = 3072
BLOCK = 32  # rows of a matrix that are summed together
SLICE = 1 << 20

_UPPER, _LETTER, _DIGIT, _SPACE, _LINE, _STOP, _MARK, _SYMBOL = range(8)
STATISTICS = (
    "log_words", "log_chars", "upper", "letters", "digits", "spaces", "lines", "stops", "marks", "symbols", "beyond_ascii",
    "word_length", "word_length_spread", "longest_word", "short_words", "long_words", "capital_words",
    "distinct_words", "top_word", "entropy", "repeated_fives", "repeated_twos", "same_as_before",
)
_CLASSES: list[np.ndarray] = []  # made once per worker


def _class_table() -> np.ndarray:
    if not _CLASSES:
        kinds = {"Lu": _UPPER, "Lt": _UPPER, "Nd": _DIGIT}
        table = np.empty(0x110000, np.uint8)
        for i in range(0x110000):
            kind = unicodedata.category(chr(i))
            table[i] = kinds.get(kind, _LETTER if kind[0] in "LM" else _MARK if kind[0] == "P" else _SYMBOL)
        for char in " \t\v\f\r ":
            table[ord(char)] = _SPACE
        table[ord("\n")] = _LINE
        for char in ".!?":
            table[ord(char)] = _STOP
        for char in "#*$%&|<>@\\^_~":
            table[ord(char)] = _SYMBOL
        _CLASSES.append(table)
    return _CLASSES[0]


# --- statistics --------------------------------------------------------------------------------


def _share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def _runs(keys: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and count of every different value; the row is in the upper bits of a key."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.diff(keys, prepend=keys[:1] ^ np.uint64(1)))
    return (keys[first] >> np.uint64(40)).astype(np.int64), np.diff(np.append(first, len(keys)))


def _keyed(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    return (row.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24))


def _per_row(row: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(row, values, rows)


def _repeated(hashes: np.ndarray, row: np.ndarray, width: int, rows: int) -> np.ndarray:
    """Share of the windows of `width` words that come twice or more in their row."""
    if len(hashes) < width:
        return np.zeros(rows)
    inside = row[width - 1 :] == row[: len(row) - width + 1]
    found, count = _runs(_keyed(window_hashes(hashes, width)[inside], row[: len(inside)][inside]), rows)
    return _share(_per_row(found, np.where(count > 1, count, 0), rows), _per_row(found, count, rows))


def text_statistics(texts: pa.Array) -> np.ndarray:
    """One row of `STATISTICS` per text, as whole numbers of 1 / GRID; all 0 for NULL and empty texts."""
    out = [np.zeros((0, len(STATISTICS)), np.int32)]
    table = _class_table()
    for first, end, data, offsets in text_slices(texts, SLICE):
        rows = end - first
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        at = np.zeros(len(data) + 1, np.int64)  # number of the character that starts at each byte
        np.cumsum((data & 0xC0) != 0x80, out=at[1:])
        chars = np.diff(at[offsets])
        row = np.repeat(np.arange(rows), chars)
        kinds = np.bincount(row * 8 + table[points], minlength=rows * 8).reshape(rows, 8)
        letters = kinds[:, _UPPER] + kinds[:, _LETTER]
        same = np.zeros(len(points), bool)
        same[1:] = (points[1:] == points[:-1]) & (row[1:] == row[:-1])

        begin, stop, bounds = word_bounds(data, offsets)
        words = np.diff(bounds)
        of = np.repeat(np.arange(rows), words)
        hashes = word_hashes(data, begin, stop)
        length = at[stop] - at[begin]
        mean = _share(_per_row(of, length, rows), words)
        spread = np.sqrt(np.maximum(_share(_per_row(of, length.astype(float) ** 2, rows), words) - mean**2, 0))
        longest = np.zeros(rows)
        np.maximum.at(longest, of, length)
        capital = table[points[at[begin]]] == _UPPER
        found, count = _runs(_keyed(mixed(hashes), of), rows)
        top = np.zeros(rows)
        np.maximum.at(top, found, count)
        total = np.maximum(words, 1)
        entropy = np.log2(total) - _per_row(found, count * np.log2(count), rows) / total
        values = np.stack([
            np.log2(1 + words), np.log2(1 + chars), _share(kinds[:, _UPPER], letters), _share(letters, chars),
            _share(kinds[:, _DIGIT], chars), _share(kinds[:, _SPACE], chars), _share(kinds[:, _LINE], words),
            _share(kinds[:, _STOP], words), _share(kinds[:, _MARK], words), _share(kinds[:, _SYMBOL], words),
            _share(_per_row(row, points > 127, rows), chars),
            np.log2(1 + mean), np.log2(1 + spread), np.log2(1 + longest),
            _share(_per_row(of, length <= 3, rows), words), _share(_per_row(of, length > 12, rows), words),
            _share(_per_row(of, capital, rows), words),
            _share(_per_row(found, np.ones(len(found)), rows), words), _share(top, words), entropy,
            _repeated(hashes, of, 5, rows), _repeated(hashes, of, 2, rows), _share(_per_row(row, same, rows), chars),
        ], axis=1)
        # far beyond any usual value a statistic tells no more, and squares stay exact
        out.append(np.rint(np.clip(values, 0, 64) * GRID).astype(np.int32))
    return np.concatenate(out)


def _statistics_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    width = len(STATISTICS)
    for batch in batches:
        values = text_statistics(batch["text"])
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(values) + 1) * width, pa.int32()), pa.array(values.ravel(), pa.int32())
        )
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["fold"], lists], names=["doc_id", "fold", "x"])


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, fold and x, the statistics of the text, of every row of `docs` (doc_id, text)."""
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), fold.cast("int").alias("fold"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(_statistics_rows, "doc_id long, fold int, x array<int>")


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


# --- model -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """Standardisation, random features, ridge weights, and the line of calibrated scores."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    raw: np.ndarray
    calibrated: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(fourier(x, self.mean, self.spread) @ self.weights, self.raw, self.calibrated)


def fourier(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Random Fourier features of rows of statistics, whole numbers of 1 / GRID, and a constant column."""
    random = np.random.default_rng(SEED)
    turns = random.standard_normal((x.shape[1], FEATURES)) / math.sqrt(x.shape[1])
    shift = random.uniform(0, 2 * math.pi, FEATURES)
    waves = np.rint(np.cos((x - mean) / spread @ turns + shift) * GRID)
    return np.column_stack([waves, np.full(len(x), float(GRID))])


def _standard(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of every statistic over the labelled rows, from exact sums."""
    value = F.col("v").cast("decimal(18,0)")
    n = F.col("n").cast("decimal(18,0)")
    sums = (
        rows.select("n", F.posexplode("x").alias("i", "v")).groupBy("i")
        .agg(F.sum("n").alias("n"), F.sum(value * n).alias("s"), F.sum(value * value * n).alias("q")).collect()
    )
    mean, spread = np.zeros(len(STATISTICS)), np.ones(len(STATISTICS))
    for row in sums:
        n, s, q = int(row["n"]), int(row["s"]), int(row["q"])
        mean[row["i"]] = s / n
        spread[row["i"]] = math.sqrt((q * n - s * s) / (n * n)) or 1.0
    return mean, spread


def _products(mean: np.ndarray, spread: np.ndarray):
    """Per task and fold: blocks of rows of the sums of n f f' and, as the last column, of m f; exact."""
    size = FEATURES + 1

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            folds = batch["fold"].to_numpy()
            counts = np.stack([batch[c].to_numpy() for c in ("n", "m")], axis=1).astype(float)
            waves = fourier(_matrix(batch["x"]), mean, spread)
            for fold in np.unique(folds).tolist():
                own = folds == fold
                f, (n, m) = waves[own], counts[own].T
                found = np.column_stack([(f * n[:, None]).T @ f, f.T @ m])
                sums[fold] = sums.get(fold, 0) + found.astype(np.int64)
        rows = [(fold, k, s[k : k + BLOCK].tobytes()) for fold, s in sums.items() for k in range(0, size, BLOCK)]
        yield _blocks_of(rows)

    return run


def _blocks_of(rows) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.binary())
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["fold", "k", "sums"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for fold, k, sums in zip(*(batch[c].to_pylist() for c in ("fold", "k", "sums"))):
            held[fold, k] = held.get((fold, k), 0) + np.frombuffer(sums, np.int64)
    yield _blocks_of([(*key, sums.tobytes()) for key, sums in held.items()])


def normal_equations(rows: DataFrame, mean: np.ndarray, spread: np.ndarray) -> dict[int, np.ndarray]:
    """fold -> sums of products of the random features of its labelled rows; the last column is that with the labels."""
    schema = "fold int, k int, sums binary"
    parts = rows.select("fold", "x", "n", "m").mapInArrow(_products(mean, spread), schema)
    found = parts.repartition("fold", "k").mapInArrow(_added, schema).collect()
    out: dict[int, np.ndarray] = {}
    for row in found:
        sums = np.frombuffer(row["sums"], np.int64).reshape(-1, FEATURES + 2)
        out.setdefault(row["fold"], np.zeros((FEATURES + 1, FEATURES + 2), np.int64))[row["k"] : row["k"] + len(sums)] = sums
    return out


def ridge(sums: np.ndarray) -> np.ndarray:
    """Weights that minimise the squared error plus `PENALTY` times the number of rows times the squared weights."""
    products, targets = sums[:, :-1] / GRID**2, sums[:, -1] / GRID
    penalty = np.full(len(products), PENALTY * products[-1, -1])
    penalty[-1] = 0  # the constant is free
    return np.linalg.solve(products + np.diag(penalty), targets) / GRID


def _cells(mean: np.ndarray, spread: np.ndarray, weights: dict[int, np.ndarray]):
    def run(batches):
        for batch in batches:
            folds = batch["fold"].to_numpy()
            waves = fourier(_matrix(batch["x"]), mean, spread)
            score = np.zeros(len(folds))
            for fold, w in weights.items():
                score[folds == fold] = waves[folds == fold] @ w
            cell = np.clip(np.floor((score + 1) / 3 * CELLS), 0, CELLS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cell), batch["n"], batch["m"]], names=["cell", "n", "m"])

    return run


def isotonic(value: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centre and share m / n of the pools of a rising fit, for values in order."""
    pools: list[list[float]] = []
    for v, a, b in zip(value.tolist(), n.tolist(), m.tolist()):
        pools.append([v * a, a, b])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [x + y for x, y in zip(pools[-1], last)]
    return np.array([p[0] / p[1] for p in pools]), np.array([p[2] / p[1] for p in pools])


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The statistics of documents that are not held out, with n labels of which m are 1.

    Labels other than 0 and 1 do not count; several labels of one doc_id count each.
    """
    good = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("q"))
    counted = good.filter("q in (0, 1) and doc_id is not null").groupBy("doc_id").agg(
        F.count("q").alias("n"), F.sum("q").cast("long").alias("m")
    )
    return attach(rows.filter(F.col("fold") != HELD_OUT), counted, ["doc_id"], how="inner")


def learn(rows: DataFrame) -> Model | None:
    """The model of labelled rows (fold, x, n, m); None without any."""
    mean, spread = _standard(rows)
    sums = normal_equations(rows, mean, spread)
    if not sums:
        return None
    total = sum(sums.values())
    weights = ridge(total)
    # a fold that has all labels is scored by its own weights
    others = {fold: ridge(total - own) if (total - own).any() else weights for fold, own in sums.items()}
    cells = rows.select("fold", "x", "n", "m").mapInArrow(_cells(mean, spread, others), "cell long, n long, m long")
    counts = cells.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("m").alias("m")).orderBy("cell").collect()
    centre = (np.array([r["cell"] for r in counts]) + 0.5) / CELLS * 3 - 1
    raw, share = isotonic(centre, np.array([r["n"] for r in counts]), np.array([r["m"] for r in counts]))
    return Model(mean, spread, weights, raw, share)


def _scored(model: Model | None):
    def run(batches):
        for batch in batches:
            x = _matrix(batch["x"])
            # the last bits depend on the rows that are multiplied together
            score = np.round(np.clip(model.score(x), 0, 1), 9) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["fold"], pa.array(score)], names=["doc_id", "fold", "score"])

    return run


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher for label 1) and predicted of every row of `docs` (doc_id, text).

    Learned from the labels (doc_id, quality) of the documents that are not held out; a score looks at the text
    alone. NULL text counts as empty, and empty texts are scored by their statistics, all 0. A NULL doc_id counts as
    empty for the fold and has no label. Without a label all scores are 0.5; with labels of one kind all are that
    label. Repeated rows are scored, and learned from, each. An empty table gives an empty result.
    """
    rows = written(statistics(docs), "statistics")
    model = learn(written(labelled(rows, labels), "labelled"))
    found = rows.mapInArrow(_scored(model), "doc_id long, fold int, score double")
    return found.select(
        "doc_id", (F.col("fold") == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
