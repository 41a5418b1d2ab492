"""Periodic runs of words: maximal stretches of a text that repeat with some period, found by block convolution.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) and at least
max(`least`, 2 q) words that no neighbouring word extends keeping that period.

1. **Scales.** In a run, the words that equal the word q further on are max(`least` - q, q) or more in a
   row. At the scale of blocks of L words (L a power of two) these are at least 2 L - 1 for every q from
   2 L - 1 to 4 L - 2, so they hold a whole block of a fixed grid, and that block occurs again q
   words later. The scales together meet every period.
2. **Block convolution.** An occurrence of a block at distance d is a zero of the sum of squared
   differences between the block and the words from d on: two sums of squares less twice a correlation,
   for all distances of the scale at once. The correlation is an exact number-theoretic transform modulo a
   prime; a zero of the sum is a zero modulo the prime. Blocks of up to `DIRECT` words are as exactly
   and faster correlated term by term. A block with a word that does not come again at any distance of
   the scale has no zero, so only the other blocks are transformed.
3. **Seeds.** Blocks in a row with one distance make one seed, which is extended word by word to both
   sides; the extension decides, so a chance zero modulo the prime has no effect. Seeds that are long enough
   are runs; of equal stretches the smallest period is the run's.

Tasks work through slices of texts and hold a few arrays of the longest text's words: nothing is
shuffled. Words are compared by 64-bit hashes.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import mixed, text_slices, word_bounds, word_hashes

LEAST = 12
# widest block that is correlated term by term
DIRECT = 8
# bytes of text and numbers of a transform that are worked on at once
SLICE = 1 << 20
TRANSFORM = 1 << 18
# 15 * 2**27 + 1, and a generator of its group
PRIME, GENERATOR = 2013265921, 31
_P = np.uint64(PRIME)
_ROOTS: dict[tuple[int, bool], list[np.ndarray]] = {}  # made once per worker


# --- transform ---------------------------------------------------------------------------------


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo the prime; a division by a constant is faster than a remainder."""
    return x - (x // _P) * _P


def _roots(n: int, inverse: bool) -> list[np.ndarray]:
    """For half = n / 2, n / 4 .. 1 the powers 0 .. half - 1 of a primitive root of order 2 half."""
    if (n, inverse) not in _ROOTS:
        tables, half = [], n // 2
        while half:
            root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
            root = pow(root, -1, PRIME) if inverse else root
            table = np.ones(1, np.uint64)
            while len(table) < half:
                step = np.uint64(pow(root, len(table), PRIME))
                table = np.concatenate([table, _reduced(table * step)])
            tables.append(table)
            half //= 2
        _ROOTS[n, inverse] = tables
    return _ROOTS[n, inverse]


def transformed(x: np.ndarray) -> np.ndarray:
    """Number-theoretic transform of every row (values below the prime), in bit-reversed order."""
    rows, n = x.shape
    for table in _roots(n, False):
        x = x.reshape(rows, -1, 2, len(table))
        a, b = x[:, :, 0], x[:, :, 1]
        total = a + b
        total -= _P * (total >= _P)
        x = np.stack([total, _reduced((a + (_P - b)) * table)], axis=2)
    return x.reshape(rows, n)


def restored(x: np.ndarray) -> np.ndarray:
    """The rows whose transforms these are."""
    rows, n = x.shape
    for table in reversed(_roots(n, True)):
        x = x.reshape(rows, -1, 2, len(table))
        a, b = x[:, :, 0], _reduced(x[:, :, 1] * table)
        total, rest = a + b, a + (_P - b)
        total -= _P * (total >= _P)
        rest -= _P * (rest >= _P)
        x = np.stack([total, rest], axis=2)
    return _reduced(x.reshape(rows, n) * np.uint64(pow(n, -1, PRIME)))


def squared_differences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Sums of squared differences modulo the prime, of every row of `blocks` (L values) to its window.

    Column e holds that of the block and the L values of the window from e on.
    """
    rows, size = blocks.shape
    places = windows.shape[1] - size + 1
    n = 1 << (windows.shape[1] - 1).bit_length()
    # the block backwards in a circle, so that the product of the transforms is the correlation
    turned = np.zeros((rows, n), np.uint64)
    turned[:, 0] = blocks[:, 0]
    turned[:, n - size + 1 :] = blocks[:, :0:-1]
    wide = np.zeros((rows, n), np.uint64)
    wide[:, : windows.shape[1]] = windows
    shared = restored(_reduced(transformed(turned) * transformed(wide)))[:, :places]
    squares = np.zeros((rows, windows.shape[1] + 1), np.uint64)
    np.cumsum(_reduced(windows * windows), axis=1, out=squares[:, 1:])
    there = _reduced(squares[:, size : size + places] - squares[:, :places])
    own = _reduced(_reduced(blocks * blocks).sum(axis=1))[:, None]
    return _reduced(own + there + np.uint64(2) * (_P - shared))


# --- occurrences of blocks ---------------------------------------------------------------------


def _direct(ids: np.ndarray, size: int, low: int, high: int) -> Iterator[tuple[np.ndarray, int]]:
    """(blocks that occur again at the distance, distance) for every distance, term by term."""
    n = len(ids)
    same = np.zeros(-(-n // size) * size, bool)
    whole = np.frombuffer(b"\x01" * size, f"u{size}")[0]
    for distance in range(low, min(high, n - 1) + 1):
        np.equal(ids[: n - distance], ids[distance:], out=same[: n - distance])
        same[n - distance :] = False
        found = np.flatnonzero(same.view(f"u{size}") == whole)
        if len(found):
            yield found, distance


class _Places:
    """Places of the words that come more than once, ordered by word: who comes again at some distance."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        self.step = 4 * max(len(ids), 1)
        self.keys = np.sort(ids * self.step + np.arange(len(ids)))
        self.place = self.keys % self.step
        self.lengths = lengths

    def again(self, low: int, high: int, n: int) -> np.ndarray:
        """Whether the word of each place is found from `low` to `high` places further on.

        Periods of this and later scales need a text of 2 * low words, so shorter texts leave for good.
        """
        long = self.lengths[self.place] >= 2 * low
        self.keys, self.place = self.keys[long], self.place[long]
        out = np.zeros(n, bool)
        if len(self.keys):
            at = np.searchsorted(self.keys, self.keys + low)
            next_key = self.keys[np.minimum(at, len(self.keys) - 1)]
            out[self.place[(at < len(self.keys)) & (next_key - self.keys <= high)]] = True
        return out


def _convolved(
    ids: np.ndarray, size: int, low: int, high: int, chosen: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(block, distance) arrays of the occurrences of the chosen blocks at the distances low .. high."""
    values = np.zeros(len(ids) + high + size, np.uint64)  # past the end is a value that no word has
    values[: len(ids)] = (ids + 1) % PRIME
    step = max(1, TRANSFORM // (4 * size))
    for k in range(0, len(chosen), step):
        start = chosen[k : k + step, None] * size
        window = start + np.arange(low, high + size)
        sums = squared_differences(values[start + np.arange(size)], values[window])
        block, shift = np.nonzero(sums == 0)
        yield chosen[k + block], low + shift


# --- runs --------------------------------------------------------------------------------------


def _extent(ids: np.ndarray, at: np.ndarray, distance: np.ndarray, way: int) -> np.ndarray:
    """How many words from each place on, in the direction `way`, equal the word `distance` further on."""
    n = len(ids)
    length = np.zeros(len(at), np.int64)
    going, width = np.arange(len(at)), 4
    while len(going):
        step = np.arange(width)
        far = []
        for k in range(0, len(going), max(1, TRANSFORM // width)):
            part = going[k : k + max(1, TRANSFORM // width)]
            near = (at[part] + way * length[part])[:, None] + way * step
            beyond = near + distance[part, None]
            inside = (near >= 0) & (beyond < n)
            same = inside & (ids[np.where(inside, near, 0)] == ids[np.where(inside, beyond, 0)])
            found = np.where(same.all(axis=1), width, np.argmin(same, axis=1))
            length[part] += found
            far.append(part[found == width])
        going = np.concatenate(far)
        width = min(4 * width, 4096)
    return length


def find_runs(ids: np.ndarray, lengths: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs, by start, then period.

    `ids` are the words of some texts one after another, numbered so that equal words of one text, and no
    others, have one number below len(ids); `lengths` has the number of words of its text for every word.
    """
    n, longest = len(ids), int(lengths.max()) if len(lengths) else 0
    size = 1
    while 2 * (2 * size) - 1 <= -(-least // 2):
        size *= 2
    low, places = 1, None
    found = [np.empty((0, 3), np.int64)]
    while 2 * low <= longest:
        high = 4 * size - 2
        if size <= DIRECT:
            hits = [(b, np.full(len(b), d)) for b, d in _direct(ids, size, low, high)]
        else:
            places = places or _Places(ids, lengths)
            again = places.again(low, high, n)
            whole = again[: n // size * size].reshape(-1, size).all(axis=1)
            hits = list(_convolved(ids, size, low, high, np.flatnonzero(whole)))
        block, distance = (np.concatenate(v) for v in zip(*hits)) if hits else (ids[:0], ids[:0])
        if len(block):
            order = np.lexsort((block, distance))
            block, distance = block[order], distance[order]
            first = np.ones(len(block), bool)
            first[1:] = (np.diff(block) != 1) | (np.diff(distance) != 0)
            head = np.flatnonzero(first)
            tail = np.append(head[1:], len(block)) - 1
            distance, start, end = distance[head], block[head] * size, (block[tail] + 1) * size
            while len(start):
                real = _extent(ids, start, distance, 1)
                true = real >= size  # a zero modulo the prime may be none; the blocks after it still count
                begin = start[true] - _extent(ids, start[true] - 1, distance[true], -1)
                stop = start[true] + real[true] + distance[true]
                long = stop - begin >= np.maximum(least, 2 * distance[true])
                found.append(np.stack([begin, stop, distance[true]], axis=1)[long])
                start = start + (real // size + 1) * size
                left = start < end
                distance, start, end = distance[left], start[left], end[left]
        low, size = high + 1, 2 * size
    runs = np.unique(np.concatenate(found), axis=0)
    # a stretch that has several periods is the run of the smallest one
    keep = np.ones(len(runs), bool)
    keep[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[keep]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    return runs[:, 0], runs[:, 1], runs[:, 2]


# --- texts -------------------------------------------------------------------------------------


def _kept(raw: bytes, starts, ends, periods) -> bytes:
    """The words that no run repeats, joined by one space."""
    words = raw.split()  # bytes are split at the white space of the word pattern
    if len(starts):
        drop = np.zeros(len(words), bool)
        for a, b, q in zip(starts, ends, periods):
            drop[a + q : b] = True
        words = [w for w, gone in zip(words, drop.tolist()) if not gone]
    return b" ".join(words)


def _run_rows(least: int):
    def run(batches):
        for batch in batches:
            for first, end, data, offsets in text_slices(batch["text"], SLICE):
                begin, stop, rows = word_bounds(data, offsets)
                counts = np.diff(rows)
                of_text = np.repeat(np.arange(len(counts)), counts)
                keys = mixed(word_hashes(data, begin, stop) + mixed(of_text.astype(np.uint64) + np.uint64(1)))
                ids = np.unique(keys, return_inverse=True)[1].astype(np.int64)
                start, finish, period = find_runs(ids, counts[of_text], least)
                cuts = np.searchsorted(start, rows)
                own = rows[of_text[start]] if len(start) else start
                start, finish = start - own, finish - own
                raw = data.tobytes()
                kept = [
                    _kept(raw[offsets[i] : offsets[i + 1]], *(v[cuts[i] : cuts[i + 1]] for v in (start, finish, period)))
                    for i in range(len(counts))
                ]
                found = pa.StructArray.from_arrays(
                    [pa.array(v, pa.int64()) for v in (start, finish - start, period)], ["start", "length", "period"]
                )
                yield pa.RecordBatch.from_arrays([
                    batch["doc_id"].slice(first, end - first), pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), found),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ], names=["doc_id", "n_words", "runs", "kept"])

    return run


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs and kept of every row of `docs` (doc_id, text).

    `runs` lists (start, length, period) in words from 0, by start, then period; `kept` is the text without
    the words that a run repeats, those after its first period, words joined by one space. NULL text is
    empty, and empty or blank texts have no words, no runs and an empty `kept`. Rows are judged one by
    one, so repeated rows, NULL ids, other columns and the size of groups change nothing; an empty table gives
    an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        _run_rows(least),
        "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, kept string",
    )
