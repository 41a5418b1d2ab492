"""Substring dedup: remove words that lie in a passage of `WINDOW` words which starts in an earlier document.

A suffix automaton of every earlier document, broadcast to all documents, would compare each document
with the whole corpus. So each automaton goes only to the documents that may share a passage with it:

1. **Anchors.** Of the `width`-word grams of a window, the one with the smallest hash is its anchor. Equal
   windows have equal anchors. The home of an anchor is the smallest doc_id that has it.
2. **Reference shards.** For each home, the spans of its text under its anchors are one shard. Documents
   send the spans under anchors with that home to the shard. A shard with many spans is broadcast to
   several tasks, so a passage that a third of all documents share fills no single task.
3. **Matching statistics.** A task builds the shard's suffix automaton and streams the spans through it:
   after each word it holds the length of the longest suffix that the shard contains. Where that is
   `WINDOW` or more, a window is found.
4. Windows whose anchor is shared but which the home lacks (edits, the edges of a passage) go through the same
   steps once more with `width = WINDOW`: then the home of an anchor is the first document with the
   window itself, and nothing is left over. Only the words of those windows go on, not whole texts.

Documents whose words all equal those of an earlier document are settled before by a fingerprint of their
words. What a task holds is one shard, which is part of one document, and one span.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.attach import BROADCAST_VALUES, attach
from ..session import written
from .arrays import hashed_words, long_array, window_hashes
from .signature_join import _by_id

WINDOW = 13
ANCHOR = 7
# spans that one task compares with one shard
SPANS_PER_TASK = 1024


# --- anchors -----------------------------------------------------------------------------------


def anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """The anchor of every window: the smallest of its grams, the first of equal ones."""
    grams = window_hashes(hashes, width)
    windows = len(hashes) - WINDOW + 1
    if windows <= 0:
        return np.empty(0, np.uint64)
    best = grams[:windows].copy()
    for k in range(1, WINDOW - width + 1):
        np.minimum(best, grams[k : windows + k], out=best)
    return best


def _anchor_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"].to_numpy()
            grams, docs = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for row, hashes in hashed_words(batch["text"], lower=False):
                found = np.unique(anchors(hashes, width))
                grams.append(found)
                docs.append(np.full(len(found), ids[row]))
            yield pa.RecordBatch.from_arrays(
                [long_array(np.concatenate(grams)), pa.array(np.concatenate(docs), pa.int64())], names=["gram", "doc"]
            )

    return run


def _homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by gram and doc: gram, doc and home for grams of two documents or more."""
    gram = first = None
    shared = False  # whether a second document has been seen
    for batch in batches:
        grams, docs = batch["gram"].to_numpy(), batch["doc"].to_numpy()
        if not len(grams):
            continue
        starts = np.flatnonzero(np.diff(grams) != 0) + 1
        bounds = np.concatenate([[0], starts, [len(grams)]])
        homes = docs[bounds[:-1]].copy()
        more = np.maximum.reduceat(docs, bounds[:-1]) != homes
        out_gram, out_doc, out_home = [], [], []
        if gram is not None and grams[0] == gram:  # goes on from the batch before
            head = docs[: bounds[1]]
            homes[0] = first
            more[0] = shared or bool((head != first).any())
            if more[0] and not shared:
                out_gram.append([gram])
                out_doc.append([first])
                out_home.append([first])
        sizes = np.diff(bounds)
        keep = np.repeat(more, sizes)
        out_gram.append(grams[keep])
        out_doc.append(docs[keep])
        out_home.append(np.repeat(homes, sizes)[keep])
        gram, first, shared = grams[-1], homes[-1], bool(more[-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c).astype(np.int64)) for c in (out_gram, out_doc, out_home)],
            names=["gram", "doc", "home"],
        )


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by doc and gram: one row per document with its shared grams and their homes."""
    doc, grams, homes = None, [], []
    rows: list[tuple[int, bytes, bytes]] = []

    def close():
        if doc is not None:
            rows.append((doc, *(np.concatenate(c).astype(np.int64).tobytes() for c in (grams, homes))))

    def out():
        ids, *lists = zip(*rows)
        rows.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), *[pa.array(c, pa.binary()) for c in lists]], names=["doc_id", "grams", "homes"]
        )

    for batch in batches:
        ids, g, h = (batch[c].to_numpy() for c in ("doc", "gram", "home"))
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(ids) != 0) + 1, [len(ids)]]) if len(ids) else [0]
        for a, b in zip(bounds, bounds[1:]):
            if ids[a] != doc:
                close()
                doc, grams, homes = int(ids[a]), [], []
            grams.append(g[a:b])
            homes.append(h[a:b])
        if rows:
            yield out()
    close()
    if rows:
        yield out()


def _spans(width: int):
    """Spans of text under shared anchors: home, doc, tie, start (in words), words joined by a blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: batch[c].to_pylist() for c in ("doc_id", "tie", "start", "text", "grams", "homes")}
            rows = []
            for row, hashes in hashed_words(batch["text"], lower=False):
                found = anchors(hashes, width).view(np.int64)
                if not len(found):
                    continue
                grams = np.frombuffer(columns["grams"][row], np.int64)
                homes = np.frombuffer(columns["homes"][row], np.int64)
                order = np.argsort(grams)
                grams, homes = grams[order], homes[order]
                at = np.searchsorted(grams, found)
                at[at == len(grams)] = 0
                starts = np.flatnonzero(grams[at] == found)
                if not len(starts):
                    continue
                home = homes[at[starts]]
                fresh = np.flatnonzero((np.diff(starts, prepend=-2) > 1) | (np.diff(home, prepend=home[0]) != 0))
                words = (columns["text"][row] or "").encode().split()
                place = columns["doc_id"][row], columns["tie"][row]
                for a, b in zip(fresh, np.append(fresh[1:], len(starts))):
                    begin, end = int(starts[a]), int(starts[b - 1]) + WINDOW
                    rows.append((int(home[a]), *place, columns["start"][row] + begin, b" ".join(words[begin:end])))
            parts = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(p, k) for p, k in zip(parts, kinds)], names=["home", "doc", "tie", "start", "words"]
            )

    return run


# --- suffix automaton --------------------------------------------------------------------------


class SuffixAutomaton:
    """All runs of words of some spans. A number between two spans matches no word."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.last = 0
        self.spans = 0

    def add_span(self, words: list[bytes]) -> None:
        self.spans += 1
        for word in (*words, self.spans):
            self._add(word)

    def _add(self, word) -> None:
        nodes, link, length = self.next, self.link, self.length
        new = len(nodes)
        nodes.append({})
        length.append(length[self.last] + 1)
        link.append(0)
        at = self.last
        while at >= 0 and word not in nodes[at]:
            nodes[at][word] = new
            at = link[at]
        if at >= 0:
            to = nodes[at][word]
            if length[at] + 1 == length[to]:
                link[new] = to
            else:
                copy = len(nodes)
                nodes.append(dict(nodes[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                while at >= 0 and nodes[at].get(word) == to:
                    nodes[at][word] = copy
                    at = link[at]
                link[to] = link[new] = copy
        self.last = new

    def matches(self, words: list[bytes]) -> Iterator[int]:
        """After each word the length of the longest suffix of what was read that occurs in a span."""
        nodes, link, length = self.next, self.link, self.length
        at = matched = 0
        for word in words:
            while at and word not in nodes[at]:
                at = link[at]
                matched = length[at]
            if word in nodes[at]:
                at = nodes[at][word]
                matched += 1
            yield matched


def _runs(flags: np.ndarray) -> np.ndarray:
    """(begin, end) of the runs of true values."""
    edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    return edges.reshape(-1, 2)


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (home, part), reference first: runs of windows found in it, and the words of those that are not."""
    key, automaton = None, SuffixAutomaton()
    names = ("doc", "tie", "begin", "end", "left")
    for batch in batches:
        rows = []
        for home, part, doc, tie, start, text in zip(
            *(batch[c].to_pylist() for c in ("home", "part", "doc", "tie", "start", "words"))
        ):
            if (home, part) != key:
                key, automaton = (home, part), SuffixAutomaton()
            words = text.split(b" ")
            if doc == home:
                automaton.add_span(words)
                continue
            lengths = np.fromiter(automaton.matches(words), np.int64, len(words))
            found = lengths[WINDOW - 1 :] >= WINDOW
            rows += [(doc, tie, start + int(a), start + int(b), None) for a, b in _runs(found)]
            rows += [
                (doc, tie, start + int(a), start + int(b), b" ".join(words[a : b + WINDOW - 1]).decode())
                for a, b in _runs(~found)
            ]
        parts = list(zip(*rows)) or [()] * 5
        kinds = (*[pa.int64()] * 4, pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(p, k) for p, k in zip(parts, kinds)], names=names)


# --- rounds ------------------------------------------------------------------------------------


def _round(docs: DataFrame, width: int) -> DataFrame:
    """doc, tie, begin, end, left: runs of windows (by start) that their home has, or the words of those it lacks.

    `docs`: doc_id, tie, start (the place of the text's first word), text.
    """
    rows = docs.select("doc_id", "text").mapInArrow(_anchor_rows(width), "gram long, doc long")
    homes = rows.repartition("gram").sortWithinPartitions("gram", "doc").mapInArrow(
        _homes, "gram long, doc long, home long"
    )
    shared = homes.repartition("doc").sortWithinPartitions("doc", "gram")
    lists = written(shared.mapInArrow(_lists, "doc_id long, grams binary, homes binary"), "anchor-lists")
    # texts without a shared anchor stay where they are
    some = _by_id(docs, lists.select("doc_id"), "left_semi")
    spans = written(
        some.join(lists, "doc_id").mapInArrow(_spans(width), "home long, doc long, tie long, start long, words binary"),
        "spans",
    )
    counts = written(
        spans.filter("doc <> home").groupBy("home").agg(F.count(F.lit(1)).alias("n")).select(
            "home", F.ceil(F.col("n") / SPANS_PER_TASK).cast("int").alias("parts")
        ),
        "span-counts",
    )
    dealt = attach(spans, counts, ["home"], how="inner", computed=True)
    part = F.pmod(F.xxhash64("doc", "start"), F.col("parts")).cast("int")
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    dealt = dealt.withColumn("part", F.explode(F.when(F.col("doc") == F.col("home"), every).otherwise(F.array(part))))
    ordered = dealt.drop("parts").repartition("home", "part").sortWithinPartitions("home", "part", "doc", "tie", "start")
    return ordered.mapInArrow(_matched, "doc long, tie long, begin long, end long, left string")


def _range_lists(runs: DataFrame, name: str) -> DataFrame:
    """One row per document: doc_id, tie, bounds (begin, end, begin, end, ...)."""
    both = F.sort_array(F.collect_set(F.struct("begin", "end")))  # parts of one document
    return written(runs.groupBy("doc", "tie").agg(both.alias("pairs")).select(
        F.col("doc").alias("doc_id"), "tie", F.flatten(F.transform("pairs", lambda p: F.array(p["begin"], p["end"]))).alias("bounds")
    ), name)


def _with_ranges(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """All texts with their ranges or NULL. While the ranges are few they are broadcast; beyond, while the
    ids are few, only texts that have ranges move."""
    total, ids = lists.agg(F.sum(F.size("bounds") + 2), F.count(F.lit(1))).first()
    if (total or 0) <= BROADCAST_VALUES:
        return docs.join(F.broadcast(lists), ["doc_id", "tie"], "left")
    if ids > BROADCAST_VALUES:
        return docs.join(lists, ["doc_id", "tie"], "left")
    places = F.broadcast(lists.select("doc_id"))
    rest = docs.join(places, "doc_id", "left_anti").withColumn("bounds", F.lit(None).cast("array<bigint>"))
    some = docs.join(places, "doc_id", "left_semi").join(lists, ["doc_id", "tie"], "left")
    return some.unionByName(rest)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [(t or "").encode().split() for t in batch["text"].to_pylist()]
        prints = [hashlib.blake2b(b" ".join(w), digest_size=16).digest() for w in words]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["tie"], pa.array([len(w) for w in words], pa.int64()), pa.array(prints, pa.binary())],
            names=["doc_id", "tie", "n_words", "print"],
        )


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """doc_id, tie, bounds: for each document with a repeated window, (begin, end) word ranges to remove.

    `docs`: doc_id, tie (a hash of the text), text. Ranges may overlap.
    """
    rows = written(
        docs.mapInArrow(_fingerprints, "doc_id long, tie long, n_words long, print binary").filter(
            F.col("doc_id").isNotNull() & (F.col("n_words") >= WINDOW)
        ),
        "fingerprints",
    )
    ids = rows.groupBy("print").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    ids = written(ids.filter("first <> last").select("print", "first"), "copied-prints")
    copies = written(
        attach(rows, ids, ["print"], how="inner", computed=True).filter("doc_id <> first")
        .select(F.col("doc_id").alias("doc"), "tie", "n_words"),
        "copies",
    )
    # ids of which every row is a copy
    gone = written(
        copies.select(F.col("doc").alias("doc_id"), "tie").distinct().withColumn("copy", F.lit(1))
        .join(rows.select("doc_id", "tie").distinct(), ["doc_id", "tie"], "right")
        .groupBy("doc_id").agg(F.count("copy").alias("copies"), F.count(F.lit(1)).alias("all"))
        .filter(F.col("copies") == F.col("all")).select("doc_id"),
        "copy-ids",
    )
    only = _by_id(docs.filter(F.col("doc_id").isNotNull()), gone, "left_anti")
    first = written(_round(only.withColumn("start", F.lit(0).cast("long")), ANCHOR), "first-round")
    left = first.filter(F.col("left").isNotNull())
    left = left.select(F.col("doc").alias("doc_id"), "tie", F.col("begin").alias("start"), F.col("left").alias("text"))
    second = written(_round(left, WINDOW), "second-round")
    found = first.filter(F.col("left").isNull()).union(second.filter(F.col("left").isNull()))
    # windows by start cover WINDOW words each
    covered = found.select("doc", "tie", "begin", (F.col("end") + (WINDOW - 1)).alias("end"))
    whole = copies.select("doc", "tie", F.lit(0).cast("long").alias("begin"), F.col("n_words").alias("end"))
    return _range_lists(covered.union(whole), "removed")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, removed, kept = [], [], []
        for text, bounds in zip(batch["text"].to_pylist(), batch["bounds"].to_pylist()):
            words = (text or "").encode().split()
            if bounds:
                stay = np.ones(len(words), bool)
                for a, b in zip(bounds[::2], bounds[1::2]):
                    stay[a:b] = False
                left = [words[i] for i in np.flatnonzero(stay)]
            else:
                left = words
            counts.append(len(words))
            removed.append(len(words) - len(left))
            kept.append(b" ".join(left).decode())
        yield pa.RecordBatch.from_arrays([
            batch["doc_id"], pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
            pa.array(kept, pa.large_string()).cast(pa.string()),
        ], names=["doc_id", "n_words", "n_removed", "kept"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words joined by one blank, of every row of `docs`.

    NULL or blank text has no words. Rows of one doc_id are one place: no row of it is earlier than
    another, each loses what a smaller doc_id has. A row without doc_id has no place: it keeps
    its words and removes none. An empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    cut = _with_ranges(rows, repeated_ranges(rows))
    return cut.select("doc_id", "text", "bounds").mapInArrow(
        _cut, "doc_id long, n_words long, n_removed long, kept string"
    )
