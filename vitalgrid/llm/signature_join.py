"""N-gram Jaccard join: which documents have 5-word shingle sets with a Jaccard similarity of 0.8 or more.

Every pair is found; nothing is sampled or capped.

1. **Copies.** Documents with equal sets are linked to the smallest doc_id among them, and only
   that one goes on.
2. **Blocks.** The shingles of a document are put in one order for all documents: frequent ones
   last, else by hash. Two sets with a Jaccard similarity of t or more share one of the first
   n - ceil(t n) + 1 shingles of each, so a block (the documents with a given shingle among
   those) holds both. Blocks with equal members are one block.
3. **Clusters.** A document is compared exactly with the smallest document of the blocks that the two
   share most often, if those are a quarter of its own. The components of these links are the clusters.
4. **Signature trees.** A block that holds several clusters gets a tree for each size range. A leaf is one
   document with its shingles as a bitmap; a node above has the OR of its children's bitmaps, the
   range of their sizes and their largest number of shingles lost to shared bits. Nodes join
   documents of one cluster first, then clusters. The tree is traversed against itself: a pair of
   nodes is dropped when both are inside one cluster, when the size ranges rule a link out, or
   when even the largest possible overlap is too small. A tree passes on the documents of the leaf pairs
   that are left, as groups that hang together, and no pairs: at most as many rows as it has leaves.
5. **Links.** The documents of a group, with their whole sets, make a tree of their own in one task. Its leaf pairs
   are compared exactly unless links found before join the two already, so a task returns fewer links than
   it has clusters.

The size of what a task holds is bounded by `MEMBERS` documents of a block and `SHINGLES` of a group; larger ones
are cut into tasks that meet every pair of different clusters. Frequent shingles only order the others:
their table has at most `MAX_FREQUENT` rows, and any table gives the same links.
"""

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.attach import BROADCAST_VALUES, attach
from ..session import written
from .arrays import common, hashed_words, long_array, shingle_set
from .components import components
from .text import packed, unpacked

NUMERATOR, DENOMINATOR = 4, 5  # the similarity, as a fraction
# a shingle in more documents than this comes last in the order
FREQUENT = 50
MAX_FREQUENT = 1 << 18
# frequencies are counted below this part of the hash range: prefixes seldom reach beyond
COUNTED_PART = 0.35
# documents of a block in one task, shingles of a group in one task, and bits of the widest bitmap
MEMBERS = 512
SHINGLES = 1 << 22
MAX_BITS = 1 << 16
FANOUT = 8
# pairs that one task compares with one set
PAIRS_PER_TASK = 128
# groups that a task names once only; repeats of others go in the shuffle after it
REMEMBERED = 1 << 18


def prefix_length(n: int) -> int:
    return n - -(-NUMERATOR * n // DENOMINATOR) + 1


def linked(overlap: int, a: int, b: int) -> bool:
    return a > 0 and b > 0 and DENOMINATOR * overlap >= NUMERATOR * (a + b - overlap)


# --- sets and copies ---------------------------------------------------------------------------


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, prints = [], []
        for _, hashes in hashed_words(batch["text"], lower=True):
            found = shingle_set(hashes)
            sizes.append(len(found))
            prints.append(blake2b(found.tobytes(), digest_size=16).digest())
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(prints, pa.binary())],
            names=["doc_id", "n_shingles", "print"],
        )


def shingle_sets(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and a 128-bit fingerprint of the shingle set, one row per row of `docs`."""
    return docs.mapInArrow(_set_rows, "doc_id long, n_shingles long, print binary")


def _by_id(docs: DataFrame, ids: DataFrame, how: str = "inner") -> DataFrame:
    """Documents joined with rows keyed by doc_id: by broadcast while those are few, so texts do not move."""
    if ids.count() * len(ids.columns) <= BROADCAST_VALUES:
        ids = F.broadcast(ids)
    return docs.join(ids, "doc_id", how)


# --- order and blocks --------------------------------------------------------------------------


def _counted_tokens(ranges: int, flush: int = 1 << 20):
    """Per task and range of hashes: the distinct low shingles with their numbers of documents."""
    top = np.uint64(int(COUNTED_PART * 2**64))
    bits = np.uint64(64 - (ranges.bit_length() - 1))

    def emit(parts):
        values, counts = np.unique(np.concatenate(parts), return_counts=True)
        owner = (values >> bits).astype(np.int64)
        cuts = np.flatnonzero(np.diff(owner, prepend=-1))
        # 32 bits below those of the range tell shingles apart well enough to order them
        low = ((values >> (bits - np.uint64(32))) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        counts = counts.astype(np.uint32)
        bounds = [*cuts, len(values)]
        yield pa.RecordBatch.from_arrays([
            pa.array(owner[cuts], pa.int64()),
            pa.array([low[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary()),
            pa.array([counts[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary()),
        ], names=["range", "low", "n"])

    def run(batches):
        parts, held = [], 0
        for batch in batches:
            for _, hashes in hashed_words(batch["text"], lower=True):
                found = shingle_set(hashes)
                found = found[: int(np.searchsorted(found, top))]
                if len(found):
                    parts.append(found)
                    held += len(found)
                if held >= flush:
                    yield from emit(parts)
                    parts, held = [], 0
        if parts:
            yield from emit(parts)

    return run


def _frequent_in_range(table: pa.Table) -> pa.Table:
    low = np.concatenate([np.frombuffer(b, np.uint32) for b in table["low"].to_pylist()])
    n = np.concatenate([np.frombuffer(b, np.uint32) for b in table["n"].to_pylist()]).astype(np.int64)
    order = np.argsort(low, kind="stable")
    low, n = low[order], n[order]
    first = np.flatnonzero(np.diff(low.astype(np.int64), prepend=-1))
    total = np.add.reduceat(n, first)
    keep = total > FREQUENT
    key = (table["range"][0].as_py() << 32) | low[first][keep].astype(np.int64)
    return pa.table({"key": pa.array(key, pa.int64()), "n": pa.array(total[keep], pa.int64())})


def frequent_tokens(docs: DataFrame, shingles: int) -> tuple[np.ndarray, int]:
    """Sorted keys of the most frequent shingles, at most MAX_FREQUENT, and the shift from hash to key."""
    ranges = 64
    while ranges * (1 << 20) < COUNTED_PART * shingles:
        ranges *= 2
    counted = docs.mapInArrow(_counted_tokens(ranges), "range long, low binary, n binary")
    many = written(counted.groupBy("range").applyInArrow(_frequent_in_range, "key long, n long"), "frequent")
    least = FREQUENT
    while many.filter(F.col("n") > least).count() > MAX_FREQUENT:
        least *= 2
    keys = [r["key"] for r in many.filter(F.col("n") > least).select("key").collect()]
    return np.sort(np.array(keys, np.uint64)), 32 - (ranges.bit_length() - 1)


def _prefixes(frequent: np.ndarray, shift: int):
    def run(batches):
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            tokens, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for row, hashes in hashed_words(batch["text"], lower=True):
                found = shingle_set(hashes)
                if not len(found) or ids[row] is None:
                    continue
                length = prefix_length(len(found))
                if len(frequent):
                    key = found >> np.uint64(shift)
                    at = np.searchsorted(frequent, key)
                    at[at == len(frequent)] = 0
                    late = frequent[at] == key
                    found = np.concatenate([found[~late][:length], found[late]])
                tokens.append(found[:length])
                owners.append(np.full(length, ids[row]))
            yield pa.RecordBatch.from_arrays(
                [long_array(np.concatenate(tokens)), pa.array(np.concatenate(owners), pa.int64())],
                names=["token", "doc"],
            )

    return run


def _blocks(batches: Iterator[pa.RecordBatch], flush: int = 200_000) -> Iterator[pa.RecordBatch]:
    """Rows sorted by token and doc to blocks of two documents or more.

    A block is named by its members, so that equal blocks are one; a block of more than MEMBERS
    documents is passed on as it comes, named by its token.
    """
    seen: dict[bytes, int] = {}
    rows = {"block": [], "doc": [], "leader": [], "weight": []}
    held = 0
    token, members, long_leader = None, np.empty(0, np.int64), None

    def put(block, docs, leader, weight):
        rows["block"].append(np.full(len(docs), block))
        rows["doc"].append(docs)
        rows["leader"].append(np.full(len(docs), leader))
        rows["weight"].append(np.full(len(docs), weight))
        return len(docs)

    def out():
        for packed, weight in seen.items():
            docs = np.frombuffer(packed, np.int64)
            name = int.from_bytes(blake2b(packed, digest_size=8).digest(), "little", signed=True)
            put(name, docs, docs[0], weight)
        seen.clear()
        if rows["block"]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(v), pa.int64()) for v in rows.values()], names=list(rows)
            )
            for v in rows.values():
                v.clear()

    def close():
        if long_leader is None and len(members) > 1:
            packed = members.tobytes()
            new = packed not in seen
            seen[packed] = seen.get(packed, 0) + 1
            return len(members) if new else 0
        return 0

    for batch in batches:
        tokens = batch["token"].to_numpy()
        docs = batch["doc"].to_numpy()
        if not len(tokens):
            continue
        starts = np.flatnonzero(np.diff(tokens, prepend=tokens[0] - 1 if token is None else token))
        bounds = [*starts, len(tokens)]
        if bounds[0] > 0:  # goes on from the batch before
            more = docs[: bounds[0]]
            if long_leader is None:
                members = np.unique(np.concatenate([members, more]))
                if len(members) > MEMBERS:
                    long_leader = members[0]
                    held += put(token, members, long_leader, 1)
                    members = members[-1:]
            else:
                held += put(token, np.unique(more), long_leader, 1)
        sizes = np.diff(bounds)
        # only runs of two rows or more, and the last one, matter
        for k in [*np.flatnonzero(sizes[:-1] > 1), len(sizes) - 1] if len(sizes) else []:
            held += close()
            token, members, long_leader = int(tokens[bounds[k]]), np.unique(docs[bounds[k] : bounds[k + 1]]), None
            if len(members) > MEMBERS:
                long_leader = members[0]
                held += put(token, members, long_leader, 1)
        if held >= flush:
            yield from out()
            held = 0
    close()
    yield from out()


def blocks(docs: DataFrame, shingles: int) -> DataFrame:
    """block, doc, leader, weight: members of every block of two documents or more."""
    frequent, shift = frequent_tokens(docs, shingles)
    prefixes = docs.mapInArrow(_prefixes(frequent, shift), "token long, doc long")
    ordered = prefixes.repartition("token").sortWithinPartitions("token", "doc")
    return ordered.mapInArrow(_blocks, "block long, doc long, leader long, weight long")


# --- exact comparison --------------------------------------------------------------------------


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (a, part, b first NULL): the sets of a, then the texts of its partners."""
    key, own = None, []
    for batch in batches:
        heads, parts, others = (batch[c].to_pylist() for c in ("a", "part", "b"))
        left, right = [], []
        for row, hashes in hashed_words(batch["text"], lower=True):
            found = shingle_set(hashes)
            if key != (heads[row], parts[row]):
                key, own = (heads[row], parts[row]), []
            if others[row] is None:
                own.append(found)
            elif any(linked(common(mine, found), len(mine), len(found)) for mine in own):
                left.append(heads[row])
                right.append(others[row])
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def compared(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked, by their whole sets.

    The text of a is sent once per `PAIRS_PER_TASK` partners, that of b once per pair.
    """
    tasks = F.ceil(F.col("n") / PAIRS_PER_TASK).cast("int")
    sizes = written(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")), "pair-counts")
    # the part depends on the partner's id alone, so a repeated task deals rows alike
    partner = attach(pairs, sizes, ["a"], computed=True).select(
        F.col("b").alias("doc_id"), "a", F.pmod(F.xxhash64("b"), tasks).cast("int").alias("part"), "b"
    )
    head = sizes.select(
        F.col("a").alias("doc_id"), "a",
        F.explode(F.sequence(F.lit(0), tasks - 1)).alias("part"), F.lit(None).cast("long").alias("b"),
    )
    wanted = written(partner.union(head), "pairs")
    rows = _by_id(docs, wanted).select("a", "part", "b", "text")
    ordered = rows.repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return ordered.mapInArrow(_compare, "a long, b long")


# --- signature trees ---------------------------------------------------------------------------


def _bitmap(tokens: np.ndarray, bits: int) -> bytes:
    """Bit (token mod bits) set for every token; bits is a power of two, 64 at least."""
    marks = np.zeros(bits, bool)
    marks[(tokens & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(marks, bitorder="little").tobytes()


def _width(band: int) -> int:
    """Bits of the bitmaps of sets with less than 2**band shingles."""
    return min(max(2 << band, 64), MAX_BITS)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, band, n, bits: a bitmap for the band of the set's size, and one for the band above if near it."""
    for batch in batches:
        ids = batch["doc_id"].to_pylist()
        rows = []
        for row, hashes in hashed_words(batch["text"], lower=True):
            found = shingle_set(hashes)
            n = len(found)
            own = n.bit_length()
            for band in (own, own + 1):
                if n and (band == own or DENOMINATOR * n >= NUMERATOR * (1 << own)):
                    rows.append((ids[row], band, n, _bitmap(found, _width(band))))
        columns = list(zip(*rows)) or [(), (), (), ()]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc", "band", "n", "bits"]
        )


class _Level:
    """Nodes of one height: OR of the bitmaps, size range, most shingles lost to shared bits, cluster or -1."""

    def __init__(self, bits, low, high, lost, cluster, first):
        self.bits, self.low, self.high, self.lost, self.cluster, self.first = bits, low, high, lost, cluster, first

    def above(self, starts: np.ndarray) -> "_Level":
        same = np.minimum.reduceat(self.cluster, starts) == np.maximum.reduceat(self.cluster, starts)
        return _Level(
            np.bitwise_or.reduceat(self.bits, starts, axis=0),
            np.minimum.reduceat(self.low, starts),
            np.maximum.reduceat(self.high, starts),
            np.maximum.reduceat(self.lost, starts),
            np.where(same, self.cluster[starts], -1),
            np.append(starts, len(self.low)),
        )


def _tree(sizes: np.ndarray, clusters: np.ndarray, bits: np.ndarray) -> list[_Level]:
    """Levels from leaves (sorted by cluster and size) to a root level of at most FANOUT nodes."""
    lost = sizes - np.bitwise_count(bits).sum(axis=1)
    levels = [_Level(bits, sizes, sizes, lost, clusters, None)]
    while len(levels[-1].low) > FANOUT:
        below = levels[-1]
        new = np.flatnonzero(np.diff(below.cluster, prepend=below.cluster[0] - 1))
        if len(new) < len(below.low) and below.cluster.min() >= 0:  # inside clusters first
            place = np.arange(len(below.low)) - np.repeat(new, np.diff(np.append(new, len(below.low))))
            starts = np.flatnonzero(place % FANOUT == 0)
        else:
            starts = np.arange(0, len(below.low), FANOUT)
        levels.append(below.above(starts))
    return levels


def _surviving(level: _Level, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Node pairs that may still hold a link between different clusters."""
    apart = (level.cluster[x] != level.cluster[y]) | (level.cluster[x] < 0)
    fits = DENOMINATOR * level.high[x] >= NUMERATOR * level.low[y]
    fits &= DENOMINATOR * level.high[y] >= NUMERATOR * level.low[x]
    x, y = x[apart & fits], y[apart & fits]
    keep = []
    step = max(1, (1 << 21) // level.bits.shape[1])
    for k in range(0, len(x), step):
        a, b = x[k : k + step], y[k : k + step]
        shared = np.bitwise_count(level.bits[a] & level.bits[b]).sum(axis=1, dtype=np.int64)
        most = shared + np.minimum(level.lost[a], level.lost[b])
        keep.append((NUMERATOR + DENOMINATOR) * most >= NUMERATOR * (level.low[a] + level.low[b]))
    keep = np.concatenate(keep) if keep else np.empty(0, bool)
    return x[keep], y[keep]


def _children(level: _Level, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a child of x and a child of y, each once."""
    nx = level.first[x + 1] - level.first[x]
    ny = level.first[y + 1] - level.first[y]
    count = nx * ny
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    width = np.repeat(ny, count)
    a = np.repeat(level.first[x], count) + inside // width
    b = np.repeat(level.first[y], count) + inside % width
    once = np.repeat(x != y, count) | (a <= b)
    return a[once], b[once]


def tree_pairs(sizes: np.ndarray, clusters: np.ndarray, bits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs, in portions, of documents of different clusters that may be linked.

    The traversal goes depth first in portions, so that its memory stays small.
    """
    order = np.lexsort((sizes, clusters))
    levels = _tree(sizes[order], clusters[order], bits[order])
    top = len(levels) - 1
    x, y = np.triu_indices(len(levels[top].low))
    stack = [(top, x, y)]
    while stack:
        height, x, y = stack.pop()
        x, y = _surviving(levels[height], x, y)
        if not height:
            yield order[x], order[y]
        else:
            for k in range(0, len(x), 4096):
                stack.append((height - 1, *_children(levels[height], x[k : k + 4096], y[k : k + 4096])))


def _joined(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """`label` (the smallest member of the set of each) after the sets of every x and y have become one."""
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _bit_rows(packed: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.uint64).reshape(len(packed), -1)


def _keyed_rows(batches: Iterator[pa.RecordBatch], key: tuple[str, ...], names: tuple[str, ...]):
    """The rows of each key in turn, as lists of the columns `names`, and None at the end of a batch."""
    now, held = None, []
    for batch in batches:
        for row in zip(*(batch[c].to_pylist() for c in (*key, *names))):
            if row[: len(key)] != now:
                if held:
                    yield [list(c) for c in zip(*held)]
                now, held = row[: len(key)], []
            held.append(row[len(key) :])
        yield None
    if held:
        yield [list(c) for c in zip(*held)]
    yield None


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (block, band, task): one tree each; the documents that its traversal leaves, by groups."""
    seen: set[int] = set()
    rows = {"group": [], "doc": [], "component": [], "n": []}
    for held in _keyed_rows(batches, ("block", "band", "task"), ("doc", "component", "n", "bits")):
        if held is None:
            if rows["doc"]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(v), pa.int64()) for v in rows.values()], names=list(rows)
                )
                for v in rows.values():
                    v.clear()
            continue
        docs, named, n = (np.array(c, np.int64) for c in held[:3])
        clusters = np.unique(named, return_inverse=True)[1]
        label = np.arange(len(docs))
        for x, y in tree_pairs(n, clusters, _bit_rows(held[3])):
            label = _joined(label, x, y)
        order = np.lexsort((docs, label))
        cuts = np.append(np.flatnonzero(np.diff(label[order], prepend=-1)), len(order))
        for a, b in zip(cuts, cuts[1:]):
            if b - a > 1:
                own = order[a:b]
                # the same group comes from many blocks and is one
                name = int.from_bytes(blake2b(docs[own].tobytes(), digest_size=8).digest(), "little", signed=True)
                if name not in seen:
                    if len(seen) < REMEMBERED:
                        seen.add(name)
                    for c, v in zip(rows, (np.full(b - a, name), docs[own], named[own], n[own])):
                        rows[c].append(v)


def joining_links(clusters: np.ndarray, sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """Index pairs of linked sets that join the clusters as far as links do: fewer than there are clusters."""
    sizes = np.array([len(s) for s in sets], np.int64)
    width = _width(int(sizes.max()).bit_length())
    first = np.unique(clusters, return_index=True, return_inverse=True)
    label = first[1][first[2]]
    left, right = [], []
    for x, y in tree_pairs(sizes, first[2], _bit_rows([_bitmap(s, width) for s in sets])):
        for a, b in zip(x.tolist(), y.tolist()):
            if label[a] != label[b] and linked(common(sets[a], sets[b]), sizes[a], sizes[b]):
                low, high = sorted((label[a], label[b]))
                label[label == high] = low
                left.append(a)
                right.append(b)
    return left, right


def _linked_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (group, task) with whole sets: the links that join the clusters of each."""
    left, right = [], []
    for held in _keyed_rows(batches, ("group", "task"), ("doc", "component", "hashes")):
        if held is None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"]
            )
            left, right = [], []
            continue
        sets = [np.frombuffer(h, np.uint64) for h in held[2]]
        for a, b in zip(*joining_links(np.array(held[1], np.int64), sets)):
            left.append(held[0][a])
            right.append(held[0][b])


def _hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(hashes).tobytes() for _, hashes in hashed_words(batch["text"], lower=True)]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(sets, pa.binary())], names=["doc", "hashes"])


def _tasks(rows: DataFrame, group: list[str], size: Column, limit: int) -> DataFrame:
    """Deal the rows of a group to tasks of about `limit` of `size` that meet every pair of clusters.

    Pairs inside the largest cluster need no meeting: the others are dealt to r parts, everything to
    parts of that size, and task (i, j) holds part i of the others and part j of all.
    """
    sizes = rows.groupBy(*group, "component").agg(F.sum(size).alias("m"))
    largest = written(
        sizes.groupBy(*group)
        .agg(F.max(F.struct("m", "component")).alias("top"), F.sum("m").alias("total"))
        .filter("total > top.m")
        .select(*group, F.col("top.component").alias("main"), "total", (F.col("total") - F.col("top.m")).alias("rest")),
        "block-sizes",
    )
    dealt = attach(rows, largest, group, how="inner", computed=True)
    parts = F.ceil(F.col("rest") / limit).cast("int")
    all_parts = F.ceil(F.col("total") / limit).cast("int")
    one = F.col("total") <= 2 * limit
    i, j = (F.pmod(F.xxhash64("doc", F.lit(s)), p).cast("int") for s, p in ((1, parts), (2, all_parts)))

    def named(i, j):
        return i * all_parts + j

    as_all = F.transform(F.sequence(F.lit(0), parts - 1), lambda k: named(k, j))
    as_other = F.when(
        F.col("component") != F.col("main"), F.transform(F.sequence(F.lit(0), all_parts - 1), lambda k: named(i, k))
    ).otherwise(F.array().cast("array<int>"))
    tasks = F.when(one, F.array(F.lit(0))).otherwise(F.array_union(as_all, as_other))
    return dealt.withColumn("task", F.explode(tasks)).select(*group, "task", "doc", "component", "n")


def tree_groups(docs: DataFrame, members: DataFrame) -> DataFrame:
    """group, doc, component, n: documents of different clusters that the signature trees of the blocks leave.

    `members`: block, doc, component of the blocks that hold several clusters.
    """
    ids = written(members.select(F.col("doc").alias("doc_id")).distinct(), "tree-docs")
    signatures = written(
        _by_id(docs, ids).mapInArrow(_signatures, "doc long, band int, n long, bits binary"), "signatures"
    )
    # a hot document has many blocks, a hot block many documents; neither has many of the other's rows
    rows = written(members.join(signatures.drop("bits"), "doc"), "leaves")
    key = ["block", "band", "task"]
    full = _tasks(rows, key[:2], F.lit(1), MEMBERS).join(signatures.select("doc", "band", "bits"), ["doc", "band"])
    ordered = full.select(*key, "doc", "component", "n", "bits").repartition(*key).sortWithinPartitions(*key, "doc")
    return ordered.mapInArrow(_trees, "group long, doc long, component long, n long").groupBy(
        "group", "doc"
    ).agg(F.max("component").alias("component"), F.max("n").alias("n"))


def tree_links(docs: DataFrame, members: DataFrame) -> DataFrame:
    """Links (a, b) that join the clusters of `members` as far as links do."""
    groups = written(tree_groups(docs, members), "groups")
    ids = written(groups.select(F.col("doc").alias("doc_id")).distinct(), "group-docs")
    sets = written(_by_id(docs, ids).mapInArrow(_hash_rows, "doc long, hashes binary"), "group-sets")
    key = ["group", "task"]
    full = _tasks(groups, key[:1], F.col("n"), SHINGLES).join(sets, "doc")
    ordered = full.select(*key, "doc", "component", "hashes").repartition(*key).sortWithinPartitions(*key, "doc")
    return ordered.mapInArrow(_linked_members, "a long, b long").distinct()


# --- the join ----------------------------------------------------------------------------------


def _clusters(members: DataFrame, found: DataFrame) -> DataFrame:
    """block, doc, component of the blocks whose members are not all in one component."""
    named = attach(members, found.select(F.col("id").alias("doc"), "component"), ["doc"])
    named = written(named.select("block", "doc", F.coalesce("component", "doc").alias("component")), "members")
    open_blocks = named.groupBy("block").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    return attach(named, open_blocks.filter("x <> y").select("block"), ["block"], how="inner")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row: the smallest doc_id reachable by links.

    A doc_id on several rows is one document with the links of all its rows. NULL or blank text has
    no shingle and no link: its component is itself. A row without doc_id cannot be linked; its
    component is NULL. An empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = written(shingle_sets(docs), "shingle-sets")
    filled = sets.filter("n_shingles > 0 and doc_id is not null")
    per_print = filled.groupBy("print").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.max("n_shingles").alias("n")
    )
    first = written(per_print, "copies")
    shared = written(first.filter("first <> last").select("print", "first"), "shared-prints")
    copies = written(
        attach(filled, shared, ["print"], how="inner", computed=True)
        .filter("doc_id <> first").select(F.col("doc_id").alias("a"), F.col("first").alias("b")).distinct(),
        "copy-links",
    )
    others = written(
        copies.select(F.col("a").alias("doc_id")).distinct()
        .join(first.select(F.col("first").alias("doc_id")), "doc_id", "left_anti"),
        "copy-ids",
    )
    only = _by_id(docs, others, "left_anti")
    shingles = first.agg(F.sum("n")).first()[0] or 0

    found_blocks = written(blocks(only, shingles), "blocks")
    best = found_blocks.filter("doc <> leader").groupBy("doc", "leader").agg(F.sum("weight").alias("w"))
    best = best.groupBy("doc").agg(F.max(F.struct("w", (-F.col("leader")).alias("a"))).alias("top"))
    sizes = filled.groupBy(F.col("doc_id").alias("doc")).agg(F.max("n_shingles").alias("n"))
    sized = attach(best, sizes.join(found_blocks.select("doc").distinct(), "doc"), ["doc"])
    near = sized.filter(4 * DENOMINATOR * F.col("top.w") >= (DENOMINATOR - NUMERATOR) * F.col("n"))
    stars = written(near.select((-F.col("top.a")).alias("a"), F.col("doc").alias("b")), "stars")
    links = written(compared(only, stars), "links")
    members = found_blocks.select("block", "doc").distinct()
    more = written(tree_links(only, _clusters(members, components(links))), "more-links")

    found = components(links.union(more).union(copies))
    joined = attach(sets, found.select(F.col("id").alias("doc_id"), "component"), ["doc_id"])
    return joined.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _told_apart(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """doc_id, _hash and `_key` of every text of a doc_id with several texts: a number that no other text has.

    The text with the smallest hash keeps its doc_id; the others get a hash that is nobody's doc_id.
    """
    texts = _by_id(rows, repeated, "left_semi").select("doc_id", "_hash").distinct()
    first = texts.groupBy("doc_id").agg(F.min("_hash").alias("_first"), F.count(F.lit(1)).alias("_texts"))
    texts = written(texts.join(first.filter("_texts > 1"), "doc_id"), "texts-of-ids")
    for salt in range(8):
        number = F.call_function("shiftrightunsigned", F.xxhash64("doc_id", "_hash", F.lit(salt)), F.lit(1))
        key = F.when(F.col("_hash") == F.col("_first"), F.col("doc_id")).otherwise(number)
        named = written(texts.select("doc_id", "_hash", key.alias("_key"), (key == number).alias("_new")), "text-keys")
        new = named.filter("_new").select(F.col("_key").alias("doc_id"))
        if new.count() == new.distinct().count() and _by_id(rows.select("doc_id"), new, "left_semi").isEmpty():
            return named.select("doc_id", "_hash", "_key")
    raise RuntimeError("no free numbers for texts that share a doc_id")


def one_per_component(docs: DataFrame) -> DataFrame:
    """The rows of `docs` whose doc_id is the smallest of its component, with the columns of `docs`.

    Rows that repeat a kept doc_id and its text are one document: that with the smallest hash stays. Texts
    that share a doc_id are documents of their own, compared as others are; among them the smallest hash of
    the text comes first. Rows without doc_id stay.
    """
    rows = packed(docs, "text").select(
        "_row", "_text", F.col("_row.doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.md5(F.col("_text").cast("string").cast("binary")), F.lit("")).alias("_hash"),
    )
    ids = rows.filter("doc_id is not null").groupBy("doc_id").count()
    repeated = written(ids.filter("count > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        found = written(jaccard_components(docs).select("doc_id", "component_id"), "jaccard")
        gone = written(found.filter("doc_id <> component_id").select("doc_id").distinct(), "jaccard-gone")
        return _by_id(docs, gone, "left_anti").select(*docs.columns)

    keys = _told_apart(rows, repeated)
    keyed = attach(rows, keys, ["doc_id", "_hash"], computed=True).withColumn("_key", F.coalesce("_key", "doc_id"))
    nodes = keyed.select(F.col("_key").alias("doc_id"), F.col("_text").alias("text"))
    found = written(jaccard_components(nodes).select(F.col("doc_id").alias("_key"), "component_id").distinct(), "jaccard")
    named = attach(found, keys, ["_key"], computed=True)
    order = F.struct(F.coalesce("doc_id", "_key").alias("id"), F.coalesce("_hash", F.lit("")).alias("hash"), "_key")
    heads = named.groupBy("component_id").agg(F.min(order)["_key"].alias("_head"))
    gone = written(
        attach(found, heads, ["component_id"]).filter("_key <> _head").select(F.col("_key").alias("doc_id")), "jaccard-gone"
    )
    several = written(keyed.filter("_key is not null").groupBy("_key").count().filter("count > 1").select(F.col("_key").alias("doc_id")), "repeated-texts")
    kept = _by_id(keyed.select("_row", F.col("_key").alias("doc_id")), gone, "left_anti")
    once = _by_id(kept, several, "left_anti").select("_row")
    # maps cannot be hashed
    whole = F.xxhash64(*[F.col("_row").getField(c) for c, kind in docs.dtypes if "map<" not in kind])
    again = _by_id(kept, several, "left_semi").groupBy("doc_id").agg(F.min_by("_row", whole).alias("_row")).select("_row")
    return unpacked(once.unionByName(again), docs.columns)
