"""Token ids in patched frame-of-reference blocks: written in doc_id order and read back.

A file row is a segment: the ids of consecutive whole documents, about `SEGMENT_IDS` of them, with
the documents' ids and lengths as its index. The payload has one block per `BLOCK_IDS` ids:

    header   minimum uint32, bits uint8, exceptions uint16
    body     (id - minimum) mod 2**bits of every id, `bits` bits each, least significant first
    patches  position uint16 and (id - minimum) uint32 of every id that needs more bits

`bits` is the width that holds `PERCENT` percent of the block's differences. `block_starts` has the
byte offset of every block, so that any block can be read alone.

Segments are rows of Parquet files, because those are committed whole by any file system that Spark
writes to: a task that is run again leaves no torn file. Rows are range-partitioned and sorted by doc_id,
and documents of one doc_id by a hash of their text, so equal ids do not fill one task.
"""

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.attach import attach
from .arrays import _BLANK, bytes_of, text_slices, word_bounds

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
SEGMENT_IDS = 1 << 16
BLOCK_IDS = 256
PERCENT = 95
# words whose ids a worker remembers, and bytes of text in which equal words are looked up once
REMEMBERED = 600_000
PORTION_BYTES = 4 << 20
# pieces of these letters are encoded so many at a time
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
JOINED = 1000
WORD_END = "</w>"
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:!?")] = True

_HEADER = np.dtype([("minimum", "<u4"), ("bits", "u1"), ("patches", "<u2")])
_PATCH = np.dtype([("position", "<u2"), ("value", "<u4")])
SEGMENT_SCHEMA = (
    "shard int, segment int, start long, n_ids long, doc_ids array<long>, lengths array<long>, "
    "block_starts binary, payload binary"
)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# --- blocks ------------------------------------------------------------------------------------


def _packed(values: np.ndarray, bits: int) -> np.ndarray:
    """Rows of numbers, the low `bits` of each, as rows of bytes."""
    whole = values.astype("<u2" if bits <= 16 else "<u4")
    marks = np.unpackbits(whole.view(np.uint8).reshape(*whole.shape, -1), axis=2, bitorder="little")
    return np.packbits(marks[:, :, :bits].reshape(len(values), -1), axis=1, bitorder="little")


def _unpacked(rows: np.ndarray, bits: int) -> np.ndarray:
    kind = np.dtype("<u2" if bits <= 16 else "<u4")
    marks = np.zeros((len(rows), BLOCK_IDS, kind.itemsize * 8), np.uint8)
    marks[:, :, :bits] = np.unpackbits(rows, axis=1, bitorder="little", count=BLOCK_IDS * bits).reshape(
        len(rows), BLOCK_IDS, bits
    )
    return np.packbits(marks, axis=2, bitorder="little").view(kind)[:, :, 0]


def encode_blocks(ids: np.ndarray) -> tuple[bytes, bytes]:
    """(block starts, payload) of unsigned 32-bit ids; the last block is filled up with its last id."""
    if not len(ids):
        return b"", b""
    blocks = -(-len(ids) // BLOCK_IDS)
    full = np.pad(ids.astype(np.uint32), (0, blocks * BLOCK_IDS - len(ids)), "edge").reshape(blocks, BLOCK_IDS)
    minimum = full.min(axis=1)
    differences = full - minimum[:, None]
    place = -(-PERCENT * BLOCK_IDS // 100) - 1
    chosen = np.partition(differences, place, axis=1)[:, place]
    bits = np.ceil(np.log2(chosen.astype(np.float64) + 1)).astype(np.int64)
    late = differences.astype(np.uint64) >> bits[:, None].astype(np.uint64) > 0
    headers = np.empty(blocks, _HEADER)
    headers["minimum"], headers["bits"], headers["patches"] = minimum, bits, late.sum(axis=1)
    row, position = np.nonzero(late)
    patches = np.empty(len(row), _PATCH)
    patches["position"], patches["value"] = position, differences[row, position]
    head, tail = headers.tobytes(), patches.tobytes()
    ends = np.cumsum(headers["patches"].astype(np.int64)) * _PATCH.itemsize
    begins = (ends - headers["patches"].astype(np.int64) * _PATCH.itemsize).tolist()
    pieces: list[bytes] = [b""] * blocks
    for width in np.unique(bits).tolist():
        rows = np.flatnonzero(bits == width)
        body, size = _packed(differences[rows], width).tobytes(), BLOCK_IDS * width // 8
        for k, i in enumerate(rows.tolist()):
            header = head[i * _HEADER.itemsize : (i + 1) * _HEADER.itemsize]
            pieces[i] = header + body[k * size : (k + 1) * size] + tail[begins[i] : ends[i]]
    starts = np.cumsum([0, *map(len, pieces[:-1])]).astype("<u4")
    return starts.tobytes(), b"".join(pieces)


def decode_blocks(block_starts: bytes, payload: bytes, n_ids: int) -> np.ndarray:
    starts = np.frombuffer(block_starts, "<u4").astype(np.int64)
    data = np.frombuffer(payload, np.uint8)
    if not len(starts):
        return np.empty(0, np.uint32)
    headers = data[starts[:, None] + np.arange(_HEADER.itemsize)].copy().view(_HEADER)[:, 0]
    bits = headers["bits"].astype(np.int64)
    out = np.zeros((len(starts), BLOCK_IDS), np.uint32)
    for width in np.unique(bits[bits > 0]):
        rows = np.flatnonzero(bits == width)
        at = starts[rows, None] + _HEADER.itemsize + np.arange(BLOCK_IDS * width // 8)
        out[rows] = _unpacked(data[at], int(width))
    count = headers["patches"].astype(np.int64)
    row = np.repeat(np.arange(len(starts)), count)
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = (starts + _HEADER.itemsize + BLOCK_IDS * bits // 8)[row] + inside * _PATCH.itemsize
    patches = data[at[:, None] + np.arange(_PATCH.itemsize)].copy().view(_PATCH)[:, 0]
    out[row, patches["position"]] = patches["value"]
    return (out + headers["minimum"][:, None]).reshape(-1)[:n_ids]


# --- encoding ----------------------------------------------------------------------------------


def _with_cuts(places: np.ndarray, cuts: np.ndarray, size: int) -> np.ndarray:
    marks = np.zeros(size + 1, bool)
    marks[places] = marks[cuts] = True
    return np.flatnonzero(marks)


class WordEncoder:
    """Token ids of texts through those of their words.

    This tokenizer drops white space before it splits a text, and parts letters from punctuation. So
    no token spans two words, or a letter and a full stop after it, and a text's ids are those of
    such pieces in a row. Pieces of plain letters are encoded many at a time: each ends with the one
    token that ends a word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallel unit
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True

    def _encode(self, pieces: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in encoded]

    def _encode_letters(self, pieces: list[str]) -> list[bytes]:
        out = []
        for k in range(0, len(pieces), JOINED):
            some = pieces[k : k + JOINED]
            ids = np.frombuffer(self._encode([" ".join(some)])[0], np.uint32)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(some):
                raise ValueError("this tokenizer does not end each word of letters with one token")
            out += [ids[a:b].tobytes() for a, b in zip([0, *ends], ends)]
        return out

    def _piece_ids(self, pieces: list[bytes]) -> list[bytes]:
        found = [self.known.get(p) for p in pieces]
        new = [(i, pieces[i].decode()) for i, ids in enumerate(found) if ids is None]
        for letters, encode in ((True, self._encode_letters), (False, self._encode)):
            some = [(i, p) for i, p in new if bool(LETTERS.fullmatch(p)) is letters]
            for (i, _), ids in zip(some, encode([p for _, p in some])):
                found[i] = ids
                if len(self.known) < REMEMBERED:
                    self.known[pieces[i]] = ids
        return found

    def slices(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids, number of ids of each row) for portions of the texts; NULL has none."""
        for first, end, data, starts in text_slices(texts, PORTION_BYTES):
            begin, stop, _ = word_bounds(data, starts)
            cuts = np.flatnonzero(_STOP[data[1:]] & _LETTER[data[:-1]]) + 1
            begin, stop = _with_cuts(begin, cuts, len(data)), _with_cuts(stop, cuts, len(data))
            rows = np.searchsorted(begin, starts)
            lengths = stop - begin
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
            joined = data[~_BLANK[data]]  # the words, one behind the other
            words = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(joined)]
            ).dictionary_encode()
            known = self._piece_ids(bytes_of(words.dictionary))
            flat = np.frombuffer(b"".join(known), np.uint32)
            sizes = np.array([len(k) // 4 for k in known], np.int64)
            which = words.indices.to_numpy()
            count = sizes[which] if len(which) else np.empty(0, np.int64)
            upto = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
            at = np.repeat((np.cumsum(sizes) - sizes)[which] - upto[:-1], count)
            at += np.arange(upto[-1])
            yield first, flat[at], np.diff(upto[rows])


_ENCODERS: dict[str, WordEncoder] = {}  # a worker keeps its words from task to task


def _encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _segments(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, segment, start = TaskContext.get().partitionId(), 0, 0
        docs, lengths, held, size = [], [], [], 0
        encoder = _encoder(path)

        def flush():
            block_starts, payload = encode_blocks(np.concatenate(held))
            row = [shard, segment, start, size, docs, lengths, block_starts, payload]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()),
                     pa.binary(), pa.binary()]
            names = [c.split()[0] for c in SEGMENT_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            for first, tokens, counts in encoder.slices(batch["text"]):
                ends = np.cumsum(counts)
                for k, (end, n) in enumerate(zip(ends, counts)):
                    docs.append(ids[first + k])
                    lengths.append(int(n) + 1)
                    held += [tokens[end - n : end], np.array([END_ID], np.uint32)]
                    size += int(n) + 1
                    if size >= SEGMENT_IDS:
                        yield flush()
                        segment, start = segment + 1, start + size
                        docs, lengths, held, size = [], [], [], 0
        if docs:
            yield flush()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None) -> None:
    """Write the ids of every document, each with END_ID after it, in ascending doc_id order (NULL first)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("_tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select("doc_id", "text")
    rows.mapInArrow(_segments(tokenizer or tokenizer_path()), SEGMENT_SCHEMA).write.parquet(path)


# --- reading -----------------------------------------------------------------------------------


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            lengths = np.array(row["lengths"], np.int64)
            ends = np.cumsum(lengths)
            ids = decode_blocks(row["block_starts"], row["payload"], row["n_ids"]).astype("<u4")
            yield pa.RecordBatch.from_arrays([
                pa.array([row["shard"]] * len(lengths), pa.int32()),
                pa.array(row["doc_ids"], pa.int64()),
                pa.array(row["start"] + ends - lengths, pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array([ids[e - n : e].tobytes() for e, n in zip(ends, lengths)], pa.binary()),
            ], names=["shard", "doc_id", "start", "n_tokens", "ids"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32 bits)."""
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    sizes = segments.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    # one row per file shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    rows = segments.mapInArrow(_documents, "shard int, doc_id long, start long, n_tokens long, ids binary")
    return attach(rows, offsets, ["shard"]).select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids"
    )


def token_digest(docs: DataFrame, path: str) -> DataFrame:
    """Write `docs` to `path`, read the files back: doc_id, start, n_tokens, ids_crc32, one row per row of `docs`.

    NULL or blank text is the end id alone. Rows of one doc_id follow each other. An empty table
    gives files without segments and an empty result.
    """
    write_tokens(docs, path)
    found = read_tokens(docs.sparkSession, path)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
