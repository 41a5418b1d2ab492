"""Token counts of a byte-level BPE vocabulary by rank-synchronous array merging.

A batch of pre-tokens is one flat array of symbols with the index of each symbol's pre-token. In
every round each pre-token's lowest-ranked adjacent pair is found, all its occurrences in all
pre-tokens are merged at once, and pre-tokens without a mergeable pair leave with their number of
symbols. A vocabulary's merges are ranked in the order in which they were made, so a merge never
creates a pair of lower rank, and rounds give what one merge at a time gives.

Texts are cut before each run of blanks. A cut text is counted once per batch, and a worker
remembers the counts of up to `REMEMBERED` of them.
"""

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import _BLANK, bytes_of, text_slices

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
REMEMBERED = 400_000
# white space beyond the blanks at which texts are cut
_OTHER_SPACE = regex.compile(r"[^\S\x20\x09-\x0D]")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself when printable, else 256 and up in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class MergeTable:
    """Symbols of the bytes, and rank and result of every mergeable pair, from a tokenizer file."""

    def __init__(self, path: str):
        from public_tokenizers import PATTERN

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary = content["model"]["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in content["model"]["merges"]]
        self.size = len(vocabulary)
        self.bytes = np.array([vocabulary[c] for c in byte_characters()], np.int64)
        keys = np.array([vocabulary[a] * self.size + vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.results = np.array([vocabulary[a + b] for a, b in pairs], np.int64)  # by rank
        self.specials = [t["content"] for t in content["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) or r"(?!)")
        self.pattern = regex.compile(PATTERN)
        self.known: dict[bytes, int] = {}

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or the number of merges where there is none."""
        key = left * self.size + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], len(self.keys)).astype(np.int32)

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        """Number of symbols left of every pre-token."""
        lengths = np.array([len(p) for p in pieces], np.int64)
        out = np.zeros(len(pieces), np.int64)
        symbols = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), lengths)
        none = len(self.keys)
        while len(symbols):
            ranks = np.full(len(symbols), none, np.int32)
            pair = owner[:-1] == owner[1:]
            inside = np.flatnonzero(pair)
            ranks[inside] = self.pair_ranks(symbols[inside], symbols[inside + 1])
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            sizes = np.diff(np.append(first, len(owner)))
            lowest = np.minimum.reduceat(ranks, first)
            done = lowest == none
            out[owner[first[done]]] = sizes[done]
            hit = (ranks == np.repeat(lowest, sizes)) & (ranks < none)
            # in a run of overlapping occurrences every second one merges, from the left
            at = np.flatnonzero(hit)
            fresh = np.diff(at, prepend=-2) > 1
            start = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - start) % 2 == 0]
            symbols[at] = self.results[ranks[at]]
            keep = np.repeat(~done, sizes)
            keep[at + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return out

    def text_counts(self, texts: list[str]) -> list[int]:
        """Token counts of whole texts: special strings count one each, the rest by pre-tokens."""
        found: list[list[bytes]] = []
        totals = []
        for text in texts:
            parts = self.special.split(text)
            totals.append(len(parts) - 1)
            found.append([p.encode() for part in parts for p in self.pattern.findall(part)])
        distinct = list({p: None for pieces in found for p in pieces})
        sizes = dict(zip(distinct, self.counts(distinct).tolist())) if distinct else {}
        return [n + sum(sizes[p] for p in pieces) for n, pieces in zip(totals, found)]

    def chunk_counts(self, chunks: list[bytes]) -> np.ndarray:
        counts = [self.known.get(c, -1) for c in chunks]
        missing = [i for i, n in enumerate(counts) if n < 0]
        new = self.text_counts([chunks[i].decode() for i in missing])
        for i, n in zip(missing, new):
            counts[i] = n
            if len(self.known) < REMEMBERED:
                self.known[chunks[i]] = n
        return np.array(counts, np.int64)


_TABLES: dict[str, MergeTable] = {}  # a worker keeps its table from task to task


def _table(path: str) -> MergeTable:
    if path not in _TABLES:
        _TABLES[path] = MergeTable(path)
    return _TABLES[path]


def slice_counts(table: MergeTable, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Tokens of every row of a slice of texts."""
    blank = _BLANK[data]
    cut = blank.copy()
    cut[1:] &= ~blank[:-1]
    cut[starts[:-1][starts[:-1] < len(data)]] = True
    begin = np.flatnonzero(cut)
    offsets = np.append(begin, len(data)).astype(np.int64)
    chunks = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    ).dictionary_encode()
    sizes = table.chunk_counts(bytes_of(chunks.dictionary))
    upto = np.concatenate([[0], np.cumsum(sizes[chunks.indices.to_numpy()])]) if len(begin) else np.zeros(1, np.int64)
    rows = np.searchsorted(begin, starts)
    out = np.diff(upto[rows])
    # a special string may hold blanks, and other white space joins a run of blanks: whole text
    whole = data.tobytes()
    doubtful = [s.encode() for s in table.specials if any(c.isspace() for c in s)]
    if (data >= 0xC2).any() or ((data >= 0x1C) & (data <= 0x1F)).any() or any(s in whole for s in doubtful):
        for i, (a, b) in enumerate(zip(starts[:-1], starts[1:])):
            text = whole[a:b].decode()
            if _OTHER_SPACE.search(text) or any(s.decode() in text for s in doubtful):
                out[i] = table.text_counts([text])[0]
    return out


def _count_rows(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(path)
        for batch in batches:
            sizes, tokens = [], []
            for _, _, data, starts in text_slices(batch["text"]):
                sizes.append(np.diff(starts))
                tokens.append(slice_counts(table, data, starts))
            columns = [np.concatenate(c) if c else np.empty(0, np.int64) for c in (sizes, tokens)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *[pa.array(c, pa.int64()) for c in columns]], names=["doc_id", "n_bytes", "n_tokens"]
            )

    return run


def token_counts(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit of every row; NULL text is empty.

    No begin, end or added special token; special strings inside texts are one token each, as is the
    library's default. Repeated rows are counted each; an empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(_count_rows(tokenizer or tokenizer_path()), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
