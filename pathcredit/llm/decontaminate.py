"""Benchmark decontamination: short test items found inside long documents.

Containment of an item's word shingles in a document decides, so a document's
length must not matter. Items are partitioned by size (number of distinct
shingles, in powers of two), and every item gets a MinHash sketch: its bottom-k
shingle hashes, with k set by its partition's largest size u and the threshold t
as floor((1 - t) u) + 1. A document that contains the share t of an item misses
at most (1 - t) u of its shingles, so it holds one of those k: a document's
candidates are the items of whose sketch it holds a hash, and none is missed at
any document length. (Banded MinHash signatures of whole documents lose short
items in long documents: the Jaccard similarity of 30 shingles to 20,000 is
0.0015.) Candidates are then verified by exact containment, on the shingles'
words, not their hashes.

Documents are read once for every block of items of bounded size, the block's
sketches going to all tasks; there is no shuffle of text and no cap on matches.

Words are runs of 0-9, a-z and non-ASCII characters after lower-casing A-Z;
shingles have five words, those of an item with fewer words are its whole
sequence.

Defined results: null texts count as empty, items without words match nothing;
repeated documents and items are answered one by one; an empty table on either
side gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.common import materialize, whole_text
from pathcredit.llm.tokens import combine, hash_segments, spans

SHINGLE = 5
THRESHOLD = 0.8
#: Bytes of item text that one pass over the documents carries.
BLOCK_BYTES = 8 << 20
PIECE = 1 << 20
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


def shingles_of(words: list[bytes], n: int = SHINGLE) -> set[bytes]:
    """Distinct shingles, words joined by a space; fewer words than ``n``: the whole sequence."""
    if not words:
        return set()
    return {b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))}


def word_hashes(text: bytes) -> np.ndarray:
    """Hash of every word of a lower-cased text."""
    codes = np.frombuffer(text, np.uint8)
    inside = _IS_WORD[codes]
    starts, ends = spans(inside)
    return hash_segments(codes[inside], ends - starts)


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    h = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        h = combine(h, words[i:len(words) - n + 1 + i])
    return h


class ItemBlock:
    """Sketches and shingles of a block of items."""

    def __init__(self, items: list[tuple[int, bytes]], n: int, threshold: float) -> None:
        self.n, self.threshold = n, threshold
        self.shingles: dict[int, set[bytes]] = {}
        sketches: dict[int, dict[int, list[int]]] = {}  # words in a shingle -> hash -> items
        for number, text in items:
            words = words_of(text)
            found = shingles_of(words, n)
            if not found:
                continue
            self.shingles[number] = found
            length = min(n, len(words))
            hashes = np.unique(shingle_hashes(word_hashes(text.lower()), length))
            largest = 1 << (len(found) - 1).bit_length()  # of the size partition (2**i, 2**(i+1)]
            k = int((1 - threshold) * largest + 1e-9) + 1
            for h in hashes[:k].tolist():
                sketches.setdefault(length, {}).setdefault(h, []).append(number)
        self.sketches = {length: (np.array(sorted(s), np.uint64), s) for length, s in sketches.items()}
        self.holders: dict[bytes, list[int]] = {}
        for number, found in self.shingles.items():
            for s in found:
                self.holders.setdefault(s, []).append(number)

    def candidates(self, text: bytes) -> set[int]:
        """Items of whose sketch the lower-cased text holds a hash; read in pieces that overlap."""
        out: set[int] = set()
        for piece in _pieces(text, self.n):
            words = word_hashes(piece)
            for length, (keys, items) in self.sketches.items():
                h = shingle_hashes(words, length)
                at = np.searchsorted(keys, h)
                at[at == len(keys)] = 0
                for key in np.unique(h[keys[at] == h]).tolist() if len(keys) else ():
                    out.update(items[key])
        return out

    def matches(self, text: bytes) -> list[tuple[int, int, int]]:
        """(item, shingles found, shingles) of every item contained at the threshold, verified exactly."""
        lower = text.lower()
        candidates = self.candidates(lower)
        if not candidates:
            return []
        found: dict[int, set[bytes]] = {c: set() for c in candidates}
        for length in {min(self.n, min(len(s.split()) for s in self.shingles[c])) for c in candidates}:
            for piece in _pieces(lower, self.n):
                words = _WORD.findall(piece)
                for i in range(len(words) - length + 1):
                    s = b" ".join(words[i:i + length])
                    for item in self.holders.get(s, ()):
                        if item in found:
                            found[item].add(s)
        return [(c, len(f), len(self.shingles[c])) for c, f in sorted(found.items())
                if len(f) >= self.threshold * len(self.shingles[c]) - 1e-9]


def _pieces(text: bytes, n: int) -> Iterator[bytes]:
    """Pieces of about PIECE bytes, cut between words, each overlapping the next by ``n - 1`` words."""
    at, size = 0, PIECE
    while at + size < len(text):
        tail = _WORD.match(text, at + size)
        end = tail.end() if tail and _IS_WORD[text[at + size - 1]] else at + size
        back = end
        for _ in range(n - 1):  # go back over n - 1 words
            while back > at and not _IS_WORD[text[back - 1]]:
                back -= 1
            while back > at and _IS_WORD[text[back - 1]]:
                back -= 1
        if back == at:  # fewer than n words: take a longer piece
            size *= 2
            continue
        yield text[at:end]
        at, size = back, PIECE
    yield text[at:]


def contained_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text", shingle: int = SHINGLE,
                    threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, item, found, shingles, containment): one row per document and item that it contains."""
    items = _numbered(benchmark, item_col, item_text_col)
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("id"), whole_text(text_col).cast("binary").alias("text"))
    schema = f"id {id_type}, number long, found int, shingles int"

    def search(block: ItemBlock):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, found = [], []
                for at, text in enumerate(batch.column(1)):
                    for match in block.matches(text.as_py()):
                        rows.append(at)
                        found.append(match)
                take = pa.array(rows, pa.int64())
                columns = list(zip(*found)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), pa.array(columns[0], pa.int64()),
                     pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32())],
                    ["id", "number", "found", "shingles"])
        return run

    passes = [materialize(narrow.mapInArrow(search(ItemBlock(block, shingle, threshold)), schema))
              for block in _blocks(items, block_bytes)]
    hits = passes[0]
    for p in passes[1:]:
        hits = hits.unionByName(p)
    return hits.join(items.select("number", "item"), "number").select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), "found", "shingles",
        (F.col("found") / F.col("shingles")).alias("containment"))


def _numbered(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    items = benchmark.select(F.col(item_col).alias("item"), whole_text(text_col).cast("binary").alias("text"))
    return materialize(items.withColumn("number", F.monotonically_increasing_id()))


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, bytes]]]:
    """The items, some at a time: never more than ``block_bytes`` of text (or one item) on the driver."""
    block, size = [], 0
    for r in items.select("number", "text").toLocalIterator():
        if block and size + len(r["text"]) > block_bytes:
            yield block
            block, size = [], 0
        block.append((r["number"], bytes(r["text"])))
        size += len(r["text"])
    yield block


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                    item_text_col: str = "text", shingle: int = SHINGLE, threshold: float = THRESHOLD,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that contain no item, all columns kept; nothing is shuffled."""
    def clean(block: ItemBlock):
        @F.pandas_udf("boolean")
        def is_clean(texts: pd.Series) -> pd.Series:
            return pd.Series([not block.matches(bytes(t)) for t in texts], dtype=bool)
        return is_clean

    left, first = docs, True
    for block in _blocks(_numbered(benchmark, item_col, item_text_col), block_bytes):
        left = left if first else materialize(left)  # so the driver holds one block at a time
        left = left.where(clean(ItemBlock(block, shingle, threshold))(whole_text(text_col).cast("binary")))
        first = False
    return left
