"""Repeated passages across documents, found by a hash-compared suffix sort.

A byte is removed when a string of ``length`` bytes that covers it also starts in a
document with a smaller id. Every such string (a window) has a winnowing key: the least
hash of the ``gram``-byte strings inside it. Equal windows have equal keys, and
neighbouring windows mostly share one, so a document is a list of runs, each some 10 windows long at the defaults.

1. Keys are counted: per chunk of documents and bucket one row with the chunk's distinct
   keys, 32 bits each, and the number of its documents that hold them. A key of one document cannot repeat. (Of
   colliding keys more are taken for shared than are, which costs work, not correctness.)
2. Each chunk cuts the pieces of text that its shared runs cover, and hands on each distinct
   piece once, packed by shard, with the smallest id that has it. Runs of keys that very many
   documents share are cut into single windows, dealt by their own text, so a frequent
   phrase in ever different surroundings is spread over all shards, and a frequent window
   is one row a chunk.
3. In a shard, equal pieces are merged. Where a key has several distinct pieces, the
   suffixes of all its windows are sorted: a mergesort whose comparisons find the common extension of two suffixes
   by binary search over prefix polynomial hashes. The order is then verified byte by byte;
   should hashes ever collide, the sort is repeated with another base. Neighbours equal over the window's length share the smallest id.
4. Chunks mark the windows whose smallest id is smaller than the document's own.

Texts cross the shuffle twice, compressed by chunk: to be cut, and to be marked. Cutting is
deterministic, so a shard answers by a piece's place among those that the chunk sent it.

Defined results: null counts as empty text; texts shorter than a window lose nothing; documents
with the same id lose nothing to one another; a null id is larger than every id; repeated rows
are answered one by one; an empty table gives an empty result. A chunk holds ``chunk_bytes``
on average, and a longer text is a chunk of its own; some ten times that is the memory of a task.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.common import input_order, materialize, whole_text
from pathcredit.llm.tokens import scramble, spans

LENGTH = 50
GRAM = 32
CHUNK_BYTES = 4 << 20
SHARD_BYTES = 8 << 20
BUCKET_KEYS = 1 << 19
#: Documents from which on a key's runs are cut into single windows.
HOT = 4096
MAX_RUN = 256
_BLOCK = 1 << 17
_LAST = np.iinfo(np.int64).max
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_OF_BYTE = scramble(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)


# ------------------------------------------------------------------ keys

def gram_hashes(codes: np.ndarray, gram: int) -> np.ndarray:
    """Hash of each string of ``gram`` bytes, by doubling polynomial hashes."""
    base, part, width = 0xD1B54A32D192ED03, _OF_BYTE[codes], 1
    whole, covered = None, 0
    while True:
        if gram & width:
            if whole is None:
                whole = part
            else:
                n = len(codes) - covered - width + 1
                whole = whole[:n] * np.uint64(pow(base, width, 1 << 64)) + part[covered:covered + n]
            covered += width
        if covered == gram:
            return scramble(whole)
        part = part[:-width] * np.uint64(pow(base, width, 1 << 64)) + part[width:]
        width *= 2


def least_in_windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive values."""
    size = 1
    while 2 * size <= width:
        hashes = np.minimum(hashes[:-size], hashes[size:])
        size *= 2
    return np.minimum(hashes[:len(hashes) - (width - size)], hashes[width - size:]) if width > size else hashes


def runs(codes: np.ndarray, lengths: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(start, count, key) of the runs of windows with one key in consecutive texts; no window crosses two texts."""
    ends = np.cumsum(lengths)
    inside = np.ones(len(codes) + 1, bool)
    for end, n in zip(ends.tolist(), lengths.tolist()):
        inside[max(end - length + 1, end - n):end] = False
    found = []
    for at in range(0, len(codes) - length + 1, _BLOCK):
        part = codes[at:at + _BLOCK + length - 1]
        least = least_in_windows(gram_hashes(part, gram), length - gram + 1)
        valid = inside[at:at + len(least)]
        new = valid.copy()
        new[1:] &= (least[1:] != least[:-1]) | ~valid[:-1]
        start = np.flatnonzero(new)
        stop = np.append(np.flatnonzero(valid[:-1] & (new[1:] | ~valid[1:])) + 1, len(valid)) if valid[-1] else \
            np.flatnonzero(valid[:-1] & (new[1:] | ~valid[1:])) + 1
        count = stop - start
        if len(count) and count.max() > MAX_RUN:
            pieces = -(-count // MAX_RUN)
            nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            begin = np.repeat(start, pieces) + nth * MAX_RUN
            count = np.minimum(np.repeat(stop, pieces) - begin, MAX_RUN)
            start = begin
        found.append((start + at, count, scramble(least[start])))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _buffer(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    whole = b"".join(texts)
    return whole, np.frombuffer(whole, np.uint8), np.array([len(t) for t in texts], np.int64)


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each start, as many as its count."""
    return np.arange(counts.sum()) + np.repeat(starts - (np.cumsum(counts) - counts), counts)


def _packed(key: np.ndarray, n_buckets: int) -> np.ndarray:
    """Bucket of a key in the upper, 32 of its bits in the lower half."""
    bucket = (key >> np.uint64(32)) % np.uint64(n_buckets)
    return (bucket << np.uint64(32)) | (key & np.uint64(0xFFFFFFFF))


def _zipped(x: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(x)


def _unzipped(x: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(x)


# ------------------------------------------------------------------ chunks

def pack_chunks(chunked: DataFrame, id_type: str, chunk_bytes: int) -> DataFrame:
    """(chunk, at, ids, own, lengths, texts): the documents of a chunk in few rows, their texts compressed together."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, at, rows, size = None, 0, [], 0

        def row(schema: pa.Schema) -> pa.RecordBatch:
            ids, own, texts = zip(*rows)
            return pa.RecordBatch.from_pydict({
                "chunk": pa.array([current], pa.int64()), "at": pa.array([at], pa.int64()),
                "ids": pa.array([ids], pa.list_(schema.field("id").type)), "own": pa.array([own], pa.list_(pa.int64())),
                "lengths": pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                "texts": pa.array([_zipped(b"".join(texts))], pa.binary())})

        for batch in batches:
            for chunk, number, id_, own, text in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if rows and (chunk != current or size > 2 * chunk_bytes):
                    yield row(batch.schema)
                    rows, size = [], 0
                if not rows:
                    current, at = chunk, number
                rows.append((id_, own, text))
                size += len(text)
        if rows:
            yield row(batch.schema)
    return chunked.select("chunk", "at", "id", "own", "text").mapInArrow(
        pack, f"chunk long, at long, ids array<{id_type}>, own array<long>, lengths array<long>, texts binary")


class Chunk:
    """The documents of a chunk, always in the same order, and the windows that their texts may share with others."""

    def __init__(self, packs: pa.Table) -> None:
        packs = packs.sort_by("at")
        self.number = packs["chunk"][0].as_py()
        self.whole = b"".join(_unzipped(t) for t in packs["texts"].to_pylist())
        self.codes = np.frombuffer(self.whole, np.uint8)
        self.ids, self.own, self.lengths = (packs[c].combine_chunks().flatten() for c in ("ids", "own", "lengths"))
        self.own, self.lengths = (np.asarray(x).astype(np.int64) for x in (self.own, self.lengths))
        self.ends = np.cumsum(self.lengths)

    def cut(self, shared: pa.Table, n_buckets: int, n_shards: int, length: int, gram: int) -> None:
        """Sets the shared runs (start, count, variant, doc) and the distinct pieces (texts, size, first, route, shard)."""
        start, count, key = runs(self.codes, self.lengths, length, gram)
        rows = list(zip(shared["part"].to_pylist(), shared["a"].to_pylist(), shared["b"].to_pylist()))
        known, at = np.unique(np.concatenate([*((np.uint64(b) << np.uint64(32)) | np.frombuffer(k, np.uint32) for b, k, _ in rows),
                                              np.zeros(0, np.uint64)]), return_index=True)
        hot = np.concatenate([*(np.frombuffer(f, bool) for _, _, f in rows), np.zeros(1, bool)])[np.append(at, -1)]
        packed = _packed(key, n_buckets)
        place = np.searchsorted(known, packed)
        several = np.append(known, 0)[place] == packed
        several &= place < len(known)
        start, count, key, hot = start[several], count[several], key[several], hot[place[several]]
        if hot.any():  # cut into single windows
            each = np.where(hot, count, 1)
            start = _ranges(start, each)
            key, hot, count = (np.repeat(x, each) for x in (key, hot, np.where(hot, 1, count)))
        pieces = pa.array([self.whole[a:b] for a, b in zip(start.tolist(), (start + count + length - 1).tolist())],
                          pa.binary()).dictionary_encode()
        self.start, self.count = start, count
        self.variant = pieces.indices.to_numpy().astype(np.int64)
        self.doc = np.searchsorted(self.ends, start, side="right")
        self.texts = pieces.dictionary.to_pylist()
        n = len(self.texts)
        self.size = np.zeros(n, np.int64)
        self.size[self.variant] = count
        self.first = np.full(n, _LAST)
        np.minimum.at(self.first, self.variant, self.own[self.doc])
        self.route = np.zeros(n, np.uint64)
        self.route[self.variant] = key
        by_text = np.zeros(n, bool)
        by_text[self.variant[hot]] = True
        for i in np.flatnonzero(by_text).tolist():
            self.route[i] = xxhash.xxh64_intdigest(self.texts[i])
        self.shard = ((self.route >> np.uint64(16)) % np.uint64(n_shards)).astype(np.int64)

    def shards(self) -> Iterator[tuple[int, np.ndarray]]:
        """(shard, its distinct pieces in a fixed order)."""
        order = np.argsort(self.shard, kind="stable")
        found, at = np.unique(self.shard[order], return_index=True)
        for shard, part in zip(found.tolist(), np.split(order, at[1:])):
            yield shard, part


def count_keys(packs: DataFrame, n_buckets: int, length: int, gram: int) -> DataFrame:
    """(bucket, chunk, keys, docs): 32 bits of a chunk's distinct keys, and how many documents (255: or more) hold each."""
    def counted(row: pa.RecordBatch) -> pa.RecordBatch:
        chunk = Chunk(pa.Table.from_batches([row]))
        start, _, key = runs(chunk.codes, chunk.lengths, length, gram)
        doc = np.searchsorted(chunk.ends, start, side="right")
        packed = _packed(key, n_buckets)
        order = np.lexsort((doc, packed))
        packed, doc = packed[order], doc[order]
        new = np.ones(len(packed), bool)
        new[1:] = packed[1:] != packed[:-1]
        more = new.copy()
        more[1:] |= doc[1:] != doc[:-1]
        at = np.flatnonzero(new)
        docs = np.minimum(np.add.reduceat(more, at, dtype=np.int64), 255).astype(np.uint8) if len(at) else np.zeros(0, np.uint8)
        packed = packed[at]
        of, where = np.unique(packed >> np.uint64(32), return_index=True)
        edges = [*where.tolist(), len(packed)]
        low = packed.astype(np.uint32)
        return pa.RecordBatch.from_pydict({
            "bucket": pa.array(of.astype(np.int32)), "chunk": np.full(len(of), chunk.number, np.int64),
            "keys": pa.array([low[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary()),
            "docs": pa.array([docs[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield counted(batch.slice(i, 1))
    return packs.mapInArrow(count, "bucket int, chunk long, keys binary, docs binary")


def shared_keys(counts: DataFrame, hot: int) -> DataFrame:
    """(chunk, part, a, b): the chunk's keys ``a`` of bucket ``part`` that several documents hold, and whether over ``hot`` do."""
    def shared(key: tuple, table: pa.Table) -> pa.Table:
        rows = [(np.frombuffer(k, np.uint32), np.frombuffer(d, np.uint8)) for k, d in
                zip(table["keys"].to_pylist(), table["docs"].to_pylist())]
        keys, docs = (np.concatenate(x) for x in zip(*rows))
        found, inverse = np.unique(keys, return_inverse=True)
        total = np.bincount(inverse, docs, len(found))[inverse]
        out, at = [], 0
        for chunk, (k, _) in zip(table["chunk"].to_pylist(), rows):
            sums = total[at:at + len(k)]
            at += len(k)
            if (several := sums > 1).any():
                out.append((chunk, k[several].tobytes(), (sums[several] > hot).tobytes()))
        chunks, kept, flags = zip(*out) if out else ((), (), ())
        return pa.table({"chunk": pa.array(chunks, pa.int64()), "part": pa.array([key[0].as_py()] * len(out), pa.int32()),
                         "a": pa.array(kept, pa.binary()), "b": pa.array(flags, pa.binary())})
    return counts.groupBy("bucket").applyInArrow(shared, "chunk long, part int, a binary, b binary")


# ------------------------------------------------------------------ pieces

def cut_pieces(packs: DataFrame, shared: DataFrame, n_buckets: int, n_shards: int, length: int, gram: int) -> DataFrame:
    """(shard, chunk, routes, firsts, sizes, pieces): a chunk's distinct shared pieces, each with the smallest id that has it."""
    def cut(texts: pa.Table, keys: pa.Table) -> pa.Table:
        chunk = Chunk(texts)
        chunk.cut(keys, n_buckets, n_shards, length, gram)
        rows = [(shard, chunk.route[part].tobytes(), chunk.first[part].tobytes(), chunk.size[part].astype(np.int16).tobytes(),
                 _zipped(b"".join(chunk.texts[i] for i in part.tolist()))) for shard, part in chunk.shards()]
        columns = zip(*rows) if rows else [()] * 5
        shards, *parts = (pa.array(c, t) for c, t in zip(columns, [pa.int32()] + [pa.binary()] * 4))
        return pa.table({"shard": shards, "chunk": pa.array([chunk.number] * len(rows), pa.int64()),
                         **dict(zip(("routes", "firsts", "sizes", "pieces"), parts))})
    return packs.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(
        cut, "shard int, chunk long, routes binary, firsts binary, sizes binary, pieces binary")


# ------------------------------------------------------------------ suffix sort

class Suffixes:
    """Suffixes of a text, compared over ``length`` bytes through prefix polynomial hashes."""

    def __init__(self, codes: np.ndarray, length: int, base: int) -> None:
        self.codes, self.length = codes, length
        n = len(codes) + 1
        powers = np.full(n, np.uint64(base))
        powers[0] = 1
        powers = np.cumprod(powers)
        back = np.full(n, np.uint64(pow(base, -1, 1 << 64)))
        back[0] = 1
        self.back = np.cumprod(back)  # base ** -i
        self.prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_OF_BYTE[codes] * powers[:-1])])
        self.head = np.zeros(len(codes), np.uint64)  # the suffix's first eight bytes
        padded = np.concatenate([codes, np.zeros(8, np.uint8)]).astype(np.uint64)
        for k in range(8):
            self.head = (self.head << np.uint64(8)) | padded[k:k + len(codes)]

    def hashes(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        return (self.prefix[at + n] - self.prefix[at]) * self.back[at]

    def extension(self, x: np.ndarray, y: np.ndarray, low: int) -> np.ndarray:
        """Length of the common beginning of suffixes, at least ``low``, at most ``length``: a binary search."""
        low, high = np.full(len(x), low), np.full(len(x), self.length)
        while (low < high).any():
            mid = (low + high + 1) >> 1
            same = self.hashes(x, mid) == self.hashes(y, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def less(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        a, b = self.head[x], self.head[y]
        out = a < b
        tied = np.flatnonzero(a == b)
        if len(tied) and self.length > 8:
            x, y = x[tied], y[tied]
            n = self.extension(x, y, 8)
            inside = n < self.length
            n = np.minimum(n, self.length - 1)
            out[tied] = inside & (self.codes[x + n] < self.codes[y + n])
        return out

    def sort(self, starts: np.ndarray) -> np.ndarray | None:
        """``starts`` in the order of their suffixes: a mergesort, all merges of a round at once.

        Every element of a left run finds its place in the right run by binary search. None
        when two find the same place, which only colliding hashes bring about.
        """
        order, size, n = starts.copy(), 1, len(starts)
        while size < n:
            at = np.arange(n)
            left = (at // size) % 2 == 0
            mine = at[left]
            begin = np.minimum((mine // size + 1) * size, n)
            low, high = begin.copy(), np.minimum(begin + size, n)
            open_ = np.flatnonzero(low < high)
            while len(open_):
                mid = (low[open_] + high[open_]) >> 1
                smaller = self.less(order[mid], order[mine[open_]])
                low[open_] = np.where(smaller, mid + 1, low[open_])
                high[open_] = np.where(smaller, high[open_], mid)
                open_ = open_[low[open_] < high[open_]]
            place = mine + (low - begin)
            merged, free = np.empty_like(order), np.ones(n, bool)
            merged[place] = order[mine]
            free[place] = False
            if free.sum() != n - len(mine):
                return None
            merged[free] = order[~left]
            order, size = merged, 2 * size
        return order

    def verified(self, order: np.ndarray) -> np.ndarray | None:
        """Whether each suffix equals the one before it, by their bytes; None when the order is wrong."""
        same = np.zeros(len(order), bool)
        steps = np.arange(self.length)
        for at in range(1, len(order), 1 << 14):
            here = order[at:at + (1 << 14)]
            a, b = self.codes[order[at - 1:at - 1 + len(here), None] + steps], self.codes[here[:, None] + steps]
            differs = a != b
            where = differs.argmax(1)
            row = np.arange(len(here))
            any_ = differs[row, where]
            if (any_ & (a[row, where] > b[row, where])).any():
                return None
            same[at:at + len(here)] = ~any_
        return same


def equal_windows(codes: np.ndarray, starts: np.ndarray, length: int, bases: Iterator[int] | None = None) -> np.ndarray:
    """A class for each start, equal when the ``length`` bytes there are equal."""
    if not len(starts):
        return np.zeros(0, np.int64)
    bases = bases or (int(scramble(np.array([k], np.uint64))[0]) | 1 for k in range(77, 1 << 30))
    for base in bases:
        suffixes = Suffixes(codes, length, base)
        order = suffixes.sort(starts)
        same = None if order is None else suffixes.verified(order)
        if same is not None:
            break
    classes = np.empty(len(starts), np.int64)
    back = np.empty(len(codes), np.int64)
    back[starts] = np.arange(len(starts))
    classes[back[order]] = np.cumsum(~same)
    return classes - 1


#: What a shard answers for a piece: its first id is that of the chunk; one other for all windows; one for each window.
_SAME, _ONE, _EACH = 0, 1, 2


def first_owners(pieces: DataFrame, length: int) -> DataFrame:
    """(chunk, part, a, b): for a chunk's pieces in shard ``part`` kinds ``a`` of answers, and the smallest ids ``b``."""
    def search(key: tuple, table: pa.Table) -> pa.Table:
        own, route, size, texts, n_pieces = [], [], [], [], []
        for routes, firsts, sizes, packed in zip(*(table[c].to_pylist() for c in ("routes", "firsts", "sizes", "pieces"))):
            route.append(np.frombuffer(routes, np.uint64))
            own.append(np.frombuffer(firsts, np.int64))
            size.append(np.frombuffer(sizes, np.int16).astype(np.int64))
            n_pieces.append(len(size[-1]))
            whole, ends = _unzipped(packed), np.cumsum(size[-1] + length - 1).tolist()
            texts += [whole[a:b] for a, b in zip([0, *ends], ends)]
        own, route, size = np.concatenate(own), np.concatenate(route), np.concatenate(size)
        encoded = pa.array(texts, pa.binary()).dictionary_encode()
        piece = encoded.indices.to_numpy().astype(np.int64)
        texts = encoded.dictionary.to_pylist()
        n = len(texts)
        first, counts, of_key = np.full(n, _LAST), np.zeros(n, np.int64), np.zeros(n, np.uint64)
        np.minimum.at(first, piece, own)
        counts[piece], of_key[piece] = size, route
        _, group, kinds = np.unique(of_key, return_inverse=True, return_counts=True)
        # Only keys with several distinct pieces hold windows that equal windows of another piece.
        mixed = np.flatnonzero(kinds[group] > 1)
        at = np.cumsum(counts) - counts
        firsts = np.repeat(first, counts)
        if len(mixed):
            codes = np.frombuffer(b"".join(texts[i] for i in mixed.tolist()), np.uint8)
            long = counts[mixed] + length - 1
            same = equal_windows(codes, _ranges(np.cumsum(long) - long, counts[mixed]), length)
            where = _ranges(at[mixed], counts[mixed])
            least = np.full(same.max() + 1, _LAST)
            np.minimum.at(least, same, firsts[where])
            firsts[where] = least[same]
        low, high = np.minimum.reduceat(firsts, at), np.maximum.reduceat(firsts, at)
        kind = np.where(low[piece] < high[piece], _EACH, np.where(low[piece] == own, _SAME, _ONE)).astype(np.uint8)
        edges = np.append(0, np.cumsum(n_pieces)).tolist()
        kinds, values = [], []
        for a, b in zip(edges, edges[1:]):
            answered = piece[a:b][kind[a:b] != _SAME]
            many = np.where(kind[a:b][kind[a:b] != _SAME] == _EACH, counts[answered], 1)
            kinds.append(_zipped(kind[a:b].tobytes()))
            values.append(_zipped(firsts[_ranges(at[answered], many)].tobytes()))
        return pa.table({"chunk": table["chunk"], "part": table["shard"], "a": pa.array(kinds, pa.binary()),
                         "b": pa.array(values, pa.binary())})
    return pieces.groupBy("shard").applyInArrow(search, "chunk long, part int, a binary, b binary")


# ------------------------------------------------------------------ removal

def removed_spans(packs: DataFrame, found: DataFrame, id_type: str, n_buckets: int, n_shards: int, length: int,
                  gram: int) -> DataFrame:
    """(id, n_bytes, n_removed, removed, kept_sha256): ``removed`` lists [from, to) of the removed runs.

    ``found`` are the rows of :func:`shared_keys` (kind 0) and :func:`first_owners` (kind 1).
    """
    def mark(texts: pa.Table, rows: pa.Table) -> pa.Table:
        chunk = Chunk(texts)
        chunk.cut(rows.filter(pc.equal(rows["kind"], 0)), n_buckets, n_shards, length, gram)
        at = np.cumsum(chunk.size) - chunk.size
        firsts = np.repeat(chunk.first, chunk.size)
        answers = rows.filter(pc.equal(rows["kind"], 1))
        answers = dict(zip(answers["part"].to_pylist(), zip(answers["a"].to_pylist(), answers["b"].to_pylist())))
        for shard, part in chunk.shards():
            kind, value = (np.frombuffer(_unzipped(x), t) for x, t in zip(answers[shard], (np.uint8, np.int64)))
            part, kind = part[kind != _SAME], kind[kind != _SAME]
            many = np.where(kind == _EACH, chunk.size[part], 1)
            repeats = np.where(kind == _ONE, chunk.size[part], 1)
            firsts[_ranges(at[part], chunk.size[part])] = np.repeat(value, np.repeat(repeats, many))
        covered = firsts[_ranges(at[chunk.variant], chunk.count)] < np.repeat(chunk.own[chunk.doc], chunk.count)
        window = _ranges(chunk.start, chunk.count)[covered]
        change = np.zeros(len(chunk.codes) + 1, np.int16)  # no byte lies in more than ``length`` windows
        change[window] += 1
        change[window + length] -= 1
        gone = np.cumsum(change[:-1], dtype=np.int16) > 0
        gone = np.append(gone, False)
        removed, hashes, taken = [], [], []
        for end, n in zip(chunk.ends.tolist(), chunk.lengths.tolist()):
            mine = gone[end - n:end]
            starts, ends = spans(mine) if n and mine.any() else ((), ())
            removed.append([{"from": int(x), "to": int(y)} for x, y in zip(starts, ends)])
            taken.append(sum(x["to"] - x["from"] for x in removed[-1]))
            kept = chunk.codes[end - n:end]
            hashes.append(hashlib.sha256(kept[~mine] if removed[-1] else kept).hexdigest())
        span = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
        return pa.table({"id": chunk.ids, "n_bytes": chunk.lengths, "n_removed": pa.array(taken, pa.int64()),
                         "removed": pa.array(removed, span), "kept_sha256": pa.array(hashes, pa.string())})
    return packs.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(
        mark, f"id {id_type}, n_bytes long, n_removed long, removed array<struct<from:long,to:long>>, kept_sha256 string")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                      gram: int = GRAM, chunk_bytes: int = CHUNK_BYTES, shard_bytes: int = SHARD_BYTES,
                      hot: int = HOT) -> DataFrame:
    """(id, n_bytes, n_removed, removed, kept_sha256) for every row of ``docs``.

    ``removed`` lists the maximal removed runs as byte ranges [from, to) of the UTF-8 text; ids are whole numbers.
    """
    if not 0 < gram <= length <= 1 << 14:
        raise ValueError("0 < gram <= length <= 16384 is needed")
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    narrow = docs if input_order(docs) else materialize(docs.select(id_col, text_col))
    name, number = input_order(narrow)
    text = whole_text(text_col).cast("binary")
    sizes = narrow.select(F.octet_length(text).alias("n"), name.alias("file"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("bytes"), F.count("*").alias("rows")).first()
    together = max(1, int(chunk_bytes * max(total["rows"], 1) / max(total["bytes"], 1)))
    long_text = F.octet_length(text) > chunk_bytes // 16
    chunk = F.when(long_text, F.xxhash64(name, number, F.lit(1))).otherwise(F.xxhash64(name, F.floor(number / together)))
    chunked = narrow.select(chunk.alias("chunk"), number.alias("at"), F.col(id_col).alias("id"),
                            F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("own"), text.alias("text"))
    packs = pack_chunks(chunked, id_type, chunk_bytes)
    n_buckets = max(8, math.ceil(total["bytes"] / ((length - gram) / 2 + 1) / BUCKET_KEYS))
    shared = materialize(shared_keys(count_keys(packs, n_buckets, length, gram), hot))
    n_keys = shared.agg(F.coalesce(F.sum(F.octet_length("b")), F.lit(0))).first()[0]
    n_shards = max(8, math.ceil(n_keys * (length + (length - gram) / 2) / shard_bytes))
    answers = first_owners(cut_pieces(packs, shared, n_buckets, n_shards, length, gram), length)
    found = shared.withColumn("kind", F.lit(0)).unionByName(answers.withColumn("kind", F.lit(1)))
    return removed_spans(packs, found, id_type, n_buckets, n_shards, length, gram).withColumnRenamed("id", id_col)
