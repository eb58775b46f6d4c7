"""Repeated passages: brute force over windows, hot phrases, hash collisions, odd inputs."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pathcredit.llm import suffixes as S

DOCS = "doc_id long, text string, id string, own string, chunk long, piece string"


def brute(rows, length=50):
    owner = {}
    for i, text, *_ in rows:
        data = (text or "").encode()
        for p in range(len(data) - length + 1):
            w = data[p:p + length]
            owner[w] = min(owner.get(w, float("inf")), float("inf") if i is None else i)
    out = []
    for i, text, *_ in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if owner[data[p:p + length]] < (float("inf") if i is None else i):
                gone[p:p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = sum(g and not (j and gone[j - 1]) for j, g in enumerate(gone))
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.removed), r.kept_sha256) for r in df.collect()), key=str)


def some_rows(seed=3):
    rng = random.Random(seed)
    words = ["alpha", "bé", "gamma", "dd", "eps", "zeta eta", "ü", "thé"]

    def prose(n):
        return " ".join(rng.choice(words) + str(rng.randint(0, 99)) for _ in range(n))
    passages = [prose(rng.randint(8, 40)) for _ in range(12)]
    texts = [prose(rng.randint(0, 40)) + rng.choice(passages)[rng.randint(0, 40):] + prose(rng.randint(0, 30)) for _ in range(80)]
    texts += texts[:20] + [t[:30] + "!" + t[30:] for t in texts[:20]] + [t[7:-9] for t in texts[20:40]]
    line = "one very common line of more than fifty bytes, that is it"
    texts += [f"{prose(3)} {line} {prose(3)}" for _ in range(60)]
    texts += ["", None, "a" * 49, "a" * 50, "a" * 50, "a" * 51, "ab" * 400, "ba" * 200, "a" * 3000, line, "é" * 40, "é" * 25, "x" + "é" * 30]
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = list(zip(order, texts))
    return rows + [(None, texts[3]), (None, texts[3]), (None, None), (5, texts[7]), (5, texts[7]), (-4, prose(30))]


@pytest.mark.parametrize("options", [{}, {"chunk_bytes": 2000, "shard_bytes": 1500, "hot": 3, "gram": 16}, {"gram": 40, "hot": 10}, {"gram": 5}])
def test_removal_matches_brute_force(spark, options):
    rows = [(i, t, "x", "y", 1, "z") for i, t in some_rows()]
    df = spark.createDataFrame(rows, DOCS).repartition(7)
    assert result(S.repeated_passages(df, **options)) == brute(rows)


def test_short_windows_and_spans(spark):
    rows = [(3, "xxhello worldyy"), (1, "hello world"), (2, "say hello world")]
    df = spark.createDataFrame([(*r, "", "", 0, "") for r in rows], DOCS)
    found = {r.doc_id: [tuple(s) for s in r.removed] for r in S.repeated_passages(df, length=8, gram=4).collect()}
    assert found == {1: [], 2: [(4, 15)], 3: [(2, 13)]}
    assert S.repeated_passages(spark.createDataFrame([], DOCS)).collect() == []


def test_long_text_and_many_copies(spark):
    rng = np.random.default_rng(1)
    long = "".join(chr(97 + c) for c in rng.integers(0, 26, 300_000))
    df = spark.createDataFrame([(0, long), (1, long[100_000:200_000])], "doc_id long, text string").unionByName(
        spark.range(10, 3010).select(F.col("id").alias("doc_id"), F.lit(long[:400]).alias("text")))
    found = {r.doc_id: r.n_removed for r in S.repeated_passages(df, hot=100, chunk_bytes=50_000).collect()}
    assert found.pop(0) == 0 and found.pop(1) == 100_000 and set(found.values()) == {400} and len(found) == 3000


def test_colliding_hashes_are_noticed():
    rng = random.Random(2)
    codes = np.frombuffer(bytes(rng.choice(b"abc") for _ in range(2000)), np.uint8)
    starts = np.arange(len(codes) - 49)
    expected = len({codes[p:p + 50].tobytes() for p in starts.tolist()})
    bases = iter([1, 1, 0x9E3779B97F4A7C15])  # under 1 every permutation of a string collides with it
    classes = S.equal_windows(codes, starts, 50, bases)
    assert len(set(classes.tolist())) == expected and next(bases, None) is None


def test_suffixes_are_sorted():
    codes = np.frombuffer(b"banana" * 30 + b"bandana", np.uint8)
    starts = np.arange(len(codes) - 19)
    order = S.Suffixes(codes, 20, 0x9E3779B97F4A7C15).sort(starts).tolist()
    windows = [codes[p:p + 20].tobytes() for p in order]
    assert windows == sorted(windows) and sorted(order) == starts.tolist()


def test_runs_cover_every_window_with_a_key_of_its_text():
    texts = [b"abracadabra" * 9, b"", b"short", b"q" * 700, b"abracadabra" * 6]
    whole, codes, lengths = S._buffer(texts)
    start, count, key = S.runs(codes, lengths, 20, 8)
    at = [p for a, n in zip(start.tolist(), count.tolist()) for p in range(a, a + n)]
    ends = np.cumsum(lengths).tolist()
    assert at == [p for e, t in zip(ends, texts) for p in range(e - len(t), e - 19)]
    keys = {}
    for p, k in zip(at, np.repeat(key, count).tolist()):
        assert keys.setdefault(whole[p:p + 20], k) == k
