"""Quality classifier, URL filter and Pitman-Yor scores: held-out accuracy, brute force and odd inputs."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pathcredit.llm import pitman_yor, quality, url_filter

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, held_out string, score string, id string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], DOCS).repartition(3)


# ------------------------------------------------------------------ quality

def test_quality_is_learned_and_holds_on_unseen_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score_quality(docs, labels)
    assert scored.count() == docs.count()
    held = scored.where("held_out").join(labels, "doc_id").collect()
    right = sum(r["predicted"] == r["quality"] for r in held) / len(held)
    assert right > 0.95 and all(0 <= r["score"] <= 1 for r in held)
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in held)


def test_held_out_labels_are_never_learned(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    apart = quality.third_quarter(F.col("doc_id"))
    flipped = labels.withColumn("quality", F.when(apart, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.score_quality(docs, x).orderBy("doc_id").collect() for x in (labels, flipped))
    assert a == b
    assert {r["doc_id"] for r in a if r["held_out"]} == {
        r["doc_id"] for r in a if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2}


def test_features_do_not_depend_on_pieces(monkeypatch):
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abcé") for _ in range(rng.randint(1, 9))) for _ in range(4000))
    words = [f for f in quality.piece_features(text)][0]
    monkeypatch.setattr(quality, "PIECE", 500)
    cut = np.concatenate([next(iter(quality.piece_features(p))) for p in quality._pieces(text)])
    assert np.array_equal(words, cut)
    buckets, counts = quality.bucket_counts(text)
    assert len(buckets) and counts.sum() > 3 * len(text) * 0.9


def plain_buckets(text):
    """Bucket counts by loops over words and n-grams, in plain integers."""
    wide, counts = 1 << 32, Counter()

    def mix(h):
        h ^= h >> 15
        h = h * 0x85EBCA6B % wide
        return (h ^ h >> 13) % quality.BUCKETS
    codes = [ord(c) for c in f" {text} "]
    words = [[ord(c) for c in w] for w in re.findall(r"[^\x00-\x20]+", text)]
    # A word's hash is a sum over its letters and the blanks up to the next word, which add nothing.
    hashes = [mix((sum(((c + 7) * (i * 0x9E3779B1 | 1) % wide ^ c << 9) % wide for i, c in enumerate(w)) * 0x9E3779B1 + 1) % wide)
              for w in words]
    counts.update(hashes)
    counts.update(0 for a, b in zip(hashes, hashes[1:]) if a == b)
    for n in quality.GRAMS:
        for i in range(len(codes) - n + 1):
            h = codes[i] * 0x9E3779B1 % wide
            for c in codes[i + 1:i + n]:
                h = ((h ^ h >> 16) * 0x9E3779B1 + c) % wide
            counts[mix((h + n) % wide)] += 1
    return counts


@pytest.mark.parametrize("text", ["one two  two\nthree", "é ü é é", "x", "", " \t", "Same same same", "a" * 300 + " b"])
def test_features_match_a_plain_list(text):
    buckets, counts = quality.bucket_counts(text)
    want = plain_buckets(text) if text.strip() or text else Counter()
    if not text:
        assert len(buckets) == 0
    else:
        assert dict(zip(buckets.tolist(), counts.tolist())) == dict(want)


def test_training_matches_a_dense_softmax(monkeypatch):
    """The same steps with a dense feature matrix and explicit gradients of the log loss."""
    monkeypatch.setattr(quality, "BUCKETS", 12)
    rng = np.random.default_rng(5)
    samples = [(np.sort(rng.choice(12, 4, replace=False)).astype(np.int32), rng.integers(1, 4, 4).astype(np.int32), int(i % 3 == 0))
               for i in range(9)]
    dim, epochs, rate = 3, 2, 0.5
    model = quality.train(samples, 0.4, dim, epochs, rate, seed=7)
    draw = np.random.default_rng(7)
    vectors = draw.uniform(-1 / dim, 1 / dim, (12, dim)).astype(np.float32).astype(float)
    out, bias, done = np.zeros((2, dim)), np.zeros(2), 0
    for _ in range(epochs):
        for i in draw.permutation(len(samples)):
            buckets, counts, y = samples[i]
            x = np.zeros(12)
            x[buckets] = counts / counts.sum()
            hidden = x @ vectors
            p = np.exp(out @ hidden + bias)
            p /= p.sum()
            step = rate * (1 - done / (epochs * len(samples)))
            done += 1
            grad = p - np.eye(2)[y]  # of the loss by the logits
            by_feature = np.outer(np.minimum(x * len(buckets), 8) * (x > 0), grad @ out)
            out, bias, vectors = out - step * np.outer(grad, hidden), bias - step * grad, vectors - step * by_feature
    ones = sum(y for *_, y in samples)
    assert model.delta == pytest.approx(vectors @ (out[1] - out[0]), abs=1e-4)
    assert model.bias == pytest.approx(bias[1] - bias[0] + math.log(0.4 / 0.6) - math.log(ones / (len(samples) - ones)), abs=1e-4)


def test_long_texts_are_learned_from(spark):
    """Classes told apart only by texts far beyond any usual length."""
    rng = random.Random(6)

    def prose(kind):
        return " ".join(rng.choice(["good", "fine", "well"] if kind else ["bad", "poor", "ill"]) for _ in range(12_000))
    docs = docs_of(spark, [(i, prose(i % 2)) for i in range(24)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(24)], "doc_id long, quality int")
    got = quality.score_quality(docs, labels).collect()
    assert all(r["predicted"] == r["doc_id"] % 2 for r in got) and any(r["held_out"] for r in got)


def test_of_different_texts_of_an_id_always_the_same_one_is_learned_from(spark):
    rows = [(i % 7, f"text {i} " * (i % 5 + 1)) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(7)], "doc_id long, quality int")
    found = []
    for parts in (1, 5):
        docs = docs_of(spark, rows).repartition(parts, F.rand(parts))
        sample, _ = quality.training_sample(docs, labels, "doc_id", "text", "quality", F.lit(True), 100)
        found.append([(b.tolist(), c.tolist(), y) for b, c, y in sample])
    assert found[0] == found[1] and len(found[0]) == 7


def test_quality_odd_inputs(spark):
    rows = [(1, None), (2, ""), (None, "some text"), (3, "again"), (3, "again")]
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (3, 1)], "doc_id long, quality int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality.score_quality(docs_of(spark, rows), none).collect()
    assert len(got) == 5 and {r["score"] for r in got} == {0.5}
    got = quality.score_quality(docs_of(spark, rows), labels).collect()  # label 1 only
    assert {r["predicted"] for r in got} == {1}
    assert quality.score_quality(docs_of(spark, []), labels).count() == 0
    kept = quality.good_documents(docs_of(spark, rows), labels)
    assert kept.columns == docs_of(spark, rows).columns and kept.count() == 5


# ------------------------------------------------------------------ URLs

def plain_rule(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (m[1], m[2]) if m else ("", "")
    host = "".join(c.lower() if c.isascii() else c for c in host)
    best = None
    for says, rule in url_filter.RULES:
        name, rest = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            if best is None or len(rule) > len(best[1]):
                best = says, rule
    return host, path, best


def test_rules_match_brute_force(spark):
    urls = ["http://A.example.COM/en/x?q", "https://www.example.com/en/", "http://x.www.example.com/en/y#f", "http://example.com",
            "http://example.com/EN/", "ftp://b.net/es/1", "http://b.net/fr/", "http://bnet/fr/", "//b.net/fr/", "", None, "x://",
            "http://com/", "http://a.com?x=/en/", "http://é.net/es/ü", "http://h.net/es", "http://u://v.com/w", "http://a.com/"]
    pages = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(urls * 2)],
                                  "page_id long, url string, rule string, host string")
    got = url_filter.filter_urls(pages).collect()
    assert len(got) == 2 * len(urls)
    for r in got:
        host, path, best = plain_rule(urls[r["page_id"] % len(urls)])
        assert (r["host"], r["path"], r["rule"]) == (host, path, best and best[1])
        assert r["verdict"] == best[0] if best else r["verdict"] in ("allow", "block")


def plain_ratio(allowed, blocked, gram):
    def p(urls):
        out = 1 / url_filter.SYMBOLS
        for k in range(url_filter.ORDER + 1):
            pair = gram[len(gram) - k - 1:]
            seen = [g[len(g) - k - 1:] for u in urls for g in u]
            same = [s for s in seen if s[:k] == pair[:k]]
            if same:
                out = (same.count(pair) + len(set(same)) * out) / (len(same) + len(set(same)))
        return out
    return math.log(p(allowed)) - math.log(p(blocked))


def test_markov_ratio_matches_brute_force(spark):
    urls = {"allow": ["http://a.com/x1", "http://ab.com/", "http://q.org"], "block": ["http://n.net/es/9", "http://zz.net/fr/ü"]}
    df = spark.createDataFrame([(c, u) for c in urls for u in urls[c]], "says string, url string")
    grams = df.select("says", F.explode(url_filter.grams_of(url_filter.symbols_of(F.col("url")))).alias("gram"))
    counts = grams.groupBy("gram").agg(*[F.count_if(F.col("says") == c).alias(c) for c in ("allow", "block")])
    by_url = df.select("says", url_filter.grams_of(url_filter.symbols_of(F.col("url"))).alias("g")).collect()
    allowed, blocked = ([list(r["g"]) for r in by_url if r["says"] == c] for c in ("allow", "block"))
    assert "".join(g[-1] for g in allowed[0]) == "http~//a.com/x0$"
    for r in url_filter.log_ratios(counts).collect():
        assert r["ratio"] == pytest.approx(plain_ratio(allowed, blocked, r["gram"]), abs=1e-5)


def test_url_model_tells_unseen_urls_apart(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = url_filter.filter_urls(pages, rules=url_filter.RULES[:2]).where("rule is not null").collect()
    right = sum((r["ratio"] >= 0) == (r["verdict"] == "allow") for r in got) / len(got)
    assert right > 0.9
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.filter_urls(empty).count() == 0
    one = spark.createDataFrame([(1, "http://a.org/"), (2, "http://b.net/es/")], "page_id long, url string")
    assert {r["verdict"] for r in url_filter.filter_urls(one).collect()} == {"block"}


# ------------------------------------------------------------------ Pitman-Yor

def set_partitions(n):
    if n == 0:
        yield []
        return
    for rest in set_partitions(n - 1):
        for i in range(len(rest)):
            yield rest[:i] + [rest[i] + 1] + rest[i + 1:]
        yield rest + [1]


@pytest.mark.parametrize("d", [0.3, 0.8])
def test_alone_is_the_exact_conditional(d):
    for c, t in itertools.product(range(1, 8), range(1, 8)):
        weights = [(math.prod(math.gamma(s - d) / math.gamma(1 - d) for s in sizes), sizes.count(1) / c)
                   for sizes in set_partitions(c) if len(sizes) == t]
        if weights:
            want = sum(w * a for w, a in weights) / sum(w for w, _ in weights)
            assert pitman_yor.alone(np.array([c]), np.array([t]), d)[0] == pytest.approx(want, abs=1e-9)


def test_moves_settle_at_the_restaurant_process():
    d, strength, base, n = 0.5, 2.0, 0.2, 12
    rng = np.random.default_rng(0)
    t = np.ones(20000, np.int64)
    for _ in range(200):
        t = pitman_yor.move(np.full(len(t), n), t, np.full(len(t), strength * base), d, rng)
    # One dish's tables given a fixed weight w of a new table: P(t) in proportion to w**t S(n, t).
    s = np.exp(pitman_yor._log_stirling(n, d)[n]) * (strength * base) ** np.arange(n + 1)
    assert t.mean() == pytest.approx((s * np.arange(n + 1)).sum() / s.sum(), abs=0.05)


def test_predictive_probabilities_add_up():
    rng = np.random.default_rng(1)
    keys = [bytes([c]) + f"w{i}".encode() for i in range(300) for c in pitman_yor.CLASSES]
    counts = rng.poisson(rng.gamma(0.3, 20, len(keys))).astype(np.int64)
    bucket, order = pitman_yor.Bucket.of(pa.array(keys, pa.binary()), counts)
    assert sorted(bucket.count.tolist()) == sorted(counts.tolist())
    five = np.bincount(bucket.context, bucket.count, 5)
    known = np.bincount(bucket.word, bucket.count) > 0
    start = pitman_yor.Totals(five / 2, five, 300.0, int(known.sum()))
    for t, cw, tw in bucket.seatings(start, 3):
        assert ((t >= (bucket.count > 0)) & (t <= bucket.count)).all() and ((tw >= (cw > 0)) & (tw <= cw)).all()
        totals = pitman_yor.Totals(np.bincount(bucket.context, t, 5), five, float(tw.sum()), int(known.sum()))
        p = pitman_yor.pair_probability(bucket, t, cw, tw, totals)
        nothing = np.zeros(1, np.int64)
        for c in range(5):
            unseen = pitman_yor.Bucket(np.array([c]), nothing, nothing, np.zeros(0, np.uint8), nothing)
            rest = pitman_yor.pair_probability(unseen, nothing, nothing, nothing, totals)[0]
            assert p[(bucket.context == c) & known[bucket.word]].sum() + rest == pytest.approx(1, abs=1e-9)


def plain_base(rows):
    def words(t):
        return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or "")) + [None]
    held = [zlib.crc32(str("" if i is None else i).encode()) % 10 == 0 for i, _ in rows]
    train = [w for (_, t), h in zip(rows, held) if not h for w in words(t)]
    count = {}
    for w in train:
        count[w] = count.get(w, 0) + 1
    n, v = len(train), len(count)
    out = []
    for (i, t), h in zip(rows, held):
        base = sum(math.log10((count.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in words(t))
        out.append((str(i), h, len(words(t)), sum(w in count for w in words(t)), n, round(base, 6)))
    return sorted(out)


@pytest.mark.parametrize("piece", [40, 1 << 20])
def test_counts_and_base_scores_match_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(pitman_yor, "PIECE", piece)
    monkeypatch.setattr(pitman_yor, "TOKENS_AT_ONCE", 50 if piece == 40 else 1 << 21)
    rng = random.Random(4)
    vocabulary = ["the", "THE", "of,", "é.", "a\x00b", "Ünder", "x" * 300] + [f"w{i}" for i in range(60)]
    rows = [(i, "  ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40))) + "\n") for i in range(120)]
    rows += [(200, None), (201, ""), (None, "w1 w2"), (203, "twice the"), (203, "twice the"), (204, "only-here " * 3)]
    got = pitman_yor.score_documents(docs_of(spark, rows), chunk_rows=16, n_buckets=5).collect()
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                   round(r["base_score"], 6)) for r in got) == plain_base(rows)
    assert all(r["score"] < 0 for r in got)


def test_scores_beat_the_base_on_held_out_rows(spark):
    got = pitman_yor.score_documents(spark.read.parquet(f"{SF}/documents.parquet")).where("held_out").agg(
        F.sum("score").alias("score"), F.sum("base_score").alias("base")).first()
    assert got["score"] > got["base"]


def test_scoring_without_rows_or_training_rows(spark):
    assert pitman_yor.score_documents(docs_of(spark, [])).count() == 0
    got = pitman_yor.score_documents(docs_of(spark, [(1, "a b"), (2, None)]), held_out=lambda i: F.lit(True)).collect()
    assert {(r["n_tokens"], r["n_known"], r["train_tokens"], r["score"]) for r in got} == {(3, 0, 0, 0.0), (1, 0, 0, 0.0)}


def test_pitman_yor_does_not_depend_on_how_chunks_are_gathered(spark):
    docs = docs_of(spark, [(i, "the " * 9 + f"cat, w{i % 7} the dog{i % 3}. the") for i in range(60)])
    one, many = (pitman_yor.score_documents(docs, chunk_rows=4, n_buckets=5, chunks_together=n).orderBy("doc_id").collect()
                 for n in (1000, 2))
    assert len(one) == 60 and one == many


@pytest.mark.parametrize(("c", "w"), [(2, 3.0), (31, 50.0), (31, 5.0), (200, 400.0), (1000, 0.1), (1000, 50.0), (1000, 1e4)])
def test_one_move_is_a_whole_sweep(c, w):
    d = 0.8
    t = pitman_yor.move(np.full(20000, c), np.ones(20000, np.int64), np.full(20000, w), d, np.random.default_rng(2))
    log_p = pitman_yor._log_stirling(c, d)[c, 1:] + np.arange(1, c + 1) * math.log(w)
    p = np.exp(log_p - log_p.max())
    want = (p * np.arange(1, c + 1)).sum() / p.sum()
    assert t.mean() == pytest.approx(want, rel=0.025)
    assert t.min() >= 1 and t.max() <= c


def test_closing_probability_of_large_dishes_is_right_up_to_all_tables():
    d, c = 0.8, 400
    s, t = pitman_yor._log_stirling(c, d), np.arange(2, c + 1)
    assert np.allclose(pitman_yor.alone(np.full(len(t), c), t, d), np.exp(s[c - 1, t - 1] - s[c, t]), atol=0.002)


def test_table_totals_settle_whatever_they_start_from(spark):
    rng = np.random.default_rng(5)
    n = 4000
    seated = spark.createDataFrame([(i % 4, i, int(c), i // 8, int(k)) for i, (c, k) in enumerate(zip(
        rng.integers(0, 5, n), 1 + rng.poisson(rng.gamma(0.3, 30, n))))], "bucket int, at int, context int, word int, n long").cache()
    five = np.array([r["n"] for r in seated.groupBy("context").agg(F.sum("n").alias("n")).orderBy("context").collect()], float)
    low, high = (pitman_yor.settle(seated, pitman_yor.Totals(five * x, five, five.sum() * x / 2, n // 8))[1][-1] for x in (0.02, 1.0))
    assert np.allclose(low.tables, high.tables, rtol=0.05) and low.word_tables == pytest.approx(high.word_tables, rel=0.1)


def test_totals_settle_in_few_passes(spark, monkeypatch):
    """With the tables of every dish begun at the root of its customers and two lower sweeps it took three passes."""
    rng = np.random.default_rng(6)
    counts = np.minimum(rng.zipf(2.0, 30000), 3000)
    seated = spark.createDataFrame([(i % 3, i, 0 if i % 4 else int(rng.integers(1, 5)), i // 2, int(k)) for i, k in enumerate(counts)],
                                   "bucket int, at int, context int, word int, n long")
    rooms, seen, gather = pitman_yor._as_rooms(seated).cache(), [], pitman_yor.gather_totals
    begin = gather(rooms, None)
    monkeypatch.setattr(pitman_yor, "gather_totals", lambda *a: seen.append(gather(*a)) or seen[-1])
    pitman_yor.settle(rooms, begin)
    assert len(seen) <= 2 + pitman_yor.SAMPLES
    assert seen[1].tables.sum() == pytest.approx(seen[-1].tables.sum(), rel=0.02)


@pytest.mark.parametrize("d", [0.7, 0.8])
def test_dishes_of_similar_customers_are_drawn_together(d):
    """As one by one: every number of customers up to 200 has its own probabilities, and never more tables than customers."""
    c, w = np.arange(1, 202).repeat(300), 3.0
    t = pitman_yor.move(c, np.ones(len(c), np.int64), np.full(len(c), w), d, np.random.default_rng(7))
    assert (t >= 1).all() and (t <= c).all()
    for n in (2, 9, 70, 200):
        log_p = pitman_yor._log_stirling(n, d)[n, 1:] + np.arange(1, n + 1) * math.log(w)
        p = np.exp(log_p - log_p.max()) / np.exp(log_p - log_p.max()).sum()
        mean, spread = (p * np.arange(1, n + 1)).sum(), (p * np.arange(1, n + 1) ** 2).sum() - (p * np.arange(1, n + 1)).sum() ** 2
        assert t[c == n].mean() == pytest.approx(mean, abs=4.5 * (spread / 300) ** 0.5)


def test_a_word_depends_on_the_preceding_word(spark):
    """Both colours end in the same class of character, and apple and sky are equally frequent."""
    rows = [(i, "red apple" if i % 2 else "tan sky") for i in range(200)] + [(1000, "red apple"), (1001, "red sky")]
    got = {r["doc_id"]: r for r in pitman_yor.score_documents(
        docs_of(spark, rows), held_out=lambda i: i >= 1000, chunk_rows=16, n_buckets=5).collect()}
    assert got[1000]["base_score"] == pytest.approx(got[1001]["base_score"])
    assert got[1000]["score"] > got[1001]["score"] + 1


def test_texts_after_a_word_stay_below_one(spark):
    """All different texts "red w", with "red" alone and with an unknown word, are less than all texts."""
    texts = [f"red w{i % 5} red w{i % 3}" if i % 4 else f"w{i % 7} green" for i in range(120)]
    words = sorted({w for t in texts for w in t.split()})
    asked = [f"red {w}" for w in [*words, "unknown"]]
    ends = words + ["unknown"]
    rows = [(i, t) for i, t in enumerate([*texts, *asked, *[f"{w} red" for w in ends], "red"])]
    n = len(texts)
    score = {r["doc_id"]: r["score"] for r in pitman_yor.score_documents(
        docs_of(spark, rows), held_out=lambda i: i >= n, n_buckets=3).collect()}
    of = [10 ** score[n + i] for i in range(len(asked))]  # P(red|^) P(w|red) P(end|w)
    assert len(of) == len(asked) and all(0 < p < 1 for p in of)
    assert sum(of) + 10 ** score[n + 2 * len(asked)] < 1


def test_scores_do_not_depend_on_pieces(spark):
    docs = docs_of(spark, [(i, "the " * 9 + f"cat, w{i % 7} the dog{i % 3}. the") for i in range(60)])
    one, many = ({r["doc_id"]: r["score"] for r in pitman_yor.score_documents(docs, chunk_rows=n, n_buckets=5).collect()} for n in (1000, 3))
    assert len(one) == 60 and one == pytest.approx(many, rel=1e-5)


def test_seating_goes_on_from_pass_to_pass(spark):
    seated = spark.createDataFrame([(i % 4, i, 0, i, 50) for i in range(400)], "bucket int, at int, context int, word int, n long")
    rooms = pitman_yor._as_rooms(seated).cache()
    totals = pitman_yor.gather_totals(rooms, None)
    again = pitman_yor.gather_totals(rooms, None)
    assert totals.tables[0] == again.tables[0] and totals.customers[0] == 20000  # where every dish begins
    first = pitman_yor.gather_totals(rooms, totals, number=1)
    fresh = pitman_yor.Totals(first.tables, first.customers, first.word_tables, first.distinct)
    carried, anew = (pitman_yor.gather_totals(rooms, x, number=2) for x in (first, fresh))
    assert carried.tables[0] != anew.tables[0]


@pytest.mark.parametrize("most", [40, 1 << 62])
def test_distinct_values_and_places_are_those_of_unique(most):
    rng = np.random.default_rng(8)
    for n in (0, 1, 1000):
        codes, hashes = rng.integers(0, most, n), rng.integers(0, 1 << 64, max(n // 3, 1), np.uint64)[rng.integers(0, max(n // 3, 1), n)]
        for got, x in ((pitman_yor.distinct_codes(codes, most), codes), (pitman_yor.distinct_hashes(hashes), hashes)):
            for a, b in zip(got, np.unique(x, return_inverse=True)):
                assert a.tolist() == b.tolist()


def test_a_task_of_a_pass_seats_several_buckets(spark, monkeypatch):
    """A table with a task for every bucket starts more tasks a pass than it seats words; scores are the same."""
    docs = docs_of(spark, [(i, f"the cat{i % 9} saw w{i % 40}, the dog{i % 3} saw w{i % 11}.") for i in range(80)])
    asked, write = [], pitman_yor.materialize
    monkeypatch.setattr(pitman_yor, "materialize", lambda df, by=(), n=None: asked.append(n) or write(df, by, n))
    together = {r["doc_id"]: r["score"] for r in pitman_yor.score_documents(docs, n_buckets=40).collect()}
    assert [n for n in asked if n] == [10, 10]
    monkeypatch.setattr(pitman_yor, "BUCKETS_TOGETHER", 1)
    assert together == {r["doc_id"]: r["score"] for r in pitman_yor.score_documents(docs, n_buckets=40).collect()}


def test_pairs_in_more_cells_than_buckets(spark, monkeypatch):
    """A bucket's pairs are added up in several cells: a quarter as many buckets send a sixteenth of the letters, scores are the same."""
    docs = docs_of(spark, [(i, f"the cat{i % 9} saw w{i % 40}, the dog{i % 3} saw w{i % 11}.") for i in range(160)])
    letters, seat = [], pitman_yor.gather_totals

    def counted(*args):
        totals = seat(*args)
        letters.append(totals.seating.where("kind = 'up'").count())
        return totals

    def scores(**given):
        return {r["doc_id"]: r["score"] for r in pitman_yor.score_documents(docs, **given).collect()}

    one_cell = scores(n_buckets=10)
    monkeypatch.setattr(pitman_yor, "CELL_ROWS", 4)
    monkeypatch.setattr(pitman_yor, "LEAST_BUCKETS", 8)
    monkeypatch.setattr(pitman_yor, "gather_totals", counted)
    assert scores() == pytest.approx(one_cell, rel=1e-5)  # 40 cells of 10 buckets
    assert 0 < max(letters) <= 100


def test_packed_numbers_come_back():
    rng = np.random.default_rng(3)
    given = [rng.integers(0, 1 << 64, 40, np.uint64), np.zeros(0, np.int64), rng.integers(-9, 9, 7), rng.random(5).astype(np.float32)]
    found = pitman_yor._unpack(pa.scalar(pitman_yor._pack(*given), pa.binary()))
    assert [(x.dtype, x.tolist()) for x in found] == [(x.dtype, x.tolist()) for x in given]


def test_hashes_of_words_know_every_byte_and_the_last_class():
    words = [bytes([97 + i % 26]) * n for i in range(26) for n in (1, 7, 8, 9, 16, 17, 256, 257, 300)] + [b"a.", b"a,", b"a!", b"\xc3\xa9"]
    words += [w[:-1] + b"0" for w in words if len(w) > 1]
    first, second = (pitman_yor.words_of(sep.join(words) + tail)[0] for sep, tail in ((b" ", b""), (b" \n\t", b"  x")))
    assert len(set(first.tolist())) == len(set(words)) and (first == second[:-1]).all()
    assert [int(h) & 7 for h in pitman_yor.words_of(b"a a. a, a!")[0]] == [1, 2, 3, 4]
