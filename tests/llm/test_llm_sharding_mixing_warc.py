"""Sharding, mixing and revisits: brute force, hot groups and odd inputs."""

import zlib
from math import ceil, floor

import pytest
from pyspark.sql import functions as F

from pathcredit.llm import mixing, sharding, warc
from pathcredit.llm.common import materialize

DOCS = "doc_id long, text string, source string, size string, `odd.name` string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", "y") for i, t, s in rows], DOCS).repartition(4)


ROWS = [(i, "ab" * (i % 7), f"s{i % 3}") for i in range(200)] + [
    (500, None, None), (501, "", "s0"), (502, "é" * 3000, "s1"), (None, "null id", "s2"), (7, "same id", "s0"),
    (503, "twice", "s1"), (503, "twice", "s1")]


def test_byte_shards_match_a_plain_running_sum(spark):
    got = sorted((r.asDict() for r in sharding.shard_by_bytes(docs_of(spark, ROWS), 5).collect()),
                 key=lambda r: (r["shard"], r["slot"]))
    assert len(got) == len(ROWS)
    total, at = sum(r["size"] for r in got), 0
    for r in got:
        assert r["byte_offset"] == at
        assert r["shard"] == min(4, (2 * at + r["size"]) * 5 // (2 * total))
        at += r["size"]
    for s in range(5):
        assert [r["slot"] for r in got if r["shard"] == s] == list(range(sum(r["shard"] == s for r in got)))
    text = {i: t for i, t, _ in ROWS if i not in (7, 503)}
    for r in got:
        if r["doc_id"] in text:
            raw = (text[r["doc_id"]] or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
    ids = [r["doc_id"] for r in got]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])


def test_shards_are_balanced_and_empty_input_is_empty(spark):
    got = sharding.shard_by_bytes(docs_of(spark, [(i, "x" * 99, "s") for i in range(800)]), 8)
    assert {r["n"] for r in got.groupBy("shard").agg(F.sum("size").alias("n")).collect()} == {10000}
    assert sharding.shard_by_bytes(docs_of(spark, []), 8).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_by_bytes(docs_of(spark, []), 0)


def edf(shares):
    """Earliest deadline first over one period, in plain Python."""
    period, turns, out = sum(shares), [0] * len(shares), []
    for slot in range(period):
        ready = [(ceil((turns[i] + 1) * period / a), i) for i, a in enumerate(shares) if floor(turns[i] * period / a) <= slot]
        _, i = min(ready)
        out.append((i, turns[i]))
        turns[i] += 1
    return out


@pytest.mark.parametrize("shares", [[1], [3, 1], [22, 4, 4, 2], [5, 5, 5], [1, 7, 2, 9, 13]])
def test_period_is_earliest_deadline_first_and_never_a_block_off(spark, shares):
    table = mixing.period_table(spark, {f"s{i}": a for i, a in enumerate(shares)}).orderBy("slot").collect()
    assert [(int(r["stream"][1:]), r["turn"]) for r in table] == edf(shares)
    period, done = sum(shares), [0] * len(shares)
    for x, r in enumerate(table):
        assert r["release"] <= r["slot"] < r["deadline"]
        assert list(r["placed"]) == done
        done[int(r["stream"][1:])] += 1
        assert all(abs(d - (x + 1) * a / period) < 1 for d, a in zip(done, shares))


def test_mixed_positions_are_whole_and_on_target(spark):
    targets = {"s0": 2, "s1": 1, "gone": 5, mixing.OTHER: 1}
    rows = [(i, "t", "s0" if i % 2 else "s1") for i in range(300)] + [(900 + i, "t", None) for i in range(40)]
    got = sorted(mixing.mix_sources(docs_of(spark, rows), targets, block_rows=4).collect(), key=lambda r: r["position"])
    assert [r["position"] for r in got] == list(range(len(rows)))
    assert [r["slot"] for r in got] == sorted(r["slot"] for r in got)
    share = {"s0": 2 / 4, "s1": 1 / 4, mixing.OTHER: 1 / 4}
    done = dict.fromkeys(share, 0)
    for x, r in enumerate([r for r in got if r["on_target"]], 1):
        done[r["stream"]] += 1
        assert all(abs(done[s] - x * w) < 4 for s, w in share.items())
    assert sum(done.values()) >= 4 * 16
    for s in share:
        assert [r["doc_id"] for r in got if r["stream"] == s] == sorted(r["doc_id"] for r in got if r["stream"] == s)


def test_mixing_odd_inputs(spark):
    got = mixing.mix_sources(docs_of(spark, ROWS), {"s0": 1, "s1": 1}, block_rows=3).collect()
    assert sorted(r["position"] for r in got) == list(range(len(ROWS)))
    last = [r for r in got if r["stream"] == mixing.OTHER]  # no weight: after all others, in order
    assert min(r["position"] for r in last) == len(ROWS) - len(last)
    assert mixing.mix_sources(docs_of(spark, [])).count() == 0
    with pytest.raises(ValueError):
        mixing.mix_sources(docs_of(spark, ROWS), {"s0": 0})


def test_mixed_order_lies_in_the_files(spark):
    docs = docs_of(spark, ROWS)
    mixed = materialize(mixing.in_mixed_order(docs, {"s0": 2, "s1": 1, "s2": 1}, block_rows=2))
    assert mixed.columns == docs.columns
    assert sorted(map(str, mixed.collect())) == sorted(map(str, docs.collect()))
    from pathcredit.llm.common import input_order
    first = [r["source"] for r in mixed.orderBy(*input_order(mixed)).limit(40).collect()]
    assert abs(first.count("s0") - 20) <= 2 and abs(first.count("s1") - 10) <= 2


# ------------------------------------------------------------------ revisits

REC = "record_id long, warc_type string, uri string, date timestamp, http string, payload string, url string, status string"


def records(spark, rows):
    df = spark.createDataFrame([(i, k, u, d, h, p, "clash", "clash") for i, k, u, d, h, p in rows],
                               REC.replace("date timestamp", "date long"))
    return df.withColumn("date", F.timestamp_seconds("date")).repartition(5)


OK = "HTTP/1.1 200 OK\r\nContent-Length: 5\r\nETag: \"a\"\r\nX-Old: 1\r\nCache-Control: no"


def test_canonical_urls(spark):
    rows = [("HTTP://Ex.COM:80/A?q#f", "http://ex.com/A?q"), ("https://ex.com:443", "https://ex.com/"),
            ("https://ex.com:80/x", "https://ex.com:80/x"), ("http://ex.com?q", "http://ex.com/?q"), ("mailto", "mailto"),
            (None, None)]
    df = spark.createDataFrame(rows, "u string, want string").withColumn("got", warc.canonical_url(F.col("u")))
    assert all(r["got"] == r["want"] for r in df.collect())


def test_revisits_resolve_check_and_merge(spark):
    got = {r["record_id"]: r for r in warc.resolve_revisits(records(spark, [
        (1, "response", "http://e.com/", 100, OK, "hello"),
        (2, "revisit", "HTTP://E.com:80", 200, "HTTP/1.1 304 N\r\netag: W/\"a\"\r\ncache-control: max-age=1\r\n"
                                               "Content-Length: 0\r\nbroken line\r\nConnection: close", None),
        (3, "revisit", "http://e.com/", 300, "HTTP/1.1 304 N\r\nETag: \"b\"", None),
        (4, "revisit", "http://e.com/", 50, "HTTP/1.1 304 N\r\nETag: \"a\"", None),
        (5, "revisit", "http://e.com/", 400, None, None),
        (6, "revisit", None, 400, "HTTP/1.1 304 N\r\nETag: \"a\"", None),
        (7, "revisit", "http://e.com/", None, "HTTP/1.1 304 N\r\nETag: \"a\"", None),
        (8, "response", "http://e.com/", 100, OK.replace('"a"', '"z"'), ""),
    ])).collect()}
    assert {i: r["status"] for i, r in got.items()} == {
        1: "full", 2: "changed", 3: "changed", 4: "missing", 5: "changed", 6: "missing", 7: "missing", 8: "full"}
    alone = warc.resolve_revisits(records(spark, [
        (1, "response", "http://e.com/", 100, OK, "hello"),
        (2, "revisit", "HTTP://E.com:80", 200, "HTTP/1.1 304 N\r\netag: W/\"a\"\r\ncache-control: max-age=1\r\n"
                                               "Content-Length: 0\r\nbroken line\r\nConnection: close", None)]))
    two = alone.where("record_id = 2").first()
    assert (two["status"], two["resolved_from"], two["payload_bytes"], two["payload_crc32"]) == (
        "resolved", 1, 5, zlib.crc32(b"hello"))
    assert two["headers"] == "Content-Length: 5\nX-Old: 1\netag: W/\"a\"\ncache-control: max-age=1"


def test_a_hot_url_over_many_partitions_matches_brute_force(spark):
    rows = [(i, "response" if i % 37 == 0 else "revisit", "http://hot.com/" if i % 3 else f"http://c{i}.com/", 10 * (i // 2),
             f"HTTP/1.1 200 OK\r\nETag: \"{i // 74}\"", "x" * i) for i in range(600)]
    got = {r["record_id"]: r for r in warc.resolve_revisits(records(spark, rows)).collect()}
    latest = {}
    for i, kind, url, at, http, _ in sorted(rows, key=lambda r: (r[3], r[0])):
        if kind == "response":
            want = ("full", None)
            latest[url] = (i, http)
        elif url not in latest:
            want = ("missing", None)
        else:
            same = latest[url][1] == http
            want = ("resolved", latest[url][0]) if same else ("changed", None)
        assert (got[i]["status"], got[i]["resolved_from"]) == want
    assert warc.resolve_revisits(records(spark, [])).count() == 0


def test_payload_of_resolved_records(spark):
    recs = records(spark, [(1, "response", "http://e.com/", 1, OK, "hello"), (2, "revisit", "http://e.com/", 2, OK, None)])
    got = warc.with_payload(warc.resolve_revisits(recs), recs)
    assert {(r["record_id"], r["payload"]) for r in got.collect()} == {(1, "hello"), (2, "hello")}
    twice = records(spark, [(1, "response", "http://e.com/", 1, OK, "hello")] * 2 + [(1, "response", "http://e.com/x", 1, OK, "other"),
                            (3, "response", "http://e.com/y", 1, OK, None), (4, "revisit", "http://none/", 2, OK, None)])
    got = warc.with_payload(warc.resolve_revisits(twice), twice)
    assert sorted((r["record_id"], r["url"][-1], r["payload"]) for r in got.collect()) == [
        (1, "/", "hello"), (1, "/", "hello"), (1, "x", "other"), (3, "y", None), (4, "/", None)]


def test_no_header_line_is_dropped(spark):
    many = "HTTP/1.1 200 OK" + "".join(f"\r\nX-{i}: {i}" for i in range(3000))
    got = warc.resolve_revisits(records(spark, [(1, "response", "http://e.com/", 1, many, "x"), (2, "response", "http://e.com/", 2, "", "x")]))
    assert {r["record_id"]: len((r["headers"] or "").splitlines()) for r in got.collect()} == {1: 3000, 2: 0}


def test_extra_columns_with_clashing_names(spark):
    recs = records(spark, [(1, "response", "http://e.com/", 1, OK, "hello"), (2, "revisit", "http://e.com/", 2, OK, None)])
    more = recs.selectExpr("*", "'a' as url", "'b' as status", "1 as tie", "2 as pid", "'c' as headers", "3 as crc", "'d' as _of")
    assert sorted(map(str, warc.resolve_revisits(more).collect())) == sorted(map(str, warc.resolve_revisits(recs).collect()))
    assert warc.with_payload(warc.resolve_revisits(more), more).count() == 2
