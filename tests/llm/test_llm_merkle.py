"""Merkle manifest: brute force, odd inputs, tier heights."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from pathcredit.llm import merkle

ROWS = "doc_id long, source string, lang string, n_chars long, text string, id string, grp string, place int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels_of(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i:i + 2]) for i in range(0, len(below), 2)])
    return levels


def siblings(levels, i):
    found = []
    for level in levels[:-1]:
        if (i ^ 1) < len(level):
            found.append(level[i ^ 1])
        i >>= 1
    return found


def expected(rows):
    """Sorted (id, leaf, subroot, root, proof_sha256, verified)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [levels_of([m[2] for m in sorted(groups[g], key=lambda m: m[:3])]) for g in langs]
    top = levels_of([t[-1][0] for t in trees])
    out = []
    for k, g in enumerate(langs):
        for i, (_, _, digest, r) in enumerate(sorted(groups[g], key=lambda m: m[:3])):
            proof = siblings(trees[k], i) + siblings(top, k)
            ok = r[0] is None or r[3] is None or zlib.crc32(str(r[0]).encode()) % 7 != 0
            out.append((r[0], digest, trees[k][-1][0], top[-1][0], h(*proof), ok))
    return sorted(out, key=str)


def rows_of(n):
    rows = [(i, f"s{i % 3}", ["en", "fr", "é", None][i * i % 4], None if i % 11 == 0 else i, "tëxt " * (i % 4)) for i in range(n)]
    return rows + [(None, None, "en", 3, None), (None, None, None, None, None), (4, "s", "fr", 1, "x"), (4, "s", "fr", 1, "x"),
                   (5, "", "", 0, ""), (10 ** 6, "long", "en", 1, "z" * 300_000)]


@pytest.mark.parametrize("levels", [1, 3, 13])
def test_manifest_matches_brute_force(spark, levels):
    rows = rows_of(61)
    df = spark.createDataFrame([(*r, "a", "b", 1) for r in rows], ROWS).repartition(5)
    got = merkle.verified(merkle.manifest(df, tamper=merkle.one_more_char, levels=levels)).collect()
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.verified) for r in got), key=str) == expected(rows)
    assert all((r.folded_root == r.root) == r.verified for r in got)
    # Every other row's candidate is its leaf; the changed rows fold to roots of their own.
    changed = [r.folded_root for r in got if not r.verified]
    assert changed and len(set(changed)) == len(changed)


def test_small_tables(spark):
    empty = spark.createDataFrame([], ROWS)
    assert merkle.verified(merkle.manifest(empty)).count() == 0
    one = merkle.manifest(spark.createDataFrame([(1, "s", "en", 2, "t", "", "", 0)], ROWS)).first()
    assert one.leaf == one.subroot == one.root and one.proof == one.shape == ""
    other = spark.createDataFrame([(i, "x") for i in range(9)], "key long, body string").withColumn("kind", F.lit("k"))
    proofs = merkle.verified(merkle.manifest(other, ("key", "body"), "key", "kind", levels=2), "key").collect()
    assert all(r.verified for r in proofs) and len({r.root for r in proofs}) == 1


def test_sweeps_use_labels_in_order():
    digests = [h(str(i)) for i in range(11)]
    nodes = merkle.sweep_up(digests, merkle.height(11))
    assert nodes[4, 0] == levels_of(digests)[-1][0]
    for i, (proof, shape) in enumerate(merkle.sweep_down(nodes, 4, "", "")):
        assert proof == "".join(siblings(levels_of(digests), i)) and len(shape) == 4
        assert merkle.fold(digests[i], proof, shape) == nodes[4, 0]
    assert [merkle.height(n) for n in (0, 1, 2, 3, 4, 5)] == [0, 0, 1, 2, 2, 3]
