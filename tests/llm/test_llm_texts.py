"""Exact and near duplicates, licenses, decontamination: brute force, hot groups and odd inputs."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pathcredit.llm import decontaminate, exact_dedup, licenses, simhash

DOCS = "doc_id long, text string, lang string, digest string, fp string"


def docs_of(spark, rows, parts=4):
    return spark.createDataFrame([(i, t, "en", "x", "y") for i, t in rows], DOCS).repartition(parts)


def some_texts(n, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    out = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    out += [t + " more" if i % 2 else t.upper() for i, t in enumerate(out[:n // 3])] + out[:n // 4]
    return out + [None, "", "  \t\n", "one", "one two", "é ß Ü", "a\x00b c", "x" * 5000, "\x0b\x0c tail"]


ROWS = list(enumerate(some_texts(120))) + [(None, "w1 w2"), (None, None), (1000, "hot"), (5, "same id")] + [
    (2000 + i, "hot" if i % 2 else "h o\tt") for i in range(200)] + [(3000, "twice"), (3000, "twice")]


# ------------------------------------------------------------------ exact duplicates

def test_exact_duplicates_match_brute_force(spark):
    got = exact_dedup.exact_duplicates(docs_of(spark, ROWS), k=8).collect()
    groups = {}
    for i, t in ROWS:
        key = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t or "").encode()).hexdigest()
        groups.setdefault(key, []).append((-len(t or ""), i is None, i or 0, i))
    assert len(got) == len(ROWS)
    for r in got:
        members = groups[r["text_sha256"]]
        assert (r["keep_id"], r["group_size"]) == (min(members)[3], len(members))
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(groups) and len({r["text_sha256"] for r in kept}) == len(groups)
    assert exact_dedup.exact_duplicates(docs_of(spark, [])).count() == 0


def test_misra_gries_finds_every_heavy_digest(spark):
    digests = [f"d{i}" for i in range(400)] + ["hot"] * 300 + ["warm"] * 120
    random.Random(1).shuffle(digests)
    df = spark.createDataFrame([(d,) for d in digests], "digest string").repartition(7)
    found = exact_dedup.heavy_digests(df, 9)
    assert {"hot", "warm"} <= set(found) and len(found) <= 9
    summary = exact_dedup.pruned({f"d{i}": i for i in range(20)}, 4)
    assert len(summary) <= 4 and summary["d19"] == 19 - 15


# ------------------------------------------------------------------ near duplicates

def plain_simhash(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes_of(fps, max_bits):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(fps))]


def test_near_duplicates_match_brute_force(spark):
    got = simhash.simhash_near_duplicates(docs_of(spark, ROWS)).collect()
    ids = [i for i, _ in ROWS]
    fps = [plain_simhash(t) for _, t in ROWS]
    of = classes_of(fps, 4)
    smallest = {c: min((i for i, k in zip(ids, of) if k == c and i is not None), default=None) for c in set(of)}
    want = sorted((str(i), f"{f:016x}", str(smallest[c])) for i, f, c in zip(ids, fps, of))
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got) == want
    assert simhash.simhash_near_duplicates(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("max_bits", [1, 4, 7])
def test_trees_lose_no_link(spark, max_bits):
    rng = random.Random(max_bits)
    seeds = [rng.getrandbits(64) for _ in range(250)]
    near = [s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, max_bits + 1))) for s in seeds for _ in range(3)]
    cluster = [seeds[0] ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)]  # one dense ball
    chain = [(1 << (3 * i)) - 1 for i in range(21)]
    fps = sorted({x if x < 1 << 63 else x - (1 << 64) for x in seeds + near + cluster + chain})
    points = spark.createDataFrame([(f,) for f in fps], "fp long").repartition(4)
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.near_links(points, max_bits, 200)).collect()}
    of = classes_of([f & (1 << 64) - 1 for f in fps], max_bits)
    smallest = {}
    for f, c in zip(fps, of):
        smallest[c] = min(f, smallest.get(c, f))
    assert all(roots.get(f, f) == smallest[c] for f, c in zip(fps, of))


@pytest.mark.parametrize("order", ["ascending", "zero then descending", "random"])
def test_long_chains_of_links_settle_in_few_rounds(spark, order, monkeypatch):
    n = 5000
    names = list(range(n))
    if order == "random":
        random.Random(8).shuffle(names)
    elif order != "ascending":
        names = [0, *range(n - 1, 0, -1)]
    links = spark.createDataFrame(list(zip(names, names[1:])) + [(n + 5, n + 5), (n + 7, n + 9)], "a long, b long")
    written = []
    plain = simhash.materialize
    monkeypatch.setattr(simhash, "materialize", lambda df: written.append(1) or plain(df))
    got = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    assert got == {**dict.fromkeys(range(n), 0), n + 7: n + 7, n + 9: n + 7}
    assert len(written) <= 60  # two a round


def test_components_of_random_graphs(spark):
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(1000, i) for i in range(1001, 1300)]
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in links:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: top(x) for x in {x for a, b in links if a != b for x in (a, b)}}
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_row_of_each_group_stays(spark):
    docs = docs_of(spark, ROWS)
    left = simhash.one_of_each(docs)
    assert left.columns == docs.columns
    fps = [plain_simhash(t) for _, t in ROWS]
    of = classes_of(fps, 4)
    kept = left.collect()
    assert len(kept) == len(set(of))
    smallest = {c: min(((i is None, i or 0) for (i, _), k in zip(ROWS, of) if k == c)) for c in set(of)}
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept) == sorted(smallest.values())


def test_very_long_text_has_the_same_fingerprint():
    text = " ".join(f"t{i % 977}" for i in range(70_000))
    assert simhash.simhash64(text.encode()) == plain_simhash(text)


# ------------------------------------------------------------------ licenses

def test_templates_accept_only_exact_mandatory_wording():
    m = licenses.Matcher(licenses.TEMPLATES, licenses.BASE_PHRASES)

    def labels(text):
        return m.read(text.encode())[5]
    assert labels("Licensed under the Apache License, Version 2.0.") == "apache-2.0"
    assert labels("distributed under the terms of the APACHE-license 2.0") == "apache-2.0"
    assert labels("Licensed under the Apache Software License, Version 2.0") == ""
    assert labels("Released under the MIT License.") == "mit"
    assert labels("This work is licensed under the GNU General Public License, version 3.") == "gpl,gpl-3.0"
    assert labels("Licensed under CC BY-NC 4.0.") == "cc-by,cc-by-nc-4.0"
    assert labels("licensed under a creative commons attribution 4.0 international license") == "cc-by-4.0"
    assert labels("Copyright (c) 2020 Some Body Ltd. All rights reserved") == "copyright-line,reserved"
    assert labels("Copyright (c) one two three four five six seven eight. All rights reserved") == "copyright-line,reserved"
    assert labels("Copyright one two three four five six seven eight nine. All rights reserved") == "reserved"
    assert labels("released under the 3-clause BSD license") == "bsd"
    assert labels("all rights are reserved") == ""


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use,
copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in
the documentation and/or other materials provided with the distribution.
3. Neither the name of the Example Project nor the names of its contributors may be used to endorse or promote products derived from
this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR
ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""


def test_whole_licence_texts_and_near_misses(spark):
    without = BSD[:BSD.index("3. Neither")] + BSD[BSD.index("THIS SOFTWARE"):]
    whole = {
        "mit-text": [MIT, "Copyright (c) 2001 A. Body\n\n" + MIT + "\nMore.", MIT.replace("THE AUTHORS OR COPYRIGHT HOLDERS", "SOME PERSON"),
                     MIT.replace("NONINFRINGEMENT", "NON-INFRINGEMENT"),
                     MIT.replace("notice shall", "notice (including the next paragraph) shall")],
        "bsd-text": [BSD, without, BSD.replace("the Example Project", "A Company, Inc."), BSD.replace("1. ", "* ").replace("2. ", "* "),
                     without.replace("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "ONE ``AUTHOR''")],
        "isc-text": [ISC, ISC.replace("and/or distribute", "and distribute"), ISC.replace("THE AUTHOR DISCLAIMS", "ISC AND OTHERS DISCLAIM")],
    }
    # A mandatory word changed, left out or added, a clause half left out, a holder longer than its region.
    missed = [MIT.replace("free of charge", "for a charge"), MIT.replace("sublicense, ", ""), MIT[:-20],
              MIT.replace("shall be included", "should be included"), MIT.replace("THE AUTHORS OR", "THE AUTHORS " * 7 + "OR"),
              BSD.replace("without specific prior", "with specific prior"), without.replace("binary form must", "binary form may"),
              BSD.replace("retain the above", "retain all the above"), ISC.replace("without fee", "without any fee"), ISC[40:]]
    rows = [(label, t) for label, texts in whole.items() for t in texts] + [("", t) for t in missed]
    df = docs_of(spark, [(i, t) for i, (_, t) in enumerate(rows)])
    got = {r["doc_id"]: r["labels"] for r in licenses.scan_licenses(df).collect()}
    assert [got[i] for i in range(len(rows))] == [label for label, _ in rows]


def test_template_markup():
    m = licenses.Matcher({"x": "a [[b [[c]]]] {{d|e f}} {{*2}} g"}, {"q q": "qq"})
    for text in ("a d g", "a b d g", "a b c e f g", "z a d 1 2 g z"):
        assert m.read(text.encode())[5] == "x", text
    for text in ("a c d g", "a e g", "a d 1 2 3 g", "a d", "b d g"):
        assert m.read(text.encode())[5] == "", text
    assert m.read(b"q q q")[:4] == (3, 2, 0, 1)  # overlapping places count
    for bad in ("[[a]]", "a [[b", "a b]]", "{{a|b", "{{*3}} a"):
        with pytest.raises(ValueError):
            licenses.Matcher({"x": bad}, {"q q": "qq"})


def test_phrases_over_piece_ends_and_odd_rows(spark, monkeypatch):
    text = ("pad " * 9 + "All rights reserved. CC-BY ") * 40
    whole = licenses.Matcher(licenses.TEMPLATES, licenses.BASE_PHRASES).read(text.encode())
    for size in (1, 7, 64):
        monkeypatch.setattr(licenses, "PIECE", size)
        assert licenses.Matcher(licenses.TEMPLATES, licenses.BASE_PHRASES).read(text.encode()) == whole
    assert whole[1:4] == (80, 9, 40 * 14 - 2)
    got = licenses.scan_licenses(docs_of(spark, [(1, None), (2, ""), (None, text), (2, "cc by"), (2, "cc by")])).collect()
    assert sorted([(r["doc_id"], r["n_words"], r["first_word"], r["labels"], r["score"]) for r in got], key=str) == sorted([
        (1, 0, None, "", 0.0), (2, 0, None, "", 0.0), (None, whole[0], 9, whole[5], 0.5),
        (2, 2, 0, "cc-by", 0.5), (2, 2, 0, "cc-by", 0.5)], key=str)
    assert licenses.scan_licenses(docs_of(spark, [])).count() == 0


# ------------------------------------------------------------------ decontamination

def plain_matches(docs, items, n=5, t=0.8):
    def shingles(x):
        w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in x or ""))
        return w and {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} or set(), w
    out = []
    for d, text in docs:
        words = shingles(text)[1]
        for i, item in items:
            want = shingles(item)[0]
            length = len(next(iter(want))) if want else 0
            have = {tuple(words[k:k + length]) for k in range(len(words) - length + 1)} if want else set()
            if want and len(want & have) >= t * len(want) - 1e-9:
                out.append((str(d), str(i), len(want & have), len(want)))
    return sorted(out)


def benchmark_case():
    rng = random.Random(11)
    words = [f"v{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(3, 60)))) for i in range(30)] + [
        (40, None), (41, ""), (None, "null item of some words here"), (42, "Short one"), (42, "Short one")]
    docs = []
    for d in range(60):
        base = [rng.choice(words) for _ in range(rng.choice([20, 200, 4000]))]
        if d % 2:
            cut = items[d % 30][1].split()
            for _ in range(d % 5):
                cut[rng.randrange(len(cut))] = "changed"
            at = rng.randrange(len(base))
            base[at:at] = cut
        docs.append((d, "  ".join(base).title() + "."))
    return docs + [(None, items[3][1]), (100, None), (101, ""), (102, "a SHORT, one!"), (102, "a SHORT, one!")], items


@pytest.mark.parametrize("piece", [64, 1 << 20])
def test_contained_items_match_brute_force(spark, monkeypatch, piece):
    docs, items = benchmark_case()
    monkeypatch.setattr(decontaminate, "PIECE", piece)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contained_items(docs_of(spark, docs), bench, block_bytes=500 if piece == 64 else 1 << 20).collect()
    assert sorted((str(r["doc_id"]), str(r["item_id"]), r["found"], r["shingles"]) for r in got) == plain_matches(docs, items)


def test_clean_documents_keep_all_others(spark):
    docs, items = benchmark_case()
    bench = spark.createDataFrame(items, "item_id long, text string")
    left = decontaminate.clean_documents(docs_of(spark, docs), bench, block_bytes=2000)
    bad = {m[0] for m in plain_matches(docs, items)}
    assert left.columns == DOCS_NAMES and bad
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(d) for d, _ in docs if str(d) not in bad)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.clean_documents(docs_of(spark, docs), none).count() == len(docs)
    assert decontaminate.contained_items(docs_of(spark, []), bench).count() == 0


DOCS_NAMES = ["doc_id", "text", "lang", "digest", "fp"]


def test_sketches_never_miss():
    rng = np.random.default_rng(0)
    for size in (1, 4, 5, 9, 33, 64, 65):
        words = [f"k{x}".encode() for x in rng.integers(0, 10**9, size + 4)]
        block = decontaminate.ItemBlock([(0, b" ".join(words))], 5, 0.8)
        shingles = sorted(decontaminate.shingles_of(words))
        keep = int(np.ceil(0.8 * len(shingles)))
        for _ in range(20):
            some = [shingles[i] for i in rng.permutation(len(shingles))[:keep]]
            assert block.candidates(b" . ".join(some)) == {0}


@pytest.mark.parametrize("n", [90, 150, 450])
def test_vantage_sample_is_bounded_and_never_all_fingerprints(spark, monkeypatch, n):
    monkeypatch.setattr(simhash, "SAMPLE", 100)
    sampled, build = [], simhash.upper_tree
    monkeypatch.setattr(simhash, "upper_tree", lambda sample, *a: sampled.append(len(sample)) or build(sample, *a))
    simhash.near_links(spark.range(n).select(F.xxhash64("id").alias("fp")), 4, 50)
    assert sampled and 0 < max(sampled) < min(0.75 * n, 130)
