"""Conversation repair: brute force over edits, runs against single steps, heavy conversations, odd inputs."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from pathcredit.llm import conversations as C

ROWS = "conv_id long, turn long, role string, text string, conv string, key string, kept string"
LEGAL = re.compile(r"(s?(ua)+)?")


def cheapest(symbols):
    """(cost, audit) by trying every edit: states are the legal prefixes' last initials."""
    keeps = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, last, inserted):
        options = []
        nxt = "a" if last == "u" else "u"
        if i == len(symbols):
            if last in ("", "a"):
                options.append((0, ""))
        else:
            s = symbols[i]
            c, a = best(i + 1, last, 0)
            options.append((c + 3, "D" + a))
            if s != "D":
                late = s.isupper()
                if s.lower() in keeps[last]:
                    c, a = best(i + 1, s.lower(), 0)
                    options.append((c + late, "K" + a))
                c, a = best(i + 1, nxt, 0)
                options.append((c + 2 + late, "R" + a))
        if inserted < 3:
            c, a = best(i, nxt, inserted + 1)
            options.append((c + 2, "I" + a))
        return min(options) if options else (10 ** 9, "")
    return best(0, "", 0)


def test_audits_are_the_cheapest_and_least():
    rng = random.Random(5)
    for n in range(9):
        for _ in range(250):
            symbols = "".join(rng.choice("suaxSUAXDD" if rng.random() < .5 else "ua") for _ in range(n))
            cost, audit = C.solve(symbols)
            assert (cost, "".join(audit)) == cheapest(symbols), symbols


@pytest.mark.parametrize("symbol", "suaxSUAXD")
def test_run_powers_equal_single_steps(symbol):
    for n in (1, 2, 3, 7, 64, 100):
        costs = C.AT_END
        for _ in range(n):
            costs = C.before_row(symbol, costs)
        assert C.before_run(symbol, n, C.AT_END) == costs
    cost, audit = C.solve(symbol * 500 + "ua" * 3)
    assert len(audit) == 507 and cost == C.before_run(symbol, 500, C.before_run("u", 1, C.before_run(
        "a", 1, C.before_run("u", 1, C.before_run("a", 1, C.before_run("u", 1, C.before_run("a", 1, C.AT_END)))))))[0]


def brute(rows, damage=True):
    groups = {}
    for conv, turn, role, text, *_ in rows:
        here = groups.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        k = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(k.encode()) % 20 if damage else 9
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (turn is not None, turn or 0, "user" if kind == 4 else role, text, turn)
        here += [row] * (2 if kind == 3 else 1)
    out = []
    for conv, here in groups.items():
        here.sort(key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()))
        turns = [r[4] for r in here if r[4] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        symbols, seen, counts = "", set(), [0, 0, 0]
        for _, _, role, text, _ in here:
            words = re.findall(r"[^\x20\x09-\x0D]", text)
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            if not words:
                counts[0] += 1
                symbols += "D"
            elif (role, text) in seen:
                counts[1] += 1
                symbols += "D"
            elif words[-1] not in ".!?":
                counts[2] += 1
                symbols += initial.upper()
            else:
                symbols += initial
            seen.add((role, text))
        initials = [r[2][:1] for r in here]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = cheapest(symbols)
        lines, i, last = [], 0, ""
        for step in audit:
            nxt = "assistant" if last == "u" else "user"
            if step == "I":
                lines.append(nxt + ":")
                last = nxt[0]
                continue
            if step == "K":
                lines.append(f"{here[i][2]}:{here[i][3]}")
                last = here[i][2][0]
            elif step == "R":
                lines.append(f"{nxt}:{here[i][3]}")
                last = nxt[0]
            i += 1
        assert LEGAL.fullmatch("".join(x[0] for x in lines))
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def some_rows(seed=1):
    rng = random.Random(seed)
    texts = ["Hello.", "Why?", "no end", "", " \t\n", "So!", "é ü.", "Hello. ", None, "x" * 40_000 + "."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "u2", "User"]
    rows = [(conv, rng.choice([None, *range(6)]) if conv % 5 == 0 else t, rng.choice(roles[:4] if conv % 2 else roles),
             rng.choice(texts), "c", "k", "x") for conv in range(60) for t in range(rng.randint(1, 9))]
    rows += [(None, t, "user", "a.", "c", "k", "x") for t in range(3)] + [(None, None, None, None, None, None, None)] * 2
    rows += [(7000 + i, 0, "user", "Hi.", "c", "k", "x") for i in range(60)]  # some of them lose their only row
    return rows


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("damage", [True, False])
def test_repair_matches_brute_force(spark, damage):
    rows = some_rows()
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    got = result(C.repair_conversations((C.damaged if damage else C.undamaged)(df)))
    assert got == brute(rows, damage)
    assert any(r[7] == "" for r in got) == damage


def test_heavy_conversations_in_ranges_give_the_same(spark):
    rng = random.Random(9)
    texts = [f"Line {i}{e}" for i in range(40) for e in (".", "", "?")] + ["", None]
    rows = [(1, t // 3 if t % 50 else None, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(texts), "", "", "")
            for t in range(900)]
    rows += [(2, t, "user", "Same.", "", "", "") for t in range(300)] + [(None, 5, "user", "Same.", "", "", "")] * 200
    rows += [r for r in some_rows(4) if r[0] not in (1, 2, None)]
    df = spark.createDataFrame(rows, ROWS).repartition(6)
    got = result(C.repair_conversations(C.damaged(df), heavy_rows=100, range_rows=64))
    assert got == brute(rows)
    by_bytes = result(C.repair_conversations(C.damaged(df), heavy_bytes=2000, range_rows=500))
    assert by_bytes == got


def test_empty_table(spark):
    assert C.repair_conversations(C.damaged(spark.createDataFrame([], ROWS))).collect() == []
