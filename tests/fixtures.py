"""Small visit histories and a plain-Python reckoning of every model over them."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from itertools import count

from pathcredit.constants import NON_SIGNIFICANT_ROOTS
from pathcredit.schema import RAW_VISITS

NOON = dt.datetime(2025, 3, 14, 9, 30, 15)
COUNTER, GOAL = 77, 510
_IDS = count(9001)

_SUB_FIELD = {2: "search_engine_root_id", 3: "adv_engine_id", 8: "social_network_id",
              9: "recommendation_system_id", 10: "messenger_id"}


def touch(code: str, start: dt.datetime) -> list[dict]:
    """A primary touch that derives ``code``, behind one of another attribution model."""
    root, *sub = (int(x) for x in code.split("_"))
    blank = dict.fromkeys(("search_engine_id", "search_engine_root_id", "adv_engine_id", "social_network_id",
                           "recommendation_system_id", "messenger_id", "click_banner_id", "click_target_type"), 0)
    main = {**blank, "model": 1, "id": root, "start_time": start}
    if sub:
        main[_SUB_FIELD[root]] = sub[0]
    if len(sub) > 1:
        main["click_banner_id"], main["click_target_type"] = 1, sub[1]
    return [{**blank, "model": 2, "id": 5, "start_time": start}, main]


def visit(user: int, hours: float, code: str, paid: float | None = None, *, visit_id: int | None = None,
          version: int = 1, sign: int = 1) -> tuple:
    """A delivery ``hours`` after NOON; ``paid`` makes it convert with that revenue."""
    start = NOON + dt.timedelta(hours=hours)
    hits = [] if paid is None else [dict(id=GOAL, serial=4, event_time=start, price=paid * 1e6, currency=978)]
    return (COUNTER, user, next(_IDS) if visit_id is None else visit_id, start.date(), start, 60, version, sign,
            touch(code, start), hits, [])


def raw(spark, visits: list[tuple]):
    return spark.createDataFrame(visits, RAW_VISITS)


#: Histories by name; each lasts one session under SESSION_GAP unless it says otherwise.
SESSION_GAP = 60 * 3600
HISTORIES = {
    "lone buyer": [visit(31, 0, "9_2", 40.0)],
    "never buys": [visit(32, h, c) for h, c in ((0, "0"), (3, "8_4"), (50, "7"))],
    "buys twice, then looks": [visit(33, 0, "10_3"), visit(33, 5.5, "0"), visit(33, 30, "3_6", 12.5),
                               visit(33, 31, "4"), visit(33, 80, "2_7", 99.0), visit(33, 80.25, "8_4"),
                               visit(33, 81, "7")],
    "same second": [visit(34, 2, "8_4", visit_id=20), visit(34, 2, "3_6", visit_id=10), visit(34, 2, "7", 5.0, visit_id=30)],
    "only weak channels": [visit(35, 0, "0"), visit(35, 20, "4"), visit(35, 40, "6", 7.0)],
    "two sessions": [visit(36, 0, "2_7"), visit(36, 10, "6", 3.0), visit(36, 200, "9_2"), visit(36, 201, "6", 4.0)],
    "comes back daily": [visit(37, 26 * i, ("2_7", "0", "3_6", "7")[i % 4], 10.0 + i if i % 5 == 4 else None)
                         for i in range(17)],
    "corrected and cancelled": [visit(38, 0, "8_4", visit_id=5), visit(38, 0, "8_4", visit_id=5, sign=-1),
                                visit(38, 0, "9_2", visit_id=5, version=2), visit(38, 1, "0", visit_id=6),
                                visit(38, 1, "0", visit_id=6, sign=-1), visit(38, 2, "6", 8.0)],
}


def live(visits: list[tuple]) -> dict[int, list[dict]]:
    """Visits left after collapsing, by user, in time order."""
    groups = defaultdict(list)
    for v in visits:
        groups[v[1], v[2], v[3]].append(v)
    users = defaultdict(list)
    for (user, vid, _), rows in groups.items():
        if sum(r[7] for r in rows) > 0:
            last = max(rows, key=lambda r: (r[6], r[7]))
            t = last[8][1]
            sub = t.get(_SUB_FIELD.get(t["id"], ""), 0)
            users[user].append({"at": last[4], "id": vid, "code": f"{t['id']}_{sub}" if sub else str(t["id"]),
                                "c": len(last[9]), "r": sum(h["price"] / 1e6 for h in last[9])})
    return {u: sorted(vs, key=lambda v: (v["at"], v["id"])) for u, vs in users.items()}


def session_chains(visits: list[tuple], gap: int = SESSION_GAP) -> list[list[dict]]:
    """Every session prefix, as the list of its visits."""
    out = []
    for vs in live(visits).values():
        chain: list[dict] = []
        for v in vs:
            if chain and (v["at"] - chain[-1]["at"]).total_seconds() > gap:
                chain = []
            chain = [*chain, v]
            out.append(chain)
    return out


def lookback_chains(visits: list[tuple], days: float) -> list[list[dict]]:
    """For every converting visit, the visitor's visits of the ``days`` before it."""
    out = []
    for vs in live(visits).values():
        for v in vs:
            if v["c"]:
                out.append([x for x in vs if x["at"] <= v["at"] and (v["at"] - x["at"]).total_seconds() <= days * 86400])
    return out


def shares(chain: list[dict], model: str, half_life: float = 7.0) -> dict[str, float]:
    """How a model splits one chain's value among its channels."""
    strong = [v for v in chain if int(v["code"].split("_")[0]) not in NON_SIGNIFICANT_ROOTS]
    if model == "time_decay":
        weights = [2 ** (-(chain[-1]["at"] - v["at"]).total_seconds() / 86400 / half_life) for v in chain]
    else:
        chosen = {"first_touch": chain[0], "last_touch": chain[-1], "last_significant": (strong or chain)[-1]}.get(model)
        weights = [1.0 if chosen is None or v is chosen else 0.0 for v in chain]
    out = defaultdict(float)
    for v, w in zip(chain, weights):
        out[v["code"]] += w / sum(weights)
    return {c: x for c, x in out.items() if x}


def credit(chains: list[list[dict]], model: str) -> dict[tuple, tuple]:
    """(day, channel) → (visits, conversions, revenue)."""
    out = defaultdict(lambda: [0.0, 0.0, 0.0])
    for chain in chains:
        end = chain[-1]
        for code, x in shares(chain, model).items():
            row = out[end["at"].date(), code]
            for k, value in enumerate((1, end["c"], end["r"])):
                row[k] += x * value
    return {k: tuple(round(x, 8) for x in v) for k, v in out.items()}


def assists(chains: list[list[dict]]) -> dict[tuple, tuple]:
    out = defaultdict(lambda: [0.0, 0.0])
    for chain in chains:
        for code in {v["code"] for v in chain[:-1]} if chain[-1]["c"] else ():
            out[chain[-1]["at"].date(), code][0] += chain[-1]["c"]
            out[chain[-1]["at"].date(), code][1] += chain[-1]["r"]
    return {k: tuple(round(x, 8) for x in v) for k, v in out.items()}


def steps(chains: list[list[dict]]) -> dict[tuple, tuple]:
    out = defaultdict(lambda: [0.0, 0.0])
    for chain in chains:
        for a, b in zip(chain, chain[1:]):
            out[chain[-1]["at"].date(), a["code"], b["code"]][0] += 1
            out[chain[-1]["at"].date(), a["code"], b["code"]][1] += chain[-1]["c"]
    return {k: tuple(v) for k, v in out.items()}
