from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from catchframe.llm import auction, dialogs
from catchframe.llm.common import BLANKS

TURNS = "conv_id long, turn long, role string, text string"


def cheapest(initials, faults):
    """All cheapest ways by dynamic programming, the least letters of each."""
    def inserted(ways):
        for _ in range(3):
            for state in list(ways):
                way = ways[state][0] + 5, ways[state][1] + "I"
                to = auction.NEXT[state]
                ways[to] = min(ways.get(to, way), way)
        return ways

    ways = inserted({0: (0, "")})
    for initial, fault in zip(initials, faults):
        after = {}

        def put(state, way):
            after[state] = min(after.get(state, way), way)

        for state, (cost, letters) in ways.items():
            put(state, (cost + 2, letters + "D"))
            if fault in "bd":
                continue
            more, to = 5 * (fault == "t"), auction.NEXT[state]
            if initial == "s" and state == 0:
                put(1, (cost + more, letters + "K"))
            if initial == "ua"[to - 2]:
                put(to, (cost + more, letters + "K"))
            put(to, (cost + 1 + more, letters + "R"))
        ways = inserted(after)
    return min(ways[s] for s in (0, 3) if s in ways)


def brute(rows):
    conversations = {}
    for conv, turn, role, text in rows:
        kept = conversations.setdefault(conv, [])
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        kept += [(turn, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    out = []
    for conv, kept in conversations.items():
        kept.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faults, initials = set(), "", ""
        for _, role, text in kept:
            bare = text.rstrip(BLANKS)
            faults += "b" if not bare else "d" if (role, text) in seen else "-" if bare[-1] in ".!?" else "t"
            seen.add((role, text))
            initials += role[:1] if role[:1] in ("s", "u", "a") else "x"
        illegal = sum(initials[i:i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))
        cost, audit = cheapest(initials, faults)
        told, at, last = [], 0, ""
        for edit in audit:
            given = {"": "user", "s": "user", "u": "assistant", "a": "user"}[last]
            if edit == "I":
                told.append((given, ""))
            else:
                _, role, text = kept[at]
                at += 1
                if edit == "D":
                    continue
                told.append((role if edit == "K" else given, text))
            last = told[-1][0][0]
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in told))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in told).encode()).hexdigest()
        out.append((conv, gaps, *(faults.count(f) for f in "bdt"), illegal, cost, audit, digest))
    return sorted(out, key=str)


def talk(n, seed=1, longest=12):
    r, out = random.Random(seed), []
    for conv in range(n):
        for turn in range(r.randrange(1, longest)):
            role = "system" if turn == 0 and r.random() < 0.3 else r.choice(["user", "assistant"]) if r.random() < 0.1 else ("user", "assistant")[turn % 2]
            out.append((conv, turn + r.randrange(2), role, r.choice(["Yes.", "No!", "Why? ", "and so", " \t", "é…", "Go on.\n", "x" * 40 + "."])))
    return out


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_against_brute_force(spark):
    rows = talk(200)
    assert got(dialogs.repair_report(spark.createDataFrame(rows, TURNS))) == brute(rows)


def test_odd_rows(spark):
    rows = talk(20) + [
        (None, 0, "user", "Hi."), (None, None, "assistant", "Ha."), (None, None, None, None), (30, None, "user", None), (31, 5, None, "Odd."),
        (32, -3, "System", "A."), (32, 9, "", "B."), (33, 1, "user", "A."), (33, 1, "user", "A."), (34, 0, "system", "w " * 40_000 + "."),
        (35, 2, "user", "\n.\x0b"), (36, 0, "s", "One."), (36, 1, "u", "Two?"), (36, 2, "a", "Three!"),
    ]
    rows += [(c, 0, "user", "Hi.") for c in range(100, 140)]  # some of them lose their only row
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("own") for c in ("key", "place", "fault", "audit", "cost", "copy")})
    found = got(dialogs.repair_report(df))
    assert found == brute(rows)
    assert any(r[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for r in found)
    assert dialogs.repair_report(df.limit(0)).collect() == []


def test_long_conversation_in_parts(spark):
    """A conversation of a third of all rows is cut into parts, which are joined over several levels."""
    rows = talk(60, 3) + [(99, t, "ua"[t % 2] + "x", "Yes." if t % 7 else f"no {t}") for t in range(180)]
    coded = dialogs.faults(dialogs.in_turn(dialogs.damaged(spark.createDataFrame(rows, TURNS))))
    whole, cut = (sorted(tuple(r) for r in dialogs.plans(coded, *how).collect()) for how in ((), (4, 3)))
    assert whole == cut and len(cut) > 50


def test_repaired_rows(spark):
    rows = dialogs.in_turn(dialogs.damaged(spark.createDataFrame(talk(40, 5), TURNS)))
    plan = dialogs.plans(dialogs.faults(rows))
    told = {}
    for r in sorted(dialogs.repaired(rows, plan).collect()):
        told.setdefault(r.key, []).append(f"{r.role}:{r.text}")
    digests = {r.key: r.repaired_sha256 for r in dialogs.repaired_digests(rows, plan).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert {k: d for k, d in digests.items() if d != empty} == {k: hashlib.sha256("\n".join(t).encode()).hexdigest() for k, t in told.items()}


@pytest.mark.parametrize("seed", range(4))
def test_auction(seed):
    r = random.Random(seed)
    for _ in range(150):
        n = r.choice([0, 1, 2, 3, 5, 8, 12, 25])
        initials = "".join(r.choice("suuaaax") for _ in range(n))
        faults = "".join(r.choice("------bdtt") for _ in range(n))
        want = cheapest(initials, faults)
        assert auction.repair(initials, faults) == want
        a, b = sorted((r.randrange(n + 1), r.randrange(n + 1)))
        parts = [auction.crossings(initials[i:j], faults[i:j]) for i, j in ((0, a), (a, b), (b, n))]
        assert auction.closed(auction.joined(auction.joined(*parts[:2]), parts[2])) == want


def test_prices_are_dual_feasible():
    lattice = auction.Lattice("uuasxaau", "--td-b--", True)
    prices = lattice.towards(lattice.end)
    assert prices.settle(0)
    assert all(prices.price[i] <= cost + prices.price[j] for i, out in enumerate(prices.arcs) for _, cost, j in out)
