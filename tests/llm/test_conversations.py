"""Conversation repair against plain dynamic programming and against trying every edit."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from panelfold.llm import conversations
from panelfold.llm.conversations import Nodes, _flat, _tables, _walk, repair_damaged

LEGAL = re.compile("(s?(ua)+)?")
WHITE = " \t\n\x0b\x0c\r"


def _md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def damage(rows):
    out = []
    for k, turn, role, text in rows:
        place = f"{' ' if k is None else k}:{' ' if turn is None else turn}"
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(place.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(k, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        end = text.rstrip(WHITE)
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, fault):
    """(cost, audit, repaired rows), from the last row to the first, by the roles' initials so far."""
    best = {e: w for e, w in {"": (0, "", ()), "a": (0, "", ()), "s": (6, "II", (("user", ""), ("assistant", ""))), "u": (3, "I", (("assistant", ""),))}.items()}
    nxt = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}
    for (role, text), f in reversed(list(zip(rows, fault))):
        here = {}
        for e in best:
            ways = [(best[e][0] + 4, "D" + best[e][1], best[e][2])]
            if f not in ("blank", "duplicate"):
                more, t = 3 * (f == "truncated"), nxt[e]
                ways.append((best[t][0] + 3 + more, "R" + best[t][1], ((name[t], text), *best[t][2])))
                i = role[:1]
                if i and (i == nxt[e] or (e == "" and i == "s")):
                    ways.append((best[i][0] + more, "K" + best[i][1], ((role, text), *best[i][2])))
            here[e] = min(ways)
        for _ in range(3):
            here = {e: min(here[e], (here[nxt[e]][0] + 3, "I" + here[nxt[e]][1], ((name[nxt[e]], ""), *here[nxt[e]][2]))) for e in here}
        best = here
    return best[""]


def brute(rows):
    rows = list(rows)
    after, out = damage(rows), {}
    for k in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in after if r[0] == k), key=lambda r: (r[0] is not None, r[0] or 0, r[1][:64], r[2][:64], _md5(_md5(r[1]) + _md5(r[2]))))
        turns = {t for t, _, _ in mine if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        said = [r[1:] for r in mine]
        f = faults(said)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(said))
        cost, audit, repaired = cheapest(said, f)
        assert LEGAL.fullmatch("".join(r[0] for r, _ in repaired))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out[k] = (gaps, f.count("blank"), f.count("duplicate"), f.count("truncated"), illegal, cost, audit, sha)
    return out


def found(spark, rows, schema="conv_id long, turn long, role string, text string, k string, pos int"):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], schema).repartition(4)
    got = [tuple(r) for r in repair_damaged(df).collect()]
    assert len(got) == len({r[0] for r in got})
    return {r[0]: r[1:] for r in got}


def conversation(r, k, n):
    roles = ["user", "assistant", "system", "tool", "", "u", None, "Svc"]
    texts = ["Fine.", "No", "", " \t", "Same!", "What? ", "end\x85", "a. ", None, "Über.\r\n", "x" * 200 + "."]
    return [(k, None if r.random() < 0.1 else t, r.choice(roles[: r.choice([2, 3, 8])]), r.choice(texts)) for t in range(n)]


def test_equals_dynamic_programming(spark):
    r = random.Random(1)
    rows = [x for k in range(150) for x in conversation(r, k, r.randint(1, 14))]
    rows += [(None, t, role, "Yes.") for t, role in enumerate(["user", "assistant"] * 3)] + [(-5, None, None, None)]
    rows += [(500, 1, "user", t) for t in ("a.", "b.", "a.", "c.")] + conversation(r, 501, 40)
    assert found(spark, rows) == brute(rows)


def test_long_conversations_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(conversations, "CHUNK", 4)
    r = random.Random(2)
    rows = [x for k in range(25) for x in conversation(r, k, r.randint(1, 60))]
    assert found(spark, rows) == brute(rows)


def test_copies_share_their_nodes(spark):
    rows = [(k, t, ("user", "assistant")[t % 2], f"Hello {t}.") for k in range(300) for t in range(4)]
    assert found(spark, rows) == brute(rows)
    nodes = Nodes()
    for s in sorted(["uaua", "saua", "Daua", "a"], key=lambda s: s[::-1]):
        nodes(s)
    assert nodes.made == 6  # a, ua, aua and one for each first row


def test_empty(spark):
    assert found(spark, []) == {}
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    assert found(spark, [(gone, 0, "user", "Hi.")]) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def _every(symbols):
    """The least (cost, audit) over all edits with few insertions."""
    best = None
    for inserts in range(4):
        for places in itertools.combinations_with_replacement(range(len(symbols) + 1), inserts):
            for edits in itertools.product("KRD", repeat=len(symbols)):
                ways = [("", 0, "")]
                for k, s in enumerate([*symbols, None]):
                    n = places.count(k)
                    ways = [(e + "".join(x), c + 3 * n, a + "I" * n) for e, c, a in ways for x in itertools.product("ua", repeat=n)]
                    if s is None:
                        continue
                    more = 3 * s.isupper()
                    if edits[k] == "D":
                        ways = [(e, c + 4, a + "D") for e, c, a in ways]
                    elif s == "D":
                        ways = []
                    elif edits[k] == "K":
                        ways = [(e + s.lower(), c + more, a + "K") for e, c, a in ways]
                    else:
                        ways = [(e + x, c + 3 + more, a + "R") for e, c, a in ways for x in "ua"]
                for e, c, a in ways:
                    if LEGAL.fullmatch(e) and (best is None or (c, a) < best):
                        best = (c, a)
    return best


def test_against_every_edit():
    r = random.Random(3)
    some = {"".join(r.choice("suaxSUAXD") for _ in range(r.randint(1, 4))) for _ in range(40)}
    for s in sorted(some, key=lambda s: s[::-1]):
        costs, _, audits = _flat(Nodes()(s))
        cost, states = _walk([_flat(Nodes()(s))[:2]])
        audit = audits[4 * states[0] + states[1]] + conversations._TAIL[states[1]][1]
        assert (cost, audit) == _every(s), s
        assert costs[4 * states[0] + states[1]] >= 0


def test_tables_cover_each_signature_once(spark):
    some = spark.createDataFrame([(s,) for s in ["ua", "ua", "sua", "D", "Aa"] * 20], "signature string")
    got = {r.of: (r.costs, r.places, r.audits) for r in _tables(some).collect()}
    assert got == {s: _flat(Nodes()(s)) for s in ("ua", "sua", "D", "Aa")}


@pytest.mark.parametrize("kind", ["string", "int"])
def test_other_id_types(spark, kind):
    rows = [(k, t, "user", "Hi.") for k in range(9) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").selectExpr(f"CAST(conv_id AS {kind}) conv_id", "turn", "role", "text")
    got = {int(r[0]): tuple(r[1:]) for r in repair_damaged(df).collect()}
    assert got == brute(rows)
