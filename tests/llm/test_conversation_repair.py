"""Conversation repair against a plain shortest path over all edit scripts."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np

from matchlake.llm import conversation_repair as talk
from matchlake.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, conv string, mid long, first long, edit string, code int"
DFA = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        last = re.sub(r"[\x20\x09-\x0D]", "", text)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired lines): Dijkstra over (cost, audit), ties by ASCII."""
    fault = faults(rows)
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, audit, lines
        for c, name in (("u", "user"), ("a", "assistant")):
            if (state, c) in DFA:
                heapq.heappush(heap, (cost + 2, audit + "I", i, DFA[state, c], (*lines, name + ":")))
        if i < len(rows):
            role, text = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, lines))
            if fault[i] not in ("blank", "duplicate"):
                more = cost + (fault[i] == "truncated")
                if (state, role[:1]) in DFA:
                    heapq.heappush(heap, (more, audit + "K", i + 1, DFA[state, role[:1]], (*lines, f"{role}:{text}")))
                for c, name in (("u", "user"), ("a", "assistant")):
                    if (state, c) in DFA:
                        heapq.heappush(heap, (more + 2, audit + "R", i + 1, DFA[state, c], (*lines, f"{name}:{text}")))
    raise AssertionError


def plain(rows):
    """conv_id -> what the query returns, from (conv_id, turn, role, text) after damage."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        said = [(r[2], r[3]) for r in own]
        turns = [r[1] for r in own if r[1] is not None]
        f = faults(said)
        bad = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        cost, audit, lines = cheapest(said)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, f.count("blank"), f.count("duplicate"), f.count("truncated"),
                     bad, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def hurt(rows):
    out = []
    for conv, turn, role, text in rows:
        say = lambda v: " " if v is None else str(v)
        k = zlib.crc32(f"{say(conv)}:{say(turn)}".encode()) % 20
        role, text = "user" if k == 4 else say(role), "" if k == 1 else re.sub("[.!?]", "", say(text)) if k == 2 else say(text)
        out += [(conv, turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def made(seed, n):
    rng = random.Random(seed)
    texts = ["Hello.", "Yes!", "and then", "", " \t\n", "What?", "ok. \x0b", "ünd so weiter", "x" * 5000 + "."]
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, 9)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "U", None])
            rows.append((c, rng.choice([t, t, t, None, t + 3]), role, rng.choice([*texts, f"Row {c} {t}.", f"Say {t}.", None])))
    return rows + [(None, t, "user" if t % 2 else "assistant", f"{t}.") for t in range(6)] + [(None, None, None, None)] * 2


def table(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, 2, "e", 3) for r in rows], SCHEMA).repartition(3)


def result(spark, docs, every):
    r = talk.repair(docs)
    got = {x.conv: tuple(x)[1:] for x in r.conversations.select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit").collect()}
    sums = {x.conv: x.sha for x in talk.digests(talk.repaired(r)).collect()}
    key = lambda c: "0" if c is None else f"1{c}"
    return {c: (*got[key(c)], sums.get(key(c), hashlib.sha256(b"").hexdigest())) for c in every}


def test_tables_hold_every_cost():
    """Block lookups give the cost and the audit that single rows and plain search give."""
    rng = random.Random(3)
    symbols = {0: ("system", "S{}."), 1: ("user", "U{}."), 2: ("assistant", "A{}."), 3: ("tool", "T{}."), 4: ("system", "s{}"), 5: ("user", "u{}"),
               6: ("assistant", "a{}"), 7: ("tool", "t{}"), 8: ("user", "")}
    for n in [*range(7), 9, 13, 17]:
        for _ in range(25):
            s = np.array([rng.randrange(9) for _ in range(n)], np.int64)
            rows = [(symbols[x][0], symbols[x][1].format(k)) for k, x in enumerate(s.tolist())]
            v, cost = talk.mapped(s)
            audit, _, _ = talk.traced(s, 0, True)[talk.START]
            assert (cost[0] + talk.tables().vectors[v[0], talk.START], audit) == cheapest(rows)[:2]


def test_against_search(spark):
    rows = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in made(1, 60)]
    assert result(spark, table(spark, rows), {r[0] for r in rows}) == plain(rows)


def test_segments_meet(spark, monkeypatch):
    """Conversations over many segments and partitions give the same."""
    monkeypatch.setattr(talk, "CHUNK", 3)
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["system", "user", "assistant", "tool"]), rng.choice([f"{t}.", f"{t}", "", "Again."])) for c, n in ((1, 400), (2, 31), (3, 1))
            for t in range(n)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert result(spark, table(spark, rows), {1, 2, 3}) == plain(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_damage_and_query(spark, tmp_dir):
    rows = made(2, 80) + [(900 + k, t, "user", "Hi.") for k in range(60) for t in range(1)]
    table(spark, rows).select("conv_id", "turn", "role", "text").write.parquet(f"{tmp_dir}/conversations.parquet")
    want = plain(hurt(rows))
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op12_conversation_repair"](spark, tmp_dir).collect()}
    assert got == {c: want.get(c, empty) for c in {r[0] for r in rows}}
    assert empty in got.values()


def test_empty(spark):
    r = talk.repair(table(spark, [(1, 1, "user", "x")]).where("false"))
    assert r.conversations.count() == 0 and talk.repaired(r).count() == 0


def test_lines_in_order(spark):
    rows = [(1, 0, "user", "One."), (1, 1, "user", "Two."), (1, 2, "assistant", "Three.")]
    got = [(r.edit, r.role, r.text) for r in talk.repaired(talk.repair(table(spark, rows))).orderBy("first", "place").collect()]
    assert got == [("K", "user", "One."), ("I", "assistant", ""), ("K", "user", "Two."), ("K", "assistant", "Three.")]
