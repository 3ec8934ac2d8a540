"""Cheapest repair of conversations by Four-Russians block tables.

A conversation is a string over nine symbols (its rows' role initials and
faults); repairing it is the cheapest path through the automaton of
``(s?(ua)+)?`` whose steps keep, rerole, delete and insert.  The cost to go from
each of the four states, less its least entry, is one of a few dozen vectors, so
one table holds, for every vector and every block of BLOCK symbols, the vector
before the block and the cost it adds: rows are passed a block at a time by
lookup, from the last to the first.  To trace, a block is expanded backward row
by row, and the letters are read off forward, the least one on a cheapest path
each time, which makes the ties' least audit.

Conversations are cut into segments of at most CHUNK rows.  Segments are mapped
(any vector after to the vector before), traced (any state before to the state
after) and expanded in parallel; two streaming passes over the segments, one
record each, hand the vectors back and the states on.  So no task holds a
conversation, however long; only its digest is a stream over all its rows,
because SHA-256 is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.llm.store import stored

BLOCK = 4               # symbols of a table block
CHUNK = 4096            # rows of a segment, at most
BLANKS = " \t\n\x0b\x0c\r"
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
S, U, A, OTHER = range(4)                       # role initials
NONE, BLANK, DUPLICATE, CUT = range(4)          # first faults; code = initial + 4 * fault
GONE = 8                                        # symbol of a row that must go; else initial + 4 * truncated
#: Automaton: nothing yet, system seen, user seen, assistant seen.
START, OPEN, ASKED, ANSWERED = range(4)
KEEP = {(START, S): OPEN, (START, U): ASKED, (OPEN, U): ASKED, (ANSWERED, U): ASKED, (ASKED, A): ANSWERED}
SPOKEN = [ASKED, ASKED, ANSWERED, ASKED]        # after the next user or assistant row, inserted or reroled
SAYS = "uuau"                                   # whose row that is
ROLES = {"u": "user", "a": "assistant", ".": None}
TAIL = [("", ""), ("II", "ua"), ("I", "a"), ("", "")]     # what ends a conversation: letters, initials of the roles given
_LOW = 33                                       # bits of monotonically_increasing_id below the partition
_SYMBOL = np.array([0, 1, 2, 3, GONE, GONE, GONE, GONE, GONE, GONE, GONE, GONE, 4, 5, 6, 7], np.int64)


def _before(after: tuple[int, ...], symbol: int) -> tuple[tuple[int, ...], int, list[tuple[str, str, int]]]:
    """Cost vector before a row (normalised), what it lost, and from each state
    the letters, the initials of the roles they give ('.': none) and the next state."""
    extra = TRUNCATED if symbol != GONE and symbol >= 4 else 0

    def edits(q):
        yield DELETE + after[q], "D", q
        if symbol != GONE:
            if (q, symbol % 4) in KEEP:
                yield extra + after[KEEP[q, symbol % 4]], "K", KEEP[q, symbol % 4]
            yield REROLE + extra + after[SPOKEN[q]], "R", SPOKEN[q]
    cost = [min(e[0] for e in edits(q)) for q in range(4)]
    for _ in range(3):
        cost = [min(c, INSERT + cost[SPOKEN[q]]) for q, c in enumerate(cost)]
    moves = []
    for start in range(4):
        q, letter, letters, roles = start, "I", "", ""
        while letter == "I":
            options = [("I", SPOKEN[q])] if INSERT + cost[SPOKEN[q]] == cost[q] else []
            letter, then = min(options + [(e[1], e[2]) for e in edits(q) if e[0] == cost[q]])
            letters, roles = letters + letter, roles + (SAYS[q] if letter in "IR" else ".")
            q = then
        moves.append((letters, roles, q))
    least = min(cost)
    return tuple(c - least for c in cost), least, moves


@dataclass
class Tables:
    vectors: np.ndarray         # [vector, state] cost to go, less the least
    to: np.ndarray              # [vector after, symbol] vector before
    add: np.ndarray             # and the cost it adds
    moves: list                 # [vector after][symbol][state] (letters, roles given, state after the row)
    block_to: np.ndarray        # the same for blocks: [vector after, symbols of the block in base 9]
    block_add: np.ndarray


@lru_cache(maxsize=1)
def tables() -> Tables:
    """All vectors reachable from the end, and the tables over them."""
    vectors = [tuple(INSERT * len(letters) for letters, _ in TAIL)]
    index, to, add, moves = {vectors[0]: 0}, [], [], []
    for v in vectors:                                       # grows while it is read
        rows = [_before(v, s) for s in range(9)]
        for vec, _, _ in rows:
            if vec not in index:
                index[vec] = len(vectors)
                vectors.append(vec)
        to.append([index[r[0]] for r in rows])
        add.append([r[1] for r in rows])
        moves.append([r[2] for r in rows])
    to, add = np.array(to), np.array(add)
    block_to, block_add = to, add
    for _ in range(BLOCK - 1):                              # one more symbol in front
        block_add = np.concatenate([block_add + add[block_to, s] for s in range(9)], axis=1)
        block_to = np.concatenate([to[block_to, s] for s in range(9)], axis=1)
    return Tables(np.array(vectors), to, add, moves, block_to.astype(np.int16), block_add.astype(np.int16))


def _blocks(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the whole blocks, and the symbols after them."""
    whole = len(symbols) // BLOCK * BLOCK
    return symbols[:whole].reshape(-1, BLOCK) @ (9 ** np.arange(BLOCK - 1, -1, -1)), symbols[whole:]


def mapped(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every vector after the rows the vector before them and the cost between."""
    t = tables()
    v, cost = np.arange(len(t.vectors)), np.zeros(len(t.vectors), np.int64)
    codes, rest = _blocks(symbols)
    for s in rest[::-1]:
        cost, v = cost + t.add[v, s], t.to[v, s]
    for b in codes[::-1]:
        cost, v = cost + t.block_add[v, b], t.block_to[v, b]
    return v, cost


def traced(symbols: np.ndarray, after: int, last: bool) -> list[tuple[str, str, int]]:
    """From each state before the rows: audit, roles given and state after them."""
    t = tables()
    codes, rest = _blocks(symbols)
    v, ends = after, []
    for s in rest[::-1]:
        v = int(t.to[v, s])
    for b in codes[::-1]:                                   # vector after each block, by lookup
        ends.append(v)
        v = int(t.block_to[v, b])
    pieces = [(symbols[k * BLOCK: (k + 1) * BLOCK], e) for k, e in enumerate(reversed(ends))] + [(rest, after)]
    steps = []
    for piece, v in pieces:
        behind = []
        for s in piece[::-1].tolist():                      # the block, expanded backward
            behind.append(t.moves[v][s])
            v = int(t.to[v, s])
        steps.extend(reversed(behind))
    out = []
    for q in range(4):
        letters, roles = [], []
        for step in steps:
            a, b, q = step[q]
            letters.append(a), roles.append(b)
        a, b = TAIL[q] if last else ("", "")
        out.append(("".join(letters) + a, "".join(roles) + b, q))
    return out


def _segments(table: pa.Table) -> pa.Table:
    """The segments of one chunk of consecutive rows: what they map vectors to, and their ends."""
    mid = table.column("mid").to_numpy()
    order = np.argsort(mid)
    mid, code = mid[order], table.column("code").to_numpy()[order].astype(np.uint8)
    conv = table.column("conv").combine_chunks().take(pa.array(order)).to_pylist()
    starts = [0] + [k for k in range(1, len(conv)) if conv[k] != conv[k - 1]]
    out = {k: [] for k in ("conv", "first", "codes", "to", "add", "illegal")}
    for a, b in zip(starts, [*starts[1:], len(conv)]):
        to, add = mapped(_SYMBOL[code[a:b]])
        out["conv"].append(conv[a]), out["first"].append(int(mid[a])), out["codes"].append(code[a:b].tobytes())
        out["to"].append(to.astype(np.int32).tobytes()), out["add"].append(add.astype(np.int64).tobytes())
        out["illegal"].append(illegal(code[a:b]))
    return pa.table(out, schema=pa.schema([("conv", pa.string()), ("first", pa.int64()), ("codes", pa.binary()), ("to", pa.binary()),
                                           ("add", pa.binary()), ("illegal", pa.int64())]))


def illegal(code: np.ndarray) -> int:
    """Neighbours whose initials are not su, ua or au."""
    pair = (code[:-1] % 4).astype(int) * 4 + code[1:] % 4
    return int((~np.isin(pair, [4 * S + U, 4 * U + A, 4 * A + U])).sum())


_PASSED = "conv string, first long, codes binary, illegal long, after int, cost long, last boolean"


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments from last to first: the vector after each and the cost from its start."""
    t, conv, v, cost = tables(), None, 0, 0
    for batch in batches:
        out = {"after": [], "cost": [], "last": []}
        for name, to, add in zip(*(batch.column(c).to_pylist() for c in ("conv", "to", "add"))):
            last = name != conv
            if last:
                conv, v, cost = name, 0, 0
            out["after"].append(v), out["last"].append(last)
            cost += int(np.frombuffer(add, np.int64)[v])
            v = int(np.frombuffer(to, np.int32)[v])
            out["cost"].append(cost + int(t.vectors[v, START]))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv", "first", "codes", "illegal")), pa.array(out["after"], pa.int32()),
                                          pa.array(out["cost"], pa.int64()), pa.array(out["last"], pa.bool_())],
                                         ["conv", "first", "codes", "illegal", "after", "cost", "last"])


_TRACED = "conv string, first long, codes binary, illegal long, cost long, audits array<string>, given array<string>, states array<int>"


def _trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts = pa.list_(pa.string())
    for batch in batches:
        got = [traced(_SYMBOL[np.frombuffer(c, np.uint8)], v, last)
               for c, v, last in zip(*(batch.column(k).to_pylist() for k in ("codes", "after", "last")))]
        audits, given, states = ([[x[k] for x in g] for g in got] for k in range(3))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv", "first", "codes", "illegal", "cost")), pa.array(audits, texts),
                                          pa.array(given, texts), pa.array(states, pa.list_(pa.int32()))],
                                         ["conv", "first", "codes", "illegal", "cost", "audits", "given", "states"])


_CHOSEN = "conv string, first long, illegal long, cost long, audit string, given string"


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments from first to last: the audit of each from the state it is entered in."""
    conv, q, ahead, begun = None, START, b"", False
    for batch in batches:
        bads, chosen, roles = [], [], []
        for name, codes, bad, audits, given, states in zip(*(batch.column(c).to_pylist() for c in ("conv", "codes", "illegal", "audits", "given", "states"))):
            if not begun or name != conv:
                conv, q, ahead, begun = name, START, b"", True
            bads.append(bad + illegal(np.frombuffer(ahead + codes[:1], np.uint8)))
            chosen.append(audits[q]), roles.append(given[q])
            q, ahead = states[q], codes[-1:]
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("first"), pa.array(bads, pa.int64()), batch.column("cost"),
                                          pa.array(chosen, pa.string()), pa.array(roles, pa.string())],
                                         ["conv", "first", "illegal", "cost", "audit", "given"])


_EDITS = "conv string, first long, place long, mid long, edit string, given string"


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per letter: the row it edits (null: inserted) and the role it gives (null: its own)."""
    for batch in batches:
        for conv, first, audit, given in zip(*(batch.column(c).to_pylist() for c in ("conv", "first", "audit", "given"))):
            inserted = np.frombuffer(audit.encode(), np.uint8) == ord("I")
            mids = first + np.cumsum(~inserted) - 1
            yield pa.RecordBatch.from_arrays([pa.array([conv] * len(audit), pa.string()), pa.array([first] * len(audit), pa.int64()),
                                              pa.array(np.arange(len(audit))), pa.array(mids.astype(np.int64), mask=inserted), pa.array(list(audit), pa.string()),
                                              pa.array([ROLES[r] for r in given], pa.string())],
                                             ["conv", "first", "place", "mid", "edit", "given"])


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's lines, as they stream by."""
    conv, h, begun = None, None, False
    for batch in batches:
        done, sums = [], []
        for name, line in zip(batch.column("conv").to_pylist(), batch.column("line").to_pylist()):
            if not begun or name != conv:
                if begun:
                    done.append(conv), sums.append(h.hexdigest())
                conv, h, begun = name, hashlib.sha256(line.encode()), True
            else:
                h.update(b"\n" + line.encode())
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.string()), pa.array(sums, pa.string())], ["conv", "sha"])
    if begun:
        yield pa.RecordBatch.from_arrays([pa.array([conv], pa.string()), pa.array([h.hexdigest()], pa.string())], ["conv", "sha"])


@dataclass
class Repair:
    rows: DataFrame             # conv, turn, role, text, mid: as given, in order
    conversations: DataFrame    # conv, gaps, blank, duplicate, truncated, illegal, cost, audit
    edits: DataFrame            # conv, first, place, mid, edit, given: one row per letter, ordered by (first, place)


def conversation_key(conv: str) -> Column:
    """'0' for null, else '1' and the identifier."""
    return F.coalesce(F.concat(F.lit("1"), F.col(conv).cast("string")), F.lit("0"))


def repair(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """Faults of every conversation and its cheapest repair to ``(s?(ua)+)?``.

    Rows are ordered by turn (null first), rows of one turn by role, the first
    64 characters of the text and its hash; equal rows are interchangeable.  Null
    roles and texts count as one space, a null identifier as one conversation; a
    role whose first letter is none of s, u, a (an empty one, too) must be
    reroled or go.  Other columns are not read.  An empty table gives empty results.
    """
    rows = conversations.select(
        conversation_key(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text")).withColumn("copy", F.monotonically_increasing_id())
    order = [F.col("conv").asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.substring("text", 1, 64).asc(), F.xxhash64("text").asc(),
             F.col("copy").asc()]
    rows = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("copy")
                      .withColumn("mid", F.monotonically_increasing_id()), "repair-rows")
    ended = F.rtrim(F.col("text"), F.lit(BLANKS))
    seen = rows.select("conv", "mid", F.col("turn"), F.col("role"), F.sha2(F.col("text"), 256).alias("sha"),
                       (ended == "").alias("blank"), (~F.right(ended, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    again = seen.groupBy("conv", "role", "sha").agg(F.min("mid").alias("origin"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    fault = (F.when(F.col("blank"), BLANK).when(F.col("mid") > F.col("origin"), DUPLICATE).when(F.col("cut"), CUT).otherwise(NONE))
    initial = F.coalesce(*[F.when(F.col("role").startswith(c), k) for k, c in enumerate("sua")], F.lit(OTHER))
    codes = stored(seen.join(again, ["conv", "role", "sha"], "left").select("conv", "mid", "turn", (initial + 4 * fault).cast("int").alias("code")), "repair-codes")
    chunk = [F.shiftright("mid", _LOW).alias("part"), F.expr(f"(mid & {(1 << _LOW) - 1}) div {CHUNK}").alias("chunk")]
    segments = codes.select("conv", "mid", "code", *chunk).groupBy("part", "chunk").applyInArrow(
        _segments, "conv string, first long, codes binary, to binary, add binary, illegal long")
    passed = stored(segments.repartition("conv").sortWithinPartitions("conv", F.desc("first")).mapInArrow(_backward, _PASSED), "repair-passed")
    chosen = stored(passed.mapInArrow(_trace, _TRACED).repartition("conv").sortWithinPartitions("conv", "first").mapInArrow(_forward, _CHOSEN), "repair-chosen")
    counts = codes.groupBy("conv").agg(
        *[F.count_if(F.floor(F.col("code") / 4) == k).alias(name) for k, name in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (CUT, "truncated"))])
    turns = codes.groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv").agg(
        F.coalesce((F.max("turn") - F.min("turn") + 1 - F.count("turn")).cast("long"), F.lit(0)).alias("gaps"))
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("first", "audit"))), lambda p: p["audit"])
    whole = chosen.groupBy("conv").agg(F.sum("illegal").alias("illegal"), F.min_by("cost", "first").alias("cost"), F.array_join(pieces, "").alias("audit"))
    return Repair(rows, counts.join(turns, "conv").join(whole, "conv"), chosen.mapInArrow(_expand, _EDITS))


def repaired(r: Repair) -> DataFrame:
    """The repaired rows (conv, first, place, edit, role, text, ordered by
    (first, place)); inserted ones have empty texts, deleted ones are left out."""
    own = r.rows.select("mid", "role", "text")
    left = r.edits.where("edit != 'D'").join(own, "mid", "left")
    return left.select("conv", "first", "place", "edit", F.coalesce("given", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def digests(lines: DataFrame) -> DataFrame:
    """(conv, sha): SHA-256 of the ``role:text`` lines of each conversation, joined by newlines."""
    line = F.concat("role", F.lit(":"), "text").alias("line")
    return (lines.select("conv", "first", "place", line).repartition("conv").sortWithinPartitions("conv", "first", "place")
                 .mapInArrow(_hash, "conv string, sha string"))


def damaged(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults put in by crc32(`conv:turn`) % 20: 0 drops the row, 1
    empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes its role user.
    Nulls count as one space (turns stay null in the result)."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn, role, text)]
    rows = conversations.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), said[2].alias("role"), said[3].alias("text"),
                                (F.crc32(F.concat(said[0], F.lit(":"), said[1]).cast("binary")) % 20).alias("k")).where("k != 0")
    rows = rows.withColumn("text", F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    rows = rows.withColumn("role", F.when(F.col("k") == 4, "user").otherwise(F.col("role")))
    copies = F.explode(F.when(F.col("k") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.withColumn("copy", copies).select("conv_id", "turn", "role", "text")
