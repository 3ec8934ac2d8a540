"""Substring dedup by recompression.

The words of a text are its first symbols.  Each round names runs and pairs:
a boundary between neighbours x and y goes when x = y (a run) or when x falls
into the left and y into the right half of the symbols (a pair); the half is a
bit of the symbol's name, another one each round.  The name of a symbol is the
64-bit hash of the words it stands for, so all tasks of all rounds give equal
expansions equal names without an exchange.  Whether a boundary stays depends
on its two neighbours only; each round widens by one symbol the stretch of
words that fixes it, which is tracked exactly.  A symbol whose stretch lies
inside a window is therefore found in every equal window: the least of these
names is the window's anchor, and Spark finds the high-level symbols that
documents share (see ``spans``).  Windows without such a symbol (inside long
runs) stand for themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.columns import Rolling, mix, slices, word_hashes, words
from matchlake.llm.spans import CELLS, cell_batch, covered, items_of, per_document, row_texts, settle
from matchlake.llm.store import SMALL, discard, stored
from matchlake.operators.joins import broadcast_if_small

WIDTH = 20
ROUNDS = 2


def recompress(names: np.ndarray, roll: Rolling, edges: np.ndarray, rounds: int) -> tuple[np.ndarray, ...]:
    """(boundaries, first and last word position that fixes each, symbol names)
    after the rounds.  ``edges``: document boundaries, which always stay;
    from the first round on nothing inside a document fixes them."""
    n = len(names)
    pos = np.arange(n + 1)
    fixed = np.zeros(n + 1, bool)
    fixed[edges] = True
    left, right = pos, pos  # words begin and end where they do whatever stands around them
    for j in range(rounds):
        half = ((names >> np.uint64(j)) & np.uint64(1)).astype(bool)
        stay = np.ones(len(pos), bool)
        stay[1:-1] = fixed[1:-1] | ~((names[1:] == names[:-1]) | (half[1:] & ~half[:-1]))
        new_left, new_right = left.copy(), right.copy()
        new_left[1:], new_right[:-1] = left[:-1], right[1:]
        new_left[fixed], new_right[fixed] = pos[fixed] - 1, pos[fixed] + 1
        pos, left, right, fixed = pos[stay], new_left[stay], new_right[stay], fixed[stay]
        names = roll.of(pos[:-1], pos[1:])
    return pos, left, right, names


def least(keys: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Index of the (leftmost) least key in each non-empty range [a, b)."""
    table = [np.arange(len(keys))]
    span = int((b - a).max(initial=1))
    while 2 << (len(table) - 1) <= span:
        half = 1 << (len(table) - 1)
        x, y = table[-1][:-half], table[-1][half:]
        table.append(np.where(keys[x] <= keys[y], x, y))
    level = np.frexp((b - a).astype(float))[1] - 1
    out = np.empty(len(a), np.int64)
    for k, t in enumerate(table):
        at = np.flatnonzero(level == k)
        if len(at):
            x, y = t[a[at]], t[b[at] - (1 << k)]
            out[at] = np.where(keys[x] <= keys[y], x, y)
    return out


def window_cells(names: np.ndarray, first: np.ndarray, width: int, rounds: int) -> tuple[np.ndarray, ...]:
    """(row, ckey, cell, lo, hi) of the documents whose words begin at ``first``."""
    sizes = np.diff(first)
    row = np.repeat(np.arange(len(sizes)), np.maximum(sizes - width + 1, 0))
    if not len(row):
        none = np.zeros(0, np.int64)
        return none, none.view(np.uint64), none.view(np.uint64), none, none
    before = np.cumsum(np.maximum(sizes - width + 1, 0)) - np.maximum(sizes - width + 1, 0)
    p = np.arange(len(row)) - before[row] + first[row]
    roll = Rolling(names, 2)
    pos, left, right, symbols = recompress(names, roll, first, rounds)
    left, right = left[:-1], right[1:]
    a, b = np.searchsorted(left, p), np.searchsorted(right, p + width, side="right")
    has = a < b
    anchor = np.full(len(p), -1)
    anchor[has] = least(mix(symbols), a[has], b[has])
    new = np.ones(len(p), bool)
    new[1:] = (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1]) | ~has[1:]
    at = np.flatnonzero(new)
    lo, hi = p[at], p[np.append(at[1:], len(p)) - 1]
    i, known = anchor[at], has[at]
    ckey = roll.of(np.where(known, left[i], lo), np.where(known, right[i], lo + width))
    cell = mix(roll.of(lo, hi + width) + np.where(known, pos[i] - lo, 0).astype(np.uint64))
    ckey = mix(ckey + np.where(known, pos[i] - left[i] + 1, 0).astype(np.uint64))
    return row[at], ckey, cell, lo - first[row[at]], hi - first[row[at]]


def _cells(width: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for i, j, raw, offs in slices(batch, 1):
                starts, ends, first = words(raw, offs)
                names = word_hashes(raw, starts, ends)
                row, ckey, cell, lo, hi = window_cells(names, first, width, rounds)
                if len(row):
                    yield cell_batch(ids[i:j], row, ckey, cell, lo, hi, first_too=False)
    return run


_SINGLE = pa.schema([("ckey", pa.int64()), ("w", pa.int64()), ("doc", pa.int64()), ("lo", pa.int32())])


def _single_windows(width: int):
    """Each window of the given cells by itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            rows, ckeys, los, his = items_of(batch, 2, "ckey", "lo", "hi")
            for i, j, raw, offs in slices(batch, 1):
                starts, ends, first = words(raw, offs)
                roll = Rolling(word_hashes(raw, starts, ends), 2)
                here = slice(*np.searchsorted(rows, [i, j]))
                row, lo, n = rows[here] - i, los[here].astype(np.int64), (his[here] - los[here] + 1).astype(np.int64)
                each = np.repeat(np.arange(len(lo)), n)
                at = lo[each] + np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
                p = at + first[row[each]]
                ok = p + width <= first[row[each] + 1]
                each, at, p = each[ok], at[ok], p[ok]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ckeys[here][each]), pa.array(roll.of(p, p + width).view(np.int64)),
                    pa.array(ids[i:j][row[each]]), pa.array(at.astype(np.int32))], schema=_SINGLE)
    return run


_OUT = pa.schema([("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.large_string())])


def keep_words(raw: np.ndarray, offs: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray,
               gone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the kept words of each row, joined by one space."""
    kept = np.flatnonzero(~gone)
    row = np.searchsorted(first, kept, side="right") - 1
    more = np.zeros(len(kept), bool)
    more[:-1] = row[1:] == row[:-1]
    d = np.zeros(len(raw) + 2, np.int8)
    d[starts[kept]] += 1
    d[ends[kept]] -= 1
    use = np.cumsum(d[: len(raw)], dtype=np.int8) > 0
    gaps = ends[kept[more]]
    use[gaps] = True
    out = raw.copy()
    out[gaps] = 32
    upto = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(use, out=upto[1:])
    return out[use], upto[offs]


def _cut(width: int, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, los, his = items_of(batch, 2, "lo", "hi")
            for i, j, raw, offs in slices(batch, 1):
                starts, ends, first = words(raw, offs)
                here = slice(*np.searchsorted(rows, [i, j]))
                base, top = first[rows[here] - i], first[rows[here] - i + 1]
                gone = covered(len(starts), np.minimum(base + los[here], top), np.minimum(base + his[here] + width, top))
                data, off = keep_words(raw, offs, starts, ends, first, gone)
                upto = np.zeros(len(gone) + 1, np.int64)
                np.cumsum(gone, out=upto[1:])
                text = data.tobytes()
                texts = [text[a:b] for a, b in zip(off[:-1], off[1:], strict=True)]
                if digest:
                    texts = [hashlib.sha256(t).hexdigest() for t in texts]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), pa.array(np.diff(first)), pa.array(np.diff(upto[first])),
                    pa.array(texts, pa.large_string() if not digest else pa.string())],
                    ["doc_id", "n_words", "n_removed", "kept_sha256" if digest else "text"])
    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                    rounds: int = ROUNDS, digest: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, and text, the kept
    words joined by one space (``digest``: kept_sha256, its SHA-256, instead).

    A word goes when a window of ``width`` words that covers it also starts
    earlier, in a document of smaller identifier or earlier in the same one;
    windows are judged on the input.  Null or empty texts have no words;
    documents of fewer than ``width`` words stay whole.  Each row is a document
    of its own: null identifiers rank after every other one, and rows that
    share an identifier by their texts, as ``spans.row_keys`` says.  Other
    columns are not read; an empty table gives an empty result.
    """
    rows = row_texts(docs, id_col, text_col)
    cells = rows.select("doc", "text").mapInArrow(_cells(width, rounds), CELLS)     # cheaper to make again than to store
    known, mixed = settle(cells, "substring", first_too=False)
    mixed = stored(per_document(mixed, "ckey", "lo", "hi"), "substring-mixed")
    work = rows.join(broadcast_if_small(mixed, SMALL), "doc").select("doc", "text", "items")
    single = stored(work.mapInArrow(_single_windows(width), "ckey long, w long, doc long, lo int"), "substring-windows")
    first = (single.groupBy("ckey", "w").agg(F.min(F.struct("doc", "lo")).alias("first"), F.max(F.struct("doc", "lo")).alias("last"))
                   .where("first != last").select("ckey", "w", "first"))
    later = (single.join(first, ["ckey", "w"]).where(F.struct("doc", "lo") != F.col("first"))
                   .select("doc", "lo", F.col("lo").alias("hi")))
    cuts = stored(per_document(known.unionByName(later), "lo", "hi"), "substring-cuts")
    discard(single)
    work = rows.join(cuts, "doc", "left").select("doc_id", "text", "items")
    last = "kept_sha256 string" if digest else "text string"
    return work.mapInArrow(_cut(width, digest), f"doc_id long, n_words long, n_removed long, {last}")
