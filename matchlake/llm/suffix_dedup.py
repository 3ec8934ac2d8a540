"""Suffix-array dedup with longest-previous-factor arrays.

A text position is a copy when the suffix that starts there agrees with
another one for ``width`` bytes.  In suffix order such suffixes are
neighbours, and the previous and next smaller positions of a suffix there give
its longest previous factor; the previous and next larger ones give the
longest following factor in the same way.

Spark brings together what can agree: the least ``gram``-byte name of a window
(its anchor) depends on the window only, so suffixes that agree for ``width``
bytes carry equal anchors at equal distances.  Whole stretches that stand
elsewhere unchanged are settled by one grouping (``spans``).  The different
stretches around one anchor, a bounded number, go to one task, which orders
their suffixes and reads both factor arrays off the order.  Only agreement to
``width`` bytes matters, so the order is that of the 64-bit names of the first
``width`` bytes, not alphabetical.  Anchors with more stretches than one task
should hold are ordered by Spark instead: one row per suffix, combined on the
map side.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.columns import Rolling, byte_symbols, mix, slices, window_min
from matchlake.llm.spans import CELLS, cell_batch, covered, items_of, merged, per_document, row_texts, settle
from matchlake.llm.store import stored

WIDTH = 400
GRAM = 48
#: Different stretches around one anchor that one task orders (each shorter than two widths).
GROUP = 2048
SEED = 3


def window_cells(raw: np.ndarray, offs: np.ndarray, width: int, gram: int, roll: Rolling) -> tuple[np.ndarray, ...]:
    """(row, ckey, cell, lo, hi) of the texts of one slice."""
    none = np.zeros(0, np.int64)
    ok = np.diff(offs) >= width
    if not ok.any():
        return none, none.view(np.uint64), none.view(np.uint64), none, none
    at = np.arange(len(raw) - gram + 1)
    grams = roll.of(at, at + gram)
    order = (grams & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    low = window_min(order, width - gram + 1)
    begin, stop = offs[:-1][ok], offs[1:][ok] - width + 1
    cut = np.unique(np.concatenate([np.flatnonzero(low[1:] != low[:-1]) + 1, begin, stop]))
    lo, hi = cut[:-1], cut[1:] - 1
    row = np.searchsorted(offs, lo, side="right") - 1
    use = lo + width <= offs[np.minimum(row + 1, len(offs) - 1)]
    lo, hi, row = lo[use], hi[use], row[use]
    anchor = (low[lo] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    cell = mix(roll.of(lo, hi + width) + (anchor - lo).astype(np.uint64))
    return row, grams[anchor], cell, lo - offs[row], hi - offs[row]


def _cells(width: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = byte_symbols(SEED)
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for i, j, raw, offs in slices(batch, 1):
                row, ckey, cell, lo, hi = window_cells(raw, offs, width, gram, Rolling(table[raw], SEED))
                if len(row):
                    yield cell_batch(ids[i:j], row, ckey, cell, lo, hi, first_too=True)
    return run


_PIECE = pa.schema([("ckey", pa.int64()), ("hot", pa.bool_()), ("doc", pa.int64()), ("lo", pa.int32()),
                    ("bytes", pa.binary())])


def _stretches(width: int):
    """The bytes that the windows of each given cell cover."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            rows, ckeys, los, his, hots = items_of(batch, 2, "ckey", "lo", "hi", "hot")
            for i, j, raw, offs in slices(batch, 1):
                a, b = np.searchsorted(rows, [i, j])
                r = rows[a:b] - i
                begin, end = offs[r] + los[a:b], np.minimum(offs[r] + his[a:b] + width, offs[r + 1])
                text = raw.tobytes()
                pieces = [text[x:y] for x, y in zip(begin.tolist(), end.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ckeys[a:b]), pa.array(hots[a:b]), pa.array(ids[rows[a:b]]),
                    pa.array(los[a:b]), pa.array(pieces, pa.binary())], schema=_PIECE)
    return run


def suffixes(lens: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, offset in it, position in the joined bytes) of every window start."""
    n = np.maximum(lens - width + 1, 0)
    piece = np.repeat(np.arange(len(lens)), n)
    off = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n)
    return piece, off, off + np.repeat(np.cumsum(lens) - lens, n)


def factors(prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which suffixes, given in text order by the names of their first bytes,
    have a previous and which a following factor of that length.  A stable
    sort keeps text order among equal prefixes, so the previous smaller
    position of a suffix stands right before it, the next larger one right
    after."""
    order = np.argsort(prefix, kind="stable")
    same = prefix[order[1:]] == prefix[order[:-1]]
    previous, following = np.zeros(len(prefix), bool), np.zeros(len(prefix), bool)
    previous[order[1:]] = same
    following[order[:-1]] = same
    return previous, following


_SPAN = pa.schema([("doc", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])


def _names(tab: pa.Table, width: int) -> tuple[np.ndarray, ...]:
    col = tab.column("bytes").combine_chunks()
    col = col.chunk(0) if isinstance(col, pa.ChunkedArray) else col
    offs = np.frombuffer(col.buffers()[1], np.int32)[col.offset: col.offset + len(col) + 1]
    raw = np.frombuffer(col.buffers()[2] or b"", np.uint8)[offs[0]: offs[-1]]
    piece, off, p = suffixes(np.diff(offs).astype(np.int64), width)
    roll = Rolling(byte_symbols(SEED)[raw], SEED)
    ckey = tab.column("ckey").to_numpy().view(np.uint64)
    return piece, off, mix(roll.of(p, p + width) + ckey[piece] * np.uint64(0x9E3779B97F4A7C15))


def _order(width: int, limit: int = 1 << 21):
    """Rows sorted by (ckey, doc, lo); whole groups are ordered together."""
    def solve(tab: pa.Table) -> pa.RecordBatch:
        piece, off, name = _names(tab, width)
        previous, following = factors(name)
        copy = np.flatnonzero(previous | following)
        lo = tab.column("lo").to_numpy().astype(np.int64)[piece[copy]] + off[copy]
        r, a, b = merged(piece[copy], lo, lo)
        return pa.RecordBatch.from_arrays([pa.array(tab.column("doc").to_numpy()[r]), pa.array(a.astype(np.int32)),
                                           pa.array(b.astype(np.int32))], schema=_SPAN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, max(1, limit // width))
                batch = batch.slice(part.num_rows)
                key = part.column(0).to_numpy()
                last = int(np.searchsorted(key, key[-1]))     # the last group may go on
                if last or (rest and rest[-1].column(0)[-1].as_py() != key[0]):
                    whole = [*rest, part.slice(0, last)]
                    if sum(x.num_rows for x in whole):
                        yield solve(pa.Table.from_batches(whole))
                    rest = []
                rest.append(part.slice(last))
        if sum(x.num_rows for x in rest):
            yield solve(pa.Table.from_batches(rest))
    return run


def _rows(width: int):
    """One row per suffix: name, document, start."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                tab = pa.Table.from_batches([batch.slice(k, 1024)])
                piece, off, name = _names(tab, width)
                yield pa.RecordBatch.from_arrays([
                    pa.array(name.view(np.int64)), pa.array(tab.column("doc").to_numpy()[piece]),
                    pa.array((tab.column("lo").to_numpy()[piece] + off).astype(np.int32))], ["w", "doc", "lo"])
    return run


def _cut(width: int, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, los, his = items_of(batch, 2, "lo", "hi")
            for i, j, raw, offs in slices(batch, 1):
                a, b = np.searchsorted(rows, [i, j])
                base, top = offs[rows[a:b] - i], offs[rows[a:b] - i + 1]
                gone = covered(len(raw), np.minimum(base + los[a:b], top), np.minimum(base + his[a:b] + width, top))
                first = gone.copy()
                first[1:] &= ~gone[:-1]
                inner = offs[1:-1][offs[1:-1] < len(raw)]
                first[inner] = gone[inner]                    # a span never crosses documents
                n_gone, n_first = np.zeros(len(raw) + 1, np.int64), np.zeros(len(raw) + 1, np.int64)
                np.cumsum(gone, out=n_gone[1:])
                np.cumsum(first, out=n_first[1:])
                off = (offs - n_gone[offs]).tolist()
                kept = raw[~gone].tobytes()
                texts = [kept[x:y] for x, y in zip(off[:-1], off[1:], strict=True)]
                if digest:
                    texts = [hashlib.sha256(t).hexdigest() for t in texts]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), pa.array(np.diff(offs)), pa.array(np.diff(n_gone[offs])),
                    pa.array(np.diff(n_first[offs])), pa.array(texts, pa.string() if digest else pa.binary())],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256" if digest else "kept"])
    return run


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                 gram: int = GRAM, group: int = GROUP, digest: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans (maximal
    removed runs) and kept, the remaining bytes (``digest``: kept_sha256, their
    SHA-256, instead).

    Texts are UTF-8 bytes.  A byte goes when a string of ``width`` bytes that
    covers it also starts anywhere else, in the same document or another;
    overlaps count, and strings are judged on the input.  Null or empty texts
    have no bytes; texts shorter than ``width`` stay whole.  Each row is a
    document of its own, whether its identifier is null or repeated (see
    ``spans.row_keys``).  Other columns are not read; an empty table gives an
    empty result.
    """
    rows = row_texts(docs, id_col, text_col)
    cells = stored(rows.select("doc", "text").mapInArrow(_cells(width, gram), CELLS), "suffix-cells")
    known, mixed = settle(cells, "suffix", first_too=True)
    mixed = stored(mixed, "suffix-mixed")
    sizes = mixed.groupBy("ckey").agg((F.count("*") > group).alias("hot"))
    work = rows.join(per_document(mixed.join(sizes, "ckey"), "ckey", "lo", "hi", "hot"), "doc").select("doc", "text", "items")
    pieces = stored(work.mapInArrow(_stretches(width), "ckey long, hot boolean, doc long, lo int, bytes binary"), "suffix-pieces")
    here = (pieces.where("not hot").select("ckey", "doc", "lo", "bytes")
                  .repartition("ckey").sortWithinPartitions("ckey", "doc", "lo"))
    spans = here.mapInArrow(_order(width), "doc long, lo int, hi int")
    rest = pieces.where("hot").select("ckey", "doc", "lo", "bytes").mapInArrow(_rows(width), "w long, doc long, lo int")
    twice = rest.groupBy("w").agg(F.count("*").alias("n")).where("n > 1").select("w")
    spread = rest.join(twice, "w").select("doc", "lo", F.col("lo").alias("hi"))
    cuts = stored(per_document(known.unionByName(spans).unionByName(spread), "lo", "hi"), "suffix-cuts")
    work = rows.join(cuts, "doc", "left").select("doc_id", "text", "items")
    last = "kept_sha256 string" if digest else "kept binary"
    return work.mapInArrow(_cut(width, digest), f"doc_id long, n_bytes long, n_removed long, n_spans long, {last}")
