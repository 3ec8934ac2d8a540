"""Repeated windows of fixed width, found through cells; keys of rows.

A window (``width`` consecutive tokens of one document) is named by an anchor
inside it that depends on the window's tokens only, so equal windows have equal
anchors at equal distances.  Consecutive windows of one document with the same
anchor make a cell: first and last window start (lo, hi), ``ckey`` naming the
anchor, ``cell`` naming everything the cell's windows cover.  Cells are a small
fraction of the windows, and three facts settle them:

* a ckey that stands once in the corpus has no repeated window;
* equal cells repeat each other in full;
* only different cells under one ckey need a look at their single windows, and
  of equal cells one (the first occurrence) is enough for that.

Every step is a grouping with map-side combination or a join against a side
with unique keys, which AQE can split when one key is hot.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.llm.store import stored, text_of

#: Stands for a null identifier: it ranks after every other one.
NULL_ID = (1 << 63) - 1
#: The column of row keys, and the characters of a text that order rows with one identifier.
ROW = "__row"
PREFIX = 256
CELLS = "doc long, ckey long, cell long, lo int, hi int"
CELL_SCHEMA = pa.schema([("doc", pa.int64()), ("ckey", pa.int64()), ("cell", pa.int64()),
                         ("lo", pa.int32()), ("hi", pa.int32())])


def doc_key(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc")


def row_keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` and ROW, a long of its own for each row, in the order of the
    identifiers (null last); rows that share one by the first PREFIX characters
    of the text, then by its hash; equal rows in any order.

    Identifiers that do not repeat are the keys.  Otherwise the rows are sorted
    and written with their place: equal rows spread over the ranges, too, and
    only the beginnings of texts are sampled for the splitters.
    """
    keyed = docs.withColumn(ROW, doc_key(id_col))
    if keyed.groupBy(ROW).agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return keyed
    placed = docs.orderBy(F.col(id_col).cast("long").asc_nulls_last(), F.substring(text_of(text_col), 1, PREFIX),
                          F.xxhash64(text_of(text_col)), F.monotonically_increasing_id())
    return stored(placed.withColumn(ROW, F.monotonically_increasing_id()), "row-keys")


def row_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, doc_id, text): the row's key, its identifier and its whole text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return row_keys(rows, "doc_id", "text").select(F.col(ROW).alias("doc"), "doc_id", "text")


def merged(row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of starts, sorted by (row, lo) and not overlapping, joined where they touch."""
    if not len(lo):
        return row, lo, hi
    new = np.ones(len(lo), bool)
    new[1:] = (row[1:] != row[:-1]) | (lo[1:] != hi[:-1] + 1)
    at = np.flatnonzero(new)
    return row[at], lo[at], hi[np.append(at[1:], len(lo)) - 1]


def cell_batch(ids: np.ndarray, row: np.ndarray, ckey: np.ndarray, cell: np.ndarray, lo: np.ndarray, hi: np.ndarray,
               first_too: bool) -> pa.RecordBatch:
    """Rows of one slice: each different cell of a document once, and, with a
    null ckey, the intervals of starts known to be repeated because an equal
    cell stands earlier in the same document (``first_too``: or later)."""
    own = ckey * np.uint64(3) + cell + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    _, first, back, count = np.unique(own, return_index=True, return_inverse=True, return_counts=True)
    is_first = np.zeros(len(own), bool)
    is_first[first] = True
    again = ~is_first if not first_too else (count[back] > 1)
    r, a, b = merged(row[again], lo[again], hi[again])
    keep = np.flatnonzero(is_first)
    nulls = len(r)
    pad = np.zeros(nulls, np.int64)
    mask = np.concatenate([np.zeros(len(keep), bool), np.ones(nulls, bool)])
    return pa.RecordBatch.from_arrays([
        pa.array(np.concatenate([ids[row[keep]], ids[r]])),
        pa.array(np.concatenate([ckey[keep].view(np.int64), pad]), mask=mask),
        pa.array(np.concatenate([cell[keep].view(np.int64), pad]), mask=mask),
        pa.array(np.concatenate([lo[keep], a]).astype(np.int32)),
        pa.array(np.concatenate([hi[keep], b]).astype(np.int32))], schema=CELL_SCHEMA)


def settle(cells: DataFrame, name: str, first_too: bool) -> tuple[DataFrame, DataFrame]:
    """(intervals of repeated starts known from equal cells: doc, lo, hi;
    first occurrences of the different cells that share a ckey: doc, ckey, lo,
    hi).  ``cells`` is read more than once.  ``first_too``: the first of equal windows is repeated, too."""
    keyed = cells.where("ckey is not null")
    groups = keyed.groupBy("ckey").agg(F.count("*").alias("n")).where("n > 1").select("ckey")
    shared = stored(keyed.join(groups, "ckey"), f"{name}-shared")
    whole = stored(shared.groupBy("ckey", "cell").agg(F.count("*").alias("n"), F.min(F.struct("doc", "lo", "hi")).alias("first")),
                   f"{name}-whole")
    mixed = whole.groupBy("ckey").agg(F.count("*").alias("k")).where("k > 1").select("ckey")
    equal = shared.join(whole.where("n > 1").select("ckey", "cell", "first"), ["ckey", "cell"])
    if not first_too:
        equal = equal.where((F.col("doc") != F.col("first.doc")) | (F.col("lo") != F.col("first.lo")))
    known = equal.select("doc", "lo", "hi").unionByName(cells.where("ckey is null").select("doc", "lo", "hi"))
    return known, whole.join(mixed, "ckey").select("first.doc", "ckey", "first.lo", "first.hi")


def per_document(intervals: DataFrame, *cols: str) -> DataFrame:
    """One row per document with the list ``items`` of its (lo, hi, ...), which
    is at most as long as the document."""
    return intervals.groupBy("doc").agg(F.collect_list(F.struct(*cols)).alias("items"))


def items_of(batch: pa.RecordBatch, i: int, *names: str) -> tuple[np.ndarray, ...]:
    """The list column ``items``: row of each item, then its fields."""
    col = batch.column(i)
    lens = np.nan_to_num(col.value_lengths().to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
    flat = col.flatten()
    return (np.repeat(np.arange(len(col)), lens), *(flat.field(n).to_numpy(zero_copy_only=False) for n in names))


def covered(n: int, lo: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of n tokens some interval [lo, end) covers."""
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, np.minimum(lo, n), 1)
    np.add.at(d, np.minimum(end, n), -1)
    return np.cumsum(d[:-1]) > 0
