"""Exact dedup by content sort.

Texts are compared after each run of white space became one space.  Sampled
splitters range-partition the normalised bytes, each text named by its beginning
and its SHA-256, so that splitters are short whatever the texts are (ties split
further by identifier, so one text held by a third of all rows spreads over many
partitions); Spark's external sort puts equals next to each other, and each
text is compared in full with its neighbour.  A run of equal texts inside a
partition is closed there; a run that touches a partition's edge is joined to
its neighbours through an edge table of at most two rows per partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm.store import partitions, stored, text_of

WHITE = r"[\x20\x09-\x0D]+"
BEGINNING = 64          # characters of a text in its splitter
_OUT = ("doc_id long, text_sha256 string, part int, run long, first_id long, run_size long, "
        "row_in_run long, at_start boolean, at_end boolean")
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("text_sha256", pa.string()), ("part", pa.int32()),
                     ("run", pa.int64()), ("first_id", pa.int64()), ("run_size", pa.int64()),
                     ("row_in_run", pa.int64()), ("at_start", pa.bool_()), ("at_end", pa.bool_())])


def _neighbour_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal neighbours of one sorted partition.  Only the identifiers
    of the open run and one text are held."""
    part = TaskContext.get().partitionId()
    text, sha, ids, run = None, None, [], -1

    def close(last: bool) -> pa.RecordBatch:
        n, first = len(ids), ids[0]
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array([sha] * n), pa.array(np.full(n, part, np.int32)),
            pa.array(np.full(n, run, np.int64)), pa.array([first] * n, pa.int64()), pa.array(np.full(n, n, np.int64)),
            pa.array(np.arange(n)), pa.array(np.full(n, run == 0)), pa.array(np.full(n, last))], schema=_SCHEMA)

    waiting: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for doc_id, t, name in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            if run >= 0 and t == text:
                ids.append(doc_id)
                continue
            if run >= 0:
                waiting.append(close(False))
                size += len(ids)
                if size >= 4096:
                    yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                    waiting, size = [], 0
            text, sha, ids, run = t, name, [doc_id], run + 1
    if run >= 0:
        waiting.append(close(True))
        yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                num_partitions: int | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty; an empty text is a text like others.  Rows that
    repeat an identifier are rows of their own: of equal (text, identifier)
    rows exactly one is kept.  A null identifier ranks after every other one.
    Other columns are not read; an empty table gives an empty result.
    """
    n = num_partitions or partitions(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.regexp_replace(text_of(text_col), WHITE, " ").alias("norm")).withColumn("sha", F.sha2("norm", 256))
    order = [F.substring("norm", 1, BEGINNING).asc(), F.col("sha").asc(), F.col("doc_id").asc_nulls_last()]
    ordered = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    runs = stored(ordered.mapInArrow(_neighbour_runs, _OUT), "exact-dedup")

    # edge runs, at most two per partition: chain those that continue a text
    edge = (runs.where("row_in_run = 0 and (at_start or at_end)")
                .select("part", "run", "text_sha256", "first_id", "run_size", "at_start", "at_end"))
    along = Window.orderBy("part", "run")
    chained = (edge
               .withColumn("new", F.coalesce(~((F.lag("text_sha256").over(along) == F.col("text_sha256"))
                                               & F.col("at_start") & F.lag("at_end").over(along)), F.lit(True)))
               .withColumn("chain", F.sum(F.col("new").cast("long")).over(along)))
    whole = Window.partitionBy("chain")
    merged = chained.select(
        "part", "run", (~F.col("new")).alias("continued"),
        F.first("first_id").over(whole.orderBy("part", "run")).alias("chain_id"),
        F.sum("run_size").over(whole).alias("chain_size"))
    out = runs.join(F.broadcast(merged), ["part", "run"], "left")
    return out.select(
        "doc_id", F.when(F.col("chain_size").isNull(), F.col("first_id")).otherwise(F.col("chain_id")).alias("keep_id"),
        F.coalesce("chain_size", "run_size").alias("group_size"),
        ((F.col("row_in_run") == 0) & ~F.coalesce("continued", F.lit(False))).alias("kept"), "text_sha256")
