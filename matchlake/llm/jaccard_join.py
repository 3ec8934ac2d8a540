"""N-gram Jaccard join by vertical partitioning.

A document is the set of its word n-grams; equal sets are one node throughout.
The global order of the n-grams is cut into fragments, and the sets with it.

1. *Candidates.*  In the order of the hashes, linked sets share n-grams among
   the first few of each: of the first ``size - ceil(t * size) + 1 + s`` at
   least ``1 + s`` (s a small share of the size, so that one common passage is
   not enough).  These prefixes are counted over the corpus, and only nodes with
   enough n-grams that other nodes have, too, go on; the count is repeated among
   those.  A bit array of fixed size spares n-grams that stand once the second
   exchange.
2. *The join.*  n-grams are counted among the candidates; a link needs a common
   n-gram among the rarest ``size - ceil(t * size) + 1`` of each side.  First
   every node is held against the most central node it meets (that of the
   largest mean count), and linked nodes become one component; then only pairs
   of different components meet, and only when at a common n-gram each side has
   enough n-grams left to reach the threshold.  So a group of near copies costs one pair
   per member and not all pairs.
3. *Overlaps* are counted fragment by fragment and summed per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.columns import Rolling, give_back, lean, map_arrays, lower_ascii, mix, slices, word_hashes, words
from matchlake.llm.components import components
from matchlake.llm.spans import ROW, doc_key, row_keys
from matchlake.llm.store import SMALL, discard, stored, text_of
from matchlake.operators.joins import broadcast_if_small

N = 3
THRESHOLD = 90          # percent
PARTS = 4               # fragments in which overlaps are counted
SPARE = 5               # percent of a set's size by which candidate prefixes are longer
ROUNDS = 2              # times the candidates are counted again among themselves
BITS = 27               # the bit array has 2**BITS bits, whatever the corpus


def shingles(raw: np.ndarray, offs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct n-gram hashes of each row, offsets)."""
    starts, ends, first = words(raw, offs)
    names = word_hashes(raw, starts, ends)
    sizes = np.diff(first)
    count = np.where(sizes >= n, sizes - n + 1, np.minimum(sizes, 1))
    row = np.repeat(np.arange(len(sizes)), count)
    off = np.concatenate([[0], np.cumsum(count)])
    p = np.arange(len(row)) - off[row] + first[row]
    grams = Rolling(names, 2).of(p, np.minimum(p + n, first[row + 1]))
    for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
        grams[a:b].sort()
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
    upto = np.concatenate([[0], np.cumsum(new)])
    return grams[new], upto[off]


def set_names(grams: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A 64-bit name for each set."""
    sums = np.zeros(len(grams) + 1, np.uint64)
    np.cumsum(mix(grams), out=sums[1:])
    return mix(sums[off[1:]] - sums[off[:-1]] + np.diff(off).astype(np.uint64)).view(np.int64)


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, raw, offs in slices(batch, 2):
                grams, off = shingles(lower_ascii(raw), offs, n)
                size = np.diff(off)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(size),
                    pa.array(set_names(grams, off), mask=size == 0)], ["doc", "doc_id", "n", "node"])
    return run


def _prefixes(n: int, percent: int, bits=None):
    """(key, node, n): the first n-grams of each set; those alone whose bit is set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, raw, offs in slices(batch, 0):
                grams, off = shingles(lower_ascii(raw), offs, n)
                size = np.diff(off)
                # smaller sets link with equal ones only
                take = np.where(size * (100 - percent) >= percent, size * (100 - percent) // 100 + 1 + size * SPARE // 100, 0)
                row = np.repeat(np.arange(len(size)), take)
                key = grams[np.arange(len(row)) - np.repeat(np.cumsum(take) - take, take) + off[row]]
                if bits is not None:
                    at = (key & np.uint64((1 << BITS) - 1)).astype(np.int64)
                    keep = (bits.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0
                    key, row = key[keep], row[keep]
                yield pa.RecordBatch.from_arrays([
                    pa.array(key.view(np.int64)), pa.array(set_names(grams, off)[row]), pa.array(size[row])], ["key", "node", "n"])
    return run


def _candidates(texts: DataFrame, n: int, percent: int) -> DataFrame:
    """(node) of the sets that share enough of their prefix; ``texts`` is read twice."""
    map_arrays()
    columns = "key long, node long, n long"
    keys = texts.mapInArrow(lean(_prefixes(n, percent)), columns)
    multi = stored(keys.groupBy("key").agg(F.count("*").alias("k")).where("k > 1").select("key"), "jaccard-multi")
    low = F.col("key").bitwiseAND(F.lit((1 << BITS) - 1))
    words_ = (multi.groupBy(F.shiftright(low, 6).alias("at"))
                   .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), low.bitwiseAND(F.lit(63)).cast("int"))).alias("w"))
                   .toArrow())                                   # at most 2**BITS / 64 rows
    bits = np.zeros(1 << (BITS - 6), np.uint64)
    bits[words_.column("at").to_numpy()] = words_.column("w").to_numpy().view(np.uint64)
    del words_
    sent = texts.sparkSession.sparkContext.broadcast(bits)
    some = texts.mapInArrow(lean(_prefixes(n, percent, sent)), columns)
    pairs = stored(some.join(multi, "key").distinct(), "jaccard-prefixes")     # equal sets are one node from here on
    sent.destroy()
    del bits
    discard(multi)
    give_back()
    least = F.floor(F.ceil(F.col("n") * percent / 100) * SPARE / 100) + 1
    for _ in range(ROUNDS):
        common = pairs.groupBy("key").agg(F.count("*").alias("k")).where("k > 1").select("key")
        enough = (pairs.join(common, "key").groupBy("node", "n").agg(F.count("*").alias("k")).where(F.col("k") >= least))
        fewer = stored(pairs.join(enough.select("node"), "node").select("key", "node", "n"), "jaccard-prefixes")
        discard(pairs)
        pairs = fewer
    return pairs.select("node").distinct()


def _grams(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, raw, offs in slices(batch, 1):
                grams, off = shingles(lower_ascii(raw), offs, n)
                yield pa.RecordBatch.from_arrays([
                    pa.array(set_names(grams, off)),
                    pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(grams.view(np.int64)))],
                    ["node", "grams"])
    return run


def _linked(pairs: DataFrame, cut: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, n_a, n_b) that reach the threshold: their overlap is
    counted in each fragment and summed."""
    left = cut.select(F.col("node").alias("a"), "part", F.col("grams").alias("g_a"))
    right = cut.select(F.col("node").alias("b"), "part", F.col("grams").alias("g_b"))
    partial = (pairs.join(left, "a").join(right, ["b", "part"])
                    .select("a", "b", "n_a", "n_b", F.size(F.array_intersect("g_a", "g_b")).cast("long").alias("both")))
    both = F.sum("both")
    return (partial.groupBy("a", "b", "n_a", "n_b").agg(both.alias("both"))
                   .where(F.col("both") * 100 >= percent * (F.col("n_a") + F.col("n_b") - F.col("both")))
                   .select("a", "b"))


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N,
                    percent: int = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (the smallest
    identifier reachable by links, its own included).

    A-Z are lower-cased; a text of fewer than ``n`` words has its whole
    sequence as its one n-gram.  Null and empty texts have no n-gram and link
    with nothing.  Equal sets link with each other.  Rows that repeat an
    identifier are nodes of their own under one name.  A null identifier is
    never the smallest; a component of such rows alone has a null one.  Other
    columns are not read; an empty table gives an empty result.
    """
    out = _labelled(row_keys(docs, id_col, text_col), id_col, text_col, n, percent)
    lowest = (out.where("node is not null").groupBy("label").agg(F.min("doc_id").alias("lowest")))
    out = out.join(lowest, "label", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("lowest")).alias("component_id"))


def _labelled(keyed: DataFrame, id_col: str, text_col: str, n: int, percent: int) -> DataFrame:
    """(doc, doc_id, n, node, label) of each row of ``keyed`` (see ``row_keys``):
    its key, its identifier, the size and name of its set (null when empty) and
    the name of its component."""
    rows = keyed.select(F.col(ROW).alias("doc"), F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    sets = stored(rows.mapInArrow(lean(_sets(n)), "doc long, doc_id long, n long, node long"), "jaccard-sets")
    some = _candidates(rows.select("text"), n, percent)
    # one text per candidate node; only identifiers are joined with the texts
    pick = (sets.where("node is not null").groupBy("node").agg(F.min("doc").alias("doc"))
                .join(some, "node").select("doc").distinct())
    texts = rows.join(broadcast_if_small(stored(pick, "jaccard-candidates")), "doc", "left_semi")
    grams = stored(texts.select("doc_id", "text").mapInArrow(lean(_grams(n)), "node long, grams array<long>"), "jaccard-grams")
    labels = _join_candidates(grams, percent)
    discard(grams)
    return sets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _join_candidates(grams: DataFrame, percent: int) -> DataFrame:
    """(node, label) of the linked nodes among the candidates (node, grams), one row per node."""
    each = grams.select("node", F.explode("grams").alias("g"))
    common = each.groupBy("g").agg(F.count("*").alias("df")).where("df > 1")
    shared = stored(each.join(common, "g"), "jaccard-shared")
    # n-grams that no other candidate has are lost for every link
    node = (shared.groupBy("node").agg(F.count("*").alias("c"), F.sum("df").alias("s"))
                  .join(grams.select("node", F.size("grams").alias("n")), "node")
                  .where(F.col("c") * 100 >= F.col("n") * percent))
    node = stored(node.select("node", "n", "c", (-F.col("s") / F.col("n")).alias("rank")), "jaccard-nodes")
    # the rarest n-grams of a node: those of its own come first and meet nobody
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - (F.col("n") - F.col("c"))
    per_node = (shared.join(broadcast_if_small(node.select("node"), SMALL), "node", "left_semi").groupBy("node")
                      .agg(F.array_sort(F.collect_list(F.struct("df", "g"))).alias("all")).join(broadcast_if_small(node, SMALL), "node"))
    # left: n-grams of a node from its position in this order on
    index = stored(per_node.select("node", "n", "c", "rank", F.posexplode(F.slice("all", 1, prefix.cast("int"))).alias("k", "x"))
                           .select("node", "n", "rank", "x.g", (F.col("c") - F.col("k")).alias("left")), "jaccard-index")
    cut = stored(grams.join(broadcast_if_small(node.select("node"), SMALL), "node")
                      .select("node", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"), "grams")
                      .select("node", "part", F.filter("grams", lambda g: F.pmod(g, F.lit(PARTS)) == F.col("part")).alias("grams")),
                 "jaccard-cut")

    def fits(x: str, y: str):
        """At their first common n-gram, linked nodes have enough left for the threshold."""
        most = F.least(F.col(f"left_{x}"), F.col(f"left_{y}"))
        return most * 100 >= percent * (F.col(f"n_{x}") + F.col(f"n_{y}") - most)

    centre = index.groupBy("g").agg(F.min(F.struct("rank", "node", "n", "left")).alias("p"))
    best = (index.join(centre, "g")
                 .select(F.col("p.node").alias("a"), F.col("node").alias("b"), F.col("p.n").alias("n_a"), F.col("n").alias("n_b"),
                         F.col("p.left").alias("left_a"), F.col("left").alias("left_b"), "p.rank")
                 .where("a != b").where(fits("a", "b"))
                 .groupBy("b", "n_b").agg(F.min(F.struct("rank", "a", "n_a")).alias("p"))
                 .select("p.a", "b", "p.n_a", "n_b"))
    tested = stored(best, "jaccard-first")
    links = stored(_linked(tested, cut, percent), "jaccard-links")
    labels = stored(components(links, "jaccard-first"), "jaccard-labels")
    placed = stored(index.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "jaccard-placed")
    x, y = ([F.col("g"), *[F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "left", "label")]] for s in "xy")
    # n-grams whose nodes are all of one component need no second look
    open_ = placed.groupBy("g").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("g")
    left = placed.join(open_, "g")
    pairs = (left.select(*x).join(left.select(*y), "g")
                 .where((F.col("node_x") < F.col("node_y")) & (F.col("label_x") != F.col("label_y"))).where(fits("x", "y"))
                 .select(F.col("node_x").alias("a"), F.col("node_y").alias("b"), F.col("n_x").alias("n_a"), F.col("n_y").alias("n_b"))
                 .distinct())
    done = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = _linked(stored(pairs.join(done, ["a", "b"], "left_anti"), "jaccard-second"), cut, percent)
    out = stored(components(links.unionByName(more), "jaccard-second"), "jaccard-components")
    discard(shared, node, index, cut, tested, links, labels, placed)
    return out


def one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N,
                  percent: int = THRESHOLD) -> DataFrame:
    """One row of each component, all columns kept: that of the smallest
    identifier (null last); of rows that share it one with the fewest n-grams,
    the first by row key (``spans.row_keys``).

    Rows go by their keys: another row's identifier decides nothing.  Rows
    without an n-gram link with nothing and stay, but of those that repeat an
    identifier one does.
    """
    keyed = row_keys(docs, id_col, text_col)
    rows = stored(_labelled(keyed, id_col, text_col, n, percent), "jaccard-classes")
    alone = F.col("node").isNull()
    group = [F.col("label"), F.when(alone, F.col("doc_id")).alias("own"), F.when(alone & F.col("doc_id").isNull(), F.col("doc")).alias("row")]
    first = rows.groupBy(*group).agg(F.min(F.struct(doc_key("doc_id"), "n", F.col("doc").alias("row"))).alias("first"))
    gone = stored(rows.join(first.select(F.col("first.row").alias("doc")), "doc", "left_anti").select(F.col("doc").alias(ROW)),
                  "jaccard-gone")
    return keyed.join(gone, ROW, "left_anti").select(docs.columns)
