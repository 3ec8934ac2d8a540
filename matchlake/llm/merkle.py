"""Merkle manifest of a dataset with octopus multiproofs.

Rows become leaves of one tree per group, in the order of their identifiers;
the trees' roots, in the order of their groups, are the leaves of a top tree
whose root names the dataset.  Three consecutive nodes make their parent (the
last run of a level may be shorter).

``build`` places every leaf by sorted ranges (a hot group spans many) and folds
blocks of 3**BLOCK consecutive nodes at a time, so a tree of n leaves takes
log(n)/log(3**BLOCK) exchanges, each 3**BLOCK times smaller than the last.

``prove`` works by leaf partitions of at most CHUNK consecutive leaves.  Of each
the minimal union of missing node coordinates follows from its ends: on every
level the runs at both ends lack the nodes outside, all else is derived.  They
are fetched in one join for all partitions; each partition then derives the
interiors its leaves share once and expands the single proofs locally.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm.store import stored

ARITY = 3
BLOCK = 6               # levels folded by one call: blocks of 3**6 nodes
CHUNK = 2048            # leaves of a leaf partition, at most
TOP = ""                # key of the top tree; a group's key is '0' (null) or '1' and its name
_LOW = 33               # bits of monotonically_increasing_id below the partition
_POWERS = [ARITY ** k for k in range(40)]


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    """Leaf hash of a row: lowercase hex sha256 of its encoded values."""
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def digest(parts: str) -> str:
    return hashlib.sha256(parts.encode()).hexdigest()


@dataclass
class Manifest:
    rows: DataFrame             # tree, id, leaf, claim, mid: sorted, ``mid`` grows with the order
    places: DataFrame           # tree, part, first, before, n: where each partition's rows of a tree stand
    nodes: DataFrame            # tree, lvl, idx, h, n (nodes of the level)
    tops: DataFrame             # tree, top (its place in the top tree)
    n_trees: int
    root: str | None            # None: no row


def _placed(rows: DataFrame, order: list[Column], name: str) -> tuple[DataFrame, DataFrame]:
    """Rows sorted by (tree, order) and written with ``mid``, and for each tree
    and partition the first ``mid``, the rows of the tree in earlier partitions
    and in all.  ``order`` is total, so a hot tree spreads over the ranges."""
    keys = [F.col("tree").asc(), *order]
    placed = stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                        .withColumn("mid", F.monotonically_increasing_id()), name)
    own = placed.groupBy("tree", F.shiftright("mid", _LOW).alias("part")).agg(F.min("mid").alias("first"), F.count("*").alias("own"))
    w = Window.partitionBy("tree")
    earlier = F.sum("own").over(w.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    places = own.select("tree", "part", "first", F.coalesce(earlier, F.lit(0)).alias("before"), F.sum("own").over(w).alias("n"))
    return placed, stored(places, f"{name}-places")


def _indexed(placed: DataFrame, places: DataFrame) -> DataFrame:
    """``placed`` with the index of each row in its tree and the tree's size."""
    at = placed.withColumn("part", F.shiftright("mid", _LOW)).join(places, ["tree", "part"])
    return at.withColumn("idx", F.col("mid") - F.col("first") + F.col("before")).drop("first", "before")


_NODE = "tree string, lvl int, idx long, h string, n long, carry boolean"


def _fold(level: int):
    """One block of nodes of ``level`` to its nodes up to the block's root, which
    is carried to the next call unless it is the tree's root."""
    def run(table: pa.Table) -> pa.Table:
        idx, n = table.column("idx").to_numpy(), table.column("n")[0].as_py()
        order = np.argsort(idx)
        h, lo = [table.column("h")[int(i)].as_py() for i in order], int(idx.min())
        lvls, at, hs, ns = [], [], [], []

        def keep(lvl):
            lvls.extend([lvl] * len(h)), at.extend(range(lo, lo + len(h))), hs.extend(h), ns.extend([n] * len(h))
        for lvl in range(level, level + BLOCK):
            keep(lvl)
            if n == 1:
                break
            h = [digest("".join(h[k: k + ARITY])) for k in range(0, len(h), ARITY)]
            lo, n = lo // ARITY, -(-n // ARITY)
        else:
            keep(level + BLOCK)
        carry = [lvl == level + BLOCK and k > 1 for lvl, k in zip(lvls, ns)]
        return pa.table({"tree": pa.array([table.column("tree")[0].as_py()] * len(hs), pa.string()), "lvl": pa.array(lvls, pa.int32()),
                         "idx": pa.array(at, pa.int64()), "h": pa.array(hs, pa.string()), "n": pa.array(ns, pa.int64()),
                         "carry": pa.array(carry, pa.bool_())})
    return run


def _folded(leaves: DataFrame, most: int, name: str) -> DataFrame:
    """All nodes of the trees over ``leaves`` (tree, idx, h, n); ``most``: leaves of the largest."""
    level, tables = 0, []
    while True:
        block = F.expr(f"idx div {ARITY ** BLOCK}").alias("block")
        done = stored(leaves.select("tree", "idx", "h", "n").groupBy("tree", block).applyInArrow(_fold(level), _NODE), f"{name}-{level}")
        tables.append(done.where("not carry").drop("carry"))
        level += BLOCK
        if ARITY ** level >= most:
            break
        leaves = done.where("carry")
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def build(rows: DataFrame, group: Column, ident: Column, leaf: Column, claim: Column | None = None) -> Manifest:
    """The manifest of ``rows``: one tree per ``group`` (null first, else by
    UTF-8 bytes), leaves by ``ident`` (null first), rows that share it by leaf.

    ``claim`` is a leaf hash to be verified in place of a row's own; null means
    its own.  Equal rows are leaves each.  An empty table has no root.
    """
    tree = F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit("0"))
    leaves = stored(rows.select(tree.alias("tree"), ident.alias("id"), leaf.alias("leaf"), (F.lit(None).cast("string") if claim is None else claim)
                                .alias("claim")).withColumn("copy", F.monotonically_increasing_id()), "merkle-leaves")
    order = [F.col("id").asc_nulls_first(), F.col("leaf").asc(), F.col("copy").asc()]
    placed, places = _placed(leaves, order, "merkle-rows")
    most = places.agg(F.max("n")).first()[0]
    if not most:
        empty = rows.sparkSession.createDataFrame([], "tree string, lvl int, idx long, h string, n long")
        return Manifest(placed, places, empty, empty.select("tree", F.col("idx").alias("top")), 0, None)
    nodes = _folded(_indexed(placed, places).select("tree", "idx", F.col("leaf").alias("h"), "n"), most, "merkle-nodes")
    roots = nodes.where("n = 1").select(F.lit(TOP).alias("tree"), F.col("tree").alias("name"), "h")
    top, top_places = _placed(roots, [F.col("name").asc()], "merkle-top")
    tops = stored(_indexed(top, top_places), "merkle-tops")
    n_trees = tops.count()
    upper = _folded(tops, n_trees, "merkle-upper")
    root = upper.where("n = 1").first()["h"]
    return Manifest(placed, places, nodes.unionByName(upper), tops.select(F.col("name").alias("tree"), F.col("idx").alias("top")), n_trees, root)


def missing(segments: DataFrame) -> DataFrame:
    """Coordinates (.., tree, lvl, idx) that the proofs of consecutive leaves
    ``lo``..``hi`` of a tree of ``n`` lack together, columns before ``lo`` kept."""
    keep = segments.columns[: segments.columns.index("lo")]
    powers = F.array(*[F.lit(p).cast("long") for p in _POWERS])
    per = segments.withColumn("lvl", F.explode(F.sequence(F.lit(0), F.size(F.filter(powers, lambda p: p < F.col("n"))) - 1))) \
                  .where("n > 1").withColumn("p", F.element_at(powers, F.col("lvl") + 1))
    per = per.selectExpr(*keep, "lvl", "lo div p as a", "hi div p as b", "(n + p - 1) div p as size")
    ends = F.expr(f"filter(concat(transform(sequence(1, {ARITY - 1}), k -> if(k <= a % {ARITY}, a - k, null)), "
                  f"transform(sequence(1, {ARITY - 1}), k -> if(k <= {ARITY - 1} - b % {ARITY} and b + k < size, b + k, null))), i -> i is not null)")
    return per.select(*keep, F.col("lvl").cast("int").alias("lvl"), F.explode(ends).alias("idx"))


def _climb(tree: str, lo: int, h: list[str], n: int, fetched: dict) -> tuple[list[tuple[int, list[str], list[str]]], str]:
    """For each level the first place held and, of each place, what stands left
    and right of it in its run; and the root derived."""
    levels, lvl = [], 0
    while n > 1:
        hi = lo + len(h) - 1
        a, b = lo - lo % ARITY, min(hi - hi % ARITY + ARITY, n)
        row = [*(fetched[tree, lvl, i] for i in range(a, lo)), *h, *(fetched[tree, lvl, i] for i in range(hi + 1, b))]
        left, right, up = [], [], []
        for k in range(0, len(row), ARITY):
            run = row[k: k + ARITY]
            for j in range(len(run)):
                left.append("".join(run[:j]))
                right.append("".join(run[j + 1:]))
            up.append(digest("".join(run)))
        levels.append((a, left, right))
        lo, h, n, lvl = a // ARITY, up, -(-n // ARITY), lvl + 1
    return levels, h[0]


def _expand(root: str, n_trees: int, proofs: bool):
    def run(leaves: pa.Table, nodes: pa.Table) -> pa.Table:
        fetched = {(t, lvl, i): h for t, lvl, i, h in zip(*(nodes.column(c).to_pylist() for c in ("tree", "lvl", "idx", "h")))}
        leaves = leaves.take(pa.array(np.lexsort((leaves.column("idx").to_numpy(), leaves.column("top").to_numpy()))))
        top, idx, n = (leaves.column(c).to_numpy() for c in ("top", "idx", "n"))
        tree, leaf, claim = (leaves.column(c).to_pylist() for c in ("tree", "leaf", "claim"))
        starts = np.flatnonzero(np.r_[True, top[1:] != top[:-1]]).tolist()
        ends = [*starts[1:], len(top)]
        climbed = [_climb(tree[s], int(idx[s]), leaf[s:e], int(n[s]), fetched) for s, e in zip(starts, ends)]
        above, _ = _climb(TOP, int(top[0]), [r for _, r in climbed], n_trees, fetched)
        subroots, sums, folded, siblings = [], [], [], []
        for (levels, subroot), s, e in zip(climbed, starts, ends):
            for k in range(s, e):
                h, proof = claim[k] or leaf[k], []
                for path, at in ((levels, int(idx[k])), (above, int(top[k]))):
                    for a, left, right in path:
                        x, y = left[at - a], right[at - a]
                        proof.append(x + y)
                        h = digest(x + h + y)
                        at //= ARITY
                subroots.append(subroot), folded.append(h), sums.append(digest("".join(proof)))
                if proofs:
                    siblings.append(["".join(proof)[j: j + 64] for j in range(0, sum(map(len, proof)), 64)])
        out = {"id": leaves.column("id"), "tree": leaves.column("tree"), "leaf": leaves.column("leaf"), "subroot": pa.array(subroots, pa.string()),
               "proof_sha256": pa.array(sums, pa.string()), "folded_root": pa.array(folded, pa.string()),
               "verified": pa.array([h == root for h in folded], pa.bool_())}
        if proofs:
            out["siblings"] = pa.array(siblings, pa.list_(pa.string()))
        return pa.table(out)
    return run


def prove(m: Manifest, proofs: bool = False) -> DataFrame:
    """One row per leaf: id, tree, leaf, subroot, root, proof_sha256 (hash of
    its siblings, level by level from the leaf through the subroot to the root,
    left to right), folded_root (from the claimed leaf and those siblings) and
    verified (folded_root is the manifest's root); ``proofs`` adds ``siblings``.
    """
    kind = m.rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, tree string, leaf string, subroot string, proof_sha256 string, folded_root string, verified boolean"
    schema += ", siblings array<string>" if proofs else ""
    if m.root is None:
        return m.rows.sparkSession.createDataFrame([], schema).withColumn("root", F.lit(None).cast("string"))
    places = stored(m.places.join(m.tops, "tree"), "merkle-where")
    chunk = F.expr(f"(mid & {(1 << _LOW) - 1}) div {CHUNK}").alias("chunk")
    leaves = _indexed(m.rows, places).select("part", chunk, "tree", "top", "id", "leaf", "claim", "idx", "n")
    ends = m.rows.groupBy(F.shiftright("mid", _LOW).alias("part"), chunk, "tree").agg(F.min("mid").alias("a"), F.max("mid").alias("b"))
    ends = stored(ends.join(places, ["tree", "part"]).selectExpr(
        "part", "chunk", "tree", "a - first + before as lo", "b - first + before as hi", "n", "top"), "merkle-ends")
    upper = ends.groupBy("part", "chunk").agg(F.min("top").alias("lo"), F.max("top").alias("hi")).select(
        "part", "chunk", F.lit(TOP).alias("tree"), "lo", "hi", F.lit(m.n_trees).cast("long").alias("n"))
    wanted = missing(ends.drop("top").unionByName(upper))
    fetched = wanted.join(m.nodes.select("tree", "lvl", "idx", "h"), ["tree", "lvl", "idx"]).select("part", "chunk", "tree", "lvl", "idx", "h")
    out = leaves.groupBy("part", "chunk").cogroup(fetched.groupBy("part", "chunk")).applyInArrow(_expand(m.root, m.n_trees, proofs), schema)
    return out.withColumn("root", F.lit(m.root))


def tampered_leaf(id_col: str = "doc_id", text_col: str = "text", others: tuple[str, ...] = ("source", "lang", "n_chars")) -> Column:
    """The leaf of a row whose text has lost its newlines, where 2 divides the
    crc32 of the identifier; null (as it was) for other rows, for texts without
    newlines or null, and for null identifiers."""
    hit = (F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0) & F.contains(F.col(text_col), F.lit("\n"))
    text = F.replace(F.col(text_col), F.lit("\n"), F.lit(""))
    return F.when(hit, leaf_of(F.col(id_col), *[F.col(c) for c in others], text))
