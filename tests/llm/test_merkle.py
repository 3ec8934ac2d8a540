"""The Merkle manifest against plain recursion, and the size of its multiproofs."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from matchlake.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, id long, idx long, h string, n long, copy int"


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(out[-1][k:k + 3]) for k in range(0, len(out[-1]), 3)])
    return out


def siblings(tree, at):
    out = []
    for row in tree[:-1]:
        first = at // 3 * 3
        out.append((row[first:at], row[at + 1:first + 3]))
        at //= 3
    return out


def plain(rows):
    """Rows as in the query, sorted; of rows with the same identifier and leaf any order."""
    trees = {}
    for d, t, lang, source, n in rows:
        said = t.replace("\n", "") if t is not None and d is not None and zlib.crc32(str(d).encode()) % 2 == 0 else t
        trees.setdefault(source, []).append((d is not None, d or 0, leaf(d, source, lang, n, t), leaf(d, source, lang, n, said), d))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: levels([x[2] for x in sorted(trees[s], key=lambda x: x[:3])]) for s in names}
    top = levels([built[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for at, (_, _, own, claim, d) in enumerate(sorted(trees[s], key=lambda x: x[:3])):
            path = siblings(built[s], at) + siblings(top, k)
            folded = claim
            for left, right in path:
                folded = h([*left, folded, *right])
            out.append((d, own, built[s][-1][0], top[-1][0], h(x for a, b in path for x in (*a, *b)), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def run(spark, rows):
    docs = spark.createDataFrame([(d, t, lang, s, n, "x", 1, 2, "h", 3, 4) for d, t, lang, s, n in rows], SCHEMA).repartition(5)
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    m = merkle.build(docs, F.col("source"), F.col("doc_id"), merkle.leaf_of(*values), merkle.tampered_leaf())
    return m, merkle.prove(m, proofs=True)


def rows_of(out):
    return sorted([(r.id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in out.collect()], key=str)


CASES = {
    "one": [(7, "a\nb", "en", "s", 3)],
    "runs": [(i, f"t{i}\n\nü", "en", s, i) for s, n in (("b", 1), ("a", 3), ("é", 4), (None, 28), ("", 10)) for i in range(100 * n, 101 * n + n)],
    "odd": [(None, None, None, None, None), (None, "", "", "", 0), (5, None, "en", "s", None), (5, "\n", "en", "s", 1), (5, "\n", "en", "s", 1),
            (-3, " \n", None, "s", 2), (8, "x" * 300_000 + "\n", "en", "t", 9)],
}


@pytest.mark.parametrize("name", CASES)
def test_against_recursion(spark, name, monkeypatch):
    monkeypatch.setattr(merkle, "CHUNK", 4)         # many leaf partitions, proofs across their borders
    monkeypatch.setattr(merkle, "BLOCK", 2)         # several rounds of folding
    _, out = run(spark, CASES[name])
    out = out.cache()
    assert rows_of(out) == plain(CASES[name])
    for r in out.collect():
        assert h(r.siblings) == r.proof_sha256 and all(len(x) == 64 for x in r.siblings)


def test_one_group_holds_all(spark):
    rows = [(i, f"{i}\n", "en", "hot", 1) for i in range(5000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        m, out = run(spark, rows)
        assert rows_of(out) == plain(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert m.places.count() > 1                     # the hot group spans partitions


def test_empty(spark):
    m, out = run(spark, [])
    assert m.root is None and out.count() == 0 and "siblings" in out.columns


def test_union_is_minimal(spark):
    """Leaves 4..16 of 28: whole runs inside are derived, only the ends' runs are asked for."""
    seg = spark.createDataFrame([("k", "t", 4, 16, 28)], "part string, tree string, lo long, hi long, n long")
    got = sorted((r.lvl, r.idx) for r in merkle.missing(seg).collect())
    assert got == [(0, 3), (0, 17), (1, 0), (2, 2), (3, 1)]
    whole = spark.createDataFrame([("k", "t", 0, 27, 28)], "part string, tree string, lo long, hi long, n long")
    assert not merkle.missing(whole).collect()


def test_tampering_is_found(spark):
    rows = [(i, "a\nb" if i % 3 else "ab", "en", "s", 3) for i in range(60)]
    _, out = run(spark, rows)
    for r in out.collect():
        assert r.verified == (zlib.crc32(str(r.id).encode()) % 2 == 1 or r.id % 3 == 0)
