"""The registered queries against their DuckDB SQL or the plain versions, and the pipeline."""

import brute
import pytest

import corpus_pipeline
from cmp import compare
from matchlake.llm.queries import ORACLE_SQL, QUERIES
from oracle_compare import duck

SF = "/root/testdata/sf0.001"


def test_names():
    assert [int(q[2:].split("_")[0]) for q in sorted(QUERIES, key=lambda q: int(q[2:].split("_")[0]))] == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    assert not compare(spark, lambda s: QUERIES[name](s, SF), ORACLE_SQL[name], duck(SF))


@pytest.fixture(scope="module")
def texts(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def test_plain(spark, texts):
    want = brute.suffix_dedup(texts, 400)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op2_suffix_dedup"](spark, SF).collect()}
    assert got == {d: (*x[:3], brute.sha(x[3])) for d, x in want.items()}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op5_jaccard_join"](spark, SF).collect()}
    assert got == brute.jaccard_classes(texts)
    got = {r[0]: tuple(r)[1:6] for r in QUERIES["op6_pii"](spark, SF).collect()}
    assert got == {d: brute.pii_digest(t) for d, t in texts}


def test_pipeline(spark, texts):
    """Each stage on what its predecessor kept."""
    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
        kept[name] = [(r.doc_id, r.text) for r in docs.collect()]
    # too few labels here to learn much: no document labelled clean goes
    fine = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0").collect()}
    gone = {d for d, _ in texts} - {d for d, _ in kept["toxicity"]}
    assert len(gone & fine) <= 1
    classes = brute.jaccard_classes(kept["toxicity"], 5, 80)
    assert sorted(d for d, _ in kept["jaccard_join"]) == sorted(d for d, (_, c) in classes.items() if c == d)
    items = [(r.item_id, brute.WORD.findall((r.text or "").lower())) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {d for d, t in kept["jaccard_join"] for _, w in items if w and " ".join(w) in " ".join(brute.WORD.findall(t.lower()))}
    left = {d for d, _ in kept["decontamination"]}
    assert not leaks & left and len(left) >= len(kept["jaccard_join"]) - len(leaks) - 3
    assert {d for d, _ in kept["mixing"]} <= left
    index = corpus_pipeline.run(spark, SF).collect()
    assert {d for r in index for d in r.doc_ids} == {d for d, _ in kept["mixing"]}
