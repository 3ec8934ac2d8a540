"""Decontamination against a search of every place of every document."""

import numpy as np
import pytest

from matchlake.llm import decontaminate as d


def every_place(names, item, same=d.SAME, close=d.CLOSE):
    """Whether some window, wide enough for the item and the operator's slack,
    holds the item as the operator would accept it."""
    kinds, slack, n = np.unique(item), d.BLOCK + len(item) // 4, len(item)
    held = np.concatenate([[0], np.cumsum(np.isin(names, kinds))])
    for at in range(0, max(len(names) - 1, 1), d.BLOCK):
        lo, hi = max(at - slack, 0), min(at + d.BLOCK + n + slack, len(names))
        if held[hi] - held[lo] < close * n:
            continue
        region = d.among(kinds, names[lo:hi])
        share = d.common(item, region) / n
        if share >= same or share >= close and d.common(item[-d.ANSWER:], region) >= min(d.ANSWER, n) - 1:
            return True
    return False


def words_of(text):
    raw = np.frombuffer((text or "").encode(), np.uint8)
    return d._words(raw, np.array([0, len(raw)]))[0]


def test_recall_against_every_place(spark):
    sf = "/root/testdata/sf0.01"
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    found = {(r.doc_id, r.item_id) for r in d.contaminated(docs, bench).collect()}
    items = [(r.item_id, w) for r in bench.collect() if len(w := words_of(r.text))]
    want = set()
    for r in docs.select("doc_id", "text").collect():
        names = words_of(r.text)
        seen = set(names.tolist())
        want |= {(r.doc_id, it) for it, w in items if sum(x in seen for x in w.tolist()) >= d.CLOSE * len(w) and every_place(names, w)}
    assert len(want) >= 20 and found <= want
    assert len(found & want) >= 0.9 * len(want)


def test_paraphrases_and_answers(spark):
    """Items with words swapped out, dropped and put in, in long documents; the same words in another order are left alone."""
    rng = np.random.default_rng(4)
    vocab = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(3000)]
    say = lambda n: [vocab[k] for k in rng.integers(0, 3000, n)]
    items = [say(int(n)) for n in rng.integers(20, 50, 40)]
    rows, want = [], set()
    for k, item in enumerate(items):
        near = [say(1)[0] if rng.random() < 0.08 else w for w in item if rng.random() > 0.05]
        rows.append((k, " ".join(say(300) + near + say(200))))
        share = d.common(words_of(" ".join(item)), words_of(" ".join(near))) / len(item)
        if share >= d.SAME:
            want.add((k, k))
        rows.append((100 + k, " ".join(say(100) + sorted(item) + say(100))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in d.contaminated(docs, bench).collect()}
    assert len(want) >= 25 and len(found & want) >= 0.9 * len(want) and all(a < 100 for a, _ in found)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_weak_directions_do_not_overflow(spark, n):
    """Hardly any text: most directions have no power, and nothing becomes infinite."""
    docs = spark.createDataFrame([(k, f"the only words here {k}") for k in range(n)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "the only words here are these")], "item_id long, text string")
    with np.errstate(over="raise"):
        space = d.fit_space(docs, bench)
        assert np.isfinite(space.basis.astype(np.float16)).all()
        assert d.contaminated(docs, bench).count() == 0


def test_space_knows_every_document(spark):
    """Words that stand in one document of thousands have a place in the latent space, whichever documents those are."""
    rare = [f"rare{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(40)]
    rows = [(k, f"usual words all over {rare[k // 100] if k % 100 == 0 else 'here'}") for k in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    space = d.fit_space(docs, spark.createDataFrame([(1, "some other words")], "item_id long, text string"))
    seen = np.abs(space.basis[d._term(words_of(" ".join(rare).replace("0", "")))]).max(axis=1)
    assert (seen > 1e-4 * np.abs(space.basis).max()).all()


@pytest.mark.parametrize("longest", [1, d.PIECE, d.PIECE + 1, 40 * d.PIECE])
def test_sums_of_runs(longest):
    """Runs of any length, longer than a piece of a piece, and more than a tile of them."""
    rng = np.random.default_rng(longest)
    size = rng.integers(1, longest + 1, 3 * d.TILE + 5)
    end = np.cumsum(size)
    start, at = end - size, rng.integers(0, 50, end[-1])
    table = rng.integers(-9, 9, (50, 7)).astype(np.float32)
    want = np.add.reduceat(table[at], start, axis=0)
    assert (d.sums(table, at, start, end) == want).all()
    names = rng.permutation(len(size) + 4)[: len(size)]
    total = np.ones((len(size) + 4, 7))
    d.add_sums(total, names, table, at, start, end)
    assert (total[names] == want + 1).all() and total.sum() == total.size + want.sum()
    assert d.sums(table, at, start[:0], end[:0]).shape == (0, 7)


def test_sketch_is_linear_in_time_per_word():
    """The products with all passages, against a plain sum over passages, on rows of no, one, few and many words."""
    import time

    import pyarrow as pa

    rng = np.random.default_rng(3)
    rows = [rng.integers(0, 900, n) ** 2 % d.TERMS for n in [0, 1, 7, 8, 9, 16, 17, 24, 400, 0]]
    idf = rng.random(d.TERMS, np.float32)
    basis = rng.standard_normal((d.TERMS, 136)).astype(np.float16)

    class Sent:
        value = (idf, basis)

    def sketch(texts):
        batch = pa.RecordBatch.from_arrays([pa.array([t.astype("<u2").tobytes() for t in texts], pa.binary()),
                                            pa.array(np.arange(len(texts)) + 1.0)], ["terms", "weight"])
        (out,) = d._sketch(Sent, 8)(iter([batch]))
        return np.concatenate([np.frombuffer(x.as_py(), np.float32) for x in out.column("sums")]).reshape(d.TERMS, -1)

    want = np.zeros((d.TERMS, 136))
    for k, t in enumerate(rows):
        cuts = range(0, len(t), 8)
        for c in [c for c in cuts if c + 8 < len(t)] or cuts:
            a = np.zeros(d.TERMS)
            np.add.at(a, t[c: c + 16], idf[t[c: c + 16]])
            want += (k + 1) * np.outer(a, a @ basis.astype(float)) / (idf[t[c: c + 16]] ** 2).sum()
    assert np.abs(sketch(rows) - want).max() < 1e-4 * np.abs(want).max()

    many = [rng.zipf(1.3, 4000) % d.TERMS for _ in range(250)]
    started, began = time.process_time(), time.perf_counter()
    sketch(many)
    took = min(time.process_time() - started, time.perf_counter() - began)
    started, began = time.process_time(), time.perf_counter()
    flat = np.concatenate(many)
    np.add.reduceat(basis.astype(np.float32)[flat], np.arange(0, len(flat), 8), axis=0)
    plain = min(time.process_time() - started, time.perf_counter() - began)
    assert took < 1.2 * plain           # both sums cost less than one by ``reduceat``
