"""The additive quality model: features against plain Python, what its trees and
pairs learn, and held-out accuracy."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchlake.llm import quality_gam as gam
from matchlake.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, words double, label int, predicted int"


def plain(text):
    raw = text.encode()
    if not raw:
        return [0.0] * len(gam.FEATURES)
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    lines = [x for x in raw.split(b"\n") if x]
    n, size, symbol = max(len(words), 1), len(raw), set(b"#$%&*+/<=>@[\\]^_`{|}~")
    share = lambda f: sum(map(f, raw)) / size
    counts, letters = Counter(words), Counter(b & 31 for b in raw)
    return [math.log1p(len(words)), sum(map(len, words)) / n, math.log1p(max(map(len, words), default=0)), share(lambda b: 65 <= b < 91),
            share(lambda b: 48 <= b < 58), share(lambda b: b in b" \t\n\x0b\x0c\r"), share(lambda b: b in symbol), share(lambda b: b == 33),
            share(lambda b: b >= 128), sum(any(b in symbol for b in w) for w in words) / n, sum(all(b in symbol for b in w) for w in words) / n,
            sum(a == b for a, b in zip(words, words[1:])) / n, len(counts) / n, max(counts.values(), default=0) / n,
            sum(b in b".!?" for b in raw) / n, math.log1p(len(lines)), math.log1p(size / max(len(lines), 1)),
            1 - len(set(lines)) / max(len(lines), 1), 1 - sum((c / size) ** 2 for c in letters.values())]


TEXTS = ["", "a", " \n\t", "One two two.\nOne two two.\n\nThree!", "\n", "| | a| #b", "ÄÖ ü\x0b12 3", "x" * 3000, "go " * 2000, "end\n", "\nstart", "", "same\nsame\nsame"]


def test_features():
    parts = [t.encode() for t in TEXTS]
    raw, offs = np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    np.testing.assert_allclose(gam.features(raw, offs), [plain(t) for t in TEXTS], rtol=1e-9, atol=1e-12)


def test_interaction_needs_a_pair():
    """A label that is the exclusive or of two features: no main effect tells it, one pair does."""
    rng = np.random.default_rng(1)
    x = rng.random((3000, len(gam.FEATURES)))
    y = ((x[:, 3] > 0.5) ^ (x[:, 7] > 0.5)).astype(float)
    m = gam.learn(x, y, np.arange(3000) % 4 == 0)
    assert (7, 3) in m.pairs
    z = rng.random((1000, x.shape[1]))
    assert (((m.score(z) >= 0.5) == ((z[:, 3] > 0.5) ^ (z[:, 7] > 0.5))).mean()) > 0.95


def test_scores_are_sums_of_table_entries(spark):
    rng = np.random.default_rng(2)
    x = rng.random((1500, len(gam.FEATURES)))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + 0.2 * rng.random(1500) > 1).astype(float)
    m = gam.learn(x, y, np.arange(1500) % 4 == 0)
    rows = gam.lookup_tables(spark, m).collect()
    assert len(rows) == 1 + sum(map(len, m.tables)) + sum(t.size for t in m.pair_tables)

    def at(value, low):
        return low is None or value >= low
    one = dict(zip(gam.FEATURES, x[5]))
    total = m.intercept
    for f in gam.FEATURES:
        total += [r.value for r in rows if r.feature == f and r.other is None and at(one[f], r.low)][-1]
    for i, j in m.pairs:
        f, o = gam.FEATURES[i], gam.FEATURES[j]
        total += [r.value for r in rows if r.feature == f and r.other == o and at(one[f], r.low) and at(one[o], r.other_low)][-1]
    assert abs(total - m.logit(x[5:6])[0]) < 1e-9
    assert ((m.score(x) >= 0.5) == y).mean() > 0.93


def test_one_class_and_no_rows():
    x = np.random.default_rng(3).random((50, len(gam.FEATURES)))
    m = gam.learn(x, np.ones(50), np.zeros(50, bool))
    assert len(set(m.score(x))) == 1 and m.score(x)[0] > 0.9
    assert gam.learn(x[:0], np.zeros(0), np.zeros(0, bool)).score(x)[0] == pytest.approx(0.5)


def test_odd_rows(spark):
    good, bad = "The plain words of a text, one after the other, go on here. ", "### $$$ %%% *** &&& "
    rows = [(i, (good if i % 3 else bad) * (1 + i % 5) + str(i), "en", "s", 1, 0.1, 2.0, 1, 0) for i in range(300)]
    rows += [(None, None, None, None, None, None, None, None, None), (7, "", "", "", 0, 0.0, 0.0, 0, 0), (7, good * 5000, "", "", 0, 0.0, 0.0, 0, 0)] * 2
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(300)] + [(None, 1), (5, None), (5, 1)], "doc_id long, quality int")
    m = gam.fit(docs, labels)
    out = gam.quality(docs, m).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    once = {r.doc_id: r.predicted for r in out if r.doc_id is not None and r.doc_id != 7}
    assert sum(once[i] == (i % 3 > 0) for i in once) >= 0.97 * len(once)
    assert gam.quality(docs.where("false"), m).count() == 0
    assert gam.fit(docs, labels.where("false")).score(np.zeros((1, len(gam.FEATURES))))[0] == pytest.approx(0.5)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op11_quality"](spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = got.where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    right, poor, caught = held.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count_if(F.col("quality") == 0),
                                   F.count_if((F.col("quality") == 0) & (F.col("predicted") == 0))).first()
    assert right >= 0.95 and caught >= 0.8 * poor
