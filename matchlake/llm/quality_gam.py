"""Document quality by a generalised additive model with pairwise interactions.

Each text becomes FEATURES, numbers about its words, lines and characters.  A
feature is cut into bins at quantiles of a bounded labelled sample; the model is
an intercept, one lookup table per feature and one per chosen pair of features.
The tables are learned by cyclic boosting: feature after feature a shallow tree
(at most LEAVES leaves, found on the bins' sums of gradients) adds a small step
to that feature's table alone.  Pairs follow in the same way on what is left,
trees of one cut on either axis; those pairs are taken whose best tree explains
most.  A score is a sum of table entries, so scoring is a search of bins and
additions over whole columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.columns import Rolling, byte_symbols, slices, words
from matchlake.llm.store import stored, text_of
from matchlake.llm.toxicity import fold

SAMPLE = 20_000         # labelled documents the model is fitted on, at most
BINS = 32               # bins of a feature, at most
LEAVES = 4
PAIRS = 6
ROUNDS, PAIR_ROUNDS = 400, 150      # passes over the features and over the pairs, at most
RATE = 0.1
PATIENCE = 25           # passes without a better fit of the checking part
LEAST = 0.5             # least sum of second derivatives of a leaf
THRESHOLD = 0.3

FEATURES = ["words", "word_bytes", "longest_word", "upper", "digits", "spaces", "symbols", "exclaims", "beyond_ascii", "symbol_words",
            "bare_symbols", "again_words", "distinct_words", "top_word", "stops", "lines", "line_bytes", "again_lines", "letters_even"]


def _mask(chars: str) -> np.ndarray:
    m = np.zeros(256, bool)
    m[list(chars.encode())] = True
    return m


_SYMBOL, _STOP, _DIGIT = _mask("#$%&*+/<=>@[\\]^_`{|}~"), _mask(".!?"), _mask("0123456789")
_UPPER, _BLANK = np.zeros(256, bool), _mask(" \t\n\x0b\x0c\r")
_UPPER[65:91] = True


def features(raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of FEATURES per text; an empty text has zeros."""
    rows = len(offs) - 1
    size = np.maximum(np.diff(offs), 1)

    def per_text(mask: np.ndarray) -> np.ndarray:
        upto = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=upto[1:])
        return upto

    def share(table: np.ndarray) -> np.ndarray:
        return np.diff(per_text(table[raw])[offs]) / size
    starts, ends, first = words(raw, offs)
    n = np.diff(first)
    some = np.maximum(n, 1)
    row = np.repeat(np.arange(rows), n)
    length = ends - starts
    rolling = Rolling(byte_symbols(1)[raw], 1)
    name = rolling.of(starts, ends)
    symbols = per_text(_SYMBOL[raw])
    held = symbols[ends] - symbols[starts]
    own, at, copies = np.unique(name ^ (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True, return_counts=True)
    top, longest = np.zeros(rows), np.zeros(rows)
    np.maximum.at(top, row[at], copies)
    np.maximum.at(longest, row, length)
    again = np.zeros(len(row), bool)
    again[1:] = (name[1:] == name[:-1]) & (row[1:] == row[:-1])
    # lines: the text between newlines
    cut = np.flatnonzero(raw == 10)
    l_starts = np.sort(np.concatenate([offs[:-1], cut + 1]))
    l_row = np.searchsorted(offs, l_starts, side="right") - 1
    inside = (l_starts < len(raw)) & (l_row < rows)
    l_starts, l_row = l_starts[inside], l_row[inside]
    l_ends = np.minimum(np.append(l_starts[1:], len(raw)), offs[l_row + 1])
    l_ends = l_ends - ((l_ends > l_starts) & (raw[l_ends - 1] == 10))
    full = l_ends > l_starts
    l_starts, l_ends, l_row = l_starts[full], l_ends[full], l_row[full]
    n_lines = np.bincount(l_row, minlength=rows)
    l_name = rolling.of(l_starts, l_ends) ^ (l_row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    l_first = np.unique(l_name, return_index=True)[1]
    letters = np.bincount(np.repeat(np.arange(rows), np.diff(offs)) * 32 + (raw & 31), minlength=rows * 32).reshape(rows, 32) / size[:, None]
    per_word = lambda x: np.bincount(row, x, rows) / some
    return np.stack([
        np.log1p(n), per_word(length), np.log1p(longest), share(_UPPER), share(_DIGIT), share(_BLANK), share(_SYMBOL), share(_mask("!")),
        share(np.arange(256) >= 128), per_word(held > 0), per_word(held == length), per_word(again), np.bincount(row[at], minlength=rows) / some,
        top / some, share(_STOP) * size / some, np.log1p(n_lines), np.log1p(np.diff(offs) / np.maximum(n_lines, 1)),
        1 - np.bincount(l_row[l_first], minlength=rows) / np.maximum(n_lines, 1), 1 - (letters ** 2).sum(1)], axis=1) * (np.diff(offs) > 0)[:, None]


@dataclass
class Model:
    intercept: float
    cuts: list[np.ndarray]              # inner bounds of each feature's bins
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, k], side="right") for k, c in enumerate(self.cuts)], axis=1)

    def logit(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        out = np.full(len(x), self.intercept)
        for k, t in enumerate(self.tables):
            out += t[b[:, k]]
        for (i, j), t in zip(self.pairs, self.pair_tables):
            out += t[b[:, i], b[:, j]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def _worth(g, h):
    return np.where(h >= LEAST, g * g / (h + 1.0), -np.inf)


def shallow_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Step of each bin by a tree on the bins' sums of gradients and second
    derivatives: the best cut of any leaf, until LEAVES leaves."""
    leaves = [(0, len(g))]
    up_g, up_h = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    while len(leaves) < LEAVES:
        best = (1e-6, None, 0)
        for a, b in leaves:
            if b - a > 1:
                at = np.arange(a + 1, b)
                gain = (_worth(up_g[at] - up_g[a], up_h[at] - up_h[a]) + _worth(up_g[b] - up_g[at], up_h[b] - up_h[at])
                        - (up_g[b] - up_g[a]) ** 2 / (up_h[b] - up_h[a] + 1.0))
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], (a, b), int(at[k]))
        if best[1] is None:
            break
        a, b = best[1]
        leaves.remove((a, b))
        leaves += [(a, best[2]), (best[2], b)]
    step = np.zeros(len(g))
    for a, b in leaves:
        step[a:b] = (up_g[b] - up_g[a]) / (up_h[b] - up_h[a] + 1.0)
    return step


def cross_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and steps of the best tree of one cut on either axis (four cells)."""
    def corners(m):
        c = np.zeros((m.shape[0] + 1, m.shape[1] + 1))
        c[1:, 1:] = m.cumsum(0).cumsum(1)
        left, up, all_ = c[1:-1, -1:], c[-1:, 1:-1], c[-1, -1]
        a = c[1:-1, 1:-1]
        return a, left - a, up - a, all_ - left - up + a
    if min(g.shape) < 2:
        return 0.0, np.zeros_like(g)
    cells = list(zip(corners(g), corners(h)))
    gain = sum(_worth(x, y) for x, y in cells)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    if not np.isfinite(gain[i, j]):
        return 0.0, np.zeros_like(g)
    a, right, below, rest = (float(x[i, j] / (y[i, j] + 1.0)) for x, y in cells)
    step = np.empty_like(g)
    step[:i + 1, :j + 1], step[:i + 1, j + 1:], step[i + 1:, :j + 1], step[i + 1:, j + 1:] = a, right, below, rest
    return float(gain[i, j]), step


def _loss(logit: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logit) - y * logit)) if len(y) else 0.0


def _boost(rounds: int, terms: list, logit: np.ndarray, y: np.ndarray, check: np.ndarray) -> None:
    """Cyclic passes over ``terms`` (table, its index for every row, tree on the
    sums of gradients).  Changes the tables, and ``logit`` with them, to those of
    the pass that fits the checking rows best."""
    fit = ~check
    best, kept, since = _loss(logit[check], y[check]), [t.copy() for t, _, _ in terms], 0
    for _ in range(rounds):
        for table, at, tree in terms:
            p = 1 / (1 + np.exp(-logit[fit]))
            flat = np.ravel_multi_index(tuple(a[fit] for a in at), table.shape)
            g, h = (np.bincount(flat, w, table.size).reshape(table.shape) for w in (y[fit] - p, p * (1 - p)))
            step = RATE * tree(g, h)
            table += step
            logit += step[at]
        now = _loss(logit[check], y[check])
        since += 1
        if not check.any() or now < best - 1e-5:
            best, kept, since = now, [t.copy() for t, _, _ in terms], 0
        if since >= PATIENCE:
            break
    for (table, at, _), good in zip(terms, kept):
        logit += (good - table)[at]
        table[...] = good


def learn(x: np.ndarray, y: np.ndarray, check: np.ndarray) -> Model:
    """The model of features ``x`` and labels ``y``; rows of ``check`` choose the
    number of passes.  With a class missing the score is the same for all."""
    cuts = [np.unique(np.quantile(x[:, k], np.arange(1, BINS) / BINS)) if len(x) else np.zeros(0) for k in range(x.shape[1])]
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Model(float(np.log(share / (1 - share))), cuts, [np.zeros(len(c) + 1) for c in cuts], [], [])
    if not 0 < y.sum() < len(y):
        return model
    b, fit, logit = model.bins(x), ~check, np.full(len(y), model.intercept)
    _boost(ROUNDS, [(t, (b[:, k],), shallow_tree) for k, t in enumerate(model.tables)], logit, y, check)
    p = 1 / (1 + np.exp(-logit[fit]))
    gains = []
    for i in range(b.shape[1]):
        for j in range(i):
            shape = len(model.tables[i]), len(model.tables[j])
            flat = b[fit, i] * shape[1] + b[fit, j]
            gain, _ = cross_tree(*(np.bincount(flat, w, shape[0] * shape[1]).reshape(shape) for w in (y[fit] - p, p * (1 - p))))
            gains.append((gain, i, j))
    model.pairs = [(i, j) for gain, i, j in sorted(gains, reverse=True)[:PAIRS] if gain > 0]
    model.pair_tables = [np.zeros((len(model.tables[i]), len(model.tables[j]))) for i, j in model.pairs]
    _boost(PAIR_ROUNDS, [(t, (b[:, i], b[:, j]), lambda g, h: cross_tree(g, h)[1]) for (i, j), t in zip(model.pairs, model.pair_tables)],
           logit, y, check)
    return model


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        others = [k for k in range(batch.num_columns) if k]
        for i, j, raw, offs in slices(batch, 0):
            yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(i, j - i) for k in others), *(pa.array(c) for c in features(raw, offs).T.copy())],
                                             [*(batch.schema.names[k] for k in others), *FEATURES])


def _schema(*columns: str) -> str:
    return ", ".join([*columns, *(f"{f} double" for f in FEATURES)])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """The model of a bounded sample of labelled documents outside fold 0.

    At most ``sample`` labelled documents, those of smallest identifier hash, are
    used; of a document labelled twice the larger label counts, null labels and
    identifiers are left out.  Only their FEATURES reach the driver.  Fold 1
    chooses the number of passes, folds 2 to 4 are learned from.
    """
    known = (labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("label")).where("__id is not null and label is not null")
                   .groupBy("__id").agg(F.max("label").alias("label")).withColumn("fold", fold("__id")).where("fold != 0")
                   .orderBy(F.xxhash64("__id"), "__id").limit(sample))      # bounded, so it may be broadcast
    known = F.broadcast(stored(known, "quality-sample"))
    train = docs.select(text_of(text_col).alias("text"), F.col(id_col).alias("__id")).join(known, "__id").select("text", "label", "fold", F.xxhash64("__id").alias("h"))
    got = train.mapInArrow(_features, _schema("label int", "fold long", "h long")).toPandas().sort_values(["h", *FEATURES], kind="stable")
    return learn(got[FEATURES].to_numpy(float), (got["label"].to_numpy() > 0).astype(float), got["fold"].to_numpy() == 1)


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, raw, offs in slices(batch, 0):
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(i, j - i), pa.array(model.score(features(raw, offs)))], ["doc_id", "score"])
    return run


def quality(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, score (0 to 1, higher: better) and
    predicted (1 from ``threshold`` on).

    Null texts count as empty and have the score of zero features.  Rows that
    repeat an identifier are scored each; other columns are not read; an empty
    table gives an empty result.
    """
    rows = docs.select(text_of(text_col).alias("text"), F.col(id_col).alias("doc_id"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_score(model), f"doc_id {kind}, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def lookup_tables(spark: SparkSession, model: Model) -> DataFrame:
    """The model to be read: (feature, other, low, other_low, value), one row
    per table entry; ``low`` is the bin's lower bound (null: none), ``other`` and
    ``other_low`` are null outside pairs; the intercept has no feature."""
    low = [[None, *c.tolist()] for c in model.cuts]
    rows = [(None, None, None, None, model.intercept)]
    rows += [(FEATURES[k], None, low[k][a], None, float(v)) for k, t in enumerate(model.tables) for a, v in enumerate(t)]
    rows += [(FEATURES[i], FEATURES[j], low[i][a], low[j][c], float(t[a, c])) for (i, j), t in zip(model.pairs, model.pair_tables)
             for a in range(t.shape[0]) for c in range(t.shape[1])]
    return spark.createDataFrame(rows, "feature string, other string, low double, other_low double, value double")
