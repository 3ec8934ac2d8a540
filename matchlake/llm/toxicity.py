"""Toxic spans by a linear-chain conditional random field.

Tokens are runs of letters.  A bounded sample of labelled documents, half of
it, gives each word and word beginning a cautious log-odds of standing in a
toxic document; its level is what the field sees of a token.  In the other half
the tokens of high level in toxic documents are labelled toxic, and the field
(two tags; weights for levels, for changes of tag and for the start) is fitted
to them by conditional likelihood.  Forward-backward over a whole text then
gives every token's marginal; the probability that any token is toxic and the
expected number of toxic ones, calibrated by logistic regression, are the
document's score, and the likely tokens its offending offsets.

Tokens of level 0 share one matrix, so a stretch of them is a power of it: the
passes visit the other tokens only and stay exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.llm.columns import give_back, lean, lower_ascii, map_arrays, mix, slices, word_hashes, words
from matchlake.llm.store import discard, stored, text_of

SAMPLE = 20_000         # labelled documents the model is fitted on, at most
TERMS = 8192            # words and word beginnings it knows, at most
BEGINNING = 5           # bytes of a word beginning
WINDOW = 48             # tokens of a training window
WINDOWS = 4096          # training windows, at most
LEVELS = np.array([0.5, 1.5, 2.5, 3.5, 4.5])   # log-odds that separate the levels 0..5
TOXIC_LEVEL = 3         # tokens of this level in a toxic document are labelled toxic
FOLDS = 5


def fold(id_col: str) -> Column:
    """crc32 of the identifier as text modulo 5; 0 is held out.  A null
    identifier counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def _tokens(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """(word names, names of beginnings, starts, ends, first token of each row)"""
    raw = lower_ascii(raw)
    starts, ends, first = words(raw, offs, letters=True)
    whole = word_hashes(raw, starts, ends)
    begin = word_hashes(raw, starts, np.minimum(ends, starts + BEGINNING)) ^ np.uint64(0x5BD1E995)
    return whole, begin, starts, ends, first


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class that hold a word or a beginning, per slice."""
    for batch in batches:
        label = batch.column(1).to_numpy(zero_copy_only=False)
        for i, j, raw, offs in slices(batch, 0):
            whole, begin, _, _, first = _tokens(raw, offs)
            row = np.repeat(np.arange(j - i), np.diff(first))
            pairs = np.unique(np.stack([np.concatenate([whole, begin]), np.concatenate([row, row]).astype(np.uint64)]), axis=1)
            term, at = np.unique(pairs[0], return_inverse=True)
            toxic = label[i:j][pairs[1].astype(np.int64)] > 0
            yield pa.RecordBatch.from_arrays([
                pa.array(term.view(np.int64)), pa.array(np.bincount(at, toxic, len(term)).astype(np.int64)),
                pa.array(np.bincount(at, ~toxic, len(term)).astype(np.int64))], ["term", "p", "q"])


@dataclass
class Model:
    terms: np.ndarray           # sorted names
    levels: np.ndarray          # level of each
    field: np.ndarray           # start, 0->1, 1->0, 1->1, weight of each level
    final: np.ndarray           # weights of the document's features, the last one constant

    def level(self, names: np.ndarray) -> np.ndarray:
        if not len(self.terms):
            return np.zeros(len(names), np.int8)
        at = np.minimum(np.searchsorted(self.terms, names), len(self.terms) - 1)
        return np.where(self.terms[at] == names, self.levels[at], 0).astype(np.int8)


def signals(model: Model, raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, token index in the row, level, start, end) of tokens above level
    0, and the number of tokens of each row."""
    whole, begin, starts, ends, first = _tokens(raw, offs)
    level = np.maximum(model.level(whole), model.level(begin))
    at = np.flatnonzero(level)
    row = np.searchsorted(first, at, side="right") - 1
    return row, at - first[row], level[at], starts[at], ends[at], np.diff(first)


def _potentials(field: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    start = np.array([1.0, np.exp(field[0])])
    change = np.array([[1.0, np.exp(field[1])], [np.exp(field[2]), np.exp(field[3])]])
    return start, change, np.exp(field[4:])


def _power(a: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """a**n for each n as (matrix, log of a factor)."""
    half, det = (a[0, 0] + a[1, 1]) / 2, a[0, 0] * a[1, 1] - a[0, 1] * a[1, 0]
    root = np.sqrt(max(half * half - det, 1e-18))
    one, two = half + root, half - root
    ratio = np.power(two / one, n)[:, None, None]
    eye = np.eye(2)
    return ((a - two * eye) - ratio * (a - one * eye)) / (2 * root), n * np.log(one)


def marginals(field: np.ndarray, row: np.ndarray, index: np.ndarray, level: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log of the partition sum of each row, where the all-clean path weighs 1;
    toxic marginal of each token given)."""
    start, change, weight = _potentials(field)
    plain = change * np.array([1.0, weight[0]])
    rows = len(n)
    count = np.bincount(row, minlength=rows)
    off = np.cumsum(count) - count
    alpha = np.tile([1.0, 0.0], (rows, 1))      # before the first token; see ``enter``
    enter = np.array([[1.0, start[1]], [0.0, 0.0]])
    log = np.zeros(rows)
    kept_alpha = np.zeros((len(row), 2))
    last = np.full(rows, -1)

    def advance(alpha, log, who, steps, begin):
        """Over ``steps`` tokens of level 0."""
        first = begin & (steps > 0)
        alpha[first] = alpha[first] @ (enter * np.array([1.0, weight[0]]))
        steps = steps - first
        m, f = _power(plain, steps.astype(float))
        return np.einsum("ri,rij->rj", alpha, m), log + f

    order = np.argsort(-count, kind="stable")
    for k in range(int(count.max(initial=0))):
        who = order[: np.searchsorted(-count[order], -k, side="left")]
        at = off[who] + k
        a, f = advance(alpha[who], log[who], who, index[at] - last[who] - 1, last[who] < 0)
        step = np.where((index[at] == 0)[:, None, None], enter, change)
        a = np.einsum("ri,rij->rj", a, step)
        a[:, 1] *= weight[level[at]]
        total = a.sum(1)
        alpha[who], log[who] = a / total[:, None], f + np.log(total)
        kept_alpha[at], last[who] = alpha[who], index[at]
    rest = n - last - 1
    alpha, log = advance(alpha, log, np.arange(rows), rest, last < 0)
    log_z = log + np.log(alpha.sum(1))
    # backward: the sum over what follows each tag, up to a factor
    beta = np.ones((rows, 2))
    then = n.copy()
    out = np.zeros(len(row))
    for k in range(int(count.max(initial=0)) - 1, -1, -1):
        who = order[: np.searchsorted(-count[order], -k, side="left")]
        at = off[who] + k
        m, _ = _power(plain, (then[who] - index[at] - 1).astype(float))
        b = np.einsum("rij,rj->ri", m, beta[who])
        p = kept_alpha[at] * b
        out[at] = p[:, 1] / p.sum(1)
        b[:, 1] *= weight[level[at]]
        b = np.einsum("ij,rj->ri", change, b)
        beta[who], then[who] = b / b.sum(1)[:, None], index[at]
    return log_z, out


def features(log_z: np.ndarray, row: np.ndarray, marginal: np.ndarray, n: np.ndarray) -> np.ndarray:
    expected = np.bincount(row, marginal, len(n))
    some = np.where(log_z > 30, log_z, np.log(np.expm1(np.clip(log_z, 1e-12, 30))))
    return np.stack([np.clip(some, -15, 15), np.log1p(expected), np.log1p(n), np.ones(len(n))], axis=1)


def fit_field(levels: np.ndarray, tags: np.ndarray, n_levels: int, rounds: int = 150) -> np.ndarray:
    """Weights by gradient ascent on the conditional likelihood of windows of tokens."""
    theta = np.zeros(4 + n_levels)
    theta[:4] = [-3, -3, -1, 0]
    w, t = levels.shape
    seen = np.zeros_like(theta)
    seen[0] = tags[:, 0].sum()
    for a, b, i in ((0, 1, 1), (1, 0, 2), (1, 1, 3)):
        seen[i] = ((tags[:, :-1] == a) & (tags[:, 1:] == b)).sum()
    seen[4:] = np.bincount(levels[tags == 1], minlength=n_levels)
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    for r in range(1, rounds + 1):
        start, change, weight = _potentials(theta)
        emit = np.ones((w, t, 2))
        emit[:, :, 1] = weight[levels]
        alpha, beta = np.zeros((t, w, 2)), np.ones((t, w, 2))
        for k in range(t):
            a = (start if k == 0 else alpha[k - 1] @ change) * emit[:, k]
            alpha[k] = a / a.sum(1, keepdims=True)
        for k in range(t - 2, -1, -1):
            b = (beta[k + 1] * emit[:, k + 1]) @ change.T
            beta[k] = b / b.sum(1, keepdims=True)
        p = alpha * beta
        p = (p / p.sum(2, keepdims=True))[:, :, 1]
        expect = np.zeros_like(theta)
        expect[0] = p[0].sum()
        expect[4:] = np.bincount(levels.T.ravel(), p.ravel(), n_levels)
        joint = alpha[:-1, :, :, None] * change * (beta[1:] * emit.transpose(1, 0, 2)[1:])[:, :, None, :]
        joint /= joint.sum((2, 3), keepdims=True)
        joint = joint.sum((0, 1))
        expect[1:4] = joint[0, 1], joint[1, 0], joint[1, 1]
        gradient = (seen - expect) / w - 2e-4 * theta
        m1, m2 = 0.9 * m1 + 0.1 * gradient, 0.99 * m2 + 0.01 * gradient ** 2
        theta = theta + 0.1 * (m1 / (1 - 0.9 ** r)) / (np.sqrt(m2 / (1 - 0.99 ** r)) + 1e-8)
    return theta


def fit_final(x: np.ndarray, y: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps, lightly regularised."""
    theta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-2 * np.eye(len(theta))
        theta = theta + np.linalg.solve(h, x.T @ (y - p) - 1e-2 * theta)
    return theta


_WINDOW = "signal boolean, key long, toxic int, levels binary"


def _windows(model: Model):
    """Windows of levels of (text, toxic, h): one around every eighth token
    above level 0 of a document (``signal``), and one where it begins."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, ids = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
            for i, j, raw, offs in slices(batch, 0):
                row, index, level, _, _, n = signals(model, raw, offs)
                begins = np.flatnonzero(n > 0)
                pick = np.flatnonzero((np.arange(len(row)) - np.searchsorted(row, row)) % 8 == 0)
                w_row = np.concatenate([begins, row[pick]])
                w_at = np.concatenate([np.zeros(len(begins), np.int64), np.maximum(index[pick] - WINDOW // 2, 0)])
                levels = np.zeros((len(w_row), WINDOW), np.int8)
                place = row * (1 << 32) + index
                lo = np.searchsorted(place, w_row * (1 << 32) + w_at)
                hi = np.searchsorted(place, w_row * (1 << 32) + w_at + WINDOW)
                own = np.repeat(np.arange(len(w_row)), hi - lo)
                at = np.arange(len(own)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[own]
                levels[own, index[at] - w_at[own]] = level[at]
                key = mix(mix(ids[i:j].astype(np.int64).view(np.uint64)[w_row]) + w_at.astype(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(len(w_row)) >= len(begins)), pa.array(key), pa.array(toxic[i:j][w_row], pa.int32()),
                    pa.array([x.tobytes() for x in levels], pa.binary())], ["signal", "key", "toxic", "levels"])
    return run


def training_windows(rows: DataFrame, model: Model, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """Levels and tags of at most ``windows`` windows of ``rows`` (text, toxic,
    h), those of smallest hash: half document beginnings and half signal
    windows, or more of one where the other has fewer."""
    every = stored(rows.select("text", "toxic", "h").mapInArrow(lean(_windows(model)), _WINDOW), "toxicity-windows")
    begins, hot = (every.where(kind).orderBy("key", "levels", "toxic").limit(windows).collect() for kind in ("not signal", "signal"))
    discard(every)
    some = min(len(begins), max(windows // 2, windows - len(hot)))
    got = begins[:some] + hot[:windows - some]
    levels = np.frombuffer(b"".join(r["levels"] for r in got), np.int8).reshape(-1, WINDOW).astype(np.int64)
    tags = (levels >= TOXIC_LEVEL) & (np.array([r["toxic"] for r in got], np.int64) > 0)[:, None]
    return levels, tags.astype(np.int64)


def _features(model: Model):
    """What the score is made of, for each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, raw, offs in slices(batch, 0):
                row, index, level, _, _, n = signals(model, raw, offs)
                log_z, p = marginals(model.field, row, index, level, n)
                x = features(log_z, row, p, n)
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(i, j - i), *(pa.array(c) for c in x.T.copy())],
                                                 ["toxic", "f0", "f1", "f2", "f3"])
    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample: int = SAMPLE, terms: int = TERMS, windows: int = WINDOWS) -> Model:
    """The model of a bounded sample of labelled documents outside fold 0.

    At most ``sample`` labelled documents, those of smallest identifier hash,
    are used; of a document labelled twice the larger label counts, and null
    labels and identifiers are left out.  Token labels are made up: a token of
    TOXIC_LEVEL or more in a toxic document counts as toxic.  The field is fitted
    on at most ``windows`` windows of WINDOW tokens (``training_windows``), and
    only they and four numbers a document reach the driver.  With a class
    missing the score is the same for all documents.
    """
    map_arrays()
    known = (labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("toxic"))
                   .where(F.col("__id").isNotNull() & F.col("toxic").isNotNull())
                   .groupBy("__id").agg(F.max("toxic").alias("toxic")).withColumn("fold", fold("__id")).where("fold != 0")
                   .orderBy(F.xxhash64("__id"), "__id").limit(sample))      # bounded, so it may be broadcast
    known = F.broadcast(stored(known, "toxicity-sample"))
    train = stored(docs.select(F.col(id_col).alias("__id"), text_of(text_col).alias("text")).join(known, "__id")
                       .select("text", "toxic", "fold", F.xxhash64("__id").alias("h")), "toxicity-train")
    some = train.where("fold <= 2").groupBy().agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    n_p, n_q = (float(v or 0) for v in some)
    counts = train.where("fold <= 2").select("text", "toxic").mapInArrow(lean(_counts), "term long, p long, q long")
    counts = counts.groupBy("term").agg(F.sum("p").alias("p"), F.sum("q").alias("q")).where("p >= 3")
    odds = (F.log((F.col("p") + 0.5) / (n_p + 1)) - F.log((F.col("q") + 0.5) / (n_q + 1))
            - F.sqrt(1 / (F.col("p") + 0.5) + 1 / (F.col("q") + 0.5)))
    lexicon = (counts.select("term", odds.alias("odds")).where(F.col("odds") >= float(LEVELS[0]))
                     .orderBy(F.desc("odds"), "term").limit(terms).toPandas())
    name = lexicon["term"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(name)
    level = np.searchsorted(LEVELS, lexicon["odds"].to_numpy(float), side="right")
    model = Model(name[order], level[order].astype(np.int8), np.zeros(4 + len(LEVELS) + 1), np.zeros(4))
    rest = train.where("fold > 2")
    y_p, y_n = (int(v or 0) for v in rest.groupBy().agg(F.sum("toxic"), F.count("*")).first())
    if not 0 < y_p < y_n or not len(lexicon):
        discard(train)
        share = (n_p + y_p + 1) / (n_p + n_q + y_n + 3)
        model.field[:4] = [-9, -9, 0, 0]
        model.final[-1] = np.log(share / (1 - share))
        return model
    model.field = fit_field(*training_windows(rest, model, windows), len(LEVELS) + 1)
    got = rest.select("text", "toxic").mapInArrow(lean(_features(model)), "toxic int, f0 double, f1 double, f2 double, f3 double").toPandas()
    discard(train)
    model.final = fit_final(got[["f0", "f1", "f2", "f3"]].to_numpy(float), got["toxic"].to_numpy(float))
    del got
    give_back()
    return model


_SCORED = "score double, spans array<struct<start:long,end:long>>"


def _score(model: Model, at_text: int, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others = [k for k in range(batch.num_columns) if k != at_text]
            for i, j, raw, offs in slices(batch, at_text):
                row, index, level, start, end, n = signals(model, raw, offs)
                log_z, p = marginals(model.field, row, index, level, n)
                score = 1 / (1 + np.exp(-np.clip(features(log_z, row, p, n) @ model.final, -30, 30)))
                hot = np.flatnonzero(p >= least)
                off = np.searchsorted(row[hot], np.arange(j - i + 1)).astype(np.int32)
                spans = pa.StructArray.from_arrays([pa.array(start[hot] - offs[row[hot]]), pa.array(end[hot] - offs[row[hot]])],
                                                   ["start", "end"])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(i, j - i) for k in others), pa.array(score),
                     pa.ListArray.from_arrays(pa.array(off), spans)],
                    [*(batch.schema.names[k] for k in others), "score", "spans"])
    return run


def toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """One row per input row: doc_id, score (0 to 1), predicted (1 from a score
    of 0.5) and spans, the offending words as byte offsets of the UTF-8 text
    (start, end exclusive; words whose marginal is ``least`` or more).

    Null texts count as empty; an empty text has the score of a text without
    any token.  Rows that repeat an identifier are scored each; other columns
    are not read; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(lean(_score(model, 1, least)), f"doc_id {id_type}, {_SCORED}")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def reject_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below 0.5, all columns kept whatever
    their names; null texts count as empty."""
    names = docs.columns
    rows = docs.toDF(*[f"c{k}" for k in range(len(names))])
    rows = rows.withColumn("read", text_of(f"c{names.index(text_col)}"))
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in rows.drop("read").schema] + [_SCORED])
    kept = rows.mapInArrow(lean(_score(model, len(names), 0.5)), schema).where("score < 0.5")
    return kept.drop("score", "spans").toDF(*names)
