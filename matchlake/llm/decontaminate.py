"""Benchmark decontamination by latent semantic retrieval.

Passages (two neighbouring blocks of ``BLOCK`` words) are TF-IDF vectors over
hashed words; document frequencies are counted over the whole corpus.  A
randomised SVD of all passages and of all benchmark passages gives the latent
space: texts are written once as hashed words, each task multiplies its own
passages with the current basis, Spark adds the parts up per block of terms, and
the driver only orthogonalises a table of fixed size.  Every passage of every document is then
projected; a benchmark passage of high cosine makes its item a candidate, and
the words around the passage are compared with the item by longest common
subsequence, a weaker match needing the item's answer (its last words) intact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.columns import give_back, lean, lower_ascii, map_arrays, slices, word_hashes, words
from matchlake.llm.spans import ROW, row_keys
from matchlake.llm.store import discard, stored, text_of

TERM_BITS = 14
TERMS = 1 << TERM_BITS  # hashed terms
RANK = 128              # latent dimensions
EXTRA = 8               # further columns of the random sketch
WEIGHT = 4              # times each benchmark item counts beside PER documents
PER = 1500              # so many documents weigh against the benchmark once; with more, it counts more in proportion
BLOCK = 8               # words of a block; a passage is two blocks
ITEMS = 4096            # benchmark items compared in one pass over the corpus
STEP = 2                # words between the offsets at which an item's passages begin
COSINE = 0.65           # of a text's passage and an item's, latent
OVERLAP = 0.5           # share of an item passage's kinds of words that a text's passage has, too
GROUPS = 64             # groups of items whose words are told apart before projection
WEAK = 1e-6             # directions below this share of the strongest one's power are noise and left out
SAME = 0.8              # share of an item's words in common order: a copy
CLOSE = 0.6             # the same, when the answer is there, too
ANSWER = 5              # last words of an item
FIT_TASKS = 4           # tasks that fit, or the cores if they are more; each sends a table of fixed size
TILE = 512              # runs of rows that are added up at a time
PIECE = 32              # rows of a run that are added up before other pieces of it
SLICE = 1 << 16         # bytes of text that are made terms at a time
_SPLIT = 16             # blocks of terms that are summed apart


def _words(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    raw = lower_ascii(raw)
    starts, ends, first = words(raw, offs, letters=True)
    return word_hashes(raw, starts, ends), first


def _term(names: np.ndarray) -> np.ndarray:
    return (names >> np.uint64(64 - TERM_BITS)).astype(np.int64)


def blocks(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of blocks of ``size`` words; the last block of a row may be shorter."""
    n = np.diff(first)
    count = -(-n // size)
    row = np.repeat(np.arange(len(n)), count)
    start = first[row] + (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * size
    return start, np.minimum(start + size, first[row + 1]), row


def paired(row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) block of each passage: two neighbouring blocks of a row; a
    row of one block is one passage."""
    pair = np.zeros(len(row), bool)
    pair[:-1] = row[1:] == row[:-1]
    alone = ~pair & np.append(True, ~pair[:-1])[:len(row)]
    at = np.flatnonzero(pair | alone)
    return at, at + pair[at]


def passages(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, end, row) of passages."""
    start, end, row = blocks(first, size)
    a, b = paired(row)
    return start[a], end[b], row[a]


def inner(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(passage, word) of every word of every passage."""
    n = end - start
    at = np.repeat(np.arange(len(n)), n)
    return at, np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + start[at]


def _tiles(table: np.ndarray, at: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(runs, their sums of rows ``table[at[i]]``, start <= i < end), ``TILE`` runs at a time (none is empty).

    Runs of like length go together, the first row of each, then the second and
    so on: what is added up stays in the cache, and no row is copied for each word.
    """
    order = np.argsort(start - end, kind="stable")
    held, more = np.empty((2, min(TILE, len(order)), table.shape[1]), table.dtype)
    for k in range(0, len(order), TILE):
        run = order[k: k + TILE]
        first, size = start[run], end[run] - start[run]
        np.take(table, at[first], axis=0, out=held[: len(run)], mode="clip")
        for j in range(1, int(size[0])):
            m = int(np.searchsorted(-size, -j))         # runs longer than j
            np.take(table, at[first[:m] + j], axis=0, out=more[:m], mode="clip")
            held[:m] += more[:m]
        yield run, held[: len(run)]


def sums(table: np.ndarray, at: np.ndarray, start: np.ndarray, end: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """Sums of the rows ``table[at[i]]`` over each run start <= i < end (none is empty)."""
    if out is None:
        out = np.empty((len(start), table.shape[1]), table.dtype)
    for run, held in _tiles(table, at, start, end):
        out[run] = held
    return out


def add_sums(total: np.ndarray, names: np.ndarray, table: np.ndarray, at: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
    """Adds the sum of each run to the row of ``total`` that ``names`` gives it
    (no two the same); long runs are added up in pieces first."""
    short = end - start <= PIECE
    if not short.all():
        first, last = start[~short], end[~short]
        pieces = -(-(last - first) // PIECE)
        stop = np.cumsum(pieces)
        of = np.repeat(np.arange(len(pieces)), pieces)
        begin = first[of] + PIECE * (np.arange(len(of)) - (stop - pieces)[of])
        parts = sums(table, at, begin, np.minimum(begin + PIECE, last[of]))
        add_sums(total, names[~short], parts, np.arange(len(parts)), stop - pieces, stop)
    names = names[short]
    for run, held in _tiles(table, at, start[short], end[short]):
        total[names[run]] += held


def _terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashed terms of each text, two bytes each, and its weight."""
    for batch in batches:
        for i, j, raw, offs in slices(batch, 0, SLICE):
            names, first = _words(raw, offs)
            data = _term(names).astype("<u2").tobytes()
            cut = (first * 2).tolist()
            yield pa.RecordBatch.from_arrays([
                pa.array([data[x:y] for x, y in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
                batch.column(1).slice(i, j - i)], ["terms", "weight"])


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(terms, index of each row's first, weights) for runs of rows of a bounded size."""
    for i, j, raw, offs in slices(batch.set_column(0, "terms", batch.column(0).cast(pa.large_binary()).view(pa.large_string())), 0):
        yield (np.frombuffer(raw.tobytes(), "<u2").astype(np.int64), offs // 2,
               batch.column(1).slice(i, j - i).to_numpy(zero_copy_only=False))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per hashed term, per task."""
    total, n = np.zeros(TERMS, np.int64), 0
    for batch in batches:
        for term, first, _ in _runs(batch):
            row = np.repeat(np.arange(len(first) - 1), np.diff(first))
            order = np.argsort(term.astype(np.uint16), kind="stable")
            term, row = term[order], row[order]
            total += np.bincount(term[np.append(True, (term[1:] != term[:-1]) | (row[1:] != row[:-1]))[: len(term)]], minlength=TERMS)
            n += len(first) - 1
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], n))], ["term", "df"])


@dataclass
class Space:
    idf: np.ndarray         # weight of each hashed term
    basis: np.ndarray       # (TERMS, rank): idf-weighted right singular vectors


def _sketch(sent, block: int):
    """Sums over this task's passages a of a (a Q), in blocks of terms;
    ``sent`` holds the weights of terms and Q."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, basis = sent.value
        weighted = (basis.astype(np.float32) * idf[:, None]).astype(np.float32)
        total = np.zeros((TERMS, basis.shape[1]))
        rows = np.empty((2, 0, basis.shape[1]), np.float32)
        for batch in batches:
            for term, first, weight in _runs(batch):
                if not len(term):
                    continue
                start, end, row = blocks(first, block)
                if rows.shape[1] < len(start):
                    rows = np.empty((2, len(start), basis.shape[1]), np.float32)
                own, share = rows[0, : len(start)], rows[1, : len(start) - 1]
                # a passage is the sum of its blocks, and every word of a block adds the passages the block is in
                sums(weighted, term, start, end, own)
                power = np.add.reduceat(idf[term] ** 2, start)
                pair = row[1:] == row[:-1]                      # with the next block
                alone = np.flatnonzero(~(np.append(pair, False) | np.append(False, pair)))
                single = own[alone] * (weight[row[alone]] / np.maximum(power[alone], 1e-12)).astype(np.float32)[:, None]
                np.add(own[:-1], own[1:], out=share)
                share *= np.where(pair, weight[row[:-1]] / np.maximum(power[:-1] + power[1:], 1e-12), 0).astype(np.float32)[:, None]
                own[:-1] = share
                own[-1] = 0
                own[1:] += share
                own[alone] = single
                order = np.argsort(term.astype(np.uint16), kind="stable")
                held = term[order]
                new = np.flatnonzero(np.append(True, held[1:] != held[:-1]))
                of = np.repeat(np.arange(len(start)), end - start)
                add_sums(total, held[new], own, of[order], new, np.append(new[1:], len(held)))
        total *= idf[:, None]
        parts = total.reshape(_SPLIT, -1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts))), pa.array([r.astype(np.float32).tobytes() for r in parts], pa.binary())],
                                         ["part", "sums"])
    return run


def _sketched(terms: DataFrame, idf: np.ndarray, basis: np.ndarray, block: int) -> np.ndarray:
    """The summed sketch, a table of fixed size; nothing of it stays behind on the executors."""
    spark = terms.sparkSession
    sent = spark.sparkContext.broadcast((idf, basis))
    try:
        parts = (terms.mapInArrow(lean(_sketch(sent, block)), "part long, sums binary")
                      .groupBy("part").applyInArrow(_add, "part long, sums binary"))
        parts = stored(parts, "decontaminate-sketch")
        got = parts.orderBy("part").collect()
        discard(parts)
        none = [np.zeros(TERMS * basis.shape[1] // _SPLIT, np.float32)] * (0 if got else _SPLIT)
        return np.concatenate([np.frombuffer(r["sums"], np.float32) for r in got] or none).astype(float).reshape(TERMS, -1)
    finally:
        sent.destroy()


def _add(key, table):
    total = sum(np.frombuffer(x.as_py(), np.float32) for x in table.column("sums"))
    return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "sums": pa.array([total.tobytes()], pa.binary())})


def fit_space(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", rank: int = RANK, block: int = BLOCK) -> Space:
    """The latent space of the passages of all documents and of the benchmark;
    document frequencies are of all documents.

    Two products with all passages: the first one's range is the sketch of the
    second, and what that gives is solved for the strongest directions
    (Nystroem), which takes no further pass.
    """
    map_arrays()
    cores = max(FIT_TASKS, docs.sparkSession.sparkContext.defaultParallelism)
    whole = "terms binary, weight double"
    own = stored(docs.select(text_of(text_col).alias("text"), F.lit(1.0).alias("weight")).mapInArrow(lean(_terms_of), whole), "decontaminate-terms")
    counts = {r["term"]: r["df"] for r in own.mapInArrow(lean(_frequencies), "term long, df long")
              .groupBy("term").agg(F.sum("df").alias("df")).collect()}          # at most TERMS rows
    n = counts.pop(-1, 0)
    df = np.zeros(TERMS)
    df[list(counts)] = list(counts.values())
    idf = (np.log((n + 1) / (df + 1)) + 0.1).astype(np.float32)
    tests = benchmark.select(text_of("text").alias("text"), F.lit(WEIGHT * max(1.0, n / PER)).alias("weight"))
    train = own.unionByName(tests.mapInArrow(lean(_terms_of), whole)).coalesce(cores)
    basis = np.random.default_rng(11).standard_normal((TERMS, rank + EXTRA)).astype(np.float16)
    basis = np.linalg.qr(_sketched(train, idf, basis, block))[0].astype(np.float16)
    got = _sketched(train, idf, basis, block)
    discard(own)
    inner_, turn = np.linalg.eigh((half := basis.astype(float).T @ got) + half.T)
    kept = np.flatnonzero(inner_ > WEAK * max(inner_[-1], 1e-30))
    got = got @ (turn[:, kept] / np.sqrt(inner_[kept] / 2))          # got got' is the sum of a'a, as far as the sketch tells
    power, turn = np.linalg.eigh(got.T @ got)
    kept = np.flatnonzero(power[::-1][:rank] > WEAK * max(power[-1:].max(initial=0), 1e-30))
    # every direction counts alike, else the commonest words decide the cosine
    basis = got @ (turn[:, ::-1][:, kept] / power[::-1][kept])
    basis = basis / max(np.abs(basis).max(initial=0), 1e-30)          # cosines do not change; no entry is out of a short float's range
    space = Space(idf, (basis * idf[:, None]).astype(np.float32))
    del basis, got
    give_back()
    return space


def common(item: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence, on machine words of any size."""
    where: dict[int, int] = {}
    for k, w in enumerate(item.tolist()):
        where[w] = where.get(w, 0) | (1 << k)
    full = (1 << len(item)) - 1
    state = full
    for w in text.tolist():
        m = where.get(w)
        if m:
            both = state & m
            state = ((state + both) | (state - both)) & full
    return len(item) - state.bit_count()


def among(words_of: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The words of ``text`` that are in the sorted ``words_of``, in their order;
    no other can be in a common subsequence."""
    at = np.minimum(np.searchsorted(words_of, text), len(words_of) - 1)
    return text[words_of[at] == text]


def _bits(term: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of 64 classes of words each passage has."""
    if not len(start):
        return np.zeros(0, np.uint64)
    _, word = inner(start, end)
    n = end - start
    return np.bitwise_or.reduceat(np.uint64(1) << (term[word] & 63).astype(np.uint64), np.cumsum(n) - n)


def _near(weight: np.ndarray, known: np.ndarray, any_known: np.ndarray, term: np.ndarray, b_start, b_end, one, two, cosine: float) -> np.ndarray:
    """Passages that have the share ``cosine`` ** 2 of their squared weight on
    words of some group of items (``known``: that weight per term and group,
    ``any_known``: per term, in any group): the cosine with anything made of an item's
    words is at most the root of the share on them."""
    total, some = (np.add.reduceat(w[term], b_start) for w in (weight, any_known))
    twice = one != two
    need = cosine ** 2 * (total[one] + np.where(twice, total[two], 0)) * (1 - 1e-5)
    near = np.flatnonzero(some[one] + np.where(twice, some[two], 0) >= need)            # on words of any item, then of a group
    out = [near[:0]]
    for k in range(0, len(near), 2048):
        at = near[k: k + 2048]
        blocks_, back = np.unique(np.concatenate([one[at], two[at]]), return_inverse=True)
        part = sums(known, term, b_start[blocks_], b_end[blocks_])
        a, b = back[: len(at)], back[len(at):]
        most = np.where(a != b, (part[a] + part[b]).max(axis=1), part[a].max(axis=1))
        out.append(at[most >= need[at]])
    return np.concatenate(out)


def _compare(space: Space, item_ids: list, item_words: list[np.ndarray], block: int, cosine: float, same: float, close: float, overlap: float):
    # an item's passages begin at several offsets, so that some agree with a text's blocks
    vectors, bits, owner, begin = [], [], [], []
    for it, w in enumerate(item_words):
        for k in range(0, min(block, len(w)), STEP):
            term = _term(w[k:])
            start, end, _ = passages(np.array([0, len(term)]), block)
            vectors.append(sums(space.basis, term, start, end))
            bits.append(_bits(term, start, end))
            owner += [it] * len(start)
            begin += (start + k).tolist()
    query = np.concatenate([*vectors, space.basis[:0]])
    query = (query / np.maximum(np.linalg.norm(query, axis=1, keepdims=True), 1e-30)).astype(np.float32)
    seen = np.concatenate([*bits, np.zeros(0, np.uint64)])
    least = np.ceil(np.bitwise_count(seen) * overlap).astype(np.int64)
    packed, idf = space.basis.astype(np.float16), space.idf          # what travels with the job
    owner, begin = np.array(owner, np.int64), np.array(begin, np.int64)
    kinds = [np.unique(w) for w in item_words]
    known = np.zeros((TERMS, GROUPS), bool)
    for it, w in enumerate(item_words):
        known[_term(w), it % GROUPS] = True
    known = known[:, : max(min(GROUPS, len(item_words)), 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, basis = idf.astype(float) ** 2, packed.astype(np.float32)
        in_group, in_any = known * weight[:, None].astype(np.float32), np.where(known.any(axis=1), weight, 0)
        for batch in batches:
            for i, j, raw, offs in slices(batch, 1):
                names, top = _words(raw, offs)
                if not len(names) or not len(query):
                    continue
                term = _term(names)
                b_start, b_end, b_row = blocks(top, block)
                one, two = paired(b_row)
                start, end, row = b_start[one], b_end[two], b_row[one]
                near = _near(weight, in_group, in_any, term, b_start, b_end, one, two, cosine)
                best: dict[tuple[int, int], tuple] = {}
                tried: set = set()
                for k in range(0, len(near), 1024):
                    some = near[k: k + 1024]
                    need, back = np.unique(np.concatenate([one[some], two[some]]), return_inverse=True)
                    own = sums(basis, term, b_start[need], b_end[need])
                    a, b = back[: len(some)], back[len(some):]
                    own = np.where((a != b)[:, None], own[a] + own[b], own[a])
                    own /= np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-30)
                    cos = own @ query.T
                    p, q = np.divmod(np.flatnonzero(cos.ravel() >= cosine), len(query))
                    # and enough kinds of the item passage's words are there
                    ok = np.bitwise_count(_bits(term, start[some], end[some])[p] & seen[q]) >= least[q]
                    p, q = p[ok], q[ok]
                    # where the item would begin; starts within a block of each other share one look, which covers both
                    at = start[some[p]] - begin[q]
                    place = np.stack([row[some[p]], owner[q], at // block], axis=1)
                    _, once = np.unique(place, axis=0, return_index=True)
                    for x in once.tolist():
                        r, it, where = place[x].tolist()
                        if (r, it, where) in tried:
                            continue
                        tried.add((r, it, where))
                        item = item_words[it]
                        slack = block + len(item) // 4
                        region = names[max(where * block - slack, int(top[r])): min((where + 1) * block + len(item) + slack, int(top[r + 1]))]
                        region = among(kinds[it], region)
                        if len(region) < min(same, close) * len(item):
                            continue
                        share = common(item, region) / len(item)
                        if share >= same or share >= close and common(item[-ANSWER:], region) >= min(ANSWER, len(item)) - 1:
                            old = best.get((r, it))
                            if old is None or share > old[0]:
                                best[r, it] = (share, float(cos[p[x], q[x]]), int(at[x]) - int(top[r]))
                if best:
                    ids = batch.column(0).slice(i, j - i).to_pylist()
                    keys = sorted(best)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([ids[r] for r, _ in keys], pa.int64()), pa.array([item_ids[it] for _, it in keys], pa.int64()),
                        pa.array([best[x][0] for x in keys]), pa.array([best[x][1] for x in keys]),
                        pa.array([max(best[x][2], 0) for x in keys], pa.int64())],
                        ["doc_id", "item_id", "share", "cosine", "word"])
    return run


_MATCH = "doc_id long, item_id long, share double, cosine double, word long"


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", rank: int = RANK,
                 block: int = BLOCK, cosine: float = COSINE, same: float = SAME, close: float = CLOSE,
                 items: int = ITEMS, overlap: float = OVERLAP) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id,
    share (of the item's words in common order), cosine (of the passages that
    led to it) and word (where the item begins, counted in words).

    A pair is looked at when a passage of the text and one of the item reach
    ``cosine`` in the latent space, share ``overlap`` of the item passage's kinds
    of words (64 hashed kinds), and the text's passage has the share ``cosine`` ** 2
    of its squared weight on words of the benchmark, without which no passage of
    the benchmark can reach the cosine before projection.  It is reported when
    ``same`` of the item's words stand there in common order, or ``close`` and
    all but one of the item's last ANSWER words.

    Words are runs of letters, A-Z lower-cased.  Null and empty texts match
    nothing, nor do benchmark rows without words or identifier.  The benchmark
    is compared in blocks of ``items`` rows, each a pass over the corpus.  Rows
    that repeat an identifier are compared each and may repeat a pair; a null
    identifier is kept as null.  Other columns are not read; an empty table
    gives an empty result.
    """
    spark: SparkSession = docs.sparkSession
    tests = stored(benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_of("text").alias("text"))
                            .where("item_id is not null"), "decontaminate-items")
    n = tests.count()
    out = spark.createDataFrame([], _MATCH)
    if not n:
        return out
    space = fit_space(docs, tests, text_col, rank, block)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    passes = -(-n // items)
    for k in range(passes):
        some = tests.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k).orderBy("item_id", "text").collect()
        pairs = []
        for r in some:
            raw = np.frombuffer(r["text"].encode(), np.uint8)
            names, _ = _words(raw, np.array([0, len(raw)]))
            if len(names):
                pairs.append((r["item_id"], names))
        found = rows.mapInArrow(
            lean(_compare(space, [p[0] for p in pairs], [p[1] for p in pairs], block, cosine, same, close, overlap)), _MATCH)
        out = found if k == 0 else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item was found, all columns kept.
    Rows go by their keys (``spans.row_keys``), whatever their identifiers."""
    keyed = row_keys(docs, id_col, text_col)
    hit = stored(contaminated(keyed, benchmark, ROW, text_col, **options).select("doc_id").distinct(), "decontaminate-hits")
    return keyed.join(hit.select(F.col("doc_id").alias(ROW)), ROW, "left_anti").select(docs.columns)
