"""The training-data operators against plain Python on small tables with nulls,
empty and very long texts, ties, repeated rows, empty tables and extra columns
whose names clash with the operators' own."""

import hashlib
import itertools
import random

import brute
import numpy as np
import pytest

from matchlake.llm import decontaminate, toxicity as tox
from matchlake.llm.exact_dedup import exact_dedup
from matchlake.llm.jaccard_join import jaccard_classes, one_per_class
from matchlake.llm.line_dedup import line_dedup
from matchlake.llm.mixing import mix_sources, mixed_rows
from matchlake.llm.pii import digest, find_pii
from matchlake.llm.substring_dedup import substring_dedup
from matchlake.llm.suffix_dedup import suffix_dedup
from matchlake.llm.token_output import END, VOCABULARY, PATTERN, encoder, permuted, read_slots, write_tokens

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept boolean, n long, node long, cell string, "
          "w string, size long, score double, spans string, items string, label int, `key` string, n_words int")
EXTRA = (True, 7, 8, "c", "w", 9, 0.5, "s", "i", 1, "k", 3)


def table(spark, rows, source=lambda i: f"s{i % 3}"):
    return spark.createDataFrame([(i, t, "en", source(k), len(t or ""), *EXTRA) for k, (i, t) in enumerate(rows)], SCHEMA)


def corpus():
    """Unique identifiers: near and exact copies, shared passages, odd texts."""
    rng = random.Random(5)
    vocab = ["".join(rng.choices("abcdefgéü", k=rng.randint(2, 8))) for _ in range(300)]
    say = lambda n: rng.choices(vocab, k=n)
    passage, base, line = say(60), say(90), " ".join(say(9))
    rows = [None, "", " \n\t ", "one", "one two", "One Two", " x y", "a" * 900, "ab " * 700, "z" * 399,
            "\n".join([line] * 8), " ".join(say(6000)) + " " + " ".join(passage)]
    for k in range(12):
        rows.append(" ".join(say(rng.randint(5, 120)) + passage + say(rng.randint(0, 60))))
    for k in range(8):
        near = list(base)
        for _ in range(k // 2):
            near[rng.randrange(len(near))] = rng.choice(vocab)
        rows.append(" ".join(near))
    rows += [rows[-1], rows[-1].upper(), rows[-1] + "\n", rows[-1].replace(" ", "  "), "Zoë\x0bq\x0cr\r\n" + line]
    return [(3 * i + 1, t) for i, t in enumerate(rows)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return table(spark, rows)


@pytest.fixture(scope="module")
def odd(spark):
    """Null and repeated identifiers, repeated rows."""
    text = " ".join(f"w{i}" for i in range(200))
    return table(spark, [(None, text), (None, None), (1, text), (1, text), (1, "other " + text), (2, text), (2, ""), (None, text)])


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [(1, "x")]).limit(0)


def test_exact_dedup(docs, rows, odd, none):
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup(docs).collect()}
    import re
    norm = {d: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for d, t in rows}
    for d, t in norm.items():
        same = [x for x, y in norm.items() if y == t]
        assert got[d] == (min(same), len(same), d == min(same), brute.sha(t))
    out = exact_dedup(odd).collect()
    assert len(out) == 8 and sum(r.kept for r in out) == 3          # three different texts
    assert exact_dedup(none).count() == 0


@pytest.mark.parametrize("group", [2048, 1])
def test_suffix_dedup(docs, rows, odd, none, group):
    for width in (400, 40):
        want = brute.suffix_dedup(rows, width)
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
               for r in suffix_dedup(docs, width=width, gram=min(48, width // 2), group=group).collect()}
        assert got == want
    out = suffix_dedup(odd, group=group).collect()
    assert len(out) == 8 and all(r.n_removed == r.n_bytes for r in out if r.n_bytes > 500 and r.doc_id != 1)
    assert suffix_dedup(none).count() == 0


def test_substring_dedup(docs, rows, odd, none):
    for width, rounds in ((20, 2), (20, 4), (6, 1), (2, 0)):
        want = brute.substring_dedup(rows, width)
        got = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in substring_dedup(docs, width=width, rounds=rounds).collect()}
        assert got == want
    digested = {r.doc_id: r.kept_sha256 for r in substring_dedup(docs, digest=True).collect()}
    assert digested == {d: brute.sha(x[2]) for d, x in brute.substring_dedup(rows, 20).items()}
    out = [(r.doc_id, r.n_words, r.n_removed) for r in substring_dedup(odd).collect()]
    assert len(out) == 8 and (2, 200, 200) in out and out.count((None, 200, 200)) == 2
    assert substring_dedup(none).count() == 0


def test_line_dedup(docs, rows, none):
    seen, want = set(), {}
    for d, t in rows:
        lines = (t or "").split("\n")
        gone = set()
        for p in range(len(lines) - 2):
            key = tuple(lines[p: p + 3])
            if key in seen:
                gone |= {p, p + 1, p + 2}
            seen.add(key)
        want[d] = (len(lines), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    assert {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in line_dedup(docs).collect()} == want
    assert line_dedup(none).count() == 0


def shared_ids(spark, odd):
    """(rows, table): rows of ``odd``, and different texts under one identifier or none, many of them equal."""
    rng = random.Random(8)
    say = lambda n: [f"v{rng.randrange(5000)}" for _ in range(n)]
    passage = say(120)
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for k in range(30):
        i = (None, 1, 5, k)[k % 4]
        rows += [(i, "\n".join(" ".join(say(8)) for _ in range(20))), (i, " ".join(say(k) + passage + say(90)))]
    rows += [(None, rows[-1][1])] * 9 + [(1, rows[-2][1])] * 2 + [(None, "a\nb\nc\na\nb\nc"), (7, "x\na\nb\nc")]
    rng.shuffle(rows)
    return rows, table(spark, rows)


def by_row(rows):
    """The rows in the order of their keys, numbered: a document each."""
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def test_dedup_by_row(spark, odd):
    """Null and repeated identifiers: the full results of the three operators."""
    rows, docs = shared_ids(spark, odd)
    for rows, docs in ((rows, docs), ([(r.doc_id, r.text) for r in odd.collect()], odd)):
        order = by_row(rows)
        texts = [(k, t) for k, (_, t) in enumerate(order)]
        of = lambda k: -1 if order[k][0] is None else order[k][0]
        for width in (400, 40):
            want = sorted((of(k), *x) for k, x in brute.suffix_dedup(texts, width).items())
            for group in (2048, 1):
                got = suffix_dedup(docs, width=width, gram=min(48, width // 2), group=group).collect()
                assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == want
        for width in (20, 3):
            want = sorted((of(k), *x) for k, x in brute.substring_dedup(texts, width).items())
            got = substring_dedup(docs, width=width).collect()
            assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.text) for r in got) == want
        want = sorted((of(k), *x) for k, x in line_brute(texts).items())
        got = line_dedup(docs).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_lines, r.n_removed, r.text) for r in got) == want


def line_brute(rows):
    seen, want = set(), {}
    for d, t in rows:
        lines = (t or "").split("\n")
        gone = set()
        for p in range(len(lines) - 2):
            key = tuple(lines[p: p + 3])
            if key in seen:
                gone |= {p, p + 1, p + 2}
            seen.add(key)
        want[d] = (len(lines), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return want


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80), (1, 60)])
def test_jaccard_classes(docs, rows, n, percent):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_classes(docs, n=n, percent=percent).collect()}
    assert got == brute.jaccard_classes(rows, n, percent)


def test_jaccard_odd(odd, none, spark):
    out = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard_classes(odd).collect()}
    assert out == {(None, 198): 1, (None, 0): None, (1, 198): 1, (1, 199): 1, (2, 198): 1, (2, 0): 2}
    assert jaccard_classes(none).count() == 0
    kept = [(r.doc_id, r.n_chars) for r in one_per_class(odd).collect()]
    assert kept.count((1, 889)) == 1 and (2, 889) not in kept


def test_stages_by_row(spark):
    """Rows that share an identifier, or have none, go and stay by themselves."""
    rng = random.Random(12)
    say = lambda n: " ".join(f"u{rng.randrange(4000)}" for _ in range(n))
    base, leak = say(150), " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(40))
    rows = [(None, base), (None, base + " more"), (3, base + " end"), (3, say(100)), (4, base), (4, say(90)), (None, say(80)),
            (None, leak + " " + say(60)), (8, say(50) + " " + leak), (8, say(120)), (None, ""), (None, None), (9, ""), (9, "")]
    docs = table(spark, rows)
    kept = sorted((r.doc_id or -1, r.text or "") for r in one_per_class(docs, n=5, percent=80).collect())
    assert kept == sorted((i or -1, t or "") for k, (i, t) in enumerate(rows) if k not in (0, 1, 4, 13))
    tests = spark.createDataFrame([(1, leak)], "item_id long, text string")
    kept = sorted((r.doc_id or -1, r.text or "") for r in decontaminate.clean(docs, tests).collect())
    assert kept == sorted((i or -1, t or "") for k, (i, t) in enumerate(rows) if k not in (7, 8))


def test_jaccard_chain(spark):
    """A long chain of links is one component, and a group in which each text links with its neighbours only."""
    words = [f"t{i}" for i in range(400)]
    chain = [(k, " ".join(words[4 * k: 4 * k + 102])) for k in range(30)]
    got = {r.doc_id: r.component_id for r in jaccard_classes(table(spark, chain)).collect()}
    assert got == {d: c for d, (_, c) in brute.jaccard_classes(chain).items()} and len(set(got.values())) == 1


def test_pii(spark, none):
    texts = [None, "", "a@b.com_x@y.com q@@r.s a.b@c 1.2.3.4.5.6.7.8 300.1.1.1 001.2.3.255 +1 (456) 555-2186",
             "é4111 1111-1111 1111 x+12345678901234567 ++1 2 3 4 5 6 7 8 9 0)-", "1.1.1.1 " * 1500,
             "9" * 20000 + "@" + "a" * 20000 + ".b" * 9000, "4111111111111111 4111111111111112 0 0", "\U0001F600 +49 (0) 30 123456-7 . a%b@c-d.e-"]
    rng = random.Random(3)
    texts += ["".join(rng.choices("0123456789 .-+@ab()%", k=rng.randint(10, 400))) for _ in range(150)]
    docs = table(spark, list(enumerate(texts)))
    got = {r[0]: r for r in digest(find_pii(docs)).collect()}
    for i, t in enumerate(texts):
        assert tuple(got[i])[1:6] == brute.pii_digest(t), t
        names = ("email", "ip", "card", "phone")
        base = [f"{names[k]}:{s}:{e}" for s, k, e in brute.pii_base(t)]
        assert set(base) <= set(got[i].spans.split(",")) if base else True
    assert digest(find_pii(none)).count() == 0


def test_pii_adds_unusual_forms(spark):
    rng = random.Random(4)
    num = lambda: f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
    rows = [(i, f"some words here {rng.choice(['+1 ' + num(), '10.%d.3.9' % rng.randint(0, 255), f'ann{i}@mail.example.com'])} and {rng.randint(1000, 99999999)} more 7 8")
            for i in range(300)]
    rows += [(1000, f"please call {num()} or write joe [at] example [dot] com today"), (1001, "order 12345678 shipped")]
    got = {r[0]: r.spans for r in digest(find_pii(table(spark, rows))).collect()}
    # a number without its plus and a written-out address are added; a plain number is not
    assert "phone:12:26" in got[1000] and "email:36:62" in got[1000] and got[1001] == ""


def test_pii_finds_held_out_forms(spark):
    """Forms that no base pattern matches, planted in documents of their own: how
    many are found, and how much of what is added is right."""
    rng = random.Random(11)
    vocab = ["".join(rng.choices("abcdefghilmnoprstu", k=rng.randint(2, 9))) for _ in range(300)] + ["extraordinarilylongwords", "internationalisations"]
    say = lambda n: " ".join(rng.choices(vocab, k=n))
    hexa = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    number = lambda: f"({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
    key = lambda: "AKIA" + "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=16))
    known = [lambda: "+1 " + number(), lambda: f"10.{rng.randint(0, 255)}.3.9", lambda: f"{vocab[rng.randint(0, 99)]}@mail.example.com",
             lambda: "4111 1111 1111 1111", lambda: f"password={hexa(18)}", key]
    rows = [(i, f"{say(20)} {rng.choice(known)()} {say(9)} {rng.randint(10, 99999999)} {say(5)} {rng.randint(300, 999)}.1.{rng.randint(1, 99)}.7") for i in range(600)]
    hidden = [lambda: number(), lambda: f"{vocab[rng.randint(0, 99)]} [at] {vocab[rng.randint(0, 99)]} [dot] org", lambda: f'"{hexa(40)}"']
    want = {}
    for k in range(150):
        text, what = say(rng.randint(1, 30)) + " ", hidden[k % 3]()
        inner = what.strip('"')
        start = len(text) + what.index(inner)
        rows.append((1000 + k, f"{text}{what} {say(6)} {rng.randint(10, 99999)}"))
        want[1000 + k] = f"{('phone', 'email', 'secret')[k % 3]}:{start}:{start + len(inner)}"
    rows += [(2000 + k, f"{say(30)} {rng.randint(10, 99999999)} extraordinarilylongwords {rng.randint(300, 999)}.4.5.{rng.randint(1, 99)}") for k in range(100)]
    got = {r[0]: set(filter(None, r.spans.split(","))) for r in digest(find_pii(table(spark, rows))).collect()}
    found = sum(want[d] in got[d] for d in want)
    extra = sum(len(got[d] - {w}) for d, w in want.items()) + sum(len(got[d]) for d in got if d >= 2000)
    assert found >= 0.8 * len(want) and found >= 0.95 * (found + extra)


def test_field_passes():
    """Partition sums and marginals against all tag sequences."""
    rng = np.random.default_rng(1)
    theta = rng.normal(size=10)
    start, change, weight = tox._potentials(theta)
    levels = [[0, 3, 0, 0, 5, 1], [2], [0, 0, 0], [], [4, 4, 0, 1]]
    row = np.array([r for r, x in enumerate(levels) for v in x if v], int)
    index = np.array([k for x in levels for k, v in enumerate(x) if v], int)
    level = np.array([v for x in levels for v in x if v], int)
    log_z, p = tox.marginals(theta, row, index, level, np.array([len(x) for x in levels]))
    at = 0
    for r, x in enumerate(levels):
        total, hot = 0.0, np.zeros(len(x))
        for tags in itertools.product((0, 1), repeat=len(x)):
            v = 1.0
            for k, y in enumerate(tags):
                v *= (start[y] if k == 0 else change[tags[k - 1], y]) * (weight[x[k]] if y else 1)
            total += v
            hot += v * np.array(tags)
        assert np.isclose(np.exp(log_z[r]), total)
        for k, v in enumerate(x):
            if v:
                assert np.isclose(p[at], hot[k] / total)
                at += 1


def test_toxicity(spark, docs, none, odd):
    sf = "/root/testdata/sf0.01"
    texts, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = tox.fit(texts, labels)
    out = tox.toxicity(texts, model).join(labels, "doc_id").where(tox.fold("doc_id") == 0).select("predicted", "toxic").collect()
    assert np.mean([r.predicted == r.toxic for r in out]) >= 0.93
    assert tox.toxicity(none, model).count() == 0 and tox.toxicity(odd, model).count() == 8
    empty = {r.doc_id: r.score for r in tox.toxicity(docs, model).where("doc_id in (1, 4, 7)").collect()}
    assert len(set(empty.values())) == 1 and 0 <= empty[1] < 0.5
    span = tox.toxicity(table(spark, [(1, "é you stupid, stupid idiot and moron")]), model).first()
    assert any(s.start == 7 and s.end == 13 for s in span.spans) and span.predicted == 1
    kept = tox.reject_toxic(table(spark, [(1, "stupid idiot moron scum"), (2, None)]), model)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [2]
    # one class, or no label at all: the same score for every text
    for some in (labels.where("toxic = 0"), labels.limit(0), labels.selectExpr("doc_id", "cast(null as int) toxic")):
        flat = tox.toxicity(docs, tox.fit(texts, some)).select("score").distinct().collect()
        assert len(flat) == 1 and 0 <= flat[0].score < 0.5


def test_training_windows(spark):
    """The bound is kept, and beginnings do not crowd out the signals."""
    name = tox._tokens(np.frombuffer(b"idiot", np.uint8), np.array([0, 5]))[0]
    model = tox.Model(name, np.array([4], np.int8), np.zeros(10), np.zeros(4))
    rows = [(" ".join(["word"] * 100 + ["idiot"] * (k < 30) + ["word"] * 60), int(k < 30), k) for k in range(400)]
    train = spark.createDataFrame(rows, "text string, toxic int, h long")
    for windows, hot in ((40, 20), (200, 30), (1000, 30)):
        levels, tags = tox.training_windows(train, model, windows)
        assert len(levels) == min(windows, 430) and (levels.max(1) == 4).sum() == hot == tags.sum()
    assert (levels[tags.any(1)].argmax(1) == tox.WINDOW // 2).all()


def test_mixing(spark, docs, rows, none):
    out = mix_sources(docs).collect()
    assert len(out) == len(rows)
    total = sum(r.size for r in out)
    targets = {r.source: r.target for r in out}
    taken = {s: sum(r.taken for r in out if r.source == s) for s in targets}
    assert abs(sum(targets.values()) - total) < 1e-6
    assert all(r.taken <= 3 * r.size for r in out)
    big = max(r.size for r in out)
    assert all(abs(taken[s] - targets[s]) <= big for s in targets)
    mixed = mixed_rows(docs)
    assert mixed.columns == docs.columns
    count = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert count == {r.doc_id: r.copies for r in out if r.copies}
    assert mix_sources(none).count() == 0 and mixed_rows(none).count() == 0
    alone = mix_sources(table(spark, [(1, "a b c"), (2, None)], source=lambda i: None)).collect()
    assert {r.doc_id: (r.size, r.taken) for r in alone} == {1: (3, 3), 2: (0, 0)}


def test_line_dedup_of_long_texts(spark):
    """Time grows as the lines do: 100,000 lines, twice, and runs of all kinds in them."""
    import time

    rng = random.Random(8)
    long = [f"line {k}" if rng.random() < 0.5 else "the same" for k in range(100_000)]
    rows = [(1, "\n".join(long)), (2, "\n".join(long)), (3, "\n".join(long[::2])), (4, "\n".join(["x"] * 50_000))]
    began = time.time()
    got = {r.doc_id: (r.n_lines, r.n_removed) for r in line_dedup(table(spark, rows)).collect()}
    assert time.time() - began < 90
    assert got[1][0] == got[2][0] == got[2][1] == 100_000 and got[4] == (50_000, 49_999)


@pytest.mark.parametrize("ids", ["unique", "a third null", "five", "all null"])
def test_mixing_without_identifiers(spark, ids):
    """Whatever the identifiers, every source ends within one document of its target, and reruns agree."""
    number = {"unique": lambda k: k, "a third null": lambda k: None if k % 3 == 0 else k, "five": lambda k: k % 5, "all null": lambda k: None}[ids]
    rows = [(number(k), " ".join(["w"] * 10) + f" {k // 2}" * (k % 4)) for k in range(600)]
    docs = spark.createDataFrame([(i, t, "en", "ab"[k % 2], len(t), *EXTRA) for k, (i, t) in enumerate(rows)], SCHEMA)
    out = mix_sources(docs).collect()
    big = max(r.size for r in out)
    for source in "ab":
        own = [r for r in out if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= big
        assert {r.copies for r in own} <= {int(own[0].target / own[0].source_size), int(own[0].target / own[0].source_size) + 1}
    mixed = mixed_rows(docs)
    assert mixed.count() == sum(r.copies for r in out)
    again = mix_sources(docs.repartition(7)).collect()
    key = lambda r: (str(r.doc_id), r.source, r.size, r.taken)
    assert sorted(map(key, out)) == sorted(map(key, again))


@pytest.mark.parametrize("n", [1, 2, 3, 17, 256, 1000])
def test_permutation(n):
    assert sorted(permuted(np.arange(n), n, 7)) == list(range(n))
    assert n < 17 or (permuted(np.arange(n), n, 7) != permuted(np.arange(n), n, 8)).any()


def test_token_round_trip(spark, docs, rows, odd, none, tmp_dir):
    small = dict(length=64, per_shard=10)
    out = write_tokens(docs, tmp_dir + "/a", **small).collect()
    n = len(out)
    assert sorted(r.slot for r in out) == sorted(r.sequence for r in out) == list(range(n))
    ids = read_slots(tmp_dir + "/a", 0, n, **small)
    assert (read_slots(tmp_dir + "/a", 7, 16, **small) == ids[7:23]).all()
    for r in out:
        assert hashlib.sha256(ids[r.slot].tobytes()).hexdigest() == r.sha256
        assert (r.shard, r.byte_offset) == (r.slot // 10, r.slot % 10 * 128)
    with open(VOCABULARY, "rb") as f:
        enc = encoder(f.read(), PATTERN)
    order = sorted(out, key=lambda r: r.sequence)
    stream = np.concatenate([ids[r.slot][: r.n_tokens] for r in order])
    texts = [enc.decode(x[:-1].tolist()) for x in np.split(stream, np.flatnonzero(stream == END) + 1)[:-1]]
    assert sorted(texts) == sorted(t or "" for _, t in rows)
    assert {d for r in out for d in r.doc_ids} == {d for d, _ in rows}
    assert sum(r.n_tokens for r in write_tokens(odd, **small).collect()) > 0
    assert write_tokens(none, **small).count() == 0


def test_decontaminate(spark, none, odd):
    rng = random.Random(9)
    vocab = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(400)]
    say = lambda n: rng.choices(vocab, k=n)
    items = [say(rng.randint(15, 50)) for _ in range(30)]
    rows, want = [], {}
    for d in range(240):
        w = say(rng.randint(0, 300))
        if d % 4 == 0:
            it = rng.randrange(len(items))
            put = list(items[it])
            if d % 8 == 0:                      # a paraphrase: every sixth word is another one, the answer stays
                for k in range(0, len(put) - 5, 6):
                    put[k] = rng.choice(vocab)
            w, want[d] = w + put + say(rng.randint(0, 100)), it
        rows.append((d, " ".join(w)))
    rows += [(900, None), (901, ""), (902, "!!!")]
    tests = spark.createDataFrame([(i, " ".join(x), "m") for i, x in enumerate(items)] + [(None, "q", ""), (77, None, "")],
                                  "item_id long, text string, doc_id string")
    docs = table(spark, rows)
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, tests, items=16).collect()}
    assert len(got & set(want.items())) >= 0.9 * len(want) and not got - set(want.items())
    kept = decontaminate.clean(docs, tests)
    assert kept.columns == docs.columns and kept.count() == len(rows) - len({d for d, _ in got})
    assert decontaminate.contaminated(none, tests).count() == 0
    assert decontaminate.contaminated(docs, tests.limit(0)).count() == 0
    assert decontaminate.clean(odd, tests).count() == 8


def test_longest_common_subsequence():
    def plain(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = (rng.integers(0, 9, rng.integers(0, 80)).astype(np.uint64) for _ in range(2))
        assert decontaminate.common(a, b) == plain(a.tolist(), b.tolist())


def test_pii_learns_from_every_certain_proposal(spark, monkeypatch):
    """More certain proposals than any sample held: half of them all are fitted."""
    from matchlake.llm import pii

    class Seen(Exception):
        pass

    class Counting(pii.GBTClassifier):
        def fit(self, rows, params=None):
            raise Seen(rows.count())

    monkeypatch.setattr(pii, "GBTClassifier", Counting)
    words = " ".join("abcdefghijklmnopqrstu" + chr(97 + k % 26) * (k // 26 + 1) for k in range(500))
    rows = [(k, f"{words} call +49 30 {1000000 + k} now") for k in range(100)]
    with pytest.raises(Seen) as told:
        find_pii(table(spark, rows))
    assert told.value.args[0] > 24_000
