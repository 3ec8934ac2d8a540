"""Personal data: base patterns, and boosted trees over high-recall candidates.

DataFrame functions only.  Patterns give their matches and the texts between
them; running sums of the lengths are the offsets (code points).  Matches that
pass their kind's check are base spans and always stay.  Wider generators then
propose digit groups, written-out addresses and long tokens (credentials);
boosted trees judge them by format and context.

There are no labelled spans, so the trees learn from what is certain.  Positive:
base spans as they stand and *rewritten* into the forms that are to be added (a
phone number without its plus, an address with ``[at]`` and ``[dot]``, a card in
other groups), and tokens that a rule names as credentials.  Negative: proposals
that fail their format's check, and long tokens without a digit.  What is
neither is not learned from; it is what the trees decide.  They are fitted on
half of all that is certain and their threshold is set for a precision on the
other half; a proposal at or above it that overlaps no base span is added.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.llm.store import stored, text_of

# The contract's patterns, written so that a start inside a run that has failed
# once is not tried again and no quantified group needs the stack: the matches
# are the same.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")        # in the order that breaks ties
SECRET = "secret"                               # the kind of added credentials, after the others
# Generators of the proposals.
WRITTEN = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:@| ?+[\[({]at[\])}] ?+)[A-Za-z0-9-]++"
           r"(?:(?:\.| ?+[\[({]dot[\])}] ?+)[A-Za-z0-9-]++)++")
DIGITS = r"(?<![0-9A-Za-z+])\+?+\(?+[0-9](?:[\x20().-]{0,2}+[0-9]){6,}+"
TOKEN = r"(?<![A-Za-z0-9_+/-])(?=[0-9_+/-]*+[A-Za-z])[A-Za-z0-9_+/-]{16,}+"
DIGIT_GROUPS, ADDRESS, LONG_TOKEN = range(3)    # the generators
# A token is surely a credential as a cloud access key, or when it is assigned to a word for one.
ACCESS_KEY = r"^AKIA[A-Z0-9]{16}$"
ASSIGNED = r"(?i)(password|passwd|pwd|secret|token|api_?key)\W{0,3}[=:]\W{0,2}$"
CONTEXT = 16            # code points of context on each side
PRECISION = 0.98        # of what is added, on the half not fitted
FEATURES = ("is_mail", "n_digits", "len", "n_groups", "longest", "shortest", "n_dot", "n_hyphen", "n_space", "n_paren",
            "luhn", "octets", "letter_before", "letter_after", "digit_near", "quote_near", "key_near", "is_token", "n_upper", "n_lower",
            "beyond_hex", "switches", "assigned")

_CHUNK = 256


def _sums(a: Column) -> Column:
    """Sum of what stands before each element, in chunks so that long arrays
    cost little more than their length."""
    def run(c: Column) -> Column:
        return F.aggregate(c, F.array(F.lit(0).cast("long")),
                           lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    parts = F.transform(F.sequence(F.lit(0), F.greatest(F.floor((F.size(a) - 1) / _CHUNK), F.lit(0)).cast("int")),
                        lambda k: run(F.slice(a, k * _CHUNK + 1, _CHUNK)))
    before = run(F.transform(parts, lambda p: F.element_at(p, -1)))
    return F.flatten(F.transform(parts, lambda p, k: F.transform(
        F.slice(p, 1, F.size(p) - 1), lambda v: v + F.get(before, k))))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether up to 19 digits pass the Luhn check."""
    twice = F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)])
    n = F.length(digits)
    each = F.transform(F.sequence(F.lit(1), F.greatest(F.least(n, F.lit(19)), F.lit(1))),
                       lambda i: F.when((n - i) % 2 == 1, F.get(twice, F.ascii(F.substr(digits, i, F.lit(1))) - 48))
                       .otherwise(F.ascii(F.substr(digits, i, F.lit(1))) - 48))
    return F.aggregate(each, F.lit(0), lambda s, x: s + x) % 10 == 0


def _octets(m: Column) -> Column:
    parts = F.transform(F.split(m, r"\.", -1), lambda p: F.regexp_replace(p, "^0+", ""))
    return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))


_CHECKS: dict[str, tuple[str, Callable[[Column], Column]]] = {
    "email": (EMAIL, lambda m: F.lit(True)),
    "ip": (IP, _octets),
    "card": (CARD, lambda m: F.length(_digits(m)).between(14, 19) & _luhn(_digits(m))),
    "phone": (PHONE, lambda m: F.length(_digits(m)).between(10, 15)),
}


def _matches(rows: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Columns m_<name>: array of (start, end, m) of every match; rows may be
    many, matches are few, so texts stay where they are."""
    for name, pattern in patterns.items():
        p = F.lit(pattern)
        rows = (rows.withColumn(f"__m_{name}", F.regexp_extract_all("__text", p, F.lit(0)))
                    .withColumn(f"__g_{name}", F.when(F.size(f"__m_{name}") > 0, F.transform(
                        F.split("__text", pattern, -1), lambda s: F.length(s).cast("long")))))
    for name in patterns:
        m, gaps = F.col(f"__m_{name}"), F.col(f"__g_{name}")
        size = F.zip_with(m, F.slice(gaps, 1, F.size(m)), lambda x, g: g + F.length(x))
        ends = F.zip_with(_sums(size), size, lambda b, s: b + s)
        spans = F.zip_with(m, ends, lambda x, e: F.struct((e - F.length(x)).alias("start"), e.alias("end"), x.alias("m")))
        empty = F.array().cast("array<struct<start:bigint,end:bigint,m:string>>")
        rows = rows.withColumn(f"m_{name}", F.when(F.size(m) > 0, spans).otherwise(empty)).drop(f"__m_{name}", f"__g_{name}")
    return rows


def _found(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per input row: __row, doc_id, base spans (start, kind, end) and
    proposals with their context."""
    rows = docs.select(F.monotonically_increasing_id().alias("__row"), F.col(id_col).alias("doc_id"), text_of(text_col).alias("__text"))
    rows = _matches(rows, {k: p for k, (p, _) in _CHECKS.items()} | {"written": WRITTEN, "digits": DIGITS, "token": TOKEN})

    def passed(i: int, k: str) -> Column:
        ok = _CHECKS[k][1]
        return F.transform(F.filter(f"m_{k}", lambda x: ok(x["m"])), lambda x: F.struct(
            x["start"].alias("start"), F.lit(i).alias("kind"), x["end"].alias("end")))

    base = F.concat(*[passed(i, k) for i, k in enumerate(KINDS)])

    def around(x: Column, gen: int) -> Column:
        at = F.greatest(x["start"] - CONTEXT, F.lit(0))
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), x["m"].alias("m"), F.lit(gen).alias("gen"),
                        F.substr("__text", (at + 1).cast("int"), (x["start"] - at).cast("int")).alias("before"),
                        F.substr("__text", (x["end"] + 1).cast("int"), F.lit(CONTEXT)).alias("after"))

    proposals = F.concat(F.transform("m_written", lambda x: around(x, ADDRESS)), F.transform("m_digits", lambda x: around(x, DIGIT_GROUPS)),
                         F.transform("m_token", lambda x: around(x, LONG_TOKEN)))
    return stored(rows.select("__row", "doc_id", F.array_sort(base).alias("base"), proposals.alias("proposals")), "pii-found")


def _proposals(found: DataFrame) -> DataFrame:
    """One row per proposal, with the base span it meets, if any."""
    x = F.col("p")
    met = F.get(F.filter("base", lambda b: (b["start"] < x["end"]) & (b["end"] > x["start"])), F.lit(0))
    return found.select("__row", "doc_id", "base", F.explode("proposals").alias("p")).select(
        "__row", "doc_id", *[x[c].alias(c) for c in ("start", "end", "m", "gen", "before", "after")], met["kind"].alias("met"))


def _rewritten(proposals: DataFrame) -> DataFrame:
    """Proposals over base spans in the forms that are to be added."""
    m, met = F.col("m"), F.col("met")
    digits = _digits(m)
    domain = F.replace(F.substring_index(m, "@", -1), F.lit("."), F.lit(" [dot] "))
    grouped = F.regexp_replace(digits, "(?<=.)(?=(?:.{4})+$)", F.when(F.xxhash64(m) % 2 == 0, " ").otherwise("-"))
    other = (F.when((met == 0) & (F.col("gen") == ADDRESS), F.concat(F.substring_index(m, "@", 1), F.lit(" [at] "), domain))
              .when((met == 2) & (F.col("gen") == DIGIT_GROUPS), grouped)
              .when((met == 3) & (F.col("gen") == DIGIT_GROUPS), F.regexp_replace(m, r"^\+", "")))
    return proposals.withColumn("m", other).where("m is not null")


def _features(rows: DataFrame) -> DataFrame:
    """Proposals with their features and, where it is certain, their ``label``."""
    m, before, after = F.col("m"), F.col("before"), F.col("after")
    groups = F.filter(F.split(m, "[^0-9]+", -1), lambda g: g != "")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    count = lambda c: (F.length(m) - F.length(F.regexp_replace(m, c, ""))).cast("double")
    rows = rows.select(
        "*", (F.col("gen") == ADDRESS).cast("double").alias("is_mail"), (F.col("gen") == LONG_TOKEN).cast("double").alias("is_token"),
        F.transform(groups, lambda g: F.length(g)).alias("g"),
        F.length(_digits(m)).cast("double").alias("n_digits"), F.length(m).cast("double").alias("len"),
        *[count(c).alias(n) for n, c in (("n_dot", r"\."), ("n_hyphen", "-"), ("n_space", " "), ("n_paren", r"[()]"), ("n_upper", "[A-Z]"),
                                         ("n_lower", "[a-z]"), ("beyond_hex", "[G-Zg-z]"))],
        F.size(F.regexp_extract_all(m, F.lit("(?:[A-Za-z][0-9]|[0-9][A-Za-z])"), F.lit(0))).cast("double").alias("switches"),
        flag(F.length(_digits(m)).between(13, 19) & _luhn(_digits(m))).alias("luhn"),
        flag(m.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$") & _octets(m)).alias("octets"),
        flag(before.rlike(r"\p{L}$")).alias("letter_before"), flag(after.rlike(r"^\p{L}")).alias("letter_after"),
        flag(F.concat(before, after).rlike("[0-9]")).alias("digit_near"),
        flag(F.concat(before, after).rlike("[\"'=]")).alias("quote_near"),
        flag(F.lower(before).rlike(r"(tel|phone|fon|call|fax|card|mail|ip)\W*$")).alias("key_near"),
        flag(before.rlike(ASSIGNED)).alias("assigned"))
    rows = rows.select("*", F.size("g").cast("double").alias("n_groups"),
                       F.coalesce(F.array_max("g"), F.lit(0)).cast("double").alias("longest"),
                       F.coalesce(F.array_min("g"), F.lit(0)).cast("double").alias("shortest")).drop("g")
    n = F.col("n_digits")
    fails = ((n < 9) | (n > 19) | ((n > 15) & (F.col("luhn") == 0)) | ((F.col("n_dot") == 3) & (F.col("n_groups") == 4) & (F.col("octets") == 0)))
    sure = F.col("m").rlike(ACCESS_KEY) | ((F.col("assigned") == 1) & (n > 0))
    return rows.withColumn("label", F.when(F.col("gen") == LONG_TOKEN, F.when(n == 0, 0.0).when(sure, 1.0))
                           .when(F.col("met").isNotNull(), 1.0).when((F.col("gen") == DIGIT_GROUPS) & fails, 0.0))


def _fit(rows: DataFrame, precision: float) -> tuple[GBTClassificationModel, float] | None:
    """Trees of one half of the rows, and the least probability at which the
    other half shows the precision asked for; None without both classes."""
    some = stored(rows.select("label", (F.pmod(F.xxhash64("doc_id", "start"), F.lit(2)) == 0).alias("fit"), "features"), "pii-certain")
    seen = {r["label"]: r["count"] for r in some.where("fit").groupBy("label").count().collect()}
    if len(seen) < 2:
        return None
    trees = GBTClassifier(maxIter=12, maxDepth=3, stepSize=0.3, seed=7, maxBins=32, checkpointInterval=-1).fit(some.where("fit"))
    held = trees.transform(some.where("not fit")).select(_probability(), "label")
    bins = [(r["b"], r["n"], r["good"]) for r in held.groupBy(F.floor(F.col("p") * 50).alias("b"))
            .agg(F.count("*").alias("n"), F.sum("label").alias("good")).orderBy(F.desc("b")).collect()]
    least, n, good = 1.01, 0, 0.0
    for b, more, right in bins:
        n, good = n + more, good + right
        if good >= precision * n:
            least = b / 50
    return trees, max(least, 0.5)


def _probability() -> Column:
    return vector_to_array("probability")[1].alias("p")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in (*KINDS, SECRET)])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             precision: float = PRECISION) -> DataFrame:
    """One row per input row: doc_id, base (base spans) and spans (base and
    added ones), arrays of (start, kind, end) with kind an index into KINDS (one
    more: SECRET), sorted by start, then kind; offsets in code points, end exclusive.

    Null texts count as empty and have no spans.  Rows that repeat an
    identifier are judged each.  When what is certain lacks a class,
    nothing is added.  Other columns are not read; an empty table gives an
    empty result.
    """
    found = _found(docs, id_col, text_col)
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform
    proposals = _proposals(found)
    fitted = _fit(assemble(_features(proposals.unionByName(_rewritten(proposals))).where("label is not null")), precision)
    if fitted is None:
        return found.select("doc_id", "base", F.col("base").alias("spans"))
    trees, least = fitted
    kind = (F.when(F.col("gen") == ADDRESS, 0).when(F.col("gen") == LONG_TOKEN, len(KINDS))
             .when((F.col("n_dot") == 3) & (F.col("n_groups") == 4), 1).when(F.col("n_digits") > 15, 2).otherwise(3))
    added = (trees.transform(assemble(_features(proposals.where("met is null")))).select("__row", "start", "end", kind.alias("kind"), _probability())
                  .where(F.col("p") >= least)
                  .groupBy("__row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("added")))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return (found.join(added, "__row", "left")
                 .select("doc_id", "base", F.array_sort(F.concat("base", F.coalesce("added", none))).alias("spans")))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (joined), n_spans."""
    def count(i: int, k: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long").alias(f"n_{k}")

    return found.select("doc_id", *[count(i, k) for i, k in enumerate(KINDS)], F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        _joined(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))
