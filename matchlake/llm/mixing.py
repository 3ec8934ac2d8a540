"""Mixing sources to target weights by Pareto order sampling.

Word counts give each source its size; the weights share the total, no source
gets more than ``cap`` times its own words, and the excess goes to the others
by weight (water filling).  A source asked for r times its words takes floor(r)
whole copies of every document, and a sample worth the rest: documents are
ranked by q = odds(u) / odds(p), u uniform by hash of the identifier and p the
inclusion probability, and the smallest ranks are taken until the words left
are used up (Pareto sampling of a fixed size, the size counted in words).

Only DataFrame functions.  The running sum that finds the last document taken
never orders a whole source in one task: ranks are first summed in fine bins
(map-side combined), and only the one bin per source where the target is
crossed is ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm.store import stored, text_of
from matchlake.operators import sequence_within

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1.0, 2.0, 3.0)
CAP = 3
BINS = 1 << 14


def n_words(text: Column) -> Column:
    """Words of a text without building them: starts of non-space runs."""
    packed = F.regexp_replace(text, WORD, "\x01")
    return F.length(F.translate(packed, " \t\n\x0b\x0c\r", "")).cast("long")


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per source: source, source_size, target.  Sources are ordered by
    code point, null last, and weigh ``weights`` in turn.  The table has one
    row per source, which is what its windows order."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    given = F.array(*[F.lit(float(w)) for w in weights])
    src = sizes.withColumn("w", F.get(given, (F.row_number().over(by_name) - 1) % len(weights)))
    # water filling: the level at which a source is full is cap * size / w;
    # with the sources in that order, those before the level are full
    by_level = Window.orderBy("level", F.col("source").asc_nulls_last())
    whole = Window.partitionBy(F.lit(0))
    src = (src.withColumn("level", F.lit(float(cap)) * F.col("source_size") / F.col("w"))
              .withColumn("total", F.sum("source_size").over(whole))
              .withColumn("full_before", F.coalesce(F.sum("source_size").over(
                  by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) * cap)
              .withColumn("w_left", F.sum("w").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
              .withColumn("share", (F.col("total") - F.col("full_before")) / F.col("w_left")))
    # the first source (by level) that its share does not fill sets the common share
    level = F.min(F.when(F.col("share") <= F.col("level"), F.struct("level", "share"))).over(whole)
    return src.select(
        "source", "source_size",
        F.when(level.isNull() | (F.col("level") < level["level"]), F.lit(float(cap)) * F.col("source_size"))
         .otherwise(F.least(F.col("w") * level["share"], F.lit(float(cap)) * F.col("source_size"))).alias("target"))


def uniform(id_col: Column, copy: Column, seed: str) -> Column:
    """A uniform number in (0, 1) fixed by identifier, number of the row among
    those that share it, and seed: 48 bits of MD5."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(id_col.cast("string"), F.lit("null")))
    hexa = F.substring(F.md5(F.when(copy == 1, key).otherwise(F.concat(key, F.lit(":"), copy.cast("string")))), 1, 12)
    return (F.conv(hexa, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 48))


def _told_apart(rows: DataFrame) -> DataFrame:
    """``rows`` with ``__copy``, which tells rows of one ``__id`` (null is one,
    too) apart: 1, 2, .. in the order of a hash of source and text, then of all they
    hold, so that only equal rows are interchangeable.  Where no identifier repeats it is 1."""
    if rows.groupBy("__id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return rows.withColumn("__copy", F.lit(1).cast("long"))
    hashed = rows.withColumn("__hash", F.xxhash64("__id", "source", "__text")).withColumn("__all", F.xxhash64(*rows.columns))
    return stored(sequence_within(hashed, ["__id"], ["__hash", "__all"], "__copy").drop("__hash", "__all"), "mix-rows")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[float, ...] = WEIGHTS, cap: int = CAP, seed: str = "mix",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, copies,
    taken (words taken, copies counted), and the columns named in ``keep``.

    Null or empty texts have size 0 and take nothing.  A null source is a
    source of its own, ordered last.  Rows that repeat an identifier, or have
    none, are drawn each for itself (``_told_apart``).  All sizes zero gives zero
    targets; an empty table gives an empty result; columns not named are not
    read.  The result depends on what the rows hold and on ``seed`` only.
    """
    base = _told_apart(docs.select(
        F.col(id_col).alias("__id"), F.col(source_col).cast("string").alias("source"), text_of(text_col).alias("__text"),
        *[F.col(c).alias(f"__keep_{c}") for c in keep]))

    def sized(*more: str) -> DataFrame:
        return base.select("__id", "__copy", "source", n_words(F.col("__text")).alias("size"), *more)

    slim = stored(sized(), "mix-sizes")
    # one row per source: its size is bounded by the number of sources
    plan = source_targets(slim, weights, cap)
    plan = plan.withColumn("ratio", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    plan = plan.withColumn("whole", F.floor("ratio").cast("long"))
    plan = plan.withColumn("p", F.col("ratio") - F.col("whole"))
    plan = stored(plan.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "mix-plan")
    ranked = _ranked(slim, plan, seed)

    bins = ranked.where("bin is not null").groupBy("source", "bin").agg(
        F.sum("size").alias("bin_size"), F.first("rest").alias("rest"))
    up = Window.partitionBy("source").orderBy("bin")
    bins = bins.withColumn("upto", F.sum("bin_size").over(up))
    # at most one bin per source crosses its target
    crossing = bins.where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("bin_size") <= F.col("rest"))) \
                   .select(F.col("source").alias("s"), F.col("bin").alias("cross_bin"),
                           (F.col("upto") - F.col("bin_size")).alias("before"))
    inside = (ranked.join(crossing, F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("cross_bin")))
                    .select("source", "__id", "__copy", "size", "q", "before", "rest"))
    in_bin = Window.partitionBy("source").orderBy("q", "__id", "__copy", "size").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("upto", F.col("before") + F.sum("size").over(in_bin))
    # the document that crosses the target is taken if that ends nearer to it
    inside = inside.where((F.col("upto") <= F.col("rest"))
                          | (F.col("upto") - F.col("rest") < F.col("rest") - (F.col("upto") - F.col("size"))))
    last = inside.groupBy("source").agg(F.max(F.struct("q", "__id", "__copy", "size")).alias("last"))
    limits = (crossing.join(last, F.col("s").eqNullSafe(F.col("source")), "left")
                      .select("s", "cross_bin", "last"))
    limits = (plan.join(limits, F.col("source").eqNullSafe(F.col("s")), "left").drop("s"))

    rows = sized(*[f"__keep_{c}" for c in keep]) if keep else slim
    out = _ranked(rows, stored(limits, "mix-limits"), seed)
    here = F.struct("q", "__id", "__copy", "size")
    extra = F.when(F.col("bin").isNull(), False) \
             .when(F.col("cross_bin").isNull() | (F.col("bin") < F.col("cross_bin")), True) \
             .when(F.col("bin") > F.col("cross_bin"), False) \
             .otherwise(F.coalesce(here <= F.col("last"), F.lit(False)))
    copies = F.when(F.col("size") > 0, F.col("whole") + extra.cast("long")).otherwise(F.lit(0)).cast("long")
    return out.select(F.col("__id").alias("doc_id"), "source", "size", "source_size", "target",
                      copies.alias("copies"), (copies * F.col("size")).alias("taken"),
                      *[F.col(f"__keep_{c}").alias(c) for c in keep])


def _ranked(rows: DataFrame, plan: DataFrame, seed: str) -> DataFrame:
    """Rows with their source's plan, their Pareto rank q and its bin."""
    rows = (rows.join(plan.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s")))
                .drop("__s"))
    u = uniform(F.col("__id"), F.col("__copy"), seed)
    q = (u / (1 - u)) / (F.col("p") / (1 - F.col("p")))
    rows = rows.withColumn("q", F.when((F.col("p") > 0) & (F.col("size") > 0), q))
    # q / (1 + q) is in (0, 1) and near 1/2 where the sample ends
    return rows.withColumn("bin", F.floor(F.col("q") / (1 + F.col("q")) * BINS).cast("int"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, all columns kept whatever their
    names, each as often as it is taken."""
    names = docs.columns
    own = [f"c{k}" for k in range(len(names))]
    where = {n: own[names.index(n)] for n in (id_col, text_col, source_col)}
    out = mix_sources(docs.toDF(*own), where[id_col], where[text_col], where[source_col], keep=tuple(own), **options)
    out = out.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return out.select(*own).toDF(*names)
