"""Ranking operators: top-n per group, top-n spread to columns, and row
numbers / dense ids that stay balanced when one group holds most rows."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.operators.joins import join_null_safe


def _sort(c: Column | str) -> Column:
    return F.col(c).asc() if isinstance(c, str) else c


def top_n_per_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column | str],
                    n: int, rn_col: str = "rn") -> DataFrame:
    """Rows ranked 1..n per group (ROW_NUMBER ≤ n), rank kept as BIGINT.

    The ``rn <= n`` filter lets Catalyst insert a partial WindowGroupLimit
    before the shuffle, so each map task sends at most ``n`` rows per group:
    a hot group costs no more shuffle than a cold one.  ``order_cols`` should
    end with an identifying column so that ties resolve deterministically.
    """
    w = Window.partitionBy(*group_cols).orderBy(*[_sort(c) for c in order_cols])
    return (df.withColumn(rn_col, F.row_number().over(w))
              .where(F.col(rn_col) <= n)
              .withColumn(rn_col, F.col(rn_col).cast("bigint")))


def pivot_top_n(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column | str],
                columns: Mapping[str, str], labels: Sequence[str]) -> DataFrame:
    """Top ``len(labels)`` rows per group spread into columns, one row per group.

    ``columns`` maps a source column to an output name template using
    ``{label}``, e.g. ``{"batter": "{label}_batter"}``.  Missing ranks give
    NULL columns.  Replaces one self-join per rank with a single conditional
    aggregation over the already group-partitioned top-n rows.
    """
    ranked = top_n_per_group(df, group_cols, order_cols, len(labels), "__rn")
    aggs = [F.max(F.when(F.col("__rn") == k, F.col(src))).alias(tmpl.format(label=label))
            for k, label in enumerate(labels, start=1) for src, tmpl in columns.items()]
    return ranked.groupBy(*group_cols).agg(*aggs)


#: Slices a hot group is cut into for each partition's share of rows it holds, and sampled rows for each slice.
SLICES_PER_SHARE, SAMPLES_PER_SLICE = 4, 32


def _order_key(c: Column | str) -> tuple[str, bool, bool]:
    """(name, descending, NULLs first) of an order column given by name, F.asc or F.desc."""
    if isinstance(c, str):
        return c, False, True
    m = re.fullmatch(r"Column<'([^' ]+)(?: (ASC|DESC) NULLS (FIRST|LAST))?'>", str(c))
    if not m:
        raise ValueError(f"order by plain columns, not {c}")
    return m[1], m[2] == "DESC", m[3] != "LAST"


def _before(split: Column, order: Sequence[Column | str]) -> Column:
    """Whether the order values ``split`` come strictly before the row's."""
    out = F.lit(False)
    for name, desc, nulls_first in reversed([_order_key(c) for c in order]):
        a, b = split[name], F.col(name)
        less = (a > b) if desc else (a < b)
        null_less = (a.isNull() & b.isNotNull()) if nulls_first else (a.isNotNull() & b.isNull())
        out = F.coalesce(less, F.lit(False)) | null_less | (a.eqNullSafe(b) & out)
    return out


def _hot_splits(df: DataFrame, groups: Sequence[str], order: Sequence[Column | str], parts: int) -> DataFrame | None:
    """``(groups, __n, __splits)`` of the groups that hold more than one
    partition's share of the rows, or None.  There are fewer than ``parts`` of
    them, and at most (SLICES_PER_SHARE + 1) * ``parts`` splits in all."""
    from matchlake.session import scratch_dir
    from matchlake.sources.sinks import materialize_table

    spark, seen = df.sparkSession, Observation()
    largest = (df.select(*groups).observe(seen, F.count(F.lit(1)).alias("n")).groupBy(*groups).agg(F.count(F.lit(1)).alias("__n"))
                 .orderBy(F.desc("__n")).limit(parts).collect())
    share = seen.get["n"] / parts if largest else 0
    hot = [r for r in largest if r["__n"] > share]
    if not hot or parts < 2:
        return None
    schema = T.StructType([*[df.schema[g] for g in groups], T.StructField("__n", T.LongType())])
    rows = spark.createDataFrame([tuple(r) for r in hot], T.StructType([T.StructField(f.name, f.dataType) for f in schema]))
    wanted = sum(SAMPLES_PER_SLICE * (SLICES_PER_SHARE * r["__n"] / share + 1) for r in hot)
    names = list(dict.fromkeys(_order_key(c)[0] for c in order))
    cols = [*groups, *(n for n in names if n not in groups)]
    sampled = join_null_safe(df.select(*cols).where(F.rand(7) < wanted / sum(r["__n"] for r in hot)), rows, groups, "inner", broadcast_right=True)
    # the sample is small: cut each group's part of it into slices of equal size
    w = Window.partitionBy(*groups)
    cut = F.floor((F.row_number().over(w.orderBy(*[_sort(c) for c in order])) - 1) * F.ceil(F.col("__n") * SLICES_PER_SHARE / F.lit(share))
                  / F.count(F.lit(1)).over(w))
    starts = (sampled.withColumn("__cut", cut).withColumn("__first", F.row_number().over(
        Window.partitionBy(*groups, "__cut").orderBy(*[_sort(c) for c in order]))).where("__cut > 0 and __first = 1"))
    splits = starts.groupBy(*groups, "__n").agg(F.collect_list(F.struct(*names)).alias("__splits"))
    return materialize_table(splits, scratch_dir(spark, "splits"))      # fixed: every branch slices alike


def sequence_within(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column | str],
                    out_col: str = "rn", num_partitions: int | None = None,
                    size_col: str | None = None) -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY group_cols ORDER BY order_cols) for every
    row, with one exchange of the rows and no whole group in one task.

    Rows are dealt out by (group, slice).  A group is cut into slices only if it
    holds more than one partition's share of the rows (one counting pass over
    the group columns tells); its slices follow the order, cut at values of a
    small sample.  A row's slice depends on the row and those fixed values
    alone, so nothing has to be pinned: the window numbers each slice, and the
    rows of a hot group's earlier slices, counted apart, are added.  That table
    has some rows per partition at most, so its broadcast is bounded.
    ``order_cols`` must make the order total (end with an identifying column)
    and are plain columns, by name, F.asc or F.desc.  With ``size_col`` each
    row also gets its group's row count (COUNT(*) OVER the group).
    """
    if not group_cols:
        if size_col:
            raise ValueError("size_col needs group columns")
        return number_all(df, order_cols, out_col, num_partitions)
    groups = list(group_cols)
    parts = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    splits = _hot_splits(df, groups, order_cols, parts)
    if splits is None:
        sliced, keys = df, groups
    else:
        with_splits = join_null_safe(df, splits.drop("__n"), groups, "left", broadcast_right=True)
        sliced = with_splits.withColumn("__slice", F.coalesce(
            F.size(F.filter("__splits", lambda s: _before(s, order_cols))), F.lit(0))).drop("__splits")
        keys = [*groups, "__slice"]
    dealt = sliced.repartition(num_partitions, *keys) if num_partitions else sliced
    w = Window.partitionBy(*keys)
    out = dealt.withColumn(out_col, F.row_number().over(w.orderBy(*[_sort(c) for c in order_cols])).cast("bigint"))
    if size_col:
        out = out.withColumn(size_col, F.count(F.lit(1)).over(w))
    if splits is None:
        return out
    # rows of each slice of the hot groups, and before it
    counts = join_null_safe(sliced, splits.select(*groups, "__n"), groups, "inner", broadcast_right=True) \
        .groupBy(*keys, "__n").agg(F.count(F.lit(1)).alias("__own"))
    ahead = Window.partitionBy(*groups).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*keys, "__n", F.coalesce(F.sum("__own").over(ahead), F.lit(0)).alias("__before"))
    out = join_null_safe(out, before, keys, "left", broadcast_right=True)
    out = out.withColumn(out_col, F.col(out_col) + F.coalesce("__before", F.lit(0)))
    if size_col:
        out = out.withColumn(size_col, F.coalesce("__n", size_col))
    return out.drop("__slice", "__before", "__n")


def number_all(df: DataFrame, order_cols: Sequence[Column | str], out_col: str = "rn",
               num_partitions: int | None = None) -> DataFrame:
    """ROW_NUMBER() OVER (ORDER BY order_cols) of all rows, without a single-partition window.

    Rows are range-partitioned, sorted and written once with their position
    (partition and place in it); a row's number is its place plus the rows of
    earlier partitions, a table of one row per partition.
    """
    from matchlake.session import scratch_dir
    from matchlake.sources.sinks import materialize_table

    order = [_sort(c) for c in order_cols]
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    placed = materialize_table(ranged.sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()),
                               scratch_dir(df.sparkSession, "numbered"))
    placed = placed.withColumn("__part", F.shiftright("__at", 33))
    counts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__own"))
    ahead = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)     # over one row per partition
    before = counts.select("__part", F.coalesce(F.sum("__own").over(ahead), F.lit(0)).alias("__before"))
    out = placed.join(F.broadcast(before), "__part")
    number = F.expr("__at & 8589934591") + F.col("__before") + 1        # the low 33 bits: the place in the partition
    return out.withColumn(out_col, number.cast("bigint")).drop("__part", "__at", "__before")


def dense_id(df: DataFrame, key: Column | str, id_col: str = "id",
             num_partitions: int | None = None) -> DataFrame:
    """Mapping ``(key, id)``: DENSE_RANK() OVER (ORDER BY key) of the distinct
    keys, NULL first, computed without a single-partition window."""
    k = F.col(key) if isinstance(key, str) else key
    keys = df.select(k.alias("__key")).distinct()
    return (number_all(keys, ["__key"], id_col, num_partitions)
            .withColumnRenamed("__key", key if isinstance(key, str) else "key"))


def attach_dense_id(df: DataFrame, key: str, id_col: str, null_safe: bool = False,
                    num_partitions: int | None = None) -> DataFrame:
    """``df`` plus the dense id of its ``key``.  With ``null_safe`` a NULL key
    gets its rank (the window form); otherwise NULL never joins (USING form)."""
    mapping = dense_id(df, key, id_col, num_partitions)
    if null_safe:
        return join_null_safe(df, mapping, [key], "left")
    return df.join(mapping, on=key, how="left")
