"""Column data-quality checks; each returns the failing rows (empty = pass)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.operators.joins import broadcast_if_small


def unique_violations(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Key values (non-NULL) that occur more than once, with their count."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    present = df.select(*cols).dropna(how="any", subset=cols)
    return (present.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))
                   .where(F.col("n_rows") > 1))


def not_null_violations(df: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` is NULL."""
    return df.where(F.col(col).isNull())


def accepted_values_violations(df: DataFrame, col: str, values: Iterable[str]) -> DataFrame:
    """Rows whose ``col`` is outside ``values``; NULL passes (``NOT IN`` is NULL)."""
    return df.where(~F.col(col).isin(list(values)))


def relationships_violations(child: DataFrame, col: str, parent: DataFrame,
                             parent_col: str) -> DataFrame:
    """Child rows whose non-NULL ``col`` has no parent row; NULL passes."""
    keys = parent.select(F.col(parent_col).alias(col)).distinct()
    return child.where(F.col(col).isNotNull()).join(broadcast_if_small(keys), on=col, how="left_anti")


def column_check_counts(df: DataFrame, not_null: Sequence[str] = (),
                        accepted: Mapping[str, Iterable[str]] | None = None) -> DataFrame:
    """Failure counts of several row-level checks in one aggregation pass."""
    aggs = [F.count_if(F.col(c).isNull()).alias(f"not_null__{c}") for c in not_null]
    aggs += [F.count_if(~F.col(c).isin(list(v))).alias(f"accepted_values__{c}")
             for c, v in (accepted or {}).items()]
    return df.agg(*aggs)
