"""Reshaping operators: one row per side of a record, nested array flattening."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot_sides(df: DataFrame, keep: Sequence[str],
                  sides: Sequence[Mapping[str, Column]]) -> DataFrame:
    """One output row per side (UNION ALL of per-side projections) in a single
    scan: ``inline(array(struct(side1), struct(side2), ...))``."""
    structs = [F.struct(*[c.alias(name) for name, c in side.items()]) for side in sides]
    return df.select(*keep, F.inline(F.array(*structs)))


def explode_level(df: DataFrame, array_col: str, pos_col: str, elem_col: str,
                  keep: Sequence[str | Column]) -> DataFrame:
    """``CROSS JOIN UNNEST(arr) WITH OFFSET``: one row per element with its
    0-based position; rows whose array is NULL or empty disappear.

    The array is given as an expression: from a bare column the optimiser infers
    a filter on its size, pushes it below the step that made the column, and a
    document would be parsed again for every condition of that filter."""
    return df.select(*keep, F.posexplode(F.coalesce(F.col(array_col), F.array())).alias(pos_col, elem_col))
