"""Join helpers: broadcast only behind a size check, anti-joins for deltas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Upper bound for an explicit broadcast hint, on what the side reads from
# storage.  Above it the join stays a shuffle join, which AQE may still turn into a broadcast once the real
# (measured) size of the shuffled side is known.
BROADCAST_MAX_BYTES = 8 * 1024 * 1024


# Plan nodes whose result is no larger than what they read.
_NO_GROWTH = {"Project", "Filter", "Aggregate", "Distinct", "Deduplicate", "Sort", "Union", "LocalLimit", "GlobalLimit", "Repartition",
              "RepartitionByExpression", "SubqueryAlias", "View", "LogicalRelation", "Relation", "LocalRelation", "OneRowRelation"}


def proven_size_bytes(df: DataFrame) -> int | None:
    """The size of what ``df`` reads, where the result can be no larger: stored
    tables, filtered, projected, aggregated or united.  None when it cannot be
    told, as after a join or an explode, whose size is only an estimate.  No job runs."""
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
    except Exception:  # noqa: BLE001 - no JVM access, e.g. a remote session
        return None

    def size(node) -> int | None:
        if node.nodeName().split(" ")[0] not in _NO_GROWTH:
            return None
        children = [node.children().apply(k) for k in range(node.children().size())]
        if not children:
            return int(str(node.stats().sizeInBytes()))
        sizes = [size(c) for c in children]
        return None if None in sizes else sum(sizes)
    return size(plan)


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Hint a broadcast only when ``df`` provably reads no more than
    ``max_bytes``; otherwise the planner decides, and may step back at run time."""
    size = proven_size_bytes(df)
    return F.broadcast(df) if size is not None and size <= max_bytes else df


def anti_new(candidates: DataFrame, loaded: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows of ``candidates`` whose key is not in ``loaded`` (left anti join).

    The loaded set grows with history, so it is broadcast only while small;
    afterwards both sides shuffle on the key.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    done = loaded.select(*keys).dropDuplicates(keys)
    return candidates.join(broadcast_if_small(done), on=keys, how="left_anti")


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left",
                   broadcast_right: bool = False) -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL; keeps the left key columns."""
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c)
                             for c in right.columns])
    if broadcast_right:
        renamed = F.broadcast(renamed)
    cond = None
    for k in keys:
        part = left[k].eqNullSafe(renamed[f"__r_{k}"])
        cond = part if cond is None else cond & part
    out = left.join(renamed, cond, how)
    return out.drop(*[f"__r_{k}" for k in keys])
