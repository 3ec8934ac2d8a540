"""The models' declared column tests, run as DataFrame checks.

Each entry names a model, a column and a test; ``run_checks`` returns the
failing rows per check (empty means pass) and ``check_summary`` one row per
check with its failure count.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake import constants as C
from matchlake.operators import (
    accepted_values_violations, not_null_violations, relationships_violations, unique_violations,
)


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str                      # unique | not_null | accepted_values | relationships
    values: tuple[str, ...] = ()   # accepted_values
    to: str | None = None          # relationships: parent model
    field_: str | None = field(default=None)   # relationships: parent column

    @property
    def name(self) -> str:
        return f"{self.test}__{self.model}__{self.column}"


# The declared tests of the models (model, column, test).
ORDER_STATUSES = C.ORDER_STATUSES
DECLARED_CHECKS = (
    Check("customers", "customer_id", "unique"),
    Check("customers", "customer_id", "not_null"),
    Check("stg_customers", "customer_id", "unique"),
    Check("stg_customers", "customer_id", "not_null"),
    Check("stg_orders", "order_id", "unique"),
    Check("stg_orders", "order_id", "not_null"),
    Check("stg_orders", "status", "accepted_values", values=ORDER_STATUSES),
    Check("stg_orders", "customer_id", "not_null"),
    Check("stg_orders", "customer_id", "relationships", to="stg_customers", field_="customer_id"),
    Check("stg_cricket_match", "file_name", "not_null"),
)


def failing_rows(models: Mapping[str, DataFrame], check: Check) -> DataFrame:
    df = models[check.model]
    if check.test == "unique":
        return unique_violations(df, check.column)
    if check.test == "not_null":
        return not_null_violations(df, check.column)
    if check.test == "accepted_values":
        return accepted_values_violations(df, check.column, check.values)
    if check.test == "relationships":
        return relationships_violations(df, check.column, models[check.to], check.field_ or check.column)
    raise ValueError(check.test)


def run_checks(models: Mapping[str, DataFrame], checks=DECLARED_CHECKS) -> dict[str, DataFrame | None]:
    """Failing rows per check; None where the check's model (or the parent it
    refers to) is absent, so that it could not run."""
    return {c.name: failing_rows(models, c) if _can_run(c, models) else None for c in checks}


def _can_run(c: Check, models: Mapping[str, DataFrame]) -> bool:
    return c.model in models and (c.to is None or c.to in models)


#: What a model's row adds to a check: a failure, a key to be unique, a key that refers, a key referred to.
FAILS, KEY, CHILD, PARENT = "fails", "key", "child", "parent"


def _said(check: Check, role: str, cond: Column, key: Column | None = None) -> Column:
    key = F.lit(None).cast("string") if key is None else key.cast("string")
    return F.when(cond, F.struct(F.lit(check.name).alias("check"), F.lit(role).alias("role"), key.alias("key")))


def check_summary(spark: SparkSession, models: Mapping[str, DataFrame], checks=DECLARED_CHECKS) -> DataFrame:
    """One row per check: name and number of failing rows (of key values, for
    unique); NULL when the check's model is missing, so that it did not run.

    All checks of all models are one plan: each model is scanned once and every
    row stacked as the (check, key) pairs it has a say in; one aggregation per
    (check, key), combined map-side, then counts repeats, failures and
    references without a parent.  Keys compare as text.
    """
    says: dict[str, list[Column]] = {}
    for c in checks:
        if not _can_run(c, models):
            continue
        col = F.col(c.column)
        if c.test == "not_null":
            said = _said(c, FAILS, col.isNull())
        elif c.test == "accepted_values":
            said = _said(c, FAILS, ~col.isin(list(c.values)))
        elif c.test == "unique":
            said = _said(c, KEY, col.isNotNull(), col)
        elif c.test == "relationships":
            said = _said(c, CHILD, col.isNotNull(), col)
            parent = F.col(c.field_ or c.column)
            says.setdefault(c.to, []).append(_said(c, PARENT, parent.isNotNull(), parent))
        else:
            raise ValueError(c.test)
        says.setdefault(c.model, []).append(said)
    names = spark.createDataFrame([(c.name,) for c in checks], "check string")
    ran = spark.createDataFrame([(c.name,) for c in checks if _can_run(c, models)], "check string")
    stacked = None
    for model, said in says.items():
        rows = models[model].select(F.explode(F.filter(F.array(*said), lambda x: x.isNotNull())).alias("x")).select("x.*")
        stacked = rows if stacked is None else stacked.unionByName(rows)
    if stacked is None:
        return names.select("check", F.lit(None).cast("bigint").alias("failures")).orderBy("check")
    counts = stacked.groupBy("check", "key").agg(
        *[F.count_if(F.col("role") == r).alias(f"n_{r}") for r in (FAILS, KEY, CHILD, PARENT)])
    orphans = F.when(F.col(f"n_{PARENT}") == 0, F.col(f"n_{CHILD}")).otherwise(0)
    failed = counts.groupBy("check").agg(F.sum(F.col(f"n_{FAILS}") + (F.col(f"n_{KEY}") > 1).cast("bigint") + orphans).alias("n"))
    # the declared checks are a fixed list, so broadcasting their results is bounded by it
    return (names.join(F.broadcast(ran.join(F.broadcast(failed), "check", "left")
                                      .select("check", F.coalesce("n", F.lit(0)).alias("failures"))), "check", "left")
                 .orderBy("check"))
