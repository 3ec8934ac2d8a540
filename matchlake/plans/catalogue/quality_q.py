"""Data-quality checks run on the benchmark tables (failing rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.operators import (
    accepted_values_violations, not_null_violations, relationships_violations, unique_violations,
)
from matchlake.plans.catalogue.registry import query, table
from matchlake.plans.checks import Check, check_summary

ACCEPTED_EVENT_TYPES = ["click", "view", "purchase"]


@query("dq_unique", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY 1, 2 HAVING COUNT(*) > 1
""")
def dq_unique(spark: SparkSession, d: str) -> DataFrame:
    return unique_violations(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_not_null", """
SELECT o_orderkey, NULLIF(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority FROM orders
WHERE NULLIF(o_orderpriority, '4-NOT SPECIFIED') IS NULL
""")
def dq_not_null(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("o_orderpriority"))
    return not_null_violations(o, "o_orderpriority")


@query("dq_accepted_values", """
SELECT event_id, event_type FROM events WHERE event_type NOT IN ('click', 'view', 'purchase')
""")
def dq_accepted_values(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "event_type")
    return accepted_values_violations(e, "event_type", ACCEPTED_EVENT_TYPES)


@query("dq_relationships", """
SELECT doc_id FROM documents WHERE doc_id IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)
""")
def dq_relationships(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id")
    return relationships_violations(docs, "doc_id", table(spark, d, "labels"), "doc_id")


#: Declared checks over the benchmark tables: some hold, some fail, one cannot run.
TABLE_CHECKS = (
    Check("orders", "o_orderkey", "unique"),
    Check("orders", "o_custkey", "unique"),
    Check("orders", "o_orderdate", "not_null"),
    Check("orders", "o_custkey", "relationships", to="customer", field_="c_custkey"),
    Check("lineitem", "l_orderkey", "relationships", to="orders", field_="o_orderkey"),
    Check("lineitem", "l_returnflag", "accepted_values", values=("A", "R")),
    Check("customer", "c_custkey", "unique"),
    Check("events", "event_type", "accepted_values", values=tuple(ACCEPTED_EVENT_TYPES)),
    Check("events", "user_id", "relationships", to="customer", field_="c_custkey"),
    Check("documents", "doc_id", "relationships", to="labels", field_="doc_id"),
    Check("labels", "doc_id", "unique"),
    Check("referees", "name", "not_null"),
)


def _check_sql(c: Check) -> str:
    if c.test == "unique":
        n = f"(SELECT count(*) FROM (SELECT {c.column} FROM {c.model} WHERE {c.column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1))"
    elif c.test == "not_null":
        n = f"(SELECT count(*) FROM {c.model} WHERE {c.column} IS NULL)"
    elif c.test == "accepted_values":
        n = f"(SELECT count(*) FROM {c.model} WHERE {c.column} NOT IN {c.values})"
    else:
        n = f"(SELECT count(*) FROM {c.model} ANTI JOIN {c.to} p ON {c.model}.{c.column} = p.{c.field_} WHERE {c.model}.{c.column} IS NOT NULL)"
    return f"SELECT '{c.name}' AS \"check\", {'NULL' if c.model == 'referees' else n}::BIGINT AS failures"


@query("dq_summary", "\nUNION ALL\n".join(_check_sql(c) for c in TABLE_CHECKS))
def dq_summary(spark: SparkSession, d: str) -> DataFrame:
    """All checks of all tables in one plan, each table scanned once."""
    names = {m for c in TABLE_CHECKS for m in (c.model, c.to) if m and m != "referees"}
    return check_summary(spark, {n: table(spark, d, n) for n in sorted(names)}, TABLE_CHECKS)
