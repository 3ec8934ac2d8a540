"""Registry of catalogue queries: a Spark plan and, where SQL can say it, the
equivalent DuckDB SQL over the same tables (used as the correctness oracle)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str, row_heavy: bool = False) -> DataFrame:
    """One of the benchmark tables (a Parquet file per table).

    ``row_heavy`` marks a scan followed by costly per-row work (JSON
    generation or parsing) before any shuffle: such a scan is spread over the
    cores when the file has fewer splits than that (measured: 2-3x faster at
    sf0.1 for those queries, slower for join/aggregate queries, which is why
    it is not the default)."""
    from matchlake.sources import spread

    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if row_heavy else df
