"""Row order that survives storage: each sorted model is written in its order,
and read back with every row's place in the files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchlake.plans.catalogue import io_q, json_q, marts_q, models_q  # noqa: F401 - registers the models' queries
from matchlake.plans.catalogue.registry import ORACLE_SQL, QUERIES, query
from matchlake.plans.marts import ORDER
from matchlake.session import scratch_dir
from matchlake.sources import read_positions, write_sorted


def _sql_order(order: str) -> str:
    return ", ".join(f"{p} NULLS LAST" if p.endswith(" desc") else f"{p} NULLS FIRST" for p in order.split(", "))


def _ordered(name: str, base: str, model: str) -> None:
    """Query ``name``: the rows of query ``base`` with their place in the stored ``model``."""
    @query(name, f"SELECT *, row_number() OVER (ORDER BY {_sql_order(ORDER[model])}) AS position FROM ({ORACLE_SQL[base]})")
    def run(spark: SparkSession, d: str) -> DataFrame:
        path = scratch_dir(spark, name)
        write_sorted(QUERIES[base](spark, d), path, ORDER[model])
        return read_positions(spark, path)


# --------------------------------------------------------------------------- O1 O2
_ordered("order_of_points_table", "order_points_table", "points_table")
_ordered("order_of_innings_summary", "innings_summary_analog", "innings_summary")
_ordered("order_of_schedule", "schedule_enriched", "ipl_schedule")
_ordered("order_of_match_ids", "season_listing", "match_ids")
_ordered("order_of_players", "last_name_extract", "stg_players_info")
_ordered("order_of_stadiums", "venue_lookup", "int_stadiums_info")
