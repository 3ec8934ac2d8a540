"""Build every model in dependency order from the sources.

The documents are parsed once and stored as nested Parquet; the header,
delivery and team models read only the nested fields they use.  Models with
several consumers (deliveries, match info) are written once to the output
folder and read back, so each mart plan starts from files, and a lost
executor recomputes from those files rather than from the raw documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from matchlake.plans import intermediate, marts, staging
from matchlake.session import scratch_dir
from matchlake.sources import materialize_table, materialize_view, read_seed, write_sorted


@dataclass
class Sources:
    cricket_match_raw: DataFrame
    ipl_teams: DataFrame
    players_info: DataFrame
    stadium_coordinates: DataFrame
    weather_info: DataFrame


def build(spark: SparkSession, src: Sources, out_dir: str | None = None, season: str = "2025",
          register_views: bool = False) -> dict[str, DataFrame]:
    out_dir = out_dir or scratch_dir(spark, "models")
    m: dict[str, DataFrame] = {}

    def store(name: str, df: DataFrame) -> DataFrame:
        if name in marts.ORDER:         # files in the model's order: ``read_positions`` gives each row's place
            write_sorted(df, f"{out_dir}/{name}", marts.ORDER[name])
            m[name] = spark.read.parquet(f"{out_dir}/{name}")
        else:
            m[name] = materialize_table(df, f"{out_dir}/{name}")
        return m[name]

    raw = store("stg_cricket_match", staging.stg_cricket_match(src.cricket_match_raw))
    # Parse every document once; the models read the nested Parquet columns they need.
    docs = materialize_table(staging.parsed_documents(raw), f"{out_dir}/parsed_documents")
    store("stg_match_info", staging.stg_match_info(docs))
    store("stg_match_innings", staging.stg_match_innings(docs, read_seed(spark, "default_powerplay")))
    store("stg_ipl_teams", staging.stg_ipl_teams(src.ipl_teams))
    store("stg_players_info", staging.stg_players_info(src.players_info))
    store("stg_stadium_coordinates", staging.stg_stadium_coordinates(src.stadium_coordinates))
    store("stg_weather_info", staging.stg_weather_info(src.weather_info))

    store("int_match_info", intermediate.int_match_info(m["stg_match_info"]))
    store("int_match_innings", intermediate.int_match_innings(m["stg_match_innings"], m["int_match_info"]))
    store("int_teams", intermediate.int_teams(docs, m["stg_ipl_teams"]))
    store("int_stadiums_info", intermediate.int_stadiums_info(m["stg_match_info"], m["stg_stadium_coordinates"]))
    store("int_weather_info", intermediate.int_weather_info(m["stg_weather_info"]))

    store("points_table", marts.points_table(m["int_match_info"], m["int_teams"]))
    store("ipl_schedule", marts.ipl_schedule(m["int_match_info"], m["int_stadiums_info"], m["int_weather_info"]))
    # the two views of the model set
    m["innings_summary"] = marts.innings_summary(m["int_match_innings"], m["int_match_info"])
    m["match_ids"] = marts.match_ids(m["int_match_info"], season)
    if register_views:
        for name in ("innings_summary", "match_ids"):
            m[name] = materialize_view(m[name], name)
    return m
