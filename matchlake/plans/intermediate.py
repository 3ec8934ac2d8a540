"""Intermediate models: ids, per-day slots, venue ids, joins of staging tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.functions import split_first
from matchlake.operators import attach_dense_id, broadcast_if_small, sequence_within
from matchlake import constants as C

MATCH_INFO_EXTRA = ["match_id", "matches_per_day", "flag_playoffs", "match_order",
                    "city_cleaned", "venue_cleaned", "match_time", "venue_id"]


def clean_city(city: str = "city", venue: str = "venue"):
    """City, else the first word of the venue."""
    return F.coalesce(F.col(city), split_first(venue, " "))


def clean_venue(venue: str = "venue"):
    """Venue up to the first comma."""
    return F.coalesce(split_first(venue, ","), F.col(venue))


def day_slots(df: DataFrame, day: str = "match_date", number: str = "match_number",
              tiebreak: str = "filename", num_partitions: int | None = None) -> DataFrame:
    """Adds ``matches_per_day``, ``match_order`` and ``match_time``.

    ``match_order`` is the skew-safe row number by ``number`` (text order,
    NULL first) then ``tiebreak``, and ``matches_per_day`` comes from the same
    pass (per-partition counts summed per day), so a crowded day never lands
    in one task and the input is read once.  One match a day starts at 19:30; of two, the first at
    15:30 and the second at 19:30; three or more all at 19:30.
    """
    ordered = sequence_within(df, [day], [number, tiebreak], "match_order", num_partitions,
                              size_col="matches_per_day")
    n, k = F.col("matches_per_day"), F.col("match_order")
    slot = (F.when(n == 1, C.SLOT_SINGLE)
             .when((n == 2) & (k == 1), C.SLOT_FIRST_OF_TWO)
             .when((n == 2) & (k == 2), C.SLOT_SECOND_OF_TWO)
             .otherwise(C.SLOT_OTHER))
    return ordered.withColumn("match_time", slot)


def int_match_info(stg_match_info: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Match header plus id, day slot, cleaned place names and dense venue id (26 columns)."""
    base_cols = stg_match_info.columns
    base = (stg_match_info
            .withColumn("match_id", split_first("filename", "."))
            .withColumn("flag_playoffs", F.when(F.col("match_number").isNull(), C.FLAG_PLAYOFFS)
                                          .otherwise(C.FLAG_LEAGUE))
            .withColumn("city_cleaned", clean_city())
            .withColumn("venue_cleaned", clean_venue()))
    slotted = day_slots(base, num_partitions=num_partitions)
    with_id = attach_dense_id(slotted, "venue_cleaned", "venue_id", null_safe=False,
                              num_partitions=num_partitions)
    return with_id.select(*base_cols, *MATCH_INFO_EXTRA)


def int_match_innings(stg_match_innings: DataFrame, int_match_info: DataFrame) -> DataFrame:
    """Deliveries with the match's season and id (left join on the file's base name)."""
    cols = stg_match_innings.columns
    m = int_match_info.select(F.col("match_id").alias("__mid"), "season", "match_id")
    d = stg_match_innings.withColumn("__key", split_first("file_name", "."))
    return (d.join(broadcast_if_small(m), F.col("__key") == F.col("__mid"), "left")
             .select(*cols, "season", "match_id"))


def int_teams(stg_cricket_match: DataFrame, stg_ipl_teams: DataFrame) -> DataFrame:
    """Distinct (team name, team type) from the documents, with the team's id
    and image; a name listed twice in the team table fans out."""
    from matchlake.functions import scalar_text
    from matchlake.plans.staging import parsed_documents

    d = parsed_documents(stg_cricket_match)
    names = (d.select(F.explode("doc.info.teams").alias("team_name"),
                      scalar_text("doc.info.team_type").alias("team_type"))
              .withColumn("team_name", scalar_text("team_name")).distinct())
    return attach_team_ids(names, stg_ipl_teams)


def attach_team_ids(names: DataFrame, stg_ipl_teams: DataFrame) -> DataFrame:
    """Left join (team_name, team_type) rows to the team table on the name."""
    teams = stg_ipl_teams.select(F.col("team").alias("__team"), "team_id", "image_url")
    return (names.join(broadcast_if_small(teams), F.col("team_name") == F.col("__team"), "left")
                 .select("team_name", "team_type", "team_id", "image_url"))


def int_stadiums_info(stg_match_info: DataFrame, stg_stadium_coordinates: DataFrame,
                      num_partitions: int | None = None) -> DataFrame:
    """Distinct (venue id, city, venue) with coordinates; venues without
    coordinates drop out, a venue under two cities gives two rows.

    The venue id is the dense rank of the cleaned venue over all rows, which
    is the dense rank over the distinct names: computed on the distinct set,
    and NULL-safe so that a NULL venue still gets its rank.
    """
    places = (stg_match_info
              .select(clean_city().alias("city_cleaned"), clean_venue().alias("venue_cleaned"),
                      "venue")
              .select(F.coalesce("venue_cleaned", "venue").alias("__vkey"),
                      "city_cleaned", "venue_cleaned")
              .distinct())
    ids = attach_dense_id(places, "__vkey", "venue_id", null_safe=True, num_partitions=num_partitions)
    unique = ids.select("venue_id", "city_cleaned", "venue_cleaned")
    coords = stg_stadium_coordinates.select("venue_id", "latitude", "longitude")
    return (unique.join(broadcast_if_small(coords), "venue_id", "inner")
                  .select("venue_id", "city_cleaned", "venue_cleaned", "latitude", "longitude")
                  .orderBy("venue_id"))


def int_weather_info(stg_weather_info: DataFrame) -> DataFrame:
    return stg_weather_info.select(
        "season", "match_id", "datetime", "temp_c", "humidity_percent", "pressure_hpa",
        "cloudcover_percent", "rain_mm", "wind_m_s")
