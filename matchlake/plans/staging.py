"""Staging models: typed, renamed views of the sources (one function each)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.functions import ceil_double, first_key, margin_label, parse_document, regexp_group, scalar_text
from matchlake.operators import explode_level
from matchlake import constants as C



def _cast(c, to: str, lenient: bool):
    return c.try_cast(to) if lenient else c.cast(to)


def stg_cricket_match(raw: DataFrame) -> DataFrame:
    """Raw documents with the content column named ``raw_file``."""
    return raw.select("file_name", F.col("content").alias("raw_file"), "file_upload_timestamp")


def parsed_documents(stg: DataFrame) -> DataFrame:
    """``(file_name, doc)``: each document parsed once with the declared schema.

    The models below accept either raw documents (``raw_file`` text) or this
    frame; the build stores it as nested Parquet so the JSON is parsed once
    and every model reads only the nested fields it uses.
    """
    if "doc" in stg.columns:
        return stg.select("file_name", "doc")
    return stg.select("file_name", parse_document("raw_file").alias("doc"))


def stg_match_info(stg: DataFrame, lenient: bool = False) -> DataFrame:
    """One row per document: the match header (18 columns).

    The document is parsed once; Catalyst prunes the parse to the fields used.
    ``margin`` reads 'no result' for any outcome without wickets or runs,
    ties included.  A bad date raises unless ``lenient``.
    """
    d = parsed_documents(stg)
    i, v = F.col("doc.info"), scalar_text
    return d.select(
        v(i["match_type"]).alias("match_type"),
        v(i["gender"]).alias("gender"),
        v(i["season"]).alias("season"),
        v(i["city"]).alias("city"),
        v(i["venue"]).alias("venue"),
        v(i["event"]["match_number"]).alias("match_number"),
        v(i["event"]["stage"]).alias("playoff_stage"),
        _cast(v(F.get(i["dates"], 0)), "date", lenient).alias("match_date"),
        v(F.get(i["teams"], 0)).alias("team1"),
        v(F.get(i["teams"], 1)).alias("team2"),
        v(i["toss"]["winner"]).alias("toss_winner"),
        v(i["toss"]["decision"]).alias("toss_decision"),
        v(i["outcome"]["winner"]).alias("match_winner"),
        margin_label(v(i["outcome"]["by"]["wickets"]), v(i["outcome"]["by"]["runs"])).alias("margin"),
        v(i["event"]["name"]).alias("event_name"),
        v(i["team_type"]).alias("event_type"),
        v(F.get(i["player_of_match"], 0)).alias("pom"),
        F.col("file_name").alias("filename"),
    )


INNINGS_COLUMNS = [
    "file_name", "inning_id", "over_number", "batting_team", "ball_in_over", "batter", "bowler",
    "non_striker", "runs_batter", "extra_type", "runs_extras", "runs_total", "dismissal_kind",
    "out_player", "powerplays_start_over", "powerplays_end_over", "is_powerplay",
]


def stg_match_innings(stg: DataFrame, default_powerplay: DataFrame, lenient: bool = False) -> DataFrame:
    """One row per delivery: innings → overs → deliveries, positions 1-based.

    Powerplay bounds come from the document's first powerplay (rounded up),
    else from the seed for the match type, else NULL (then not a powerplay).
    Only the first wicket of a ball counts; the extra type is the
    alphabetically first key of ``extras``.  The seed is a fixed file of a few
    rows, so broadcasting it is always safe.
    """
    d = parsed_documents(stg)
    # Each level keeps only the parent fields used later, so a delivery row
    # never carries its whole innings or over (which would grow with the
    # square of the innings length).
    v = scalar_text
    inn = explode_level(d, "doc.innings", "inning_idx", "f0",
                        ["file_name", v(F.col("doc.info.match_type")).alias("match_type")])
    pp = F.get(F.col("f0.powerplays"), 0)
    inn = inn.select("file_name", "match_type", "inning_idx", v(F.col("f0.team")).alias("batting_team"),
                     v(pp["from"]).alias("pp_from"), v(pp["to"]).alias("pp_to"), F.col("f0.overs").alias("overs"))
    parent = ["file_name", "match_type", "inning_idx", "batting_team", "pp_from", "pp_to"]
    ovs = explode_level(inn, "overs", "over_idx", "ov", parent)
    ovs = ovs.select(*parent, v(F.col("ov.over")).alias("over"), F.col("ov.deliveries").alias("deliveries"))
    dlv = explode_level(ovs, "deliveries", "ball_idx", "f1", [*parent, "over"])
    f1 = F.col("f1")
    rows = dlv.select(
        "file_name", "match_type",
        (F.col("inning_idx") + 1).cast("bigint").alias("inning_id"),
        (_cast(F.col("over"), "bigint", lenient) + 1).alias("over_number"),
        "batting_team",
        (F.col("ball_idx") + 1).cast("bigint").alias("ball_in_over"),
        v(f1["batter"]).alias("batter"),
        v(f1["bowler"]).alias("bowler"),
        v(f1["non_striker"]).alias("non_striker"),
        _cast(v(f1["runs"]["batter"]), "bigint", lenient).alias("runs_batter"),
        first_key(f1["extras"]).alias("extra_type"),
        _cast(v(f1["runs"]["extras"]), "bigint", lenient).alias("runs_extras"),
        _cast(v(f1["runs"]["total"]), "bigint", lenient).alias("runs_total"),
        v(F.get(f1["wickets"], 0)["kind"]).alias("dismissal_kind"),
        v(F.get(f1["wickets"], 0)["player_out"]).alias("out_player"),
        "pp_from", "pp_to",
    )
    return with_powerplay(rows, default_powerplay).select(*INNINGS_COLUMNS)


def with_powerplay(df: DataFrame, default_powerplay: DataFrame, match_type: str = "match_type",
                   pp_from: str = "pp_from", pp_to: str = "pp_to",
                   over_number: str = "over_number") -> DataFrame:
    """Adds ``powerplays_start_over``/``powerplays_end_over`` (DOUBLE) and
    ``is_powerplay``: the given bounds rounded up, else the seed's bounds for
    the match type, else NULL; an over is in the powerplay when it lies
    between both bounds (NULL bounds: not).  The seed holds a few fixed rows."""
    seed = F.broadcast(default_powerplay.select(
        F.col("match_type").alias("__seed_type"), "start_over", "end_over"))
    j = df.join(seed, F.col(match_type) == F.col("__seed_type"), "left")
    start = F.coalesce(ceil_double(pp_from), F.col("start_over").cast("double"))
    end = F.coalesce(ceil_double(pp_to), F.col("end_over").cast("double"))
    out = (j.withColumn("powerplays_start_over", start)
            .withColumn("powerplays_end_over", end)
            .drop("__seed_type", "start_over", "end_over"))
    in_pp = F.col(over_number).between(F.col("powerplays_start_over"), F.col("powerplays_end_over"))
    return out.withColumn("is_powerplay", F.when(in_pp, F.lit(1)).otherwise(F.lit(0)).cast("bigint"))


def stg_ipl_teams(teams: DataFrame) -> DataFrame:
    return teams.select("team_id", "team", "image_url")


def stg_players_info(players: DataFrame) -> DataFrame:
    """Players with ``last_name`` = text after the first word (NULL for one word)."""
    cols = ["player_name", "category", "type", "age", "batting_style", "bowling_style", "team",
            "player_url", "player_img"]
    return (players.select(*cols, regexp_group("player_name", C.LAST_NAME_PATTERN).alias("last_name"))
                   .orderBy("player_name"))


def stg_stadium_coordinates(coords: DataFrame) -> DataFrame:
    return (coords.select("venue_id", "city_cleaned", "venue_cleaned", "latitude", "longitude")
                  .orderBy("venue_id"))


def stg_weather_info(weather: DataFrame) -> DataFrame:
    """Weather rows with ``match_id`` as text and the ``%`` columns renamed."""
    return weather.select(
        "season", F.col("match_id").cast("string").alias("match_id"), "city", "match_num", "venue",
        "match_date", "match_time", "team1", "team2", "venue_id", "latitude", "longitude", "datetime",
        F.col("temp_C").alias("temp_c"),
        F.col("`humidity_%`").alias("humidity_percent"),
        F.col("pressure_hPa").alias("pressure_hpa"),
        F.col("`cloudcover_%`").alias("cloudcover_percent"),
        "rain_mm", "wind_m_s", "total_views",
    )
