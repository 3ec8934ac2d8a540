"""Declared schemas: nothing in the library infers a schema at read time.

Table and column names, their order and types are fixed values: results depend on them.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D = T.StringType(), T.LongType(), T.DoubleType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw document table: one row per landed JSON file.
RAW_DOCUMENTS = T.StructType([
    T.StructField("file_name", S, False),
    T.StructField("content", S, False),
    T.StructField("file_upload_timestamp", T.TimestampType(), False),
])

# Quarantined documents: the same columns, and a file may hold nothing readable.
QUARANTINE_DOCUMENTS = T.StructType([
    T.StructField("file_name", S, False),
    T.StructField("content", S, True),
    T.StructField("file_upload_timestamp", T.TimestampType(), False),
])

# Match document.  Every leaf is STRING on purpose: a number written as text
# ("1") then casts like the warehouse does, where a typed leaf would turn it
# into NULL.  Only the paths the models read are declared, so the parser
# materialises nothing else.
DELIVERY = _struct(
    ("batter", S), ("bowler", S), ("non_striker", S),
    ("runs", _struct(("batter", S), ("extras", S), ("total", S))),
    ("extras", T.MapType(S, S)),
    ("wickets", T.ArrayType(_struct(("kind", S), ("player_out", S)))),
)
OVER = _struct(("over", S), ("deliveries", T.ArrayType(DELIVERY)))
INNINGS = _struct(
    ("team", S),
    ("powerplays", T.ArrayType(_struct(("from", S), ("to", S)))),
    ("overs", T.ArrayType(OVER)),
)
MATCH_INFO = _struct(
    ("match_type", S), ("gender", S), ("season", S), ("city", S), ("venue", S),
    ("team_type", S),
    ("dates", T.ArrayType(S)), ("teams", T.ArrayType(S)), ("player_of_match", T.ArrayType(S)),
    ("event", _struct(("name", S), ("match_number", S), ("stage", S))),
    ("toss", _struct(("winner", S), ("decision", S))),
    ("outcome", _struct(("winner", S), ("by", _struct(("wickets", S), ("runs", S))))),
)
MATCH_DOCUMENT = _struct(("info", MATCH_INFO), ("innings", T.ArrayType(INNINGS)))

# Dimensions and seeds.
IPL_TEAMS = _struct(("team_id", L), ("team", S), ("image_url", S))
PLAYERS_INFO = _struct(
    ("player_name", S), ("category", S), ("type", S), ("age", T.IntegerType()),
    ("batting_style", S), ("bowling_style", S), ("team", S), ("player_url", S), ("player_img", S),
)
STADIUM_COORDINATES = _struct(
    ("venue_id", L), ("city_cleaned", S), ("venue_cleaned", S), ("latitude", D), ("longitude", D),
)
DEFAULT_POWERPLAY = _struct(("match_type", S), ("start_over", L), ("end_over", L))
PLAYOFFS_CODE = _struct(("playoff_code", L), ("match", S))

# Schedule CSV (dates DD/MM/YYYY, times HH:MM) and the enriched weather table.
SCHEDULE_COLUMNS = [
    "season", "match_id", "city", "match_num", "venue", "match_date", "match_time",
    "team1", "team2", "venue_id", "latitude", "longitude",
]
WEATHER_COLUMNS = [
    "datetime", "temp_C", "humidity_%", "pressure_hPa", "cloudcover_%", "rain_mm", "wind_m_s",
]
SCHEDULE = _struct(
    ("season", S), ("match_id", S), ("city", S), ("match_num", S), ("venue", S),
    ("match_date", S), ("match_time", S), ("team1", S), ("team2", S),
    ("venue_id", L), ("latitude", D), ("longitude", D),
)
WEATHER_INFO = T.StructType(
    SCHEDULE.fields
    + [T.StructField("datetime", S, True)]
    + [T.StructField(c, D, True) for c in WEATHER_COLUMNS[1:]]
    + [T.StructField("total_views", L, True)]
)

# Hourly weather archive: one row per (place, day) with parallel hourly arrays,
# the shape of the archive service's payload.
HOURLY_VARIABLES = [
    "temperature_2m", "relativehumidity_2m", "pressure_msl", "cloudcover", "rain", "wind_speed_10m",
]
HOURLY_ARCHIVE = T.StructType(
    [T.StructField("latitude", D), T.StructField("longitude", D), T.StructField("date", T.DateType()),
     T.StructField("time", T.ArrayType(S))]
    + [T.StructField(v, T.ArrayType(D)) for v in HOURLY_VARIABLES]
)

# Practice shop tables.
SHOP_CUSTOMERS = _struct(("id", L), ("first_name", S), ("last_name", S))
SHOP_ORDERS = _struct(("id", L), ("user_id", L), ("order_date", T.DateType()), ("status", S))
