"""Queries over the intermediate models and the row-level functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.functions import flag_from_predicate, hour_iso, margin_label, parse_dmy_hm, split_first
from matchlake.operators import anti_new, attach_dense_id, broadcast_if_small
from matchlake.plans import intermediate, marts, staging
from matchlake.sources import read_seed
from matchlake.plans.catalogue.registry import query, table


# --------------------------------------------------------------------------- M8 W1 W2
def order_match_info(spark: SparkSession, d: str) -> DataFrame:
    """Orders as the 18-column match header; the order key
    modulo 20 plays the match number (0 = a playoff without number)."""
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    j = (o.join(broadcast_if_small(c), o["o_custkey"] == c["c_custkey"], "inner")
          .join(broadcast_if_small(n), F.col("c_nationkey") == F.col("n_nationkey"), "inner"))
    num = F.col("o_orderkey") % 20
    return j.select(
        F.lit("T20").alias("match_type"),
        F.lit("male").alias("gender"),
        F.year("o_orderdate").cast("string").alias("season"),
        F.when(F.col("c_nationkey") % 5 != 0, F.col("n_name")).alias("city"),
        F.concat(F.col("c_mktsegment"), F.lit(" Park, "), F.col("n_name")).alias("venue"),
        F.when(num != 0, num.cast("string")).alias("match_number"),
        F.when(num == 0, "Final").alias("playoff_stage"),
        F.col("o_orderdate").cast("date").alias("match_date"),
        F.col("c_mktsegment").alias("team1"),
        F.col("o_orderpriority").alias("team2"),
        F.col("c_mktsegment").alias("toss_winner"),
        F.lit("bat").alias("toss_decision"),
        F.col("c_mktsegment").alias("match_winner"),
        F.lit("10 runs").alias("margin"),
        F.lit("League").alias("event_name"),
        F.lit("club").alias("event_type"),
        F.col("c_name").alias("pom"),
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".json")).alias("filename"),
    )


@query("day_slot_assignment", """
WITH game AS (
  SELECT *, o_orderdate::DATE AS day, o_orderkey || '.json' AS file,
         nullif(o_orderkey % 20, 0)::VARCHAR AS num, c_mktsegment || ' Park' AS ground
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
card AS (SELECT day, list(file ORDER BY num NULLS FIRST, file) AS files FROM game GROUP BY day),
place AS (SELECT list_sort(list(DISTINCT ground)) AS grounds FROM game)
SELECT 'T20' AS match_type, 'male' AS gender, year(day)::VARCHAR AS season, if(c_nationkey % 5 = 0, NULL, n_name) AS city,
       ground || ', ' || n_name AS venue, num AS match_number, if(num IS NULL, 'Final', NULL) AS playoff_stage,
       day AS match_date, c_mktsegment AS team1, o_orderpriority AS team2, c_mktsegment AS toss_winner, 'bat' AS toss_decision,
       c_mktsegment AS match_winner, '10 runs' AS margin, 'League' AS event_name, 'club' AS event_type, c_name AS pom,
       file AS filename, o_orderkey::VARCHAR AS match_id, len(files) AS matches_per_day,
       if(num IS NULL, 'playoffs', 'league match') AS flag_playoffs, list_position(files, file)::INT AS match_order,
       if(c_nationkey % 5 = 0, c_mktsegment, n_name) AS city_cleaned, ground AS venue_cleaned,
       if(len(files) = 2 AND file = files[1], '15:30', '19:30') AS match_time,
       list_position(grounds, ground)::BIGINT AS venue_id
FROM game JOIN card USING (day), place
""")
def day_slot_assignment(spark: SparkSession, d: str) -> DataFrame:
    return intermediate.int_match_info(order_match_info(spark, d))


# --------------------------------------------------------------------------- W3 J4 A8 F2
@query("venue_dense_id", """
WITH m AS (
  SELECT venue_cleaned, CAST(dense_rank() OVER (ORDER BY venue_cleaned ASC NULLS FIRST) AS BIGINT) AS venue_id
  FROM (SELECT DISTINCT split_part(p_name, ' ', 1) AS venue_cleaned FROM part) v)
SELECT p.p_partkey, split_part(p.p_name, ' ', 1) AS venue_cleaned, m.venue_id
FROM part p LEFT JOIN m ON split_part(p.p_name, ' ', 1) = m.venue_cleaned
""")
def venue_dense_id(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", split_first("p_name", " ").alias("venue_cleaned"))
    return attach_dense_id(p, "venue_cleaned", "venue_id").select("p_partkey", "venue_cleaned", "venue_id")


# --------------------------------------------------------------------------- W4 M11 J6
def part_places(spark: SparkSession, d: str) -> DataFrame:
    """Parts as match headers with a place: city = brand (missing for the
    largest sizes), venue = '<name>, <type>' (missing for size 1)."""
    return table(spark, d, "part").select(
        F.when(F.col("p_size") <= 45, F.col("p_brand")).alias("city"),
        F.when(F.col("p_size") != 1, F.concat_ws(", ", "p_name", "p_type")).alias("venue"))


def nation_coordinates(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    return staging.stg_stadium_coordinates(n.select(
        (F.col("n_nationkey") + 1).cast("bigint").alias("venue_id"),
        F.col("n_name").alias("city_cleaned"), F.col("n_name").alias("venue_cleaned"),
        (F.col("n_regionkey") * 10 + 0.5).cast("double").alias("latitude"),
        (F.col("n_nationkey") * 1.5).cast("double").alias("longitude")))


@query("venue_lookup", """
WITH named AS (
  SELECT if(p_size = 1, NULL, split_part(p_name, ',', 1)) AS name,
         coalesce(if(p_size <= 45, p_brand, NULL), if(p_size = 1, NULL, split_part(p_name || ',', ' ', 1))) AS town
  FROM part),
numbered AS (
  SELECT name, row_number() OVER (ORDER BY name NULLS FIRST) AS id FROM (SELECT DISTINCT name FROM named))
SELECT DISTINCT id::BIGINT AS venue_id, town AS city_cleaned, named.name AS venue_cleaned,
       (n_regionkey * 10 + 0.5)::DOUBLE AS latitude, (n_nationkey * 1.5)::DOUBLE AS longitude
FROM nation JOIN numbered ON id = n_nationkey + 1 JOIN named ON named.name IS NOT DISTINCT FROM numbered.name
""")
def venue_lookup(spark: SparkSession, d: str) -> DataFrame:
    return intermediate.int_stadiums_info(part_places(spark, d), nation_coordinates(spark, d))


# --------------------------------------------------------------------------- M15 A5 J7
@query("schedule_enriched", """
SELECT year(o_orderdate)::VARCHAR AS season, o_orderkey AS match_id, c_mktsegment AS city,
       if(o_totalprice >= 490000, 'Final', o_orderkey::VARCHAR) AS match_num, c_mktsegment AS venue,
       o_orderdate::DATE AS match_date, '19:30' AS match_time, c_mktsegment AS team1, o_orderpriority AS team2,
       c_nationkey::BIGINT AS venue_id, lat AS latitude, -far AS longitude, e.*
FROM orders
JOIN (SELECT *, min(c_acctbal) OVER here AS lat, max(c_acctbal) OVER here AS far FROM customer
      WINDOW here AS (PARTITION BY c_nationkey)) ON c_custkey = o_custkey,
LATERAL (SELECT max(value) AS temp_c, min(value) AS humidity_percent, count(*)::DOUBLE AS pressure_hpa,
                max((props ->> '$.k')::DOUBLE) AS cloudcover_percent, NULL::DOUBLE AS rain_mm,
                min((props ->> '$.k')::DOUBLE) AS wind_m_s
         FROM events WHERE user_id = o_orderkey HAVING count(*) > 0) e
""")
def schedule_enriched(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    final = F.col("o_totalprice") >= 490000
    info = o.join(broadcast_if_small(c.select("c_custkey", "c_mktsegment", "c_nationkey")),
                  o["o_custkey"] == c["c_custkey"], "inner").select(
        F.year("o_orderdate").cast("string").alias("season"),
        F.col("o_orderkey").alias("match_id"),
        F.col("c_mktsegment").alias("city_cleaned"),
        F.when(~final, F.col("o_orderkey").cast("string")).alias("match_number"),
        F.when(final, "Final").alias("playoff_stage"),
        F.col("c_mktsegment").alias("venue_cleaned"),
        F.col("o_orderdate").cast("date").alias("match_date"),
        F.lit("19:30").alias("match_time"),
        F.col("c_mktsegment").alias("team1"),
        F.col("o_orderpriority").alias("team2"),
        F.col("c_nationkey").cast("bigint").alias("venue_id"))
    stadiums = c.select(F.col("c_nationkey").cast("bigint").alias("venue_id"),
                        F.col("c_acctbal").alias("latitude"), (-F.col("c_acctbal")).alias("longitude"))
    k = F.get_json_object("props", "$.k").cast("double")
    weather = table(spark, d, "events", row_heavy=True).groupBy("user_id").agg(
        F.max("value").alias("temp_c"), F.min("value").alias("humidity_percent"),
        F.count(F.lit(1)).cast("double").alias("pressure_hpa"), F.max(k).alias("cloudcover_percent"),
        F.lit(None).cast("double").alias("rain_mm"), F.min(k).alias("wind_m_s"),
    ).withColumnRenamed("user_id", "match_id")
    return marts.ipl_schedule(info, stadiums, weather)


# --------------------------------------------------------------------------- M16 P5 O2
@query("season_listing", """
SELECT CAST(year(o_orderdate) AS VARCHAR) AS season, CAST(o_orderkey AS VARCHAR) AS match_id,
       CAST(o_orderdate AS DATE) AS match_date, CAST(o_orderkey % 97 AS VARCHAR) AS match_number,
       o_orderpriority AS team1, o_orderstatus AS team2
FROM orders WHERE CAST(year(o_orderdate) AS VARCHAR) = '1996'
""")
def season_listing(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(
        F.year("o_orderdate").cast("string").alias("season"),
        F.col("o_orderkey").cast("string").alias("match_id"),
        F.col("o_orderdate").cast("date").alias("match_date"),
        (F.col("o_orderkey") % 97).cast("string").alias("match_number"),
        F.col("o_orderpriority").alias("team1"), F.col("o_orderstatus").alias("team2"))
    return marts.match_ids(o, season="1996")


# --------------------------------------------------------------------------- M10 J5 A7
@query("team_dimension", """
WITH names AS (
  SELECT DISTINCT c.c_mktsegment AS team_name, o.o_orderstatus AS team_type
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
t AS (
  SELECT DISTINCT c_mktsegment AS team, CAST(c_nationkey AS BIGINT) AS team_id,
         'img/' || lower(c_mktsegment) AS image_url
  FROM customer)
SELECT n.team_name, n.team_type, t.team_id, t.image_url
FROM names n LEFT JOIN t ON t.team = n.team_name
""")
def team_dimension(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    names = (o.join(broadcast_if_small(c.select("c_custkey", "c_mktsegment")),
                    o["o_custkey"] == c["c_custkey"], "inner")
              .select(F.col("c_mktsegment").alias("team_name"), F.col("o_orderstatus").alias("team_type"))
              .distinct())
    teams = staging.stg_ipl_teams(
        c.select(F.col("c_nationkey").cast("bigint").alias("team_id"), F.col("c_mktsegment").alias("team"),
                 F.concat(F.lit("img/"), F.lower("c_mktsegment")).alias("image_url"))
         .distinct())
    return intermediate.attach_team_ids(names, teams)


# --------------------------------------------------------------------------- F1 J3 M9
@query("split_file_id", """
SELECT if(l_linenumber = 7, -l_orderkey, l_orderkey) || '.json' AS file_name, l_linenumber::BIGINT AS inning_id,
       l_quantity::BIGINT AS runs_batter, year(o_orderdate)::VARCHAR AS season, o_orderkey::VARCHAR AS match_id
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND l_linenumber <> 7
""")
def split_file_id(spark: SparkSession, d: str) -> DataFrame:
    deliveries = table(spark, d, "lineitem").select(
        # every seventh line is of a file without a header
        F.concat(F.when(F.col("l_linenumber") == 7, -F.col("l_orderkey")).otherwise(F.col("l_orderkey")).cast("string"),
                 F.lit(".json")).alias("file_name"),
        F.col("l_linenumber").cast("bigint").alias("inning_id"),
        F.col("l_quantity").cast("bigint").alias("runs_batter"))
    info = (table(spark, d, "orders")
            .select(F.year("o_orderdate").cast("string").alias("season"),
                    F.col("o_orderkey").cast("string").alias("match_id")))
    return intermediate.int_match_innings(deliveries, info)


# --------------------------------------------------------------------------- M5 F3 O1
@query("last_name_extract", r"""
WITH p AS (
  SELECT p_name AS player_name, 'part' AS category, p_type AS type, p_size AS age,
         p_brand AS batting_style, CAST(NULL AS VARCHAR) AS bowling_style, p_brand AS team,
         CAST(NULL AS VARCHAR) AS player_url, CAST(NULL AS VARCHAR) AS player_img
  FROM part
  UNION ALL
  SELECT c_name, 'customer', c_mktsegment, c_nationkey, CAST(NULL AS VARCHAR), c_mktsegment, c_mktsegment,
         CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)
  FROM customer)
SELECT *, CASE WHEN regexp_matches(player_name, '^[^ ]+\s+(.*)$')
               THEN regexp_extract(player_name, '^[^ ]+\s+(.*)$', 1) END AS last_name
FROM p
""")
def last_name_extract(spark: SparkSession, d: str) -> DataFrame:
    none = F.lit(None).cast("string")
    p = table(spark, d, "part").select(
        F.col("p_name").alias("player_name"), F.lit("part").alias("category"), F.col("p_type").alias("type"),
        F.col("p_size").alias("age"), F.col("p_brand").alias("batting_style"), none.alias("bowling_style"),
        F.col("p_brand").alias("team"), none.alias("player_url"), none.alias("player_img"))
    c = table(spark, d, "customer").select(
        F.col("c_name").alias("player_name"), F.lit("customer").alias("category"),
        F.col("c_mktsegment").alias("type"), F.col("c_nationkey").alias("age"), none.alias("batting_style"),
        F.col("c_mktsegment").alias("bowling_style"), F.col("c_mktsegment").alias("team"),
        none.alias("player_url"), none.alias("player_img"))
    return staging.stg_players_info(p.unionByName(c))


# --------------------------------------------------------------------------- F4 P8 P11
@query("margin_label", """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey % 10 AS VARCHAR) || ' wickets'
            WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey % 100 AS VARCHAR) || ' runs'
            ELSE 'no result' END AS margin
FROM orders
""")
def margin_label_q(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    wickets = F.when(F.col("o_orderstatus") == "F", (F.col("o_custkey") % 10).cast("string"))
    runs = F.when(F.col("o_orderstatus") != "P", (F.col("o_orderkey") % 100).cast("string"))
    return o.select("o_orderkey", margin_label(wickets, runs).alias("margin"))


# --------------------------------------------------------------------------- J2 F6 F7 P10
@query("default_fill", """
WITH l AS (
  SELECT l_orderkey, l_linenumber,
         CASE l_returnflag WHEN 'A' THEN 'T20' WHEN 'N' THEN 'ODI' ELSE 'Test' END AS match_type,
         CASE WHEN l_linestatus = 'F' AND l_returnflag = 'A' THEN '0.' || CAST(l_linenumber AS VARCHAR) END AS pp_from,
         CASE WHEN l_linestatus = 'F' AND l_returnflag = 'A' THEN CAST(l_linenumber + 3 AS VARCHAR) || '.6' END AS pp_to,
         CAST(l_quantity AS BIGINT) % 12 + 1 AS over_number
  FROM lineitem),
b AS (
  SELECT l.*, COALESCE(CEIL(CAST(pp_from AS DOUBLE)), CAST(dp.start_over AS DOUBLE)) AS powerplays_start_over,
         COALESCE(CEIL(CAST(pp_to AS DOUBLE)), CAST(dp.end_over AS DOUBLE)) AS powerplays_end_over
  FROM l LEFT JOIN (VALUES ('T20', 1, 6), ('ODI', 1, 10)) AS dp(match_type, start_over, end_over)
    ON l.match_type = dp.match_type)
SELECT l_orderkey, l_linenumber, match_type, over_number, powerplays_start_over, powerplays_end_over,
       CAST(CASE WHEN over_number BETWEEN powerplays_start_over AND powerplays_end_over THEN 1 ELSE 0 END AS BIGINT) AS is_powerplay
FROM b
""")
def default_fill(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    given = (F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "A")
    rows = li.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "A", "T20").when(F.col("l_returnflag") == "N", "ODI")
         .otherwise("Test").alias("match_type"),
        F.when(given, F.concat(F.lit("0."), F.col("l_linenumber").cast("string"))).alias("pp_from"),
        F.when(given, F.concat((F.col("l_linenumber") + 3).cast("string"), F.lit(".6"))).alias("pp_to"),
        (F.col("l_quantity").cast("bigint") % 12 + 1).alias("over_number"))
    out = staging.with_powerplay(rows, read_seed(spark, "default_powerplay"))
    return out.select("l_orderkey", "l_linenumber", "match_type", "over_number",
                      "powerplays_start_over", "powerplays_end_over", "is_powerplay")


# --------------------------------------------------------------------------- P4 P9 A3
@query("legal_ball_counts", """
WITH b AS (
  SELECT l_suppkey,
         CASE WHEN l_linestatus = 'O' THEN CASE l_returnflag WHEN 'A' THEN 'wides' WHEN 'N' THEN 'noballs' END END AS extra_type
  FROM lineitem)
SELECT l_suppkey, COUNT(*) AS balls_faced,
       CAST(SUM(CASE WHEN extra_type IN ('wides', 'noballs') THEN 0 ELSE 1 END) AS BIGINT) AS legal_balls
FROM b GROUP BY l_suppkey
""")
def legal_ball_counts(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    extra = F.when(F.col("l_linestatus") == "O",
                   F.when(F.col("l_returnflag") == "A", "wides").when(F.col("l_returnflag") == "N", "noballs"))
    b = li.select("l_suppkey", F.lit(1).alias("balls_faced"), extra.alias("extra_type")) \
        .withColumn("legal_ball", marts.legal_ball("extra_type"))
    return b.groupBy("l_suppkey").agg(F.sum("balls_faced").cast("bigint").alias("balls_faced"),
                                      F.sum("legal_ball").cast("bigint").alias("legal_balls"))


# --------------------------------------------------------------------------- M4 M6 M7 P1 P2 P3 F11
@query("projection_rename", """
SELECT CAST(year(ts) AS VARCHAR) AS season, CAST(event_id AS VARCHAR) AS match_id, event_type AS city,
       CAST(user_id AS VARCHAR) AS match_num, event_type AS venue, CAST(CAST(ts AS DATE) AS VARCHAR) AS match_date,
       strftime(ts, '%H:%M') AS match_time, event_type AS team1, CAST(NULL AS VARCHAR) AS team2,
       user_id AS venue_id, value AS latitude, -value AS longitude, strftime(ts, '%Y-%m-%dT%H:00') AS datetime,
       value AS temp_c, value / 2 AS humidity_percent, value AS pressure_hpa, value * 2 AS cloudcover_percent,
       CAST(NULL AS DOUBLE) AS rain_mm, value AS wind_m_s, user_id AS total_views
FROM events
""")
def projection_rename(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    weather = e.select(
        F.year("ts").cast("string").alias("season"), F.col("event_id").alias("match_id"),
        F.col("event_type").alias("city"), F.col("user_id").cast("string").alias("match_num"),
        F.col("event_type").alias("venue"), F.col("ts").cast("date").cast("string").alias("match_date"),
        F.date_format("ts", "HH:mm").alias("match_time"), F.col("event_type").alias("team1"),
        F.lit(None).cast("string").alias("team2"), F.col("user_id").alias("venue_id"),
        F.col("value").alias("latitude"), (-F.col("value")).alias("longitude"),
        hour_iso("ts").alias("datetime"), F.col("value").alias("temp_C"),
        (F.col("value") / 2).alias("humidity_%"), F.col("value").alias("pressure_hPa"),
        (F.col("value") * 2).alias("cloudcover_%"), F.lit(None).cast("double").alias("rain_mm"),
        F.col("value").alias("wind_m_s"), F.col("user_id").alias("total_views"))
    return staging.stg_weather_info(weather)


# --------------------------------------------------------------------------- M12
@query("weather_measures", """
SELECT year(ts)::VARCHAR AS season, event_id::VARCHAR AS match_id, strftime(ts, '%Y-%m-%dT%H:00') AS datetime, value AS temp_c,
       value / 2 AS humidity_percent, value AS pressure_hpa, value * 2 AS cloudcover_percent, NULL::DOUBLE AS rain_mm, value AS wind_m_s
FROM events
""")
def weather_measures(spark: SparkSession, d: str) -> DataFrame:
    return intermediate.int_weather_info(projection_rename(spark, d))


# --------------------------------------------------------------------------- F5 F16 F17
@query("text_flags", """
SELECT c_custkey, lower(c_mktsegment) AS segment, COALESCE(lower(c_mktsegment) = 'building', false) AS is_building,
       regexp_replace(c_name, '^Customer#0*', '') AS name_number
FROM customer
""")
def text_flags(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return c.select("c_custkey", F.lower("c_mktsegment").alias("segment"),
                    flag_from_predicate(F.lower("c_mktsegment") == "building").alias("is_building"),
                    F.regexp_replace("c_name", "^Customer#0*", "").alias("name_number"))


# --------------------------------------------------------------------------- A6 A9
@query("season_counts", """
SELECT CAST(year(o_orderdate) AS VARCHAR) AS season, COUNT(*) AS n_orders,
       CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n_fulfilled
FROM orders GROUP BY 1
""")
def season_counts(spark: SparkSession, d: str) -> DataFrame:
    return (table(spark, d, "orders").select(F.year("o_orderdate").cast("string").alias("season"), "o_orderstatus")
            .groupBy("season")
            .agg(F.count(F.lit(1)).alias("n_orders"), F.count_if(F.col("o_orderstatus") == "F").alias("n_fulfilled")))


# --------------------------------------------------------------------------- F12 P7 F14 F13
AS_OF = "1997-06-30 12:00:00"


@query("parse_and_cutoff", f"""
WITH t AS (
  SELECT o_orderkey,
         o_orderdate + CASE WHEN o_orderpriority = '1-URGENT' THEN INTERVAL '9 hours 30 minutes'
                            ELSE INTERVAL '19 hours 30 minutes' END AS match_dt
  FROM orders)
SELECT o_orderkey, match_dt, CAST(match_dt AS DATE) AS match_day, strftime(match_dt, '%Y-%m-%dT%H:00') AS match_hour
FROM t WHERE match_dt <= TIMESTAMP '{AS_OF}'
""")
def parse_and_cutoff(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    date_text = F.concat_ws("/", F.dayofmonth("o_orderdate").cast("string"),
                            F.month("o_orderdate").cast("string"), F.year("o_orderdate").cast("string"))
    time_text = F.when(F.col("o_orderpriority") == "1-URGENT", "9:30").otherwise("19:30")
    t = o.select("o_orderkey", parse_dmy_hm(date_text, time_text).alias("match_dt"))
    return (t.where(F.col("match_dt") <= F.lit(AS_OF).cast("timestamp_ntz"))
             .select("o_orderkey", "match_dt", F.to_date("match_dt").alias("match_day"),
                     hour_iso("match_dt").alias("match_hour")))


# --------------------------------------------------------------------------- U2 P13
UNION_COLUMNS = ["match_id", "o_custkey", "o_orderpriority", "o_totalprice"]


@query("union_old_new", """
SELECT o_orderkey AS match_id, o_custkey, CAST(NULL AS VARCHAR) AS o_orderpriority, o_totalprice
FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey AS match_id, CAST(NULL AS BIGINT) AS o_custkey, o_orderpriority, o_totalprice
FROM orders WHERE o_orderstatus <> 'F'
""")
def union_old_new(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    old = o.where(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("match_id"), "o_custkey", "o_totalprice")
    new = o.where(F.col("o_orderstatus") != "F").select(
        "o_totalprice", "o_orderpriority", F.col("o_orderkey").alias("match_id"))
    return old.unionByName(new, allowMissingColumns=True).select(*UNION_COLUMNS)


# --------------------------------------------------------------------------- U3
@query("set_difference_keys", """
SELECT o_orderkey FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
""")
def set_difference_keys(spark: SparkSession, d: str) -> DataFrame:
    returned = table(spark, d, "lineitem").where(F.col("l_returnflag") == "R") \
        .select(F.col("l_orderkey").alias("o_orderkey"))
    return anti_new(table(spark, d, "orders").select("o_orderkey"), returned, "o_orderkey")


# --------------------------------------------------------------------------- J1 J1b
@query("new_keys_only", """
SELECT event_id, user_id, event_type FROM events
WHERE CAST(user_id AS VARCHAR) NOT IN (
  SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def new_keys_only(spark: SparkSession, d: str) -> DataFrame:
    loaded = (table(spark, d, "customer").where(F.col("c_mktsegment") == "BUILDING")
              .select(F.col("c_custkey").cast("string").alias("key")))
    e = table(spark, d, "events").select("event_id", "user_id", "event_type",
                                         F.col("user_id").cast("string").alias("key"))
    return anti_new(e, loaded, "key").select("event_id", "user_id", "event_type")
