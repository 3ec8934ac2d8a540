"""Queries over JSON documents built from the benchmark tables and read back
through the same staging functions that read landed match files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.functions import first_key, json_array, json_value_scalar
from matchlake.operators import broadcast_if_small
from matchlake.plans import intermediate, staging
from matchlake.sources import read_seed
from matchlake.plans.catalogue.registry import query, table


def _raw(file_name, content) -> list:
    return [file_name.alias("file_name"), content.alias("content"),
            F.current_timestamp().alias("file_upload_timestamp")]


# --------------------------------------------------------------------------- X1 X11 F9
@query("json_scalar", """
SELECT event_type,
       CAST(SUM(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k,
       COUNT(*) AS n_events,
       COUNT(json_extract_string(props, '$.k')) AS n_with_k
FROM events GROUP BY event_type
""")
def json_scalar(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events", row_heavy=True).select(
        "event_type", json_value_scalar("props", "$.k").cast("bigint").alias("k"))
    return e.groupBy("event_type").agg(F.sum("k").alias("sum_k"), F.count(F.lit(1)).alias("n_events"),
                                       F.count("k").alias("n_with_k"))


# --------------------------------------------------------------------------- X6 X7 X9 X10 A7
@query("json_array_unnest", """
SELECT DISTINCT unnest([o.o_orderpriority, c.c_mktsegment]) AS team_name, o.o_orderstatus AS team_type
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
""")
def json_array_unnest(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders", row_heavy=True)
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    docs = o.join(broadcast_if_small(c), o["o_custkey"] == c["c_custkey"], "inner").select(
        F.to_json(F.struct(F.array("o_orderpriority", "c_mktsegment").alias("teams"),
                           F.col("o_orderstatus").alias("team_type"))).alias("doc"))
    return (docs.select(F.explode(json_array("doc", "$.teams")).alias("team_name"),
                        json_value_scalar("doc", "$.team_type").alias("team_type"))
                .distinct())


# --------------------------------------------------------------------------- M3 M9 X8 J9 F8
def order_documents(spark: SparkSession, d: str) -> DataFrame:
    """One match document per order: innings per return flag, overs per line
    status, deliveries per line item (positions by line number, then part,
    supplier, price, quantity).  One shuffle: the lines of an order (a
    bounded group) are collected once and nested inside the row."""
    li = table(spark, d, "lineitem", row_heavy=True)
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    is_o = F.col("l_linestatus") == "O"
    flag = F.col("l_returnflag")
    q = F.col("l_quantity").cast("bigint")
    extras = F.when(is_o, F.struct(
        F.when(flag == "N", "1").alias("noballs"),
        F.when(flag == "N", "1").alias("legbyes"),
        F.when(flag == "A", "1").alias("wides")))
    batter = F.concat(F.lit("P"), F.col("l_partkey").cast("string"))
    delivery = F.struct(
        F.col("l_linenumber").alias("seq"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"),
        F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("qty"),
        batter.alias("batter"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("bowler"),
        F.concat(F.lit("L"), F.col("l_linenumber").cast("string")).alias("non_striker"),
        F.struct(q.cast("string").alias("batter"),
                 F.when(is_o, "1").otherwise("0").alias("extras"),
                 (q + F.when(is_o, 1).otherwise(0)).cast("string").alias("total")).alias("runs"),
        extras.alias("extras"),
        F.when(flag == "R", F.array(
            F.struct(F.lit("caught").alias("kind"), batter.alias("player_out")),
            F.struct(F.lit("run out").alias("kind"),
                     F.concat(F.lit("L"), F.col("l_linenumber").cast("string")).alias("player_out"))
        )).alias("wickets"))
    lines = li.groupBy("l_orderkey").agg(F.collect_list(F.struct(
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"), delivery.alias("d")
    )).alias("lines"))

    def distinct_sorted(arr, field):
        return F.array_sort(F.array_distinct(F.transform(arr, lambda x: x[field])))

    def overs_of(flag_value):
        in_innings = F.filter("lines", lambda x: x["flag"] == flag_value)
        return F.transform(distinct_sorted(in_innings, "status"), lambda st: F.struct(
            st.alias("seq"),
            F.when(st == "F", "0").otherwise("5").alias("over"),
            F.array_sort(F.transform(F.filter(in_innings, lambda x: x["status"] == st),
                                     lambda x: x["d"])).alias("deliveries")))

    innings = F.transform(distinct_sorted("lines", "flag"), lambda fl: F.struct(
        fl.alias("seq"),
        F.concat(F.lit("team_"), fl).alias("team"),
        F.when(fl == "A", F.array(F.struct(F.lit("0.1").alias("from"), F.lit("5.6").alias("to"))))
         .alias("powerplays"),
        overs_of(fl).alias("overs")))
    docs = lines.select("l_orderkey", innings.alias("innings"))
    prio = F.col("o_orderpriority")
    match_type = (F.when(prio.isin("1-URGENT", "2-HIGH"), "T20").when(prio == "3-MEDIUM", "ODI")
                  .otherwise("Test"))
    j = docs.join(o, docs["l_orderkey"] == o["o_orderkey"], "inner")
    content = F.to_json(F.struct(F.struct(match_type.alias("match_type")).alias("info"), "innings"))
    return j.select(*_raw(F.concat(F.col("l_orderkey").cast("string"), F.lit(".json")), content))


NESTED_SQL = """
WITH l AS (
  SELECT l.*, CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'T20'
                   WHEN o.o_orderpriority = '3-MEDIUM' THEN 'ODI' ELSE 'Test' END AS match_type
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
r AS (
  SELECT *, dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag) AS inning_no,
         row_number() OVER (PARTITION BY l_orderkey, l_returnflag, l_linestatus
                            ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS ball_no,
         CASE l_linestatus WHEN 'F' THEN 1 ELSE 6 END AS over_no
  FROM l),
p AS (
  SELECT r.*,
         CASE WHEN l_returnflag = 'A' THEN 1.0 ELSE CAST(dp.start_over AS DOUBLE) END AS pp_start,
         CASE WHEN l_returnflag = 'A' THEN 6.0 ELSE CAST(dp.end_over AS DOUBLE) END AS pp_end
  FROM r LEFT JOIN (VALUES ('T20', 1, 6), ('ODI', 1, 10)) AS dp(match_type, start_over, end_over)
    ON r.match_type = dp.match_type),
m AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) AS season, CAST(o_orderkey AS VARCHAR) AS match_id
  FROM orders)
SELECT CAST(p.l_orderkey AS VARCHAR) || '.json' AS file_name, CAST(inning_no AS BIGINT) AS inning_id,
       CAST(over_no AS BIGINT) AS over_number, 'team_' || l_returnflag AS batting_team,
       CAST(ball_no AS BIGINT) AS ball_in_over,
       'P' || CAST(l_partkey AS VARCHAR) AS batter, 'S' || CAST(l_suppkey AS VARCHAR) AS bowler,
       'L' || CAST(l_linenumber AS VARCHAR) AS non_striker,
       CAST(l_quantity AS BIGINT) AS runs_batter,
       CASE WHEN l_linestatus = 'O' THEN CASE l_returnflag WHEN 'A' THEN 'wides' WHEN 'N' THEN 'legbyes' END END AS extra_type,
       CAST(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS BIGINT) AS runs_extras,
       CAST(l_quantity AS BIGINT) + CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS runs_total,
       CASE WHEN l_returnflag = 'R' THEN 'caught' END AS dismissal_kind,
       CASE WHEN l_returnflag = 'R' THEN 'P' || CAST(l_partkey AS VARCHAR) END AS out_player,
       pp_start AS powerplays_start_over, pp_end AS powerplays_end_over,
       CAST(CASE WHEN over_no BETWEEN pp_start AND pp_end THEN 1 ELSE 0 END AS BIGINT) AS is_powerplay,
       m.season, m.match_id
FROM p LEFT JOIN m ON CAST(p.l_orderkey AS VARCHAR) = m.match_id
"""


@query("json_nested_explode", NESTED_SQL)
def json_nested_explode(spark: SparkSession, d: str) -> DataFrame:
    stg = staging.stg_cricket_match(order_documents(spark, d))
    deliveries = staging.stg_match_innings(stg, read_seed(spark, "default_powerplay"))
    info = (table(spark, d, "orders")
            .select(F.year("o_orderdate").cast("string").alias("season"),
                    F.col("o_orderkey").cast("string").alias("match_id")))
    return intermediate.int_match_innings(deliveries, info)


# --------------------------------------------------------------------------- X4 X5
@query("json_first_key", """
WITH x AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_linestatus = 'O' THEN CASE l_returnflag WHEN 'A' THEN '{"wides": 1}'
              WHEN 'N' THEN '{"noballs": 1, "legbyes": 1}' ELSE '{}' END END AS extras
  FROM lineitem)
SELECT l_orderkey, l_linenumber, list_sort(json_keys(extras))[1] AS extra_type FROM x
""")
def json_first_key(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem", row_heavy=True)
    text = F.when(F.col("l_linestatus") == "O",
                  F.when(F.col("l_returnflag") == "A", '{"wides": 1}')
                   .when(F.col("l_returnflag") == "N", '{"noballs": 1, "legbyes": 1}')
                   .otherwise("{}"))
    doc = F.from_json(F.concat(F.lit('{"extras": '), text, F.lit("}")), "extras map<string,string>")
    return li.select("l_orderkey", "l_linenumber", first_key(doc["extras"]).alias("extra_type"))


# --------------------------------------------------------------------------- X2 X3
@query("json_path_index", """
SELECT event_id, event_type AS team1,
       CASE WHEN value > 50 THEN 'u' || CAST(user_id AS VARCHAR) END AS team2,
       event_type AS first_wicket_kind, CAST(NULL AS VARCHAR) AS first_wicket
FROM events
""")
def json_path_index(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events", row_heavy=True)
    user = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    teams = F.when(F.col("value") > 50, F.array("event_type", user)).otherwise(F.array("event_type"))
    wickets = F.array(F.struct(F.col("event_type").alias("kind"), user.alias("player_out")),
                      F.struct(F.lit("run out").alias("kind"), user.alias("player_out")))
    docs = e.select("event_id", F.to_json(F.struct(teams.alias("teams"), wickets.alias("wickets"))).alias("doc"))
    return docs.select(
        "event_id",
        json_value_scalar("doc", "$.teams[0]").alias("team1"),
        json_value_scalar("doc", "$.teams[1]").alias("team2"),
        json_value_scalar("doc", "$.wickets[0].kind").alias("first_wicket_kind"),
        json_value_scalar("doc", "$.wickets[0]").alias("first_wicket"))


# --------------------------------------------------------------------------- M1 M2 X1 X2 X10 F4 F10
def order_header_documents(spark: SparkSession, d: str) -> DataFrame:
    """One header-only match document per order (numbers written as JSON numbers)."""
    o = table(spark, d, "orders", row_heavy=True)
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    j = o.join(broadcast_if_small(c), o["o_custkey"] == c["c_custkey"], "inner")
    status = F.col("o_orderstatus")
    info = F.struct(
        F.lit("T20").alias("match_type"),
        F.when(F.col("c_nationkey") % 2 == 0, "male").otherwise("female").alias("gender"),
        F.year("o_orderdate").alias("season"),
        F.when(status != "P", F.col("c_mktsegment")).alias("city"),
        F.concat(F.col("c_mktsegment"), F.lit(" Ground, Town")).alias("venue"),
        F.lit("club").alias("team_type"),
        F.array(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("dates"),
        F.array("c_mktsegment", "o_orderpriority").alias("teams"),
        F.array("c_name").alias("player_of_match"),
        F.struct(F.lit("League").alias("name"), F.col("o_orderkey").alias("match_number"),
                 F.when(F.col("o_totalprice") >= 490000, "Final").alias("stage")).alias("event"),
        F.struct(F.col("c_mktsegment").alias("winner"),
                 F.when(F.col("o_orderkey") % 2 == 0, "bat").otherwise("field").alias("decision")).alias("toss"),
        F.struct(F.when(status == "F", F.col("c_mktsegment")).when(status == "O", F.col("o_orderpriority"))
                  .alias("winner"),
                 F.struct(F.when(status == "F", F.col("o_custkey") % 10).alias("wickets"),
                          F.when(status == "O", F.col("o_orderkey") % 100).alias("runs")).alias("by"))
         .alias("outcome"))
    return j.select(*_raw(F.concat(F.col("o_orderkey").cast("string"), F.lit(".json")),
                          F.to_json(F.struct(info.alias("info")))))


@query("document_header", """
SELECT 'T20' AS match_type, CASE WHEN c.c_nationkey % 2 = 0 THEN 'male' ELSE 'female' END AS gender,
       CAST(year(o.o_orderdate) AS VARCHAR) AS season,
       CASE WHEN o.o_orderstatus <> 'P' THEN c.c_mktsegment END AS city,
       c.c_mktsegment || ' Ground, Town' AS venue,
       CAST(o.o_orderkey AS VARCHAR) AS match_number,
       CASE WHEN o.o_totalprice >= 490000 THEN 'Final' END AS playoff_stage,
       CAST(o.o_orderdate AS DATE) AS match_date, c.c_mktsegment AS team1, o.o_orderpriority AS team2,
       c.c_mktsegment AS toss_winner, CASE WHEN o.o_orderkey % 2 = 0 THEN 'bat' ELSE 'field' END AS toss_decision,
       CASE o.o_orderstatus WHEN 'F' THEN c.c_mktsegment WHEN 'O' THEN o.o_orderpriority END AS match_winner,
       CASE o.o_orderstatus WHEN 'F' THEN CAST(o.o_custkey % 10 AS VARCHAR) || ' wickets'
                            WHEN 'O' THEN CAST(o.o_orderkey % 100 AS VARCHAR) || ' runs'
                            ELSE 'no result' END AS margin,
       'League' AS event_name, 'club' AS event_type, c.c_name AS pom,
       CAST(o.o_orderkey AS VARCHAR) || '.json' AS filename
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
""")
def document_header(spark: SparkSession, d: str) -> DataFrame:
    return staging.stg_match_info(staging.stg_cricket_match(order_header_documents(spark, d)))


# --------------------------------------------------------------------------- M10 X7 X9
@query("teams_of_documents", """
WITH listed AS (SELECT DISTINCT c_mktsegment AS team, c_nationkey::BIGINT AS team_id, 'img/' || lower(c_mktsegment) AS image_url FROM customer),
named AS (SELECT DISTINCT unnest([c_mktsegment, o_orderpriority]) AS team_name, 'club' AS team_type FROM orders JOIN customer ON c_custkey = o_custkey)
SELECT team_name, team_type, team_id, image_url FROM named LEFT JOIN listed ON team = team_name
""")
def teams_of_documents(spark: SparkSession, d: str) -> DataFrame:
    """Teams named in the documents, with the ids of the team table; a segment
    is listed once per nation, a priority not at all."""
    teams = table(spark, d, "customer").select(
        F.col("c_nationkey").cast("bigint").alias("team_id"), F.col("c_mktsegment").alias("team"),
        F.concat(F.lit("img/"), F.lower("c_mktsegment")).alias("image_url")).distinct()
    documents = staging.stg_cricket_match(order_header_documents(spark, d))
    return intermediate.int_teams(documents, staging.stg_ipl_teams(teams))
