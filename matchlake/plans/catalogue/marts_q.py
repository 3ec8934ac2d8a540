"""Mart-level queries: points table, innings summary, top-n, customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.operators import attach_dense_id, broadcast_if_small, pivot_top_n, top_n_per_group
from matchlake.plans import intermediate, marts, shop
from matchlake.plans.catalogue.registry import query, table
from matchlake.session import scratch_dir
from matchlake.sources import materialize_table


# --------------------------------------------------------------------------- M17
@query("customer_order_summary", """
SELECT p.customer_id, p.first_name, p.last_name, min(o.o_orderdate)::DATE AS first_order_date,
       max(o.o_orderdate)::DATE AS most_recent_order_date, count(o.o_orderkey) AS number_of_orders
FROM (SELECT c_custkey AS customer_id, c_name AS first_name, c_mktsegment AS last_name FROM customer
      UNION ALL SELECT 1000000000 + s_suppkey, s_name, 'supplier' FROM supplier) p
LEFT JOIN orders o ON o.o_custkey = p.customer_id
GROUP BY ALL
""")
def customer_order_summary(spark: SparkSession, d: str) -> DataFrame:
    # suppliers stand in for customers without orders
    cust = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name")).unionByName(
        table(spark, d, "supplier").select((F.col("s_suppkey") + 1000000000).alias("id"), F.col("s_name").alias("first_name"),
                                           F.lit("supplier").alias("last_name")))
    orders = (table(spark, d, "orders")
              .select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"),
                      F.col("o_orderdate").cast("date").alias("order_date"),
                      F.col("o_orderstatus").alias("status")))
    return shop.customers(shop.stg_customers(cust), shop.stg_customer_orders(shop.stg_orders(orders)))


# --------------------------------------------------------------------------- M13
def order_matches(spark: SparkSession, d: str) -> DataFrame:
    """Orders as matches: customer segment v order priority; status F means
    the segment won, O the priority, P no result; the priciest orders are
    playoff matches."""
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    j = o.join(broadcast_if_small(c), o["o_custkey"] == c["c_custkey"], "inner")
    return j.select(
        F.year("o_orderdate").cast("string").alias("season"),
        F.col("o_orderkey").alias("match_id"),
        F.col("c_mktsegment").alias("team1"),
        F.col("o_orderpriority").alias("team2"),
        F.when(F.col("o_orderstatus") == "F", F.col("c_mktsegment"))
         .when(F.col("o_orderstatus") == "O", F.col("o_orderpriority")).alias("match_winner"),
        F.when(F.col("o_orderstatus") == "P", "No Result").otherwise("10 runs").alias("margin"),
        F.when(F.col("o_totalprice") >= 490000, "Final").alias("playoff_stage"),
    )


def team_names(spark: SparkSession, d: str) -> DataFrame:
    """Team dimension: every segment and priority name with a dense id."""
    names = (table(spark, d, "customer").select(F.col("c_mktsegment").alias("team_name"),
                                                F.lit("segment").alias("team_type")).distinct()
             .unionByName(table(spark, d, "orders").select(F.col("o_orderpriority").alias("team_name"),
                                                          F.lit("priority").alias("team_type")).distinct()))
    with_id = attach_dense_id(names, "team_name", "team_id")
    return with_id.select("team_name", "team_type", "team_id",
                          F.concat(F.lit("img/"), F.lower("team_name")).alias("image_url"))


@query("order_points_table", """
WITH side AS (
  SELECT year(o_orderdate)::VARCHAR AS season, o_orderstatus AS st,
         unnest([{'team': c_mktsegment, 'kind': 'segment', 'wins_at': 'F'},
                 {'team': o_orderpriority, 'kind': 'priority', 'wins_at': 'O'}], recursive := true)
  FROM orders JOIN customer ON c_custkey = o_custkey
  WHERE o_totalprice < 490000),
known AS (
  SELECT list_sort(list_distinct(flatten([(SELECT list(DISTINCT c_mktsegment) FROM customer),
                                          (SELECT list(DISTINCT o_orderpriority) FROM orders)]))) AS names)
SELECT season, team, count(*) AS matches_played, count(*) FILTER (st = wins_at) AS wins,
       count(*) FILTER (st NOT IN ('P', wins_at)) AS losses, count(*) FILTER (st = 'P') AS no_results,
       sum(2 * (st = wins_at)::INT + (st = 'P')::INT)::BIGINT AS points,
       list_position(any_value(names), team)::BIGINT AS team_id, 'img/' || lower(team) AS image_url
FROM side, known
GROUP BY season, team, kind
""")
def order_points_table(spark: SparkSession, d: str) -> DataFrame:
    return marts.points_table(order_matches(spark, d), team_names(spark, d))


# --------------------------------------------------------------------------- M14
def supplier_matches(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as match headers (one match per supplier)."""
    s = table(spark, d, "supplier")
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    j = (s.join(broadcast_if_small(n), s["s_nationkey"] == n["n_nationkey"], "inner")
          .join(broadcast_if_small(r), n["n_regionkey"] == r["r_regionkey"], "inner"))
    nonneg = F.col("s_acctbal") >= 0
    return j.select(
        (F.col("n_regionkey") + 2020).cast("string").alias("season"),
        F.col("s_suppkey").cast("string").alias("match_id"),
        F.col("s_suppkey").cast("string").alias("match_number"),
        F.when(~nonneg, "Final").alias("playoff_stage"),
        F.date_add(F.lit("2024-03-01").cast("date"), F.col("s_nationkey")).alias("match_date"),
        F.col("n_name").alias("team1"),
        F.col("r_name").alias("team2"),
        F.col("n_name").alias("toss_winner"),
        F.when(F.col("s_acctbal") >= 5000, "bat").otherwise("field").alias("toss_decision"),
        F.when(nonneg, F.col("n_name")).otherwise(F.col("r_name")).alias("match_winner"),
        F.when(nonneg, "5 wickets").otherwise("no result").alias("margin"),
        F.col("s_name").alias("pom"),
    )


def lineitem_deliveries(spark: SparkSession, d: str) -> DataFrame:
    """Line items as deliveries: match = supplier (file ``<suppkey>.json``),
    innings = line number, batter = part brand, bowler = order priority,
    runs = quantity, returned item = wicket, open line = an extra (A wide,
    N no-ball, R leg-bye) worth one run."""
    li = table(spark, d, "lineitem", row_heavy=True)
    p = table(spark, d, "part").select("p_partkey", "p_brand")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    j = (li.join(broadcast_if_small(p), li["l_partkey"] == p["p_partkey"], "inner")
           .join(o, li["l_orderkey"] == o["o_orderkey"], "inner"))
    extra = F.when(F.col("l_linestatus") == "O",
                   F.when(F.col("l_returnflag") == "A", "wides")
                    .when(F.col("l_returnflag") == "N", "noballs")
                    .otherwise("legbyes"))
    runs = F.col("l_quantity").cast("bigint")
    return j.select(
        F.concat(F.col("l_suppkey").cast("string"), F.lit(".json")).alias("file_name"),
        F.col("l_linenumber").cast("bigint").alias("inning_id"),
        F.col("p_brand").alias("batter"),
        F.col("o_orderpriority").alias("bowler"),
        runs.alias("runs_batter"),
        extra.alias("extra_type"),
        (runs + F.when(F.col("l_linestatus") == "O", 1).otherwise(0)).alias("runs_total"),
        F.when(F.col("l_returnflag") == "R", "caught").alias("dismissal_kind"),
    )


INNINGS_SQL = """
WITH ball AS (
  SELECT l_suppkey AS k, l_linenumber::BIGINT AS i, p_brand AS bat, o_orderpriority AS bowl, l_quantity::BIGINT AS hit,
         l_quantity::BIGINT + (l_linestatus = 'O')::INT AS cost, (l_returnflag = 'R')::INT AS out_,
         NOT (l_linestatus = 'O' AND l_returnflag <> 'R') AS legal
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey),
best AS (
  SELECT k, i, list({'n': bat, 'r': r, 'b': b} ORDER BY r DESC, b, bat) AS x
  FROM (SELECT k, i, bat, sum(hit)::BIGINT AS r, count(*) AS b FROM ball GROUP BY ALL) GROUP BY ALL),
attack AS (
  SELECT k, i, list({'n': bowl, 'w': w, 'r': r, 'b': b} ORDER BY w DESC, r, b, bowl) AS y,
         sum(r)::BIGINT AS runs, sum(w)::BIGINT AS wickets
  FROM (SELECT k, i, bowl, sum(out_)::BIGINT AS w, sum(cost)::BIGINT AS r, count(*) FILTER (legal) AS b FROM ball GROUP BY ALL)
  GROUP BY ALL)
SELECT (n_regionkey + 2020)::VARCHAR AS season, s_suppkey::VARCHAR AS match_id, s_suppkey::VARCHAR AS match_number,
       if(s_acctbal < 0, 'Final', NULL) AS playoff_stage, DATE '2024-03-01' + s_nationkey AS match_date,
       n_name AS team1, r_name AS team2, i AS inning_id, runs AS inning_total, wickets AS total_wickets,
       x[1].n AS top_batter, x[1].r AS top_batter_runs, x[1].b AS top_batter_balls,
       x[2].n AS second_batter, x[2].r AS second_batter_runs, x[2].b AS second_batter_balls,
       y[1].n AS top_bowler, y[1].w AS top_bowler_wickets, y[1].r AS top_bowler_runs_conceded, y[1].b AS top_bowler_balls,
       y[2].n AS second_bowler, y[2].w AS second_bowler_wickets, y[2].r AS second_bowler_runs_conceded,
       y[2].b AS second_bowler_balls, n_name AS toss_winner, if(s_acctbal >= 5000, 'bat', 'field') AS toss_decision,
       if(s_acctbal >= 0, n_name, r_name) AS match_winner, if(s_acctbal >= 0, '5 wickets', 'no result') AS margin, s_name AS pom
FROM best JOIN attack USING (k, i) JOIN supplier ON s_suppkey = k
JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
"""


@query("innings_summary_analog", INNINGS_SQL)
def innings_summary_analog(spark: SparkSession, d: str) -> DataFrame:
    # The match header is a stored table, as in the model build: its file size
    # then bounds the broadcast check of the deliveries-to-header join (the
    # planner's estimate for an unstored join of three tables is a product).
    header = materialize_table(supplier_matches(spark, d), scratch_dir(spark, "match_header"))
    deliveries = intermediate.int_match_innings(lineitem_deliveries(spark, d), header)
    return marts.innings_summary(deliveries, header)


# --------------------------------------------------------------------------- W5 / O3
@query("top2_per_group", """
SELECT o_custkey, o_orderkey, o_totalprice, rn FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS rn
  FROM orders) t
WHERE rn <= 2
""")
def top2_per_group(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return top_n_per_group(o, ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"], 2)


@query("pivot_top2", """
WITH r AS (
  SELECT o_custkey, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS rn
  FROM orders)
SELECT o_custkey,
       MAX(CASE WHEN rn = 1 THEN o_orderkey END) AS first_orderkey,
       MAX(CASE WHEN rn = 1 THEN o_totalprice END) AS first_totalprice,
       MAX(CASE WHEN rn = 2 THEN o_orderkey END) AS second_orderkey,
       MAX(CASE WHEN rn = 2 THEN o_totalprice END) AS second_totalprice
FROM r WHERE rn <= 2 GROUP BY o_custkey
""")
def pivot_top2(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return pivot_top_n(o, ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"],
                       {"o_orderkey": "{label}_orderkey", "o_totalprice": "{label}_totalprice"},
                       ["first", "second"])
