"""Declared model checks, and plan properties the scale design relies on."""

import datetime as dt
import re

from pyspark.sql import functions as F

import fixtures
from matchlake import schemas
from matchlake.operators import number_all, sequence_within
from matchlake.plans import marts, shop, staging
from matchlake.plans.checks import check_summary, run_checks
from matchlake.sources import read_seed


def plan_of(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def shop_models(spark):
    cust = spark.createDataFrame([(1, "A", "X"), (2, "B", "Y"), (2, "B2", "Y2"), (3, "C", "Z")],
                                 schemas.SHOP_CUSTOMERS)
    orders = spark.createDataFrame(
        [(10, 1, dt.date(2024, 1, 1), "placed"), (11, 1, dt.date(2024, 2, 1), "shipped"),
         (12, 9, dt.date(2024, 3, 1), "lost"), (13, None, dt.date(2024, 3, 2), None)], schemas.SHOP_ORDERS)
    sc, so = shop.stg_customers(cust), shop.stg_orders(orders)
    return {"stg_customers": sc, "stg_orders": so,
            "customers": shop.customers(sc, shop.stg_customer_orders(so)),
            "stg_cricket_match": staging.stg_cricket_match(fixtures.raw_documents(spark))}


def test_declared_checks(spark):
    models = shop_models(spark)
    summary = {r["check"]: r["failures"] for r in check_summary(spark, models).collect()}
    assert summary["unique__stg_customers__customer_id"] == 1
    assert summary["accepted_values__stg_orders__status"] == 1          # 'lost'; NULL passes
    assert summary["relationships__stg_orders__customer_id"] == 1        # 9; NULL passes
    assert summary["not_null__stg_orders__customer_id"] == 1
    assert summary["not_null__stg_cricket_match__file_name"] == 0
    customers = {r["customer_id"]: r for r in models["customers"].collect()}
    assert customers[3]["number_of_orders"] == 0 and customers[3]["first_order_date"] is None
    assert run_checks(models)["unique__customers__customer_id"].count() == 1
    some = {"stg_orders": models["stg_orders"]}
    assert run_checks(some)["relationships__stg_orders__customer_id"] is None       # the parent is absent
    summary = {r["check"]: r["failures"] for r in check_summary(spark, some).collect()}
    assert summary["not_null__stg_orders__customer_id"] == 1 and summary["relationships__stg_orders__customer_id"] is None
    assert all(r["failures"] is None for r in check_summary(spark, {}).collect())


def test_check_summary_agrees_with_failing_rows(spark):
    models = shop_models(spark)
    assert {r["check"]: r["failures"] for r in check_summary(spark, models).collect()} == \
        {name: df.count() for name, df in run_checks(models).items()}


def test_all_checks_scan_each_model_once(spark):
    from matchlake.plans.catalogue.quality_q import TABLE_CHECKS, dq_summary

    plan = plan_of(dq_summary(spark, "/root/testdata/sf0.001"))
    scans = re.findall(r"FileScan parquet .*?/(\w+)\.parquet", plan.split("== Initial Plan")[0])
    assert sorted(scans) == sorted({m for c in TABLE_CHECKS for m in (c.model, c.to) if m and m != "referees"})


def test_seed_is_broadcast(spark):
    stg = staging.stg_cricket_match(fixtures.raw_documents(spark))
    plan = plan_of(staging.stg_match_innings(stg, read_seed(spark, "default_powerplay")))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_points_table_reads_matches_once(spark):
    m = spark.createDataFrame([("2025", "1", "A", "B", "A", "1 runs", None)],
                              "season string, match_id string, team1 string, team2 string, "
                              "match_winner string, margin string, playoff_stage string")
    t = spark.createDataFrame([("A", "club", 1, "a"), ("B", "club", 2, "b")],
                              "team_name string, team_type string, team_id long, image_url string")
    plan = plan_of(marts.points_table(m, t))
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") <= 2   # one per input


def wide_exchanges(df, payload):
    """Exchanges (broadcasts left out) of a formatted plan whose rows hold ``payload``."""
    df.write.format("noop").mode("overwrite").save()
    text = df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    text = text.split("== Initial Plan")[0] if "== Initial Plan" in text else text
    nodes = dict(re.findall(r"\n\((\d+)\) (?:Exchange|BroadcastExchange)\n(Input.*)\n", text))
    shuffles = {n: row for n, row in nodes.items() if re.search(rf"\n\({n}\) Exchange\n", text)}
    final = re.search(r"== Final Plan ==(.*?)(== Initial Plan|\n\n\n)", text, re.S)
    if final:
        shuffles = {n: row for n, row in shuffles.items() if re.search(rf"Exchange \({n}\)", final[1])}
    return [row for row in shuffles.values() if re.search(rf"\b{payload}#", row)]


def test_sequence_within_has_no_single_partition_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    plan = plan_of(sequence_within(df, ["g"], ["id"], "rn"))
    assert "SinglePartition" not in plan


def test_numbers_take_one_exchange_of_full_rows(spark, tmp_dir):
    df = spark.range(4000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("g"), "id", F.lit("payload").alias("w"))
    df.write.parquet(f"{tmp_dir}/in")
    rows = spark.read.parquet(f"{tmp_dir}/in")
    hot = sequence_within(rows, ["g"], ["id"], "rn", size_col="n")
    assert len(wide_exchanges(hot, "w")) == 1                   # half the rows in one group: sliced
    assert hot.where("g = 0").agg(F.max("rn"), F.max("n"), F.min("n")).first() == (2000, 2000, 2000)
    cold = sequence_within(rows.where("g > 0"), ["g"], ["id"], "rn", size_col="n")
    assert len(wide_exchanges(cold, "w")) == 1 and cold.where("rn <> 1 or n <> 1").count() == 0
    assert len(wide_exchanges(number_all(rows, ["id"], "rn"), "w")) == 0     # its one exchange ran before the written copy


def test_a_hot_group_spreads_over_tasks(spark):
    df = spark.range(20000).select(F.lit("day").alias("g"), F.col("id"))
    out = sequence_within(df, ["g"], [F.desc("id")], "rn", num_partitions=8, size_col="n")
    per_task = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) >= 4 and max(per_task) < 12000
    assert out.where("rn <> 20000 - id or n <> 20000").count() == 0


def test_parsed_documents_prune_nested_columns(spark, tmp_dir):
    from matchlake.sources import materialize_table

    docs = materialize_table(staging.parsed_documents(staging.stg_cricket_match(fixtures.raw_documents(spark))),
                             f"{tmp_dir}/parsed")
    header = staging.stg_match_info(docs)
    plan = plan_of(header)
    read_schema = [line for line in plan.splitlines() if "ReadSchema" in line or "FileScan" in line][0]
    assert "info" in read_schema and "innings" not in read_schema and "deliveries" not in read_schema
    assert header.count() == 4


def test_innings_summary_reads_deliveries_once(spark):
    from matchlake.plans.catalogue import QUERIES

    plan = plan_of(QUERIES["innings_summary_analog"](spark, "/root/testdata/sf0.001"))
    scans = [line for line in plan.splitlines() if "FileScan" in line and "lineitem" in line]
    assert len(scans) == 1, scans


def test_spread_only_when_under_split(spark, tmp_dir):
    from matchlake.sources import spread

    path = f"{tmp_dir}/many"
    spark.range(0, 1000, numPartitions=12).write.parquet(path)
    many = spark.read.parquet(path)
    have = many.rdd.getNumPartitions()          # small files are packed into fewer splits
    assert spread(many, min_partitions=have) is many                    # enough splits: unchanged
    one = spark.read.parquet("/root/testdata/sf0.001/region.parquet")
    assert spread(one, min_partitions=8).rdd.getNumPartitions() == 8    # single split: spread
