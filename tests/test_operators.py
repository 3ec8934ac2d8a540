"""Operators: ranking, skew-safe numbering, reshaping, joins, checks."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from matchlake.operators import (
    accepted_values_violations, anti_new, attach_dense_id, column_check_counts, dense_id,
    not_null_violations, observed_count, pivot_top_n, relationships_violations, sequence_within,
    top_n_per_group, unique_violations, unpivot_sides,
)
from matchlake.plans.intermediate import day_slots


def test_sequence_within_matches_window_under_skew(spark):
    df = spark.range(0, 5000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, F.lit(None))
         .otherwise((F.col("id") % 11).cast("string")).alias("g"),
        (F.col("id") * 7919 % 1000).alias("v"), "id")
    got = sequence_within(df, ["g"], [F.desc("v"), "id"], "rn", num_partitions=6)
    ref = df.withColumn("rn2", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("v"), "id")))
    j = got.join(ref.select("id", "rn2"), "id")
    assert j.count() == 5000 and j.where("rn <> rn2").count() == 0


def test_sequence_within_any_order_and_type(spark):
    """Hot groups with nulls and ties in the order columns, every direction."""
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 5 != 0, F.lit(None)).otherwise(F.col("id") % 4).cast("int").alias("g"),
        F.when(F.col("id") % 3 != 0, (F.col("id") * 31 % 50).cast("string")).alias("s"),
        F.when(F.col("id") % 7 != 0, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int"))).alias("d"), "id")
    for order in (["s", F.desc("d"), "id"], [F.desc("s"), F.asc_nulls_last("d"), F.desc("id")], [F.desc_nulls_first("d"), "id"]):
        got = sequence_within(df, ["g"], order, "rn", num_partitions=5, size_col="n")
        w = Window.partitionBy("g")
        want = df.withColumn("a", F.row_number().over(w.orderBy(*order))).withColumn("b", F.count("*").over(w)).select("id", "a", "b")
        j = got.join(want, "id")
        assert j.count() == 3000 and j.where("rn <> a or n <> b").count() == 0
    assert sequence_within(df.where("id < 0"), ["g"], ["id"], "rn").count() == 0


def test_dense_id_null_first_and_null_safe_join(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("c",)], "k string")
    assert sorted(dense_id(df, "k", "id").collect(), key=lambda r: r["id"]) == \
        [(None, 1), ("a", 2), ("b", 3), ("c", 4)]
    plain = {r["k"]: r["id"] for r in attach_dense_id(df, "k", "id").collect()}
    safe = {r["k"]: r["id"] for r in attach_dense_id(df, "k", "id", null_safe=True).collect()}
    assert plain[None] is None and safe[None] == 1


def test_top_n_plan_has_partial_limit(spark):
    df = spark.range(100).select((F.col("id") % 5).alias("g"), "id")
    out = top_n_per_group(df, ["g"], [F.desc("id")], 2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert sorted(r["id"] for r in out.where("g = 0").collect()) == [90, 95]


def test_pivot_top_n_missing_rank_is_null(spark):
    df = spark.createDataFrame([(1, "x", 5), (1, "y", 7), (2, "z", 1)], "g int, n string, v int")
    out = {r["g"]: r for r in pivot_top_n(df, ["g"], [F.desc("v")], {"n": "{label}_n"}, ["top", "second"]).collect()}
    assert (out[1]["top_n"], out[1]["second_n"]) == ("y", "x")
    assert (out[2]["top_n"], out[2]["second_n"]) == ("z", None)


def test_day_slots_one_two_three(spark):
    rows = [("d1", "9", "a"), ("d2", "9", "b"), ("d2", "10", "c"), ("d3", "1", "d"), ("d3", "2", "e"),
            ("d3", "3", "f")]
    df = spark.createDataFrame(rows, "match_date string, match_number string, filename string")
    got = {r["filename"]: r["match_time"] for r in day_slots(df).collect()}
    assert got == {"a": "19:30", "c": "15:30", "b": "19:30", "d": "19:30", "e": "19:30", "f": "19:30"}


def test_unpivot_single_scan(spark):
    df = spark.createDataFrame([(1, "A", "B")], "id int, t1 string, t2 string")
    out = unpivot_sides(df, ["id"], [{"team": F.col("t1")}, {"team": F.col("t2")}])
    assert sorted(r["team"] for r in out.collect()) == ["A", "B"]
    assert out._jdf.queryExecution().executedPlan().toString().count("Scan") == 1


def test_anti_new_and_checks(spark):
    cand = spark.createDataFrame([("a",), ("b",), ("c",)], "file_name string")
    done = spark.createDataFrame([("b",), ("b",)], "file_name string")
    assert sorted(r[0] for r in anti_new(cand, done, "file_name").collect()) == ["a", "c"]
    t = spark.createDataFrame([(1, "placed", 10), (1, None, None), (2, "lost", 99), (None, "shipped", 10)],
                              "id int, status string, cust int")
    parent = spark.createDataFrame([(10,)], "cust int")
    assert unique_violations(t, "id").collect()[0]["n_rows"] == 2
    assert not_null_violations(t, "id").count() == 1
    assert [r["status"] for r in accepted_values_violations(t, "status", ["placed", "shipped"]).collect()] == ["lost"]
    assert [r["cust"] for r in relationships_violations(t, "cust", parent, "cust").collect()] == [99]
    counts = column_check_counts(t, not_null=["id"], accepted={"status": ["placed", "shipped"]}).first()
    assert (counts["not_null__id"], counts["accepted_values__status"]) == (1, 1)
    obs_df, obs = observed_count(t, "n")
    obs_df.collect()
    assert obs.get["n"] == 4


def test_sequence_within_on_shuffled_input(spark):
    """Input straight out of a shuffle (row order varies between reads) with a
    hot group: numbering must still match the window exactly."""
    base = spark.range(0, 60000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 97).cast("string")).alias("g"),
        (F.col("id") * 7919 % 10007).alias("v"), "id")
    shuffled = base.repartition(7).groupBy("g", "v", "id").agg(F.count(F.lit(1)).alias("n"))
    got = sequence_within(shuffled, ["g"], ["v", "id"], "rn", num_partitions=8)
    ref = base.withColumn("rn2", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")))
    j = got.join(ref.select("id", "rn2"), "id")
    assert j.count() == 60000 and j.where("rn <> rn2").count() == 0


def test_sequence_within_group_sizes(spark):
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") % 5 == 0, F.lit(None))
         .otherwise((F.col("id") % 7).cast("string")).alias("g"), "id")
    got = sequence_within(df, ["g"], ["id"], "rn", num_partitions=5, size_col="n")
    ref = df.withColumn("n2", F.count(F.lit(1)).over(Window.partitionBy("g")))
    j = got.join(ref.select("id", "n2"), "id")
    assert j.count() == 3000 and j.where("n <> n2").count() == 0
    assert got.where("rn > n").count() == 0


def test_positions_follow_the_stored_order(spark, tmp_dir):
    """Many files, duplicates and nulls: the place read back is the row number of the order."""
    from matchlake.sources import read_positions, sort_columns, write_sorted

    df = spark.range(3000).select((F.col("id") * 7919 % 211).alias("a"), F.when(F.col("id") % 9 != 0, F.col("id") % 13).alias("b"), "id").repartition(7)
    order = "a, b desc, id"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_sorted(df, f"{tmp_dir}/sorted", order)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = read_positions(spark, f"{tmp_dir}/sorted")
    assert len(got.inputFiles()) > 1
    want = df.withColumn("rn", F.row_number().over(Window.orderBy(*sort_columns(order)))).select("id", "rn")
    assert got.join(want, "id").where("position <> rn").count() == 0 and got.count() == 3000


def test_broadcast_hints_need_a_proven_bound(spark, tmp_dir):
    from matchlake.operators import broadcast_if_small, proven_size_bytes

    spark.range(1000).withColumn("k", F.col("id") % 10).write.parquet(f"{tmp_dir}/t")
    t = spark.read.parquet(f"{tmp_dir}/t")

    def hinted(df, **limit):
        return "ResolvedHint" in broadcast_if_small(df, **limit)._jdf.queryExecution().analyzed().toString()
    assert hinted(t) and hinted(t.where("k > 3").select("k").distinct()) and hinted(t.unionByName(t).groupBy("k").count())
    assert not hinted(t, max_bytes=100)
    # a row may become many: only an estimate
    assert not hinted(t.select(F.explode(F.sequence(F.lit(1), F.col("id"))))) and not hinted(t.join(t.withColumnRenamed("id", "i"), "k"))
    assert proven_size_bytes(t.join(t, "k")) is None


def test_explode_level_parses_a_document_once(spark):
    """No condition on an array is pushed below the parse that made it, where each would parse the document again."""
    from matchlake.operators import explode_level
    from matchlake.plans import staging
    from matchlake.sources import read_seed

    texts = ['{"info": {"match_type": "T20"}, "innings": [{"team": "a", "overs": [{"over": "0", "deliveries": [{"batter": "x"}, {"batter": "y"}]}]}]}',
             '{"info": {}, "innings": []}', '{"info": {}}', '{"innings": [{"team": "b", "overs": null}, {"team": "c", "overs": [{"over": "1"}]}]}']
    raw = spark.createDataFrame([(f"{k}.json", t) for k, t in enumerate(texts)], "file_name string, raw_file string")
    rows = staging.stg_match_innings(raw, read_seed(spark, "default_powerplay"))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_json(StructField(info") == 1
    assert [tuple(r) for r in rows.select("file_name", "inning_id", "ball_in_over", "batter").orderBy("ball_in_over").collect()] == [
        ("0.json", 1, 1, "x"), ("0.json", 1, 2, "y")]
    df = spark.createDataFrame([(1, ["a", None]), (2, []), (3, None)], "k int, v array<string>")
    assert sorted(map(tuple, explode_level(df, "v", "at", "x", ["k"]).collect()), key=lambda r: r[1]) == [(1, 0, "a"), (1, 1, None)]
