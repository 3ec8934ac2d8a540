"""Ingest, enrichment, file and table I/O queries.

Queries that write go to a fresh folder under the session's shared folder
(``spark.checkpoint.dir``) and return a reader over what they wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake import schemas
from matchlake.functions import hour_iso
from matchlake.plans import ingest, weather
from matchlake.plans.catalogue.registry import query, table
from matchlake.session import scratch_dir
from matchlake.sources import (
    Source, SourceRegistry, batch_counts, commit_batch, ensure_table, materialize_table, materialize_view, missing_required,
    read_csv, read_latest, scan_json_files, write_files, write_version,
)
from matchlake.sources.batches import ROUTE
from matchlake.streaming import ingest_stream


# --------------------------------------------------------------------------- I1 P12 J1 F15
def event_candidates(events: DataFrame) -> DataFrame:
    """Events as landed files: errors carry trailing garbage, large clicks
    are truncated, views above 95 use single quotes; all else is valid."""
    et, v = F.col("event_type"), F.col("value")
    content = (F.when(et == "error", F.concat("props", F.lit(" x")))
                .when((et == "click") & (v > 90), F.substring("props", 1, 5))
                .when((et == "view") & (v > 95), F.regexp_replace("props", '"', "'"))
                .otherwise(F.col("props")))
    return events.select(F.concat(F.lit("evt-"), F.col("event_id").cast("string"), F.lit(".json")).alias("file_name"),
                         content.alias("content"))


INGEST_SQL = """
WITH c AS (
  SELECT 'evt-' || CAST(event_id AS VARCHAR) || '.json' AS file_name,
         CASE WHEN event_type = 'error' THEN props || ' x'
              WHEN event_type = 'click' AND value > 90 THEN substring(props, 1, 5)
              WHEN event_type = 'view' AND value > 95 THEN replace(props, '"', '''')
              ELSE props END AS content, event_type
  FROM events)
SELECT file_name, content FROM c
WHERE event_type <> 'signup' AND json_valid(content)
"""


@query("incremental_ingest", INGEST_SQL)
def incremental_ingest(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events", row_heavy=True)
    loaded = event_candidates(events.where(F.col("event_type") == "signup")).select("file_name")
    flagged = ingest.new_documents(event_candidates(events), loaded)
    valid, _quarantined = ingest.split_valid(flagged)
    return valid.select("file_name", "content")


# --------------------------------------------------------------------------- I3
@query("stream_ingest", INGEST_SQL)
def stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    """The same landing as ``incremental_ingest``, run as an available-now
    stream over the events file, with the signup files pre-loaded."""
    base = scratch_dir(spark, "stream_ingest")
    target, quarantine = f"{base}/raw", f"{base}/quarantine"
    events = table(spark, d, "events")
    pre = event_candidates(events.where(F.col("event_type") == "signup")).select(
        "file_name", "content", F.current_timestamp().alias("file_upload_timestamp"))
    pre.write.parquet(target)
    stream = (spark.readStream.schema(events.schema)
              .option("pathGlobFilter", "events.parquet").parquet(d))
    ingest_stream(spark, event_candidates(stream), target, quarantine, f"{base}/checkpoint")
    landed = spark.read.parquet(target)
    return landed.join(pre.select("file_name"), "file_name", "left_anti").select("file_name", "content")


# --------------------------------------------------------------------------- I1 S1 S2 S3 S6 J1 F15
def landed_documents(docs: DataFrame) -> DataFrame:
    """Documents as files: a folder per language, a deeper one for every tenth;
    some with another ending, some with an upper-case one, some cut short."""
    n = F.col("doc_id")
    ending = F.when(n % 10 == 7, ".txt").when(n % 10 == 3, ".JSON").otherwise(".json")
    name = F.concat(F.coalesce("lang", F.lit("none")), F.when(n % 10 == 2, "/more of+it/").otherwise("/"), F.lit("doc "), n.cast("string"), ending)
    text = F.to_json(F.struct("doc_id", "text"))
    files = docs.select("doc_id", name.alias("file_name"), text.alias("whole"))
    return files.select("doc_id", "file_name", F.when(n % 11 == 5, F.expr("left(whole, length(whole) - 1)")).otherwise(F.col("whole")).alias("content"))


@query("ingest_files", """
SELECT coalesce(lang, 'none') || CASE doc_id % 10 WHEN 2 THEN '/more of+it/' ELSE '/' END || 'doc ' || doc_id::VARCHAR
       || CASE doc_id % 10 WHEN 3 THEN '.JSON' ELSE '.json' END AS file_name,
       CASE WHEN doc_id % 11 <> 5 THEN doc_id END AS doc_id, CASE WHEN doc_id % 11 <> 5 THEN text END AS text,
       CASE WHEN doc_id % 11 = 5 THEN 'quarantined' ELSE 'loaded' END AS place,
       CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 2 END AS run
FROM documents WHERE doc_id % 10 <> 7
""")
def ingest_files_q(spark: SparkSession, d: str) -> DataFrame:
    """Files of even documents land and are ingested, then all files; ``run``
    comes from the load time."""
    base = scratch_dir(spark, "ingest_files")
    root, target, quarantine = f"{base}/landing", f"{base}/raw", f"{base}/quarantine"
    files = landed_documents(table(spark, d, "documents", row_heavy=True))
    write_files(files.where("doc_id % 2 = 0"), root)
    ingest.ingest_files(spark, root, target, quarantine)
    first = spark.read.parquet(target, quarantine).agg(F.max("file_upload_timestamp")).first()[0]
    write_files(files.where("doc_id % 2 <> 0"), root)
    ingest.ingest_files(spark, root, target, quarantine)
    doc = F.from_json("content", "doc_id bigint, text string")
    raw = spark.read.parquet(target).select("file_name", doc["doc_id"].alias("doc_id"), doc["text"].alias("text"), F.lit("loaded").alias("place"),
                                            "file_upload_timestamp")
    bad = spark.read.parquet(quarantine).select("file_name", F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("string").alias("text"),
                                                F.lit("quarantined").alias("place"), "file_upload_timestamp")
    run = F.when(F.col("file_upload_timestamp") <= F.lit(first), 1).otherwise(2).alias("run")
    return raw.unionByName(bad).select("file_name", "doc_id", "text", "place", run)


# --------------------------------------------------------------------------- A10 S7
@query("ingest_counts", f"""
WITH c AS (
  SELECT CASE WHEN event_type = 'error' THEN props || ' x'
              WHEN event_type = 'click' AND value > 90 THEN substring(props, 1, 5)
              WHEN event_type = 'view' AND value > 95 THEN replace(props, '"', '''') ELSE props END AS content, event_type
  FROM events)
SELECT count(*) AS received, count(*) FILTER (event_type <> 'signup' AND json_valid(content)) AS loaded,
       count(*) FILTER (event_type <> 'signup' AND NOT json_valid(content)) AS quarantined,
       count(*) FILTER (event_type <> 'signup' AND json_valid(content)) AS rows_in_table
FROM c
""")
def ingest_counts(spark: SparkSession, d: str) -> DataFrame:
    """The counts an ingest stream reports: rows its listener has observed,
    rows its writes have counted, and what the ledger of batches says."""
    base = scratch_dir(spark, "ingest_counts")
    target, quarantine = f"{base}/raw", f"{base}/quarantine"
    events = table(spark, d, "events")
    event_candidates(events.where(F.col("event_type") == "signup")).withColumn("file_upload_timestamp", F.current_timestamp()).write.parquet(target)
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(d)
    report = ingest_stream(spark, event_candidates(stream), target, quarantine, f"{base}/checkpoint")
    told = spark.createDataFrame([(b["batch"], b["received"], b["loaded"], b["quarantined"]) for b in report.batches],
                                 "batch bigint, received bigint, loaded bigint, quarantined bigint")
    ledger = batch_counts(spark, target).where(F.col("table") == "loaded").select(
        F.substring_index("batch", "-", -1).cast("bigint").alias("batch"), F.col("rows").alias("rows_in_table"))
    sums = [F.sum(c).alias(c) for c in ("received", "loaded", "quarantined", "rows_in_table")]
    return told.join(ledger, "batch", "left").agg(*sums)


# --------------------------------------------------------------------------- S5
REQUIRED_EVENT = T.StructType([T.StructField("event_id", T.LongType(), False), T.StructField("user_name", T.StringType(), False),
                               T.StructField("props", T.StringType(), False), T.StructField("value", T.DoubleType(), True)])


@query("required_columns", """
WITH e AS (
  SELECT event_id, CASE WHEN event_type <> 'error' THEN 'u' || user_id::VARCHAR END AS user_name,
         CASE WHEN value <= 90 THEN props END AS props, CASE WHEN event_type <> 'view' THEN value END AS value
  FROM events)
SELECT event_id, user_name, props, value, CASE WHEN user_name IS NULL OR props IS NULL THEN 'incomplete' ELSE 'complete' END AS place,
       list_filter([CASE WHEN user_name IS NULL THEN 'user_name' END, CASE WHEN props IS NULL THEN 'props' END], lambda c: c IS NOT NULL) AS missing
FROM e
""")
def required_columns(spark: SparkSession, d: str) -> DataFrame:
    """Rows that lack a REQUIRED column go to quarantine, in the same batch as
    the complete ones go to the table; the write itself checks the table's rows."""
    base = scratch_dir(spark, "required_columns")
    e = table(spark, d, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("user_name"),
        F.when(F.col("value") <= 90, F.col("props")).alias("props"), F.when(F.col("event_type") != "view", F.col("value")).alias("value"))
    rows = e.withColumn("missing", missing_required(REQUIRED_EVENT))
    route = F.when(F.size("missing") == 0, "complete").otherwise("incomplete")
    tables = {"complete": f"{base}/complete", "incomplete": f"{base}/incomplete"}
    for path in tables.values():
        ensure_table(spark, path, T.StructType([*REQUIRED_EVENT.fields, T.StructField("missing", T.ArrayType(T.StringType()))]))
    commit_batch(rows.withColumn(ROUTE, route), "events", tables, {"complete": REQUIRED_EVENT})
    out = [spark.read.parquet(path).withColumn("place", F.lit(name)) for name, path in tables.items()]
    return out[0].unionByName(out[1])


# --------------------------------------------------------------------------- I2 M12 J10 X12 X13 P14 F13
HOURLY_AS_OF = "2024-01-25 00:00:00"


def purchase_schedule(events: DataFrame) -> DataFrame:
    """Purchases as scheduled matches at one of four places (user id mod 4)."""
    p = events.where(F.col("event_type") == "purchase")
    place = (F.col("user_id") % 4)
    return p.select(
        F.year("ts").cast("string").alias("season"), F.col("event_id").cast("string").alias("match_id"),
        F.col("event_type").alias("city"), F.col("user_id").cast("string").alias("match_num"),
        F.concat(F.lit("V"), place.cast("string")).alias("venue"),
        F.concat_ws("/", F.dayofmonth("ts").cast("string"), F.month("ts").cast("string"),
                    F.year("ts").cast("string")).alias("match_date"),
        F.concat(F.hour("ts").cast("string"), F.lit(":"), F.lpad(F.minute("ts").cast("string"), 2, "0"))
         .alias("match_time"),
        F.col("event_type").alias("team1"), F.lit(None).cast("string").alias("team2"),
        place.cast("bigint").alias("venue_id"), place.cast("double").alias("latitude"),
        F.lit(0.0).alias("longitude"), F.col("value"))


def view_archive(events: DataFrame) -> DataFrame:
    """Hourly archive built from views: per place and day, parallel arrays of
    the hours seen and their measures (at most 24 entries per row)."""
    v = events.where(F.col("event_type") == "view")
    k = F.get_json_object("props", "$.k")
    hourly = v.groupBy((F.col("user_id") % 4).cast("double").alias("latitude"), F.lit(0.0).alias("longitude"),
                       F.to_date("ts").alias("date"), hour_iso("ts").alias("time")).agg(
        F.max("value").alias("temperature_2m"), F.min("value").alias("relativehumidity_2m"),
        F.count(F.lit(1)).cast("double").alias("pressure_msl"), F.max(k.cast("double")).alias("cloudcover"),
        F.sum(k.cast("bigint")).cast("double").alias("rain"),
        (F.max("value") - F.min("value")).alias("wind_speed_10m"))
    day = hourly.groupBy("latitude", "longitude", "date").agg(
        F.array_sort(F.collect_list(F.struct("time", *schemas.HOURLY_VARIABLES))).alias("h"))
    return day.select("latitude", "longitude", "date", F.col("h.time").alias("time"),
                      *[F.col("h")[v].alias(v) for v in schemas.HOURLY_VARIABLES])


@query("hourly_lookup", f"""
WITH s AS (
  SELECT CAST(year(ts) AS VARCHAR) AS season, CAST(event_id AS VARCHAR) AS match_id, event_type AS city,
         CAST(user_id AS VARCHAR) AS match_num, 'V' || CAST(user_id % 4 AS VARCHAR) AS venue,
         CAST(day(ts) AS VARCHAR) || '/' || CAST(month(ts) AS VARCHAR) || '/' || CAST(year(ts) AS VARCHAR) AS match_date,
         CAST(hour(ts) AS VARCHAR) || ':' || lpad(CAST(minute(ts) AS VARCHAR), 2, '0') AS match_time,
         event_type AS team1, CAST(NULL AS VARCHAR) AS team2, CAST(user_id % 4 AS BIGINT) AS venue_id,
         CAST(user_id % 4 AS DOUBLE) AS latitude, 0.0::DOUBLE AS longitude, value, ts
  FROM events WHERE event_type = 'purchase'),
h AS (
  SELECT CAST(user_id % 4 AS DOUBLE) AS lat, CAST(ts AS DATE) AS d,
         strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:00') AS hr,
         MAX(value) AS t, MIN(value) AS hm, CAST(COUNT(*) AS DOUBLE) AS p,
         MAX(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS c,
         CAST(SUM(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS DOUBLE) AS r,
         MAX(value) - MIN(value) AS w
  FROM events WHERE event_type = 'view' GROUP BY 1, 2, 3)
SELECT season, match_id, city, match_num, venue, match_date, match_time, team1, team2, venue_id, latitude,
       longitude, CAST(NULL AS VARCHAR) AS datetime, CAST(NULL AS DOUBLE) AS "temp_C",
       CAST(NULL AS DOUBLE) AS "humidity_%", CAST(NULL AS DOUBLE) AS "pressure_hPa",
       CAST(NULL AS DOUBLE) AS "cloudcover_%", CAST(NULL AS DOUBLE) AS rain_mm, CAST(NULL AS DOUBLE) AS wind_m_s
FROM s WHERE value < 10
UNION ALL
SELECT s.season, s.match_id, s.city, s.match_num, s.venue, s.match_date, s.match_time, s.team1, s.team2,
       s.venue_id, s.latitude, s.longitude, h.hr, h.t, h.hm, h.p, h.c, h.r, h.w
FROM s JOIN h ON s.latitude = h.lat AND CAST(s.ts AS DATE) = h.d
             AND strftime(date_trunc('hour', s.ts), '%Y-%m-%dT%H:00') = h.hr
WHERE date_trunc('minute', s.ts) <= TIMESTAMP '{HOURLY_AS_OF}' AND s.value >= 10
""")
def hourly_lookup(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events", row_heavy=True)
    schedule = purchase_schedule(events)
    previous = schedule.where(F.col("value") < 10).select(
        *schemas.SCHEDULE_COLUMNS,
        *[F.lit(None).cast("string" if c == "datetime" else "double").alias(c) for c in schemas.WEATHER_COLUMNS])
    all_rows, _new = weather.enrich_schedule(schedule.drop("value"), view_archive(events), previous,
                                             HOURLY_AS_OF)
    return all_rows


# --------------------------------------------------------------------------- A9 S9 S8 I2
EARLIER, LATER = "2024-01-08 00:00:00", "2024-01-17 00:00:00"


@query("weather_by_season", f"""
WITH s AS (
  SELECT 'D' || (day(ts) // 5)::VARCHAR AS season, event_id::VARCHAR AS match_id, event_type AS city, user_id::VARCHAR AS match_num,
         'V' || (user_id % 4)::VARCHAR AS venue, day(ts)::VARCHAR || '/' || month(ts)::VARCHAR || '/' || year(ts)::VARCHAR AS match_date,
         hour(ts)::VARCHAR || ':' || lpad(minute(ts)::VARCHAR, 2, '0') AS match_time, event_type AS team1, NULL::VARCHAR AS team2,
         (user_id % 4)::BIGINT AS venue_id, (user_id % 4)::DOUBLE AS latitude, 0.0::DOUBLE AS longitude, ts
  FROM events WHERE event_type = 'purchase'),
h AS (
  SELECT (user_id % 4)::DOUBLE AS lat, ts::DATE AS d, strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:00') AS hr, max(value) AS t, min(value) AS hm,
         count(*)::DOUBLE AS p, max(json_extract_string(props, '$.k')::DOUBLE) AS c,
         sum(json_extract_string(props, '$.k')::BIGINT)::DOUBLE AS r, max(value) - min(value) AS w
  FROM events WHERE event_type = 'view' GROUP BY 1, 2, 3)
SELECT season, match_id, city, match_num, venue, match_date, match_time, team1, team2, venue_id, latitude, longitude, hr AS datetime,
       t AS "temp_C", hm AS "humidity_%", p AS "pressure_hPa", c AS "cloudcover_%", r AS rain_mm, w AS wind_m_s,
       CASE WHEN max(date_trunc('minute', ts)) OVER (PARTITION BY season) > TIMESTAMP '{EARLIER}' THEN 2 ELSE 1 END AS written
FROM s JOIN h ON latitude = lat AND ts::DATE = d AND strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:00') = hr
WHERE date_trunc('minute', ts) <= TIMESTAMP '{LATER}'
""")
def weather_by_season(spark: SparkSession, d: str) -> DataFrame:
    """The weather job over five-day seasons, run early and again later:
    ``written`` is the run that wrote a row's season last."""
    base = scratch_dir(spark, "weather_by_season")
    events = table(spark, d, "events")
    schedule = purchase_schedule(events).withColumn(
        "season", F.concat(F.lit("D"), F.floor(F.split("match_date", "/")[0].cast("int") / 5).cast("string")))
    schedule.select(*schemas.SCHEDULE_COLUMNS).write.option("header", True).csv(f"{base}/schedule")
    weather.write_archive(view_archive(events), f"{base}/archive")
    archive = spark.read.schema(schemas.HOURLY_ARCHIVE).parquet(f"{base}/archive")

    def run(as_of: str) -> DataFrame:
        weather.run_weather_job(spark, f"{base}/schedule", archive, f"{base}/out", as_of, layout="seasons")
        out = weather.read_enriched(spark, f"{base}/out")
        return out.select("*", F.col("_metadata.file_modification_time").alias("written"))
    first = run(EARLIER).agg(F.max("written")).first()[0]
    return run(LATER).withColumn("written", F.when(F.col("written") <= F.lit(first), 1).otherwise(2))


# --------------------------------------------------------------------------- S1 S2 S3
@query("file_scan", """
SELECT doc_id, text FROM documents
""")
def file_scan(spark: SparkSession, d: str) -> DataFrame:
    """Documents written one per ``.json`` file (plus a marker file), a folder
    for each task's, scanned back whole, and parsed."""
    root = scratch_dir(spark, "file_scan")
    docs = table(spark, d, "documents", row_heavy=True).select("doc_id", "text")
    # a name of its own for each row, whatever its identifier
    name = F.format_string("%05d/part-%d.json", F.spark_partition_id(), F.monotonically_increasing_id())
    files = docs.select(name.alias("file_name"), F.to_json(F.struct("doc_id", "text")).alias("content"))
    write_files(files, root)
    write_files(spark.createDataFrame([("_SUCCESS", "")], "file_name string, content string").coalesce(1), root)
    files = scan_json_files(spark, root)
    doc = F.from_json("content", "doc_id bigint, text string")
    return files.select(doc["doc_id"].alias("doc_id"), doc["text"].alias("text"))


# --------------------------------------------------------------------------- S11 S13 S14 S15
@query("tables_and_views", """
SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def tables_and_views(spark: SparkSession, d: str) -> DataFrame:
    reg = SourceRegistry(spark, {name: Source(f"{d}/{name}.parquet") for name in ("nation", "region")})
    joined = reg.read("nation").join(reg.read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    stored = materialize_table(joined.select("n_nationkey", "n_name", "r_name"),
                               scratch_dir(spark, "tables_and_views"))
    view = "nation_region"
    materialize_view(stored, view)
    return spark.sql(f"SELECT n_nationkey, n_name, r_name FROM {view}")


# --------------------------------------------------------------------------- S8 S12
@query("seed_csv_roundtrip", """
SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer
""")
def seed_csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark, "seed_csv_roundtrip")
    (table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
     .write.option("header", True).csv(path))
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                           T.StructField("c_acctbal", T.DoubleType()), T.StructField("c_mktsegment", T.StringType())])
    return read_csv(spark, path, schema)


# --------------------------------------------------------------------------- S9 S10
@query("csv_replace", """
SELECT c_custkey, c_name FROM customer
""")
def csv_replace(spark: SparkSession, d: str) -> DataFrame:
    base = scratch_dir(spark, "csv_replace")
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType())])
    c = table(spark, d, "customer")
    building = F.col("c_mktsegment") == "BUILDING"
    write_version(c.where(building).select("c_custkey", "c_name"), base, fmt="csv", header="true")
    previous = read_latest(spark, base, fmt="csv", schema=schema, header="true")
    new = c.where(~building).select("c_custkey", "c_name")
    write_version(previous.unionByName(new), base, fmt="csv", header="true")
    return read_latest(spark, base, fmt="csv", schema=schema, header="true")
