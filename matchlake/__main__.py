"""Command line: ``python -m matchlake <job> ...`` (or ``spark-submit`` this module).

Jobs
  ingest   land new JSON files from a folder into the raw table (batch)
  stream   the same as an available-now stream with a checkpoint
  build    build every model from the raw table and the dimension tables
  weather  enrich the schedule with the weather at the start hour
  check    run the models' declared column tests on a build's output
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    """A dimension source: CSV with a header (by extension) or Parquet."""
    if path.lower().endswith(".csv"):
        return spark.read.schema(schema).option("header", True).csv(path)
    return spark.read.schema(schema).parquet(path)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="matchlake", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    sub = p.add_subparsers(dest="job", required=True)

    ing = sub.add_parser("ingest")
    ing.add_argument("--source", required=True)
    ing.add_argument("--target", required=True)
    ing.add_argument("--quarantine", required=True)

    st = sub.add_parser("stream")
    st.add_argument("--source", required=True)
    st.add_argument("--target", required=True)
    st.add_argument("--quarantine", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--max-files-per-trigger", type=int, default=75)

    b = sub.add_parser("build")
    b.add_argument("--raw", required=True, help="raw documents table (Parquet)")
    b.add_argument("--teams", required=True)
    b.add_argument("--players", required=True)
    b.add_argument("--coordinates", required=True)
    b.add_argument("--weather", required=True, help="weather job output folder")
    b.add_argument("--out", required=True)
    b.add_argument("--season", default="2025")
    b.add_argument("--customers", help="shop customers (id, first_name, last_name): also builds the shop models")
    b.add_argument("--orders", help="shop orders (id, user_id, order_date, status)")

    w = sub.add_parser("weather")
    w.add_argument("--schedule", required=True, help="schedule CSV")
    w.add_argument("--archive", required=True, help="hourly archive table (Parquet)")
    w.add_argument("--out", required=True)
    w.add_argument("--layout", choices=["versions", "seasons"], default="versions",
                   help="write the whole output as a new version, or replace the seasons with new rows")
    w.add_argument("--as-of", default=None, help="cut-off 'YYYY-MM-DD HH:MM:SS' (default: now, local time)")

    c = sub.add_parser("check")
    c.add_argument("--raw", required=True)
    c.add_argument("--models", help="folder of a build's output; all declared checks must then be able to run")

    a = p.parse_args(argv)

    from matchlake import schemas
    from matchlake.session import get_spark

    spark = get_spark(a.master)
    if a.job == "ingest":
        from matchlake.plans.ingest import ingest_files

        r = ingest_files(spark, a.source, a.target, a.quarantine)
        print(json.dumps({"loaded": r.loaded, "quarantined": r.quarantined}))
    elif a.job == "stream":
        from matchlake.streaming import ingest_stream, json_file_stream

        r = ingest_stream(spark, json_file_stream(spark, a.source, max_files_per_trigger=a.max_files_per_trigger),
                          a.target, a.quarantine, a.checkpoint)
        print(json.dumps({"loaded": r.loaded, "quarantined": r.quarantined}))
    elif a.job == "build":
        from matchlake.plans.build import Sources, build
        from matchlake.plans.weather import read_enriched

        from pyspark.sql import functions as F

        # the weather job writes no view counts; the staging model still lists the column
        weather = read_enriched(spark, a.weather).withColumn("total_views", F.lit(None).cast("bigint"))
        src = Sources(spark.read.schema(schemas.RAW_DOCUMENTS).parquet(a.raw),
                      _read(spark, a.teams, schemas.IPL_TEAMS), _read(spark, a.players, schemas.PLAYERS_INFO),
                      _read(spark, a.coordinates, schemas.STADIUM_COORDINATES), weather)
        models = build(spark, src, out_dir=a.out, season=a.season)
        for name in ("innings_summary", "match_ids"):
            models[name].write.mode("overwrite").parquet(f"{a.out}/{name}")
        if a.customers and a.orders:
            from matchlake.plans import shop
            from matchlake.sources import materialize_table

            customers = materialize_table(shop.stg_customers(spark.read.parquet(a.customers)), f"{a.out}/stg_customers")
            orders = materialize_table(shop.stg_orders(spark.read.parquet(a.orders)), f"{a.out}/stg_orders")
            materialize_table(shop.customers(customers, shop.stg_customer_orders(orders)), f"{a.out}/customers")
        print(json.dumps({"out": a.out, "models": sorted(models)}))
    elif a.job == "weather":
        from matchlake.plans.weather import run_weather_job

        archive = spark.read.schema(schemas.HOURLY_ARCHIVE).parquet(a.archive)
        print(json.dumps(run_weather_job(spark, a.schedule, archive, a.out, a.as_of, a.layout)))
    elif a.job == "check":
        from matchlake.plans.checks import DECLARED_CHECKS, check_summary
        from matchlake.plans.staging import stg_cricket_match
        from matchlake.sources import path_exists

        models = {"stg_cricket_match": stg_cricket_match(
            spark.read.schema(schemas.RAW_DOCUMENTS).parquet(a.raw))}
        checks = [x for x in DECLARED_CHECKS if a.models or x.model in models]
        for name in {x.model for x in checks} - set(models):
            if path_exists(spark, f"{a.models}/{name}"):
                models[name] = spark.read.parquet(f"{a.models}/{name}")
        rows = {r["check"]: r["failures"] for r in check_summary(spark, models, checks).collect()}
        print(json.dumps(rows))             # null: the model is missing, so the check did not run
        return 0 if all(n == 0 for n in rows.values()) else 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
