"""Weather enrichment: the weather at each match's start hour, from an hourly
archive table (one row per place and day with parallel hourly arrays).

Matches after ``as_of``, matches already enriched, and matches whose place,
day or hour is missing from the archive are left out now and picked up by a
later run once the data is there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake import schemas
from matchlake.functions import hour_iso, parse_dmy_hm
from matchlake.operators import anti_new, broadcast_if_small
from matchlake.session import scratch_dir
from matchlake.sources import (
    checkpoint_reliably, has_partitions, materialize_table, path_exists, read_csv, read_latest, replace_partitions, write_version,
)
from matchlake import constants as C

OUTPUT_COLUMNS = schemas.SCHEDULE_COLUMNS + schemas.WEATHER_COLUMNS
MEASURE_NAMES = dict(zip(schemas.HOURLY_VARIABLES, schemas.WEATHER_COLUMNS[1:]))
PLACE_DAY = ["latitude", "longitude", "date"]
# Columns of the enriched schedule the job writes (the weather table without view counts).
OUTPUT_SCHEMA = T.StructType([f for f in schemas.WEATHER_INFO.fields if f.name != "total_views"])


def now_local(tz: str = C.SCHEDULE_TIME_ZONE) -> Column:
    """Current wall-clock time at the matches' place, as a naive datetime."""
    return F.from_utc_timestamp(F.current_timestamp(), tz).cast("timestamp_ntz")


def hourly_points(archive: DataFrame) -> DataFrame:
    """One row per (place, day, hour) with the measures renamed to the output
    columns; when an hour is listed twice the first position wins."""
    z = archive.select(*PLACE_DAY, F.posexplode(F.arrays_zip("time", *schemas.HOURLY_VARIABLES)).alias("pos", "h"))
    first = F.min(F.struct("pos", *[F.col("h")[v].alias(v) for v in schemas.HOURLY_VARIABLES]))
    g = z.groupBy(*PLACE_DAY, F.col("h.time").alias("datetime")).agg(first.alias("m"))
    return g.select(*PLACE_DAY, "datetime",
                    *[F.col("m")[v].alias(out) for v, out in MEASURE_NAMES.items()])


def cutoff(as_of: Column | str | None) -> Column:
    return now_local() if as_of is None else (F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of)


def matches_to_do(schedule: DataFrame, previous: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    """Matches up to ``as_of`` that are not enriched yet, with the day and hour to look up."""
    sched = schedule.withColumn("dt_obj", parse_dmy_hm("match_date", "match_time"))
    past = sched.where(F.col("dt_obj") <= cutoff(as_of))
    done = previous.select(F.col("match_id").cast("string").alias("__mid"))
    todo = anti_new(past.withColumn("__mid", F.col("match_id").cast("string")), done, "__mid")
    return todo.withColumn("datetime", hour_iso("dt_obj")).withColumn("date", F.to_date("dt_obj")).drop("dt_obj", "__mid")


def look_up(todo: DataFrame, archive: DataFrame) -> DataFrame:
    """The matches whose place, day and hour the archive has, with its measures;
    only the places and days asked for are exploded into hours."""
    wanted = broadcast_if_small(todo.select(*PLACE_DAY).distinct())
    points = hourly_points(archive.join(wanted, PLACE_DAY, "left_semi"))
    return todo.join(points, [*PLACE_DAY, "datetime"], "inner").select(*OUTPUT_COLUMNS)


def enrich_schedule(schedule: DataFrame, archive: DataFrame, previous: DataFrame,
                    as_of: Column | str | None = None) -> tuple[DataFrame, DataFrame]:
    """(all rows, new rows): previous rows plus the newly enriched matches,
    in the fixed output column order."""
    new_rows = look_up(matches_to_do(schedule, previous, as_of), archive)
    return with_previous(previous, new_rows), new_rows


def days_of(todo: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    """The days of a to-do list, stored: at most a calendar's worth of rows.  Its
    bound lets Spark prune an archive partitioned by day while the join runs."""
    days = materialize_table(todo.select("date").distinct(), scratch_dir(todo.sparkSession, "days"))
    return days.where(F.col("date") <= F.to_date(cutoff(as_of)))


def with_previous(previous: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Previous rows, then the new ones, in the fixed output column order."""
    return (previous.select(*[c for c in OUTPUT_COLUMNS if c in previous.columns])
            .unionByName(new_rows, allowMissingColumns=True)
            .select(*OUTPUT_COLUMNS))


def write_archive(archive: DataFrame, path: str) -> None:
    """The hourly archive partitioned by day, so that a lookup opens the days it
    needs only: the to-do list prunes the partitions while the join runs."""
    archive.repartition("date").write.mode("append").partitionBy("date").parquet(path)


def read_enriched(spark: SparkSession, output_base: str) -> DataFrame:
    """The enriched schedule the job has written, whichever its layout; empty before the first run."""
    if not path_exists(spark, output_base):
        return spark.createDataFrame([], OUTPUT_SCHEMA)
    if has_partitions(spark, output_base, "season"):
        return spark.read.schema(OUTPUT_SCHEMA).option("header", True).csv(output_base).select(*OUTPUT_COLUMNS)
    return read_latest(spark, output_base, fmt="csv", schema=OUTPUT_SCHEMA, header="true")


def run_weather_job(spark: SparkSession, schedule_csv: str, archive: DataFrame, output_base: str,
                    as_of: str | None = None, layout: str = "versions") -> dict:
    """Read the schedule (required) and the previous output (optional), enrich,
    and write CSV when anything new was found.

    ``layout``: ``versions`` writes the whole output as a new version; with
    ``seasons`` the output is partitioned by season and only the seasons that
    have new rows are replaced.  Should a replacement be broken off, its matches
    count as new again on the next run.
    """
    schedule = read_csv(spark, schedule_csv, schemas.SCHEDULE, missing="error")
    previous = read_enriched(spark, output_base)
    # the to-do list and the new rows are pinned before anything is counted or written: one evaluation, one clock
    todo = materialize_table(matches_to_do(schedule, previous, as_of), scratch_dir(spark, "todo"))
    needed = archive.join(F.broadcast(days_of(todo, as_of)), "date", "left_semi")
    new_rows = checkpoint_reliably(look_up(todo, needed))
    per_season = {r["season"]: r["count"] for r in new_rows.groupBy("season").count().collect()}
    if not per_season:
        return {"new": 0, "per_season": {}}
    report = {"new": sum(per_season.values()), "per_season": per_season}
    if layout == "seasons":
        touched = F.col("season").isin([s for s in per_season if s is not None])
        touched = F.coalesce(touched | F.lit(None in per_season) & F.col("season").isNull(), F.lit(False))
        replace_partitions(with_previous(previous.where(touched), new_rows), output_base, "season", fmt="csv", header="true")
        return report
    return report | {"version": write_version(with_previous(previous, new_rows), output_base, fmt="csv", header="true")}
