"""Weather enrichment: parse, cut-off, skip-and-retry, lookup by hour."""

import datetime as dt

from matchlake import schemas
from matchlake.plans.weather import enrich_schedule, run_weather_job
from matchlake.sources import read_latest


def schedule(spark):
    rows = [
        ("2025", "1", "Mumbai", "1", "Wankhede", "5/4/2025", "19:30", "MI", "CSK", 3, 18.9, 72.8),
        ("2025", "2", "Kolkata", "2", "Eden", "6/4/2025", "15:30", "KKR", "MI", 1, 22.5, 88.3),
        ("2025", "3", "Mumbai", "3", "Wankhede", "7/4/2025", "19:30", "MI", "KKR", 3, 18.9, 72.8),
        ("2025", "4", "Mumbai", "4", "Wankhede", "30/5/2025", "19:30", "MI", "KKR", 3, 18.9, 72.8),
    ]
    return spark.createDataFrame(rows, schemas.SCHEDULE)


def archive(spark, with_day_three=False):
    hours = [f"2025-04-05T{h:02d}:00" for h in range(24)]
    vals = [float(h) for h in range(24)]
    rows = [(18.9, 72.8, dt.date(2025, 4, 5), hours, vals, vals, vals, vals, vals, vals),
            (22.5, 88.3, dt.date(2025, 4, 6), ["2025-04-06T10:00"], [1.0], [1.0], [1.0], [1.0], [1.0], [1.0])]
    if with_day_three:
        rows.append((18.9, 72.8, dt.date(2025, 4, 7), ["2025-04-07T19:00"], [9.0] * 1, [9.0], [9.0], [9.0],
                     [9.0], [9.0]))
    return spark.createDataFrame(rows, schemas.HOURLY_ARCHIVE)


def empty_previous(spark):
    from pyspark.sql import types as T

    return spark.createDataFrame([], T.StructType([f for f in schemas.WEATHER_INFO.fields
                                                   if f.name != "total_views"]))


def test_enrich_skips_and_looks_up(spark):
    all_rows, new = enrich_schedule(schedule(spark), archive(spark), empty_previous(spark), "2025-05-01 00:00:00")
    got = {r["match_id"]: r for r in new.collect()}
    assert set(got) == {"1"}          # 2: hour missing, 3: no payload, 4: after as_of
    assert got["1"]["datetime"] == "2025-04-05T19:00" and got["1"]["temp_C"] == 19.0
    assert all_rows.columns == schemas.SCHEDULE_COLUMNS + schemas.WEATHER_COLUMNS


def test_job_versions_and_retries(spark, tmp_dir):
    base = tmp_dir.replace("file:", "")
    sched_path, out = f"{base}/schedule", f"{base}/enriched"
    schedule(spark).write.option("header", True).csv(sched_path)
    first = run_weather_job(spark, sched_path, archive(spark), out, as_of="2025-05-01 00:00:00")
    assert first["new"] == 1 and first["per_season"] == {"2025": 1}
    second = run_weather_job(spark, sched_path, archive(spark, with_day_three=True), out,
                             as_of="2025-05-01 00:00:00")
    assert second["new"] == 1        # match 3 picked up once its payload exists
    third = run_weather_job(spark, sched_path, archive(spark, with_day_three=True), out,
                            as_of="2025-05-01 00:00:00")
    assert third["new"] == 0
    from pyspark.sql import types as T
    schema = T.StructType([f for f in schemas.WEATHER_INFO.fields if f.name != "total_views"])
    latest = read_latest(spark, out, fmt="csv", schema=schema, header="true")
    assert sorted(r["match_id"] for r in latest.collect()) == ["1", "3"]


def test_newest_committed_version(spark, tmp_dir):
    import os

    import pytest

    from matchlake.sources import write_version

    base = tmp_dir.replace("file:", "") + "/v"
    rows = spark.createDataFrame([(1,), (2,), (3,)], "x long")
    write_version(rows, base, version="1")
    assert read_latest(spark, base).count() == 3
    write_version(rows.limit(0), base, version="2")
    assert read_latest(spark, base).count() == 0            # replaced by an empty table
    write_version(rows.limit(1), base, version="3")
    os.remove(f"{base}/_version=3/_SUCCESS")
    assert read_latest(spark, base).count() == 0            # unfinished
    os.remove(f"{base}/_version=2/_SUCCESS")
    os.remove(f"{base}/_version=1/_SUCCESS")
    with pytest.raises(FileNotFoundError):
        read_latest(spark, base)
    assert read_latest(spark, base, schema=rows.schema).count() == 0


def test_job_evaluates_the_archive_once(spark, tmp_dir):
    base = tmp_dir.replace("file:", "")
    schedule(spark).write.option("header", True).csv(f"{base}/s")
    seen = spark.sparkContext.accumulator(0)

    watched = archive(spark).mapInArrow(lambda it: (b for b in it if not seen.add(b.num_rows)), schemas.HOURLY_ARCHIVE)
    run_weather_job(spark, f"{base}/s", watched, f"{base}/o", as_of="2025-05-01 00:00:00")
    assert seen.value == 2


def test_job_replaces_only_the_seasons_it_has_rows_for(spark, tmp_dir):
    import os

    import pytest
    from pyspark.sql import functions as F

    from matchlake.plans.weather import read_enriched

    base = tmp_dir.replace("file:", "")
    sched, out = f"{base}/schedule", f"{base}/by_season"
    rows = schedule(spark).withColumn("season", F.when(F.col("match_id") == "3", "2026").otherwise(F.col("season")))
    with pytest.raises(FileNotFoundError):                      # no schedule: an error
        run_weather_job(spark, sched, archive(spark), out, layout="seasons")
    rows.write.option("header", True).csv(sched)
    assert read_enriched(spark, out).count() == 0               # no output yet: empty
    first = run_weather_job(spark, sched, archive(spark), out, as_of="2025-05-01 00:00:00", layout="seasons")
    assert first == {"new": 1, "per_season": {"2025": 1}}

    def files(season):
        return {f: os.stat(f"{out}/season={season}/{f}").st_mtime_ns for f in os.listdir(f"{out}/season={season}")}
    kept = files("2025")
    second = run_weather_job(spark, sched, archive(spark, with_day_three=True), out, as_of="2025-05-01 00:00:00", layout="seasons")
    assert second == {"new": 1, "per_season": {"2026": 1}}
    assert files("2025") == kept                                # the other season's files were not touched
    assert run_weather_job(spark, sched, archive(spark, with_day_three=True), out, as_of="2025-05-01 00:00:00", layout="seasons")["new"] == 0
    got = read_enriched(spark, out)
    assert got.columns == schemas.SCHEDULE_COLUMNS + schemas.WEATHER_COLUMNS
    assert sorted((r["match_id"], r["season"], r["temp_C"]) for r in got.collect()) == [("1", "2025", 19.0), ("3", "2026", 9.0)]
    # a season that gets more rows keeps those it had
    more = archive(spark, with_day_three=True).unionByName(spark.createDataFrame(
        [(22.5, 88.3, dt.date(2025, 4, 6), ["2025-04-06T15:00"], *[[5.0]] * 6)], schemas.HOURLY_ARCHIVE))
    assert run_weather_job(spark, sched, more, out, as_of="2025-05-01 00:00:00", layout="seasons")["per_season"] == {"2025": 1}
    assert sorted(r["match_id"] for r in read_enriched(spark, out).collect()) == ["1", "2", "3"]


def test_only_the_days_asked_for_are_opened(spark, tmp_dir):
    """The archive's other days hold garbage: opening one would fail."""
    import os

    from pyspark.sql import functions as F

    from matchlake.plans.weather import days_of, matches_to_do, write_archive
    from matchlake.sources import materialize_table

    base = tmp_dir.replace("file:", "") + "/archive"
    days = archive(spark, with_day_three=True)
    other = days.limit(1).withColumn("date", F.explode(F.sequence(F.lit("2024-01-01").cast("date"), F.lit("2024-01-09").cast("date"))))
    write_archive(days.unionByName(other), base)
    for day in range(1, 10):
        folder = f"{base}/date=2024-01-{day:02d}"
        for name in os.listdir(folder):
            if name.endswith(".parquet"):
                with open(f"{folder}/{name}", "wb") as f:
                    f.write(b"not parquet")
            elif name.endswith(".crc"):
                os.remove(f"{folder}/{name}")
    stored = spark.read.schema(schemas.HOURLY_ARCHIVE).parquet(base)
    schedule(spark).write.option("header", True).csv(f"{base}-schedule")
    todo = materialize_table(matches_to_do(schedule(spark), empty_previous(spark), "2025-05-01 00:00:00"), f"{base}-todo")
    needed = stored.join(F.broadcast(days_of(todo, "2025-05-01 00:00:00")), "date", "left_semi")
    assert needed.count() == 3
    plan = needed._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression(date" in plan
    report = run_weather_job(spark, f"{base}-schedule", stored, f"{base}-out", as_of="2025-05-01 00:00:00")
    assert report["new"] == 2


def test_versions_are_kept_for_their_readers(spark, tmp_dir):
    from matchlake.sources import collect_versions, open_latest, write_version

    base = tmp_dir.replace("file:", "") + "/kept"
    rows = spark.range(100)
    write_version(rows, base, version="1")
    with open_latest(spark, base) as old:
        for v in ("2", "3"):
            write_version(rows.limit(int(v)), base, version=v)
        assert collect_versions(spark, base, keep=1) == ["2"]           # 1 has a reader, 3 is the newest
        assert old.count() == 100 and read_latest(spark, base).count() == 3
    assert collect_versions(spark, base, keep=1) == ["1"]
    with open_latest(spark, base, lease_seconds=-1) as late:             # a reader that outlived its lease
        write_version(rows, base, version="4")
        assert late.count() == 3 and collect_versions(spark, base, keep=1) == ["3"]
    import os
    os.remove(f"{base}/_version=4/_SUCCESS")
    assert collect_versions(spark, base) == []                          # an unfinished writer has its time
    assert collect_versions(spark, base, grace_seconds=-1) == ["4"]
    with open_latest(spark, base, schema=rows.schema) as none:
        assert none.count() == 0


def test_reader_goes_on_when_its_version_is_doomed(spark, tmp_dir, monkeypatch):
    """A collector that marks the version between the reader's choice and its lease."""
    from matchlake.sources import open_latest, sinks, write_version

    base = tmp_dir.replace("file:", "") + "/race"
    write_version(spark.range(1), base, version="1")
    real, steps = sinks._Folder.mark, []

    def mark(self, name):
        if name.startswith("_leases") and not steps:
            steps.append(name)
            write_version(spark.range(2), base, version="2")
            real(self, f"{sinks.DOOMED}/1")
        real(self, name)
    monkeypatch.setattr(sinks._Folder, "mark", mark)
    with open_latest(spark, base) as df:
        assert df.count() == 2
