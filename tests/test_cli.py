"""The command-line jobs end to end: files → ingest → weather → build → check."""

import datetime as dt
import json
import os

import fixtures
from matchlake import schemas
from matchlake.__main__ import main


def test_jobs_end_to_end(spark, tmp_dir, capsys):
    base = tmp_dir.replace("file:", "")
    land = f"{base}/land"
    os.makedirs(land)
    for name, doc in fixtures.DOCS.items():
        with open(f"{land}/{name}", "w") as f:
            json.dump(doc, f, indent=2)
    with open(f"{land}/broken.json", "w") as f:
        f.write('{"info": ')
    assert main(["ingest", "--source", land, "--target", f"{base}/raw", "--quarantine", f"{base}/q"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"loaded": 4, "quarantined": 1}

    fixtures.ipl_teams(spark).write.parquet(f"{base}/teams")
    fixtures.players(spark).write.option("header", True).csv(f"{base}/players.csv")
    fixtures.coordinates(spark).write.parquet(f"{base}/coords")
    sched = spark.createDataFrame(
        [("2025", "m1", "Mumbai", "9", "Wankhede Stadium", "5/4/2025", "19:30", "MI", "CSK", 3, 18.9, 72.8),
         ("2025", "m2", "Eden", "10", "Eden Gardens", "5/4/2025", "15:30", "KKR", "MI", 1, 22.5, 88.3)],
        schemas.SCHEDULE)
    sched.write.option("header", True).csv(f"{base}/schedule")
    hours = [f"2025-04-05T{h:02d}:00" for h in range(24)]
    vals = [20.0 + h for h in range(24)]
    spark.createDataFrame([(18.9, 72.8, dt.date(2025, 4, 5), hours, vals, vals, vals, vals, vals, vals)],
                          schemas.HOURLY_ARCHIVE).write.parquet(f"{base}/archive")
    assert main(["weather", "--schedule", f"{base}/schedule", "--archive", f"{base}/archive",
                 "--out", f"{base}/weather", "--as-of", "2025-06-01 00:00:00"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["new"] == 1   # m2: no payload

    assert main(["build", "--raw", f"{base}/raw", "--teams", f"{base}/teams", "--players",
                 f"{base}/players.csv", "--coordinates", f"{base}/coords", "--weather", f"{base}/weather",
                 "--out", f"{base}/models"]) == 0
    sched_out = spark.read.parquet(f"{base}/models/ipl_schedule").collect()
    assert [(r["match_id"], r["temp_c"]) for r in sched_out] == [("m1", 39.0)]
    assert spark.read.parquet(f"{base}/models/points_table").count() == 7
    assert spark.read.parquet(f"{base}/models/innings_summary").count() == 2
    assert main(["check", "--raw", f"{base}/raw"]) == 0
    stored = {n for n in os.listdir(f"{base}/models")}
    assert {"stg_cricket_match", "stg_match_info", "stg_match_innings", "stg_ipl_teams", "stg_players_info",
            "stg_stadium_coordinates", "stg_weather_info", "int_match_info", "int_match_innings", "int_teams",
            "int_stadiums_info", "int_weather_info", "points_table", "innings_summary", "ipl_schedule", "match_ids"} <= stored
    # the shop models are missing, so their checks cannot run
    assert main(["check", "--raw", f"{base}/raw", "--models", f"{base}/models"]) == 1
    spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], "id long, first_name string, last_name string").write.parquet(f"{base}/cust")
    spark.createDataFrame([(7, 1, dt.date(2024, 1, 1), "placed")], "id long, user_id long, order_date date, status string") \
         .write.parquet(f"{base}/orders")
    assert main(["build", "--raw", f"{base}/raw", "--teams", f"{base}/teams", "--players",
                 f"{base}/players.csv", "--coordinates", f"{base}/coords", "--weather", f"{base}/weather",
                 "--out", f"{base}/models2", "--customers", f"{base}/cust", "--orders", f"{base}/orders"]) == 0
    capsys.readouterr()
    assert main(["check", "--raw", f"{base}/raw", "--models", f"{base}/models2"]) == 0
    assert len(json.loads(capsys.readouterr().out.strip().splitlines()[-1])) == 10


def test_stream_job_twice(spark, tmp_dir):
    base = tmp_dir.replace("file:", "")
    land = f"{base}/land"
    os.makedirs(land)
    for name, doc in fixtures.DOCS.items():
        with open(f"{land}/{name}", "w") as f:
            json.dump(doc, f)
    args = ["stream", "--source", land, "--target", f"{base}/raw", "--quarantine", f"{base}/q",
            "--checkpoint", f"{base}/ck", "--max-files-per-trigger", "2"]
    assert main(args) == 0
    assert main(args) == 0                      # nothing new: no second copy
    assert spark.read.parquet(f"{base}/raw").count() == 4
