"""Intermediate models on header rows (FIXTURES §3 cases 16 and 18)."""

import datetime as dt

from pyspark.sql import types as T

from matchlake.plans import intermediate, marts

COLS = ["match_type", "gender", "season", "city", "venue", "match_number", "playoff_stage", "match_date",
        "team1", "team2", "toss_winner", "toss_decision", "match_winner", "margin", "event_name",
        "event_type", "pom", "filename"]
SCHEMA = T.StructType([T.StructField(c, T.DateType() if c == "match_date" else T.StringType()) for c in COLS])


def header(city, venue, number, stage, day, name):
    return ("T20", "male", "2025", city, venue, number, stage, day, "A", "B", "A", "bat", "A", "1 runs",
            "IPL", "club", "P", name)


def test_null_venue_and_playoff(spark):
    rows = [header("Pune", None, "1", None, dt.date(2025, 4, 1), "a.json"),
            header(None, "Eden Gardens, Kolkata", None, "Final", dt.date(2025, 5, 1), "b.json"),
            header("Delhi", "Kotla", "2", None, dt.date(2025, 4, 2), "c.json")]
    smi = spark.createDataFrame(rows, SCHEMA)
    imi = {r["match_id"]: r for r in intermediate.int_match_info(smi).collect()}
    assert imi["a"]["venue_id"] is None                     # NULL never joins the venue map
    assert (imi["b"]["venue_id"], imi["c"]["venue_id"]) == (2, 3)   # the NULL key still took rank 1
    coords = spark.createDataFrame([(1, "x", "x", 1.0, 2.0), (2, "y", "y", 3.0, 4.0)],
                                   "venue_id long, city_cleaned string, venue_cleaned string, "
                                   "latitude double, longitude double")
    stadiums = sorted(tuple(r) for r in intermediate.int_stadiums_info(smi, coords).collect())
    assert stadiums[0][:3] == (1, "Pune", None)             # rank 1 for the NULL venue, kept by the join
    assert stadiums[1][:3] == (2, "Eden", "Eden Gardens")
    base = {r["match_id"]: r for r in marts.schedule_base(intermediate.int_match_info(smi),
                                                           intermediate.int_stadiums_info(smi, coords)).collect()}
    assert base["b"]["match_num"] == "Final" and base["b"]["latitude"] == 3.0
    assert base["a"]["latitude"] is None
