"""End-to-end build over hand-written match documents (FIXTURES §3 cases)."""

import datetime as dt

import pytest

import fixtures
from matchlake.plans.build import Sources, build


@pytest.fixture(scope="module")
def models(spark):
    from matchlake.session import scratch_dir

    src = Sources(fixtures.raw_documents(spark), fixtures.ipl_teams(spark), fixtures.players(spark),
                  fixtures.coordinates(spark), fixtures.weather_info(spark))
    return build(spark, src, out_dir=scratch_dir(spark, "model_build"))


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_match_info_header(models):
    mi = {r["filename"]: r for r in models["stg_match_info"].collect()}
    assert len(mi) == 4
    assert mi["m1.json"]["margin"] == "10 runs" and mi["m2.json"]["margin"] == "5 wickets"
    assert mi["m3.json"]["margin"] == "no result" and mi["m4.json"]["margin"] == "no result"
    assert mi["m1.json"]["match_number"] == "9" and mi["m1.json"]["match_date"] == dt.date(2025, 4, 5)
    assert mi["m3.json"]["playoff_stage"] == "Final" and mi["m3.json"]["match_winner"] is None
    assert mi["m1.json"]["pom"] == "Bat C" and mi["m2.json"]["team2"] == "MI"


def test_day_slots_and_cleaning(models):
    imi = {r["match_id"]: r for r in models["int_match_info"].collect()}
    assert imi["m1"]["matches_per_day"] == 2 and imi["m2"]["matches_per_day"] == 2
    assert (imi["m2"]["match_order"], imi["m2"]["match_time"]) == (1, "15:30")   # '10' < '9'
    assert (imi["m1"]["match_order"], imi["m1"]["match_time"]) == (2, "19:30")
    assert imi["m4"]["match_time"] == "19:30"
    assert (imi["m2"]["city_cleaned"], imi["m2"]["venue_cleaned"]) == ("Eden", "Eden Gardens")
    assert imi["m3"]["flag_playoffs"] == "playoffs" and imi["m1"]["flag_playoffs"] == "league match"
    assert {k: v["venue_id"] for k, v in imi.items()} == {"m1": 3, "m2": 1, "m3": 3, "m4": 2}
    assert len(models["int_match_info"].columns) == 26


def test_deliveries(models):
    inn = models["stg_match_innings"]
    assert inn.count() == 8                      # m2 (no overs) and m3 (no innings) give none
    r = {(x["inning_id"], x["over_number"], x["ball_in_over"]): x for x in inn.collect()}
    assert r[(1, 1, 1)]["runs_batter"] == 1      # "1" given as text
    assert r[(1, 1, 2)]["extra_type"] == "wides"
    assert r[(1, 1, 4)]["extra_type"] == "legbyes"   # {noballs, legbyes} → first sorted key
    assert r[(1, 7, 2)]["extra_type"] is None        # empty extras
    assert (r[(1, 7, 1)]["dismissal_kind"], r[(1, 7, 1)]["out_player"]) == ("run out", "Bat A")
    assert (r[(1, 1, 1)]["powerplays_start_over"], r[(1, 1, 1)]["powerplays_end_over"]) == (1.0, 6.0)
    assert r[(1, 1, 1)]["is_powerplay"] == 1 and r[(1, 7, 1)]["is_powerplay"] == 0
    assert (r[(2, 1, 1)]["powerplays_start_over"], r[(2, 1, 1)]["is_powerplay"]) == (1.0, 1)  # T20 seed


def test_points_table(models):
    got = rows(models["points_table"], "season", "team", "matches_played", "wins", "losses",
               "no_results", "points", "team_id")
    assert got == sorted([
        ("2025", "MI", 2, 1, 1, 0, 2, 1), ("2025", "CSK", 1, 0, 1, 0, 0, 2),
        ("2025", "KKR", 1, 1, 0, 0, 2, 3), ("2025", "KKR", 1, 1, 0, 0, 2, 33),   # team listed twice
        ("2024", "CSK", 1, 0, 0, 1, 1, 2), ("2024", "KKR", 1, 0, 0, 1, 1, 3),
        ("2024", "KKR", 1, 0, 0, 1, 1, 33),
    ])


def test_innings_summary(models):
    s = {r["inning_id"]: r for r in models["innings_summary"].collect()}
    assert set(s) == {1, 2}
    one, two = s[1], s[2]
    assert (one["inning_total"], one["total_wickets"]) == (13, 1)
    assert (one["top_batter"], one["top_batter_runs"], one["top_batter_balls"]) == ("Bat C", 5, 1)
    assert (one["second_batter"], one["second_batter_runs"], one["second_batter_balls"]) == ("Bat B", 4, 2)
    assert (one["top_bowler"], one["top_bowler_wickets"], one["top_bowler_runs_conceded"],
            one["top_bowler_balls"]) == ("Bowl Y", 1, 5, 2)
    assert (one["second_bowler"], one["second_bowler_runs_conceded"], one["second_bowler_balls"]) == \
        ("Bowl X", 8, 3)                           # the wide is not a legal ball
    assert (two["top_batter"], two["second_batter"]) == ("Bat D", "Bat E")   # tie → lower name
    assert two["second_bowler"] is None and two["second_bowler_wickets"] is None
    assert one["season"] == "2025" and one["margin"] == "10 runs"
    assert len(models["innings_summary"].columns) == 29


def test_stadiums_schedule_and_listing(models):
    st = rows(models["int_stadiums_info"], "venue_id", "city_cleaned", "venue_cleaned")
    assert st == [(1, "Eden", "Eden Gardens"), (2, "Chennai", "MA Chidambaram Stadium"),
                  (3, "Bombay", "Wankhede Stadium"), (3, "Mumbai", "Wankhede Stadium")]
    sched = {r["match_id"]: r for r in models["ipl_schedule"].collect()}
    assert set(sched) == {"m1", "m2", "m4"}      # no weather for m3
    assert sched["m1"]["latitude"] == 18.9 and sched["m1"]["temp_c"] == 30.0
    ids = [r["match_id"] for r in models["match_ids"].collect()]
    assert ids == ["m1", "m2", "m3"]             # by date, then match number desc as text: "9" > "10"


def test_teams_and_players(models):
    assert rows(models["int_teams"], "team_name", "team_id") == [
        ("CSK", 2), ("KKR", 3), ("KKR", 33), ("MI", 1)]
    p = {r["player_name"]: r["last_name"] for r in models["stg_players_info"].collect()}
    assert p == {"Virat Kohli": "Kohli", "Dhoni": None, "AB de Villiers": "de Villiers"}
