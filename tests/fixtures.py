"""Hand-written match documents and dimensions (the reference ships none)."""

import datetime as dt
import json

from matchlake import schemas


def d(batter, bowler, runs, extras=None, wickets=None, non_striker="NS"):
    out = {"batter": batter, "bowler": bowler, "non_striker": non_striker, "runs": runs}
    if extras is not None:
        out["extras"] = extras
    if wickets is not None:
        out["wickets"] = wickets
    return out


M1 = {  # two innings, wides, no-ball+leg-bye, two wickets on one ball, tie between batters
    "info": {
        "match_type": "T20", "gender": "male", "season": "2025", "city": "Mumbai",
        "venue": "Wankhede Stadium, Mumbai", "team_type": "club", "dates": ["2025-04-05"],
        "teams": ["MI", "CSK"], "player_of_match": ["Bat C"],
        "event": {"name": "IPL", "match_number": 9},
        "toss": {"winner": "MI", "decision": "bat"},
        "outcome": {"winner": "MI", "by": {"runs": 10}},
    },
    "innings": [
        {"team": "MI", "powerplays": [{"from": 0.1, "to": 5.6}], "overs": [
            {"over": 0, "deliveries": [
                d("Bat A", "Bowl X", {"batter": "1", "extras": 0, "total": 1}),
                d("Bat A", "Bowl X", {"batter": 0, "extras": 2, "total": 2}, extras={"wides": 2}),
                d("Bat B", "Bowl X", {"batter": 4, "extras": 0, "total": 4}),
                d("Bat B", "Bowl X", {"batter": 0, "extras": 1, "total": 1},
                  extras={"noballs": 1, "legbyes": 1}),
            ]},
            {"over": 6, "deliveries": [
                d("Bat A", "Bowl Y", {"batter": 0, "extras": 0, "total": 0},
                  wickets=[{"kind": "run out", "player_out": "Bat A"},
                           {"kind": "caught", "player_out": "Bat B"}]),
                d("Bat C", "Bowl Y", {"batter": 5, "extras": 0, "total": 5}, extras={}),
            ]},
        ]},
        {"team": "CSK", "overs": [
            {"over": 0, "deliveries": [
                d("Bat E", "Bowl Z", {"batter": 2, "extras": 0, "total": 2}),
                d("Bat D", "Bowl Z", {"batter": 2, "extras": 0, "total": 2}),
            ]},
        ]},
    ],
}
M2 = {  # same day as M1, match number '10' sorts before '9'; no city; innings without overs
    "info": {
        "match_type": "T20", "gender": "male", "season": "2025",
        "venue": "Eden Gardens, Kolkata", "team_type": "club", "dates": ["2025-04-05"],
        "teams": ["KKR", "MI"], "player_of_match": ["Bat K"],
        "event": {"name": "IPL", "match_number": "10"},
        "toss": {"winner": "KKR", "decision": "field"},
        "outcome": {"winner": "KKR", "by": {"wickets": 5}},
    },
    "innings": [{"team": "KKR"}],
}
M3 = {  # playoff (stage, no number), tie, no innings at all; same venue under another city
    "info": {
        "match_type": "T20", "gender": "male", "season": "2025", "city": "Bombay",
        "venue": "Wankhede Stadium, Mumbai", "team_type": "club", "dates": ["2025-05-25"],
        "teams": ["MI", "KKR"], "event": {"name": "IPL", "stage": "Final"},
        "toss": {"winner": "KKR", "decision": "bat"}, "outcome": {"result": "tie"},
    },
}
M4 = {  # other season, no result
    "info": {
        "match_type": "ODI", "gender": "male", "season": "2024", "city": "Chennai",
        "venue": "MA Chidambaram Stadium, Chennai", "team_type": "club", "dates": ["2024-04-01"],
        "teams": ["CSK", "KKR"], "event": {"name": "IPL", "match_number": "1"},
        "toss": {"winner": "CSK", "decision": "bat"}, "outcome": {"result": "no result"},
    },
}
DOCS = {"m1.json": M1, "m2.json": M2, "m3.json": M3, "m4.json": M4}
TS = dt.datetime(2025, 6, 1, 12, 0, 0)


def raw_documents(spark):
    rows = [(name, json.dumps(doc, indent=1), TS) for name, doc in DOCS.items()]
    return spark.createDataFrame(rows, schemas.RAW_DOCUMENTS)


def ipl_teams(spark):
    return spark.createDataFrame(
        [(1, "MI", "img/mi"), (2, "CSK", "img/csk"), (3, "KKR", "img/kkr"), (33, "KKR", "img/kkr2")],
        schemas.IPL_TEAMS)


def players(spark):
    return spark.createDataFrame(
        [("Virat Kohli", "bat", "Indian", 36, "RHB", "RM", "RCB", None, None),
         ("Dhoni", "wk", "Indian", 43, "RHB", None, "CSK", None, None),
         ("AB de Villiers", "bat", "Overseas", 41, "RHB", None, "RCB", None, None)],
        schemas.PLAYERS_INFO)


def coordinates(spark):
    return spark.createDataFrame(
        [(1, "Kolkata", "Eden Gardens", 22.5, 88.3), (2, "Chennai", "MA Chidambaram Stadium", 13.0, 80.2),
         (3, "Mumbai", "Wankhede Stadium", 18.9, 72.8)],
        schemas.STADIUM_COORDINATES)


def weather_info(spark):
    def row(mid, temp):
        return ("2025", mid, None, None, None, None, None, None, None, None, None, None,
                "2025-04-05T19:00", temp, 60.0, 1000.0, 10.0, 0.0, 3.0, None)
    return spark.createDataFrame([row("m1", 30.0), row("m2", 28.0), row("m4", 25.0)], schemas.WEATHER_INFO)
