"""Row-level helpers against the traps of FIXTURES §3."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from matchlake.functions import (
    ceil_double, first_key, hour_iso, is_valid_json, json_value_scalar, margin_label, parse_dmy_hm,
    regexp_group, split_first,
)

INVALID = ["not json", '{"a":1', '{"a":1} x', '{"a":1}{"b":2}', '{"a":1}}', "{'a':1}", "", '1,"b":2']
VALID = ['{"a":1,"a":2}', '{"a":1}\n', " [1, 2] ", '"text"', "3", "null", '{"x": {"y": [1, {"z": null}]}}']


def one(spark, col, rows, schema="s string"):
    return [r[0] for r in spark.createDataFrame([(x,) for x in rows], schema).select(col).collect()]


def test_json_validity_matches_python(spark):
    got = one(spark, is_valid_json("s"), INVALID + VALID)
    expected = []
    for text in INVALID + VALID:
        try:
            json.loads(text)
            expected.append(True)
        except ValueError:
            expected.append(False)
    assert got == expected == [False] * len(INVALID) + [True] * len(VALID)


def test_json_value_scalar(spark):
    doc = '{"a": {"b": 1}, "c": [1, 2], "d": "x", "e": null, "n": 7}'
    got = spark.createDataFrame([(doc,)], "s string").select(
        *[json_value_scalar("s", p).alias(p) for p in ["$.a", "$.c", "$.d", "$.e", "$.n", "$.c[1]", "$.zz"]]
    ).first()
    assert list(got) == [None, None, "x", None, "7", "2", None]


def test_first_key_sorted_and_empty(spark):
    rows = ['{"noballs": 1, "legbyes": 1}', "{}", None, '{"wides": 1}']
    col = first_key(F.from_json("s", "map<string,string>"))
    assert one(spark, col, rows) == ["legbyes", None, None, "wides"]


def test_split_regexp_ceil_margin(spark):
    assert one(spark, split_first("s", "."), ["a.b.json", "ab", None]) == ["a", "ab", None]
    assert one(spark, split_first("s", ","), ["Eden Gardens, Kolkata"]) == ["Eden Gardens"]
    assert one(spark, regexp_group("s", r"^[^ ]+\s+(.*)$"), ["Virat Kohli", "Dhoni"]) == ["Kohli", None]
    assert one(spark, ceil_double("s"), ["0.1", "5.6", None]) == [1.0, 6.0, None]
    df = spark.createDataFrame([("3", None), (None, "20"), (None, None)], "w string, r string")
    assert [r[0] for r in df.select(margin_label("w", "r")).collect()] == \
        ["3 wickets", "20 runs", "no result"]


def test_parse_and_hour(spark):
    df = spark.createDataFrame([("5/4/2025", "9:30"), ("25/12/2024", "19:05")], "d string, t string")
    out = df.select(parse_dmy_hm("d", "t").alias("ts")).select("ts", hour_iso("ts").alias("h")).collect()
    assert out[0]["ts"] == dt.datetime(2025, 4, 5, 9, 30) and out[0]["h"] == "2025-04-05T09:00"
    assert out[1]["h"] == "2024-12-25T19:00"
    with pytest.raises(Exception):
        spark.createDataFrame([("31/31/2024", "9:30")], "d string, t string") \
            .select(parse_dmy_hm("d", "t")).collect()
    lenient = spark.createDataFrame([("31/31/2024", "9:30")], "d string, t string") \
        .select(parse_dmy_hm("d", "t", lenient=True)).first()[0]
    assert lenient is None
