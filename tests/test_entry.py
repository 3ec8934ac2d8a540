"""The driver contract in __spark_entry__.py."""

import __spark_entry__ as entry_mod
from matchlake.plans.marts import INNINGS_SUMMARY_COLUMNS


def test_entry_flagship(spark):
    df = entry_mod.entry(spark)
    assert df.columns == INNINGS_SUMMARY_COLUMNS
    rows = df.collect()
    assert len(rows) > 0
    types = dict(df.dtypes)
    assert types["inning_id"] == "bigint" and types["inning_total"] == "bigint"
    assert types["match_date"] == "date"


def test_queries_and_oracles_align():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q) and set(entry_mod.QUERIES) <= set(o)
    assert all(callable(f) for f in q.values()) and all(isinstance(s, str) and s for s in o.values())
