"""Every catalogue query against its DuckDB oracle on the smallest tables,
and the partition invariance of the flagship."""

import pytest

from matchlake.plans.catalogue import ORACLE_SQL, QUERIES
from oracle_compare import compare, digest, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF, con, verbose=True)
    assert r["status"] in ("ok", "rows-only"), r


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", ["innings_summary_analog", "day_slot_assignment", "venue_lookup",
                                  "order_points_table"])
def test_partition_invariant(spark, name):
    q = QUERIES[name]
    results = []
    for n in ("1", "3", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        df = q(spark, SF)
        results.append(digest(df.columns, [tuple(r) for r in df.collect()]))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1] == results[2]
