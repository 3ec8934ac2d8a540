"""Training-data queries against their DuckDB SQL: python tests/llm/cmp.py SF_DIR NAME..."""

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


def compare(spark, query, sql, con):
    """'' when the rows agree, else what differs."""
    got = query(spark).toPandas()
    want = con.sql(sql).df()[list(got.columns)]
    key = list(got.columns)
    got, want = (x.astype(str).sort_values(key).reset_index(drop=True) for x in (got, want))
    if len(got) != len(want):
        return f"{len(got)} rows, {len(want)} wanted"
    bad = (got != want).any(axis=1)
    return "" if not bad.any() else f"{bad.sum()} rows differ:\n{got[bad].head()}\n{want[bad].head()}"


if __name__ == "__main__":
    from matchlake.llm import queries as q
    from matchlake.session import get_spark
    from oracle_compare import duck

    spark = get_spark("local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "8g"})
    sf = sys.argv[1]
    for name in sys.argv[2:]:
        t = time.time()
        if name in q.ORACLE_SQL:
            print(name, compare(spark, lambda s: q.QUERIES[name](s, sf), q.ORACLE_SQL[name], duck(sf)) or "ok", time.time() - t, flush=True)
        else:
            df = q.QUERIES[name](spark, sf)
            df.show(5)
            print(name, df.count(), time.time() - t, flush=True)
