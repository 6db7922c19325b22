import duckdb
import pytest

import __spark_entry__ as E
from stationcast.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
QUICK = ["hourly_demand", "dense_grid", "full_features", "clean_stats", "top_stations_named",
         "popularity_bucket", "kpis", "avg_by_weekday", "time_split", "label_encode", "recursive_lag_mean"]


def test_registry_shape():
    q, o = E.queries(), E.oracle_sql()
    assert len(q) >= 100
    assert set(o) <= set(q)
    assert all(callable(f) for f in q.values())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 39 and df.count() > 0


@pytest.mark.parametrize("key", QUICK)
def test_quick_queries_match_oracle(spark, key):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[key](spark, SF)
    res = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]

    def norm(cols, recs):
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        return sorted(tuple(str(r[i]) for i in order) for r in recs)
    assert sorted(df.columns) == sorted(dcols)
    assert norm(df.columns, [tuple(r) for r in df.collect()]) == norm(dcols, res.fetchall())
