"""Every query with SQL is compared with DuckDB on the small scale factor."""

import math

import duckdb

import __spark_entry__ as E
from conftest import SF_SMALL
from lakehound.sources.tables import BASE_TABLES


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["country", "n", "avg_prob", "predicted_fraud"]
    assert df.count() > 0


def test_all_queries_match_duckdb(spark):
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    bad = []
    for name, sql in sqls.items():
        df = qs[name](spark, SF_SMALL)
        srows = [tuple(r) for r in df.collect()]
        cur = con.execute(sql)
        drows = cur.fetchall()
        dcols = [d[0] for d in cur.description]
        if sorted(df.columns) != sorted(dcols) or _rows(df.columns, srows) != _rows(dcols, drows):
            bad.append(name)
    assert not bad, bad
