"""Every registered query against its DuckDB SQL on the smallest driver data."""

import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="driver data not present")
def test_all_queries_match_oracle(spark):
    import duckdb

    import __spark_entry__ as E
    from tools.oracle_check import rows_of

    con = duckdb.connect()
    for t in ("customer part orders lineitem events embeddings documents pages labels").split():
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    from bourse.plans import registry
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    qs = {k: qs[k] for k in registry.QUERIES}   # optional packages test their own
    sql = {k: v for k, v in sql.items() if k in qs}
    assert set(sql) <= set(qs)
    bad = []
    for name, fn in sorted(qs.items()):
        df = fn(spark, SF)
        srows = [tuple(r) for r in df.collect()]
        if name not in sql:
            continue
        cur = con.execute(sql[name])
        dcols = [d[0] for d in cur.description]
        drows = cur.fetchall()
        if sorted(df.columns) != sorted(dcols) or rows_of(df.columns, srows) != rows_of(dcols, drows):
            bad.append(name)
    assert bad == []


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0 and "gap_flag" in df.columns
