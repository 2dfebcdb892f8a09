"""Runs a query and its SQL over the same tables and compares rows without order."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(rows):
    return sorted(tuple(repr(round(x, 9)) if isinstance(x, float) else repr(x) for x in r) for r in rows)


def same(spark, query, sql, sf):
    df = query(spark, sf)
    cols = sorted(df.columns)
    got = [tuple(r) for r in df.select(*[f"`{c}`" for c in cols]).collect()]
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    want = [tuple(r[names.index(c)] for c in cols) for r in found.fetchall()]
    assert _norm(got) == _norm(want)
