"""Holds a query against its SQL on one data folder."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "quantize"):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def both(df, sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    cols = sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    got = con.execute(sql)
    names = [c[0] for c in got.description]
    assert sorted(names) == cols
    theirs = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in got.fetchall()), key=repr)
    return ours, theirs
