"""Run a registered query in Spark and its SQL twin in DuckDB; compare."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from storelens.sources.tables import TABLE_NAMES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, bytes):
        return v.hex()
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    rows = cur.fetchall()
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, sorted((tuple(_norm(r[i]) for i in idx) for r in rows), key=repr)


def compare(df, con, sql):
    sc, sr = spark_rows(df)
    dc, dr = duck_rows(con, sql)
    assert sc == dc, f"columns differ: spark={sc} duck={dc}"
    assert len(sr) == len(dr), f"row count spark={len(sr)} duck={len(dr)}"
    diff = [(a, b) for a, b in zip(sr, dr) if a != b]
    assert not diff, f"{len(diff)} rows differ, first: {diff[:2]}"
    return len(sr)
