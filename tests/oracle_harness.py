"""Run a catalogue key in Spark and its oracle SQL in DuckDB, compare as bags."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

BASE_TABLES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v.normalize()) if v == v else "nan")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def compare(spark, key: str, sf_dir: str, con=None) -> dict:
    from ledgerlens.plans.catalog import ORACLE, QUERIES
    df = QUERIES[key](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    out = {"key": key, "spark_rows": len(s_rows), "spark_cols": s_cols}
    if key not in ORACLE:
        out["ok"] = None
        return out
    con = con or duck(sf_dir)
    res = con.execute(ORACLE[key])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out.update(duck_rows=len(d_rows), duck_cols=d_cols)
    if sorted(s_cols) != sorted(d_cols):
        out["ok"] = False
        out["why"] = "columns"
        return out
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_order = [d_cols.index(s_cols[i]) for i in order]
    sb = Counter(tuple(_norm(r[i]) for i in order) for r in s_rows)
    db = Counter(tuple(_norm(r[i]) for i in d_order) for r in d_rows)
    out["ok"] = sb == db
    if not out["ok"]:
        out["why"] = "values"
        out["only_spark"] = list((sb - db).items())[:3]
        out["only_duck"] = list((db - sb).items())[:3]
    return out
