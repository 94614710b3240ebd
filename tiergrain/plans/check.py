"""Local stand-in for the driver's correctness gate.

Runs a registered key on Spark and its oracle SQL on DuckDB over the same
parquet directory and compares row count, column names and an
order-insensitive hash of the values (columns sorted by name).
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

from tiergrain.sources.tables import INPUT_TABLES


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return "T" if v else "F"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if v == 0:
            v = 0.0
        return repr(float(v))
    if isinstance(v, int):
        return str(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return [columns[i] for i in order], lines, h


def duck_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in INPUT_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, key: str, builder, sql: str | None, sf_dir: str, con=None, show: int = 5) -> dict:
    df = builder(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    out = {"key": key, "spark_rows": len(s_rows)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = con or duck_connection(sf_dir)
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    sc, sl, sh = digest(s_cols, s_rows)
    dc, dl, dh = digest(d_cols, d_rows)
    out.update(duck_rows=len(d_rows), columns_match=sc == dc, hash_match=sh == dh)
    out["status"] = "ok" if (len(s_rows) == len(d_rows) and sc == dc and sh == dh) else "MISMATCH"
    if out["status"] != "ok":
        if sc != dc:
            out["spark_columns"], out["duck_columns"] = sc, dc
        ss, ds = set(sl), set(dl)
        out["only_spark"] = sorted(ss - ds)[:show]
        out["only_duck"] = sorted(ds - ss)[:show]
    return out
