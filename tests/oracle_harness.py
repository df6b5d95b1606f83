"""Run a registered Spark query and its DuckDB twin on the same parquet tables and compare.

Mirrors the driver's check: same column names, same row count, same multiset of rows (values
normalised: NaN/None as None, timestamps as ISO text, floats exact unless ``float_tol``).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, float_tol: bool):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9) if float_tol else v
    if isinstance(v, decimal.Decimal):
        return int(v) if v == v.to_integral_value() else float(v)
    if isinstance(v, bool):
        return v
    if isinstance(v, (dt.datetime, dt.date)):
        if isinstance(v, dt.datetime) and v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, float_tol) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, float_tol)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True), float_tol)
    return v


def _key(row):
    return tuple((x is None, repr(type(x)), repr(x)) for x in row)


SPARK_TYPES = {"int": "int32", "bigint": "int64", "string": "str", "double": "float64",
               "boolean": "bool", "timestamp_ntz": "ts", "timestamp": "ts", "binary": "bin"}
DUCK_TYPES = {"INTEGER": "int32", "BIGINT": "int64", "VARCHAR": "str", "DOUBLE": "float64",
              "BOOLEAN": "bool", "TIMESTAMP": "ts", "BLOB": "bin"}


def compare(spark, name: str, fn, sql: str, sf_dir: str, float_tol: bool = False):
    sdf = fn(spark, sf_dir)
    s_cols = list(sdf.columns)
    s_types = {f.name: SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    con = duck(sf_dir)
    rel = con.sql(sql)
    d_types = {c: DUCK_TYPES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows)}
    if sorted(s_cols) != sorted(d_cols):
        out["error"] = f"columns differ: {sorted(s_cols)} vs {sorted(d_cols)}"
        return out
    if s_types != d_types:
        out["error"] = f"types differ: {[(c, s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]]}"
        return out
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    sn = sorted((tuple(_norm(r[i], float_tol) for i in si) for r in s_rows), key=_key)
    dn = sorted((tuple(_norm(r[i], float_tol) for i in di) for r in d_rows), key=_key)
    if len(sn) != len(dn):
        out["error"] = "row counts differ"
    elif sn != dn:
        bad = [(a, b) for a, b in zip(sn, dn) if a != b][:3]
        out["error"] = f"values differ, e.g. {bad}"
    return out
