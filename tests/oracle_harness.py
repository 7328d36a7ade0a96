"""Spark-vs-DuckDB comparison used by the tests and by ``tools/check_oracle.py``.

Stricter than a hash check: column names, coarse types, row counts and every
value (floats compared exactly) must agree, order-insensitively.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _family_spark(t: str) -> str:
    t = t.lower()
    for key, fam in (("decimal", "decimal"), ("array", "list"), ("timestamp", "timestamp"), ("string", "string"),
                     ("bigint", "bigint"), ("int", "int"), ("double", "double"), ("date", "date"), ("boolean", "bool")):
        if t.startswith(key):
            return fam + (t[len("decimal"):] if key == "decimal" else "")
    return t


def _family_duck(t: str) -> str:
    t = t.upper()
    if t.endswith("[]"):
        return "list"
    if t.startswith("DECIMAL"):
        return "decimal" + t[len("DECIMAL"):].lower().replace(" ", "")
    return {
        "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "DATE": "date",
        "TIMESTAMP": "timestamp", "BOOLEAN": "bool", "HUGEINT": "hugeint",
    }.get(t, t.lower())


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return ("f", None if math.isnan(v) else v)
    if isinstance(v, decimal.Decimal):
        return ("d", v.normalize())
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, repr(x)) for x in row)


def compare(spark_df, con, sql: str, max_diffs: int = 5) -> dict:
    s_cols = [f.name for f in spark_df.schema.fields]
    s_types = {f.name: _family_spark(f.dataType.simpleString()) for f in spark_df.schema.fields}
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_types = {c: _family_duck(str(t)) for c, t in zip(rel.columns, rel.types)}
    out: dict = {"columns_match": sorted(s_cols) == sorted(d_cols)}
    if not out["columns_match"]:
        out["only_spark"] = sorted(set(s_cols) - set(d_cols))
        out["only_duck"] = sorted(set(d_cols) - set(s_cols))
        return out
    out["type_diffs"] = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
    cols = sorted(s_cols)
    s_rows = sorted((tuple(_norm(r[c]) for c in cols) for r in spark_df.collect()), key=_key)
    d_raw = rel.fetchall()
    idx = [d_cols.index(c) for c in cols]
    d_rows = sorted((tuple(_norm(r[i]) for i in idx) for r in d_raw), key=_key)
    out["rows"] = (len(s_rows), len(d_rows))
    diffs = []
    if len(s_rows) == len(d_rows):
        for a, b in zip(s_rows, d_rows):
            if a != b:
                diffs.append({c: (x, y) for c, x, y in zip(cols, a, b) if x != y})
                if len(diffs) >= max_diffs:
                    break
    out["value_diffs"] = diffs
    out["ok"] = len(s_rows) == len(d_rows) and not diffs and not out["type_diffs"]
    return out
