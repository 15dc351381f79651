"""Compare a Spark query with its SQL oracle the way the driver does:
same column names, same row count, same multiset of (normalised) rows."""

from __future__ import annotations

import datetime as _dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v  # exact: a value hash would see the last bit
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v))
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):  # numpy scalar
        return _norm(v.item())
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


# Spark simple type name -> DuckDB type name
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "date": "DATE", "string": "VARCHAR",
         "int": "INTEGER", "boolean": "BOOLEAN"}


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_names = spark_df.columns
    s_types = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    s_rows = [tuple(r) for r in spark_df.collect()]
    # the driver stores each query as a view first; what a view cannot hold fails here
    con.execute(f"CREATE OR REPLACE TEMP VIEW oracle_query AS {sql}")
    rel = con.sql("SELECT * FROM oracle_query")
    d_names = list(rel.columns)
    d_types = {c: str(t) for c, t in zip(d_names, rel.types)}
    d_rows = rel.fetchall()
    if sorted(s_names) != sorted(d_names):
        return False, f"columns differ: spark={sorted(s_names)} oracle={sorted(d_names)}"
    wrong = {c: (t, d_types[c]) for c, t in s_types.items() if TYPES.get(t, t.upper()) != d_types[c]}
    if wrong:
        return False, f"types differ: {wrong}"
    if len(s_rows) != len(d_rows):
        return False, f"row count differs: spark={len(s_rows)} oracle={len(d_rows)}"
    a, b = _rows(s_names, s_rows), _rows(d_names, d_rows)
    if a != b:
        diffs = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ, e.g. {diffs}"
    return True, f"{len(s_rows)} rows"
