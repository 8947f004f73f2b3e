"""Side-by-side check of a Spark query against its DuckDB SQL.

Mirrors the driver's gate: same row count, same column names, and the same
order-insensitive multiset of normalised rows.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer():
            return int(v)
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return _norm(float(v))
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def digest(rows) -> str:
    return hashlib.sha1(repr(rows).encode()).hexdigest()


def compare(spark_df, con, sql: str):
    s_cols = list(spark_df.columns)
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sc, sr = normalise(s_cols, s_rows)
    dc, dr = normalise(d_cols, d_rows)
    report = {"spark_rows": len(sr), "oracle_rows": len(dr), "columns_match": sc == dc,
              "values_match": sr == dr}
    report["ok"] = report["columns_match"] and report["values_match"] and len(sr) == len(dr)
    if not report["ok"]:
        report["spark_cols"], report["oracle_cols"] = sc, dc
        only_s = [r for r in sr if r not in set(dr)][:3]
        only_d = [r for r in dr if r not in set(sr)][:3]
        report["only_spark"], report["only_oracle"] = only_s, only_d
    return report


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "date": "DATE", "float": "FLOAT"}


def type_mismatches(spark_df, con, sql: str) -> dict:
    """Columns whose Spark type does not map to the DuckDB result type."""
    st = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
          for f in spark_df.schema.fields}
    rel = con.sql(sql)
    dt = dict(zip(rel.columns, [str(t) for t in rel.types]))
    return {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}
