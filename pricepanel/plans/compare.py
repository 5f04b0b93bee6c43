"""Spark result vs DuckDB oracle: row count, column names, values.

Columns are compared by name (sorted), rows as an order-insensitive
multiset of normalised values -- the same contract the driver checks.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(_norm(r[i]) for i in order) for r in records]


_DUCK_NAMES = {"string": "VARCHAR", "smallint": "SMALLINT", "tinyint": "TINYINT", "int": "INTEGER",
               "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT", "boolean": "BOOLEAN",
               "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP"}


def _type_diffs(spark_df, rel) -> dict:
    spark_types = {f.name: _DUCK_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
                   for f in spark_df.schema.fields}
    duck_types = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    return {n: (spark_types[n], duck_types[n]) for n in spark_types
            if n in duck_types and spark_types[n] != duck_types[n]}


def compare(spark_df, sql: str, con) -> dict:
    s_cols = spark_df.columns
    s_rows = _rows(s_cols, [tuple(r) for r in spark_df.collect()])
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = _rows(d_cols, rel.fetchall())
    type_diffs = _type_diffs(spark_df, rel)
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = sorted(s_cols), sorted(d_cols)
    cs, cd = Counter(s_rows), Counter(d_rows)
    out["values_match"] = cs == cd
    if not out["values_match"]:
        out["only_spark"] = list((cs - cd).elements())[:3]
        out["only_oracle"] = list((cd - cs).elements())[:3]
    out["types_match"] = not type_diffs
    if type_diffs:
        out["type_diffs"] = type_diffs
    out["ok"] = out["columns_match"] and out["values_match"] and out["types_match"]
    return out
