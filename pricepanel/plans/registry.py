"""Query registry: each entry is a Spark plan over the fixture views,
optionally paired with DuckDB SQL that must return the same rows.

Parameters that are features of an operator (a snapshot year, a parcel, a
sample size, a top-k) are module constants; no query subsets its input to
stay cheap -- every one scans the whole driver table it derives from.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

# Operator parameters used by the registered queries.
SNAPSHOT_YEAR = 2000
# Oracle text only: the columns of the wide reports. The queries take the years
# from the data, so a year outside this list shows as a mismatch.
EXPECTED_YEARS = list(range(1995, 2002))
SAMPLE_PARCEL = "2612010221100010001"
SAMPLE_ROWS = 200
TOP_K = 10
DIRTY_YEARS = (1997, 1998)
# A year whose pages report no rows for districts with an abolished code; outside the years with rows for some.
EMPTY_PAGE_YEAR = 2001
COLLECTED_AT = "2026-07-15"

FACT_COLS = "pnu, stdr_year, stdr_month, price_per_m2, pblntf_de, std_land_yn, source, last_updt_dt, seq, xp"


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco
