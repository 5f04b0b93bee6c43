"""Scope filters and projections.

Year and region lists are parsed on the driver (they are parameters, not
data) and become ``isin`` / ``startswith`` predicates that Catalyst pushes
into the Parquet scan or turns into partition pruning.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricepanel.functions.pnu import region_prefix_filter
from pricepanel.schema import EXPORT_COLUMNS, FIRST_YEAR


_YEARS = re.compile(r"\s*(?P<first>\d+)\s*(?:-\s*(?P<last>\d+)\s*)?")


def parse_year_spec(spec: str, first_year: int = FIRST_YEAR,
                    available: Iterable[int] | None = None) -> list[int]:
    """``"1990-2000,2005"`` -> sorted years, clipped to ``first_year``
    (and to ``available`` when given)."""
    listed = [_YEARS.fullmatch(p) for p in spec.split(",") if p.strip()]
    if None in listed:
        raise ValueError(f"not a list of years and year-year ranges: {spec!r}")
    spans = [(int(m["first"]), int(m["last"] or m["first"])) for m in listed]
    wanted = set().union(*(range(lo, hi + 1) for lo, hi in spans))
    known = wanted if available is None else wanted.intersection(available)
    return sorted(y for y in known if y >= first_year)


def year_in(years: Sequence[int], col: str = "stdr_year") -> Column:
    return F.col(col).isin(*[int(y) for y in years])


def positive_regular(month: int = 1) -> Column:
    """the statistics population -- regular month, positive price."""
    return (F.col("stdr_month") == month) & (F.col("price_per_m2") > 0)


def region_in(include_sgg: Sequence[str] = (), exclude_sido: Sequence[str] = (),
              col: str = "pnu", partition_col: str | None = None) -> Column:
    """keep listed districts (if any), drop listed provinces. With a
    ``sgg`` partition column both lists prune folders."""
    district = F.substring(F.col(col), 1, 5) if partition_col is None else F.col(partition_col)
    pred = F.lit(True)
    if include_sgg:
        pred = pred & district.isin(*include_sgg)
    if exclude_sido:
        pred = pred & ~F.substring(district, 1, 2).isin(*exclude_sido)
    return pred


def scope(year: int | None = None, y0: int = FIRST_YEAR, y1: int | None = None, month: int = 1,
          sgg: str | None = None, sido: str | None = None,
          partition_col: str | None = None) -> Column:
    """export scope -- one year or a range (no upper bound unless given), a month (0 = all), a
    district or else a province. Region tests are ``startswith`` so they
    reach the scan; with a ``sgg`` partition column they prune folders."""
    pred = (F.col("stdr_year") == year) if year else F.col("stdr_year") >= y0
    if not year and y1 is not None:
        pred = pred & (F.col("stdr_year") <= y1)
    if month:
        pred = pred & (F.col("stdr_month") == month)
    if sgg:
        pred = pred & region_prefix_filter(sgg, "pnu", partition_col)
    elif sido:
        pred = pred & region_prefix_filter(sido, "pnu")
    return pred


def project_export(df: DataFrame) -> DataFrame:
    """the seven export columns."""
    return df.select(*EXPORT_COLUMNS)
