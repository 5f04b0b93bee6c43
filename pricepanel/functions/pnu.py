"""Parcel-number (PNU) structure and region predicates (N11, F2 helpers).

Layout, 1-based: sido (1,2) · sgg (1,5) · legal dong (1,10) ·
register class (11,1) · main number (12,4) · sub number (16,4).
Region code: sido 2 + sgg 3 + emd 3 + ri 2.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sido(c="pnu") -> Column:
    return F.substring(_col(c), 1, 2)


def sgg(c="pnu") -> Column:
    return F.substring(_col(c), 1, 5)


def bjd(c="pnu") -> Column:
    return F.substring(_col(c), 1, 10)


def emd_prefix(c="pnu") -> Column:
    """8-character prefix: sido + sgg + emd."""
    return F.substring(_col(c), 1, 8)


def pnu_parts(c="pnu") -> list[Column]:
    """The six standard substrings as named columns."""
    p = _col(c)
    return [
        F.substring(p, 1, 2).alias("sido"),
        F.substring(p, 1, 5).alias("sgg"),
        F.substring(p, 1, 10).alias("bjd"),
        F.substring(p, 11, 1).alias("regstr_class"),
        F.substring(p, 12, 4).alias("main_no"),
        F.substring(p, 16, 4).alias("sub_no"),
    ]


def region_prefix_filter(prefix: str, c="pnu", partition_col: str | None = None) -> Column:
    """Predicate for "parcel lies in region ``prefix``".

    ``startswith`` pushes down to Parquet as ``StringStartsWith`` (files are
    sorted by pnu, so row groups are skipped); a 5-character prefix on a
    table partitioned by ``sgg`` also prunes whole directories.
    """
    pred = _col(c).startswith(prefix)
    if partition_col is not None and len(prefix) == 5:
        pred = (F.col(partition_col) == prefix) & pred
    return pred


def code_parts(c="code") -> list[Column]:
    """Region code split into sgg / emd / ri and the 8-char prefix."""
    k = _col(c)
    return [
        F.substring(k, 1, 2).alias("sido"),
        F.substring(k, 1, 5).alias("sgg"),
        F.substring(k, 6, 3).alias("emd"),
        F.substring(k, 9, 2).alias("ri"),
        F.substring(k, 1, 8).alias("prefix8"),
    ]
