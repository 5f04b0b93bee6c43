"""Revision handling: de-duplication, conflicts, overrides (W1-W4, J1, J2,
A12, A13, U2, Q7).

De-duplication is ``row_number() = 1`` over the key. Spark plans a partial
``WindowGroupLimit`` before the shuffle, so each map task keeps one row per
key and a hot key cannot pile up in one reducer; the final limit runs after
the hash exchange on the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricepanel.functions.pnu import bjd
from pricepanel.operators.joins import maybe_broadcast
from pricepanel.schema import KEY, SRC_API, SRC_BULK, SRC_CITY, STORED_KEY

# Columns that tell the order of arrival, where a frame has them: landed records, parsed page rows.
ARRIVALS = (("seq", "xp"), ("page_no", "rec_no"))


def _first_per_key(df: DataFrame, key: Sequence[str], order: list[Column], drop: Sequence[str] = ()) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn", *drop)


def _with_arrival(df: DataFrame, arrival: Sequence[str] | None) -> tuple[DataFrame, list[str], list[str]]:
    """Arrival-order columns: as given; else one of ``ARRIVALS`` when present;
    else the real order of a Parquet scan (file path, row index), added
    here and dropped again by the caller."""
    if arrival is not None:
        return df, list(arrival), []
    for known in ARRIVALS:
        if all(c in df.columns for c in known):
            return df, list(known), []
    return with_file_order(df), ["_file", "_row"], ["_file", "_row"]


def _arrival(arrival: Sequence[str], latest_first: bool) -> list[Column]:
    return [F.col(c).desc() if latest_first else F.col(c).asc() for c in arrival]


def dedup_latest(df: DataFrame, key: Sequence[str] = STORED_KEY, updated: str = "last_updt_dt",
                 arrival: Sequence[str] | None = None, tie: str = "last") -> DataFrame:
    """Keep the newest revision per key.

    ``updated`` is compared as text, missing = '' (lowest). ``tie='last'``
    keeps the last arrival among equal update stamps (W1); ``tie='first'``
    keeps the first (W2).
    """
    if tie not in ("last", "first"):
        raise ValueError("tie must be 'last' or 'first'")
    df, arrival, extra = _with_arrival(df, arrival)
    order = [F.coalesce(F.col(updated), F.lit("")).desc()] + _arrival(arrival, tie == "last")
    return _first_per_key(df, key, order, extra)


def dedup_keep_first(df: DataFrame, key: Sequence[str] = KEY,
                     arrival: Sequence[str] | None = None) -> DataFrame:
    """Drop repeated keys, keep the first in arrival (file) order.

    Without ``seq``/``xp`` columns the order is the Parquet scan's own
    (``_metadata.file_path``, ``_metadata.row_index``).
    """
    df, arrival, extra = _with_arrival(df, arrival)
    return _first_per_key(df, key, _arrival(arrival, latest_first=False), extra)


def with_file_order(df: DataFrame) -> DataFrame:
    """Arrival order of a Parquet scan: file path, then row index."""
    return df.select("*", F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.row_index").alias("_row"))


def source_priority(c="source") -> Column:
    """W3 priority: API and national bulk rank equal, ahead of city bulk."""
    s = F.col(c) if isinstance(c, str) else c
    return F.when(s.isin(SRC_API, SRC_BULK), F.lit(0)).when(s == SRC_CITY, F.lit(1)).otherwise(F.lit(2))


def merge_sources(df: DataFrame, key: Sequence[str] = KEY, collected: str = "collected_at",
                  updated: str = "last_updt_dt", arrival: Sequence[str] | None = None) -> DataFrame:
    """One row per parcel-year-month across sources.

    Priority API = bulk > city; then newest collection date, newest update
    stamp (when the rows carry one), latest arrival, and finally source
    name and price, so the order is total and reruns pick the same row.
    """
    df, arrival, extra = _with_arrival(df, arrival)
    order = [source_priority().asc(), F.col(collected).desc_nulls_last()]
    if updated in df.columns:
        order.append(F.coalesce(F.col(updated), F.lit("")).desc())
    order += _arrival(arrival, True) + [F.col("source").asc(), F.col("price_per_m2").desc()]
    return _first_per_key(df, key, order, extra)


def conflict_keys(df: DataFrame, key: Sequence[str] = KEY, price: str = "price_per_m2") -> DataFrame:
    """Keys carrying more than one distinct price.

    ``min < max`` is the same test as ``count(distinct) > 1`` (both ignore
    NULL) but aggregates map-side in one hash aggregate.
    """
    return (df.groupBy(*key)
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.min(price).alias("min_price"), F.max(price).alias("max_price"))
            .where(F.col("min_price") < F.col("max_price"))
            .select(*key, bjd(F.col("pnu")).alias("bjd"), "n_rows"))


def conflict_census(df: DataFrame, year: str = "stdr_year", key: Sequence[str] = ("pnu", "stdr_month"),
                    price: str = "price_per_m2") -> DataFrame:
    """Per year rows, distinct keys, conflict keys and duplicates.

    ``exact_dup`` is the reported formula rows - keys - conflicts;
    ``same_price_surplus`` is the true count of rows repeating an existing
    (key, price) pair. They agree when no key has three distinct prices.
    Two-level aggregate, each level combined map-side.
    """
    k = [year, *key]
    pairs = df.groupBy(*k, price).agg(F.count(F.lit(1)).alias("n"))
    per_key = pairs.groupBy(*k).agg(F.sum("n").alias("n"), F.count(price).alias("d"))
    out = per_key.groupBy(year).agg(
        F.sum("n").cast("long").alias("rows"),
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("d") > 1).alias("conflict_keys"),
        F.sum(F.col("n") - F.col("d")).cast("long").alias("same_price_surplus"))
    return out.select(year, "rows", "keys", "conflict_keys",
                      (F.col("rows") - F.col("keys") - F.col("conflict_keys")).alias("exact_dup"),
                      "same_price_surplus")


def conflict_candidates(refetched: DataFrame, conflicts: DataFrame) -> DataFrame:
    """Refetched rows inside a visited (bjd, year) unit whose parcel is
    anywhere in the conflict set -- two independent membership tests."""
    units = conflicts.select("bjd", "stdr_year").distinct()
    parcels = conflicts.select("pnu").distinct()
    return (refetched
            .join(units, (bjd(refetched["pnu"]) == units["bjd"])
                  & (refetched["stdr_year"] == units["stdr_year"]), "left_semi")
            .join(parcels, "pnu", "left_semi"))


def authoritative(candidates: DataFrame, key: Sequence[str] = KEY,
                  arrival: Sequence[str] | None = None) -> DataFrame:
    """Latest revision per key among candidates (W2, first on ties) as an
    override table (key, price_ov, pblntf_ov, std_ov, last_updt_dt)."""
    best = dedup_latest(candidates.where(F.col("price_per_m2").isNotNull()), key=key, tie="first", arrival=arrival)
    return best.select(*key, F.col("price_per_m2").alias("price_ov"),
                       F.col("pblntf_de").alias("pblntf_ov"),
                       F.col("std_land_yn").alias("std_ov"), "last_updt_dt")


def apply_overrides(base: DataFrame, overrides: DataFrame, key: Sequence[str] = KEY,
                    broadcast_rows: int | None = None) -> DataFrame:
    """Left join on the key; override price and publish date win,
    ``std_land_yn`` stays from the base row, row count is unchanged.

    Override keys must be unique (checked by ``authoritative``). With
    ``broadcast_rows`` the override side is broadcast after a size check
    (pass a materialised frame); otherwise AQE picks the strategy.
    """
    ov = overrides.select(*key, "price_ov", "pblntf_ov")
    if broadcast_rows is not None:
        ov = maybe_broadcast(ov, broadcast_rows)
    joined = base.join(ov, list(key), "left")
    cols = []
    for c in base.columns:
        if c == "price_per_m2":
            cols.append(F.coalesce(F.col("price_ov"), F.col(c)).cast("long").alias(c))
        elif c == "pblntf_de":
            cols.append(F.coalesce(F.col("pblntf_ov"), F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return joined.select(*cols)


def fix_revisions(stored: DataFrame, refetched: DataFrame, key: Sequence[str] = KEY,
                  arrival: Sequence[str] | None = None, broadcast_rows: int | None = None,
                  refetched_arrival: Sequence[str] | None = None, conflicts: DataFrame | None = None) -> DataFrame:
    """Q7: census -> candidates -> latest -> keep-first -> override.

    Two membership tests read the census; ``conflicts`` takes a written one
    (``conflict_keys`` of ``stored``), so that it is computed once.

    Idempotent: a second run finds no conflicts in its own output (every
    conflicting key was overridden by one authoritative price).
    """
    conflicts = conflict_keys(stored, key) if conflicts is None else conflicts
    overrides = authoritative(conflict_candidates(refetched, conflicts), key, refetched_arrival)
    return apply_overrides(dedup_keep_first(stored, key, arrival), overrides, key, broadcast_rows)


def merge_staging(staged: DataFrame, overrides: DataFrame, dirty_years: Sequence[int],
                  key: Sequence[str] = KEY, arrival: Sequence[str] | None = None) -> DataFrame:
    """Clean years pass through; dirty years get keep-first + overrides.

    The year split is a partition filter on each branch, so a partitioned
    input is read once per year, not twice.
    """
    dirty = F.col("stdr_year").isin(*dirty_years)
    fixed = apply_overrides(dedup_keep_first(staged.where(dirty), key, arrival),
                            overrides.where(F.col("stdr_year").isin(*dirty_years)), key)
    return staged.where(~dirty).unionByName(fixed)
