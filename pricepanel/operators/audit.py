"""Quality audits.

Each audit is a single aggregate over the fact table (map-side combined),
or a join whose small side is size-checked before it is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricepanel.functions.pnu import bjd, sgg
from pricepanel.operators import revise
from pricepanel.operators.joins import maybe_broadcast
from pricepanel.schema import STORED_KEY


def audit_format(df: DataFrame) -> DataFrame:
    """Q1: short parcel numbers, non-positive prices, odd months."""
    return df.agg(
        F.count_if(F.length("pnu") < 19).alias("pnu_too_short"),
        F.count_if(F.col("price_per_m2") <= 0).alias("nonpositive_price"),
        F.count_if(~F.col("stdr_month").isin(1, 7)).alias("odd_month"))


def audit_code_exists(df: DataFrame, codes: DataFrame, max_codes: int = 200_000) -> DataFrame:
    """Q2: rows whose legal-dong code (pnu 1-10) is not in the code table.

    The code table is a dimension (tens of thousands of rows); it is
    broadcast only after ``max_codes`` is checked.
    """
    known = maybe_broadcast(codes.select(F.col("code").alias("_code")).distinct(), max_codes)
    # Rows per legal dong first (combined map-side), then the lookup: the
    # join sees one row per dong, however many parcels a dong holds.
    per_bjd = df.groupBy(bjd().alias("_bjd")).agg(F.count(F.lit(1)).alias("n"))
    j = per_bjd.join(known, F.col("_bjd") == F.col("_code"), "left")
    unknown = F.col("_code").isNull()
    return j.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"),
                 F.coalesce(F.sum(F.when(unknown, F.col("n"))), F.lit(0)).cast("long").alias("n_unknown_rows"),
                 F.count_if(unknown).alias("n_unknown_bjd"))


def audit_key_unique(df: DataFrame, key: Sequence[str] = STORED_KEY) -> DataFrame:
    """Q5: duplicated natural keys and surplus rows (both 0 when clean)."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return per_key.agg(F.count(F.lit(1)).alias("dup_keys"),
                       F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("surplus_rows"))


def _dip(counts: DataFrame, part: list[str]) -> DataFrame:
    w = Window.partitionBy(*part).orderBy("stdr_year")
    prev, nxt = F.lag("rows").over(w), F.lead("rows").over(w)
    neighbours = (F.coalesce(prev, F.lit(0)) + F.coalesce(nxt, F.lit(0))) / \
        (prev.isNotNull().cast("int") + nxt.isNotNull().cast("int"))
    return counts.select(*part, "stdr_year", "rows", prev.alias("prev_rows"), nxt.alias("next_rows"),
                         F.round(F.col("rows") * 100.0 / neighbours).cast("long").alias("pct_of_neighbours"))


def audit_year_dip(df: DataFrame, per: str = "sgg", threshold_pct: int = 50) -> DataFrame:
    """Q6: row count versus neighbouring years, per sgg (or nationally).

    Counts are aggregated first; the lag/lead window then runs over one
    short series (years) per district.
    """
    if per == "sgg":
        counts = df.groupBy(sgg().alias("sgg"), "stdr_year").agg(F.count(F.lit(1)).alias("rows"))
        out = _dip(counts, ["sgg"])
    else:
        counts = df.groupBy("stdr_year").agg(F.count(F.lit(1)).alias("rows"))
        out = _dip(counts.withColumn("scope", F.lit("national")), ["scope"]).drop("scope")
    return out.withColumn("dip", F.col("pct_of_neighbours") <= threshold_pct)


def cross_source(city: DataFrame, api: DataFrame, revision: str = "latest") -> DataFrame:
    """City January rows vs the API price of the same parcel and year.

    ``revision='latest'`` compares with the newest API revision (W1),
    ``'first'`` with the first arrival (for raw rows that carry revision
    columns; a stored panel is already resolved). Rate is over all sampled rows,
    missing included. The API side is unique per (pnu, year) before the
    join, so the join cannot multiply rows even for a hot parcel.
    """
    if revision not in ("latest", "first"):
        raise ValueError("revision must be 'latest' or 'first'")
    jan = api.where(F.col("stdr_month") == 1)
    key = ["pnu", "stdr_year"]
    if "last_updt_dt" in api.columns and any({*a} <= {*api.columns} for a in revise.ARRIVALS):
        one = revise.dedup_latest(jan, key=key) if revision == "latest" else revise.dedup_keep_first(jan, key=key)
        ref = one.select(*key, F.col("price_per_m2").alias("api_price"))
    else:
        # A stored panel has no revision columns: its keys are already
        # resolved, so one price per (pnu, year) is taken as is (the max
        # only makes the pick deterministic if a key were repeated).
        ref = jan.groupBy(*key).agg(F.max("price_per_m2").alias("api_price"))
    # Only counts leave this audit, so the sample is collapsed to
    # (pnu, year, price) -> rows first (combined map-side): a parcel with
    # a third of all rows enters the join as a handful of rows.
    sample = (city.where(F.col("stdr_month") == 1)
              .groupBy("pnu", "stdr_year", "price_per_m2").agg(F.count(F.lit(1)).alias("n")))
    j = sample.join(ref, ["pnu", "stdr_year"], "left")
    missing = F.col("api_price").isNull()
    same = F.col("api_price") == F.col("price_per_m2")

    def rows(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("long")

    out = j.agg(rows(F.lit(True)).alias("total"), rows(~missing & same).alias("match"),
                rows(~missing & ~same).alias("mismatch"), rows(missing).alias("missing"))
    return out.withColumn("match_permille", F.when(F.col("total") > 0, F.round(
        F.col("match") * 1000.0 / F.col("total")).cast("long")))


def audit_pagination(pages: DataFrame) -> DataFrame:
    """Q3: rows fetched per (prefix, year) vs the server's total count.

    ``pages`` has one row per landed page with ``prefix``, ``year``,
    ``n_rows`` and ``total_count``; loss = total - fetched.
    """
    return (pages.groupBy("prefix", "year")
            .agg(F.sum("n_rows").cast("long").alias("fetched"),
                 F.max("total_count").cast("long").alias("total"),
                 F.count(F.lit(1)).alias("pages"))
            .withColumn("loss", F.col("total") - F.col("fetched")))
