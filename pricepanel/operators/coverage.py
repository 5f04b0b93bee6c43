"""Load coverage derived from the data itself.

A unit is (sgg, year). It is done when the fact holds rows for it, or a
landed page for it reported a total count of 0 (an empty unit is finished
too). The grid is each known district exploded over the year list (a job
parameter), not a cross join of two tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricepanel.functions.pnu import sgg


def unit_grid(districts: DataFrame, years: Sequence[int], col: str = "sgg") -> DataFrame:
    """All (sgg, year) units: distinct districts x the year list."""
    return (districts.select(F.col(col).alias("sgg")).distinct()
            .select("sgg", F.explode(F.array(*[F.lit(int(y)) for y in years])).alias("stdr_year")))


def filled_units(fact: DataFrame) -> DataFrame:
    """Units with rows (A14 without source) and their row counts."""
    return (fact.groupBy(sgg().alias("sgg"), F.col("stdr_year").cast("int").alias("stdr_year"))
            .agg(F.count(F.lit(1)).alias("rows")))


def done_units(fact: DataFrame, empty_pages: DataFrame | None = None) -> DataFrame:
    """Finished units: units with rows, plus units whose landed page had a
    total count of 0 (``empty_pages`` with sgg, stdr_year)."""
    done = filled_units(fact)
    if empty_pages is not None:
        zero = empty_pages.select("sgg", F.col("stdr_year").cast("int"), F.lit(0).cast("long").alias("rows"))
        done = done.unionByName(zero).groupBy("sgg", "stdr_year").agg(F.sum("rows").alias("rows"))
    return done


def units_todo(grid: DataFrame, done: DataFrame) -> DataFrame:
    """Grid minus finished units."""
    return grid.join(done.select("sgg", "stdr_year"), ["sgg", "stdr_year"], "left_anti")


def empty_units(grid: DataFrame, fact: DataFrame) -> DataFrame:
    """Q4: units of the grid without a single row."""
    return grid.join(filled_units(fact).select("sgg", "stdr_year"), ["sgg", "stdr_year"], "left_anti")


def coverage_by_year(done: DataFrame) -> DataFrame:
    """M1: per year finished units and rows."""
    return done.groupBy("stdr_year").agg(F.count(F.lit(1)).alias("units"),
                                         F.sum("rows").cast("long").alias("rows"))


def coverage_ratio(grid: DataFrame, done: DataFrame) -> DataFrame:
    """M2: finished / all units of the grid (known districts only), rows."""
    j = grid.join(done, ["sgg", "stdr_year"], "left")
    return j.agg(F.count_if(F.col("rows").isNotNull()).alias("done_units"),
                 F.count(F.lit(1)).alias("total_units"),
                 F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows")) \
            .withColumn("done_permille",
                        F.round(F.col("done_units") * 1000.0 / F.col("total_units")).cast("long"))
