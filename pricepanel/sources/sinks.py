"""Scoped CSV export (S7) and nested JSON reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricepanel.operators import filters, stats
from pricepanel.operators.joins import maybe_broadcast
from pricepanel.session import work_dir
from pricepanel.sources.manifest import write_text

#: The export's order, total up to equal rows.
EXPORT_ORDER = ["pnu", "stdr_year", "stdr_month", "source", "price_per_m2", "pblntf_de", "std_land_yn"]
EXPORT_SCHEMA = ("pnu string, stdr_year short, stdr_month byte, price_per_m2 long, "
                 "pblntf_de string, std_land_yn boolean, source string")


HEADER_FILE = "00000-header.csv"  # before every part-* file by name


def with_position(df: DataFrame, *order: str, name: str = "row_no") -> DataFrame:
    """``df`` with the place (from 1) of every row in the total order.

    Rows are range-partitioned and sorted once and written with their task and
    their place in it; prefix sums over the tasks' counts (one row a task) give
    every task its first place. No task sees more than its range.
    """
    spark = df.sparkSession
    path = work_dir(spark, "ordered")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # rows of one task
    df.orderBy(*order).select("*", F.spark_partition_id().alias("_task"), place.alias("_place")).write.mode("overwrite").parquet(path)
    rows = spark.read.parquet(path)
    tasks = rows.groupBy("_task").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    starts = tasks.select("_task", F.coalesce(before, F.lit(0)).alias("_start"))
    return rows.join(maybe_broadcast(starts), "_task").select(*df.columns, (F.col("_start") + F.col("_place") + 1).alias(name))


def export_csv(df: DataFrame, path: str, scope=None, position: str | None = None) -> None:
    """Scope -> seven columns -> total order (pnu, year, month, then the
    other columns) -> CSV.

    ``orderBy`` range-partitions, so part files are ordered among
    themselves and each is written by its own task (no single-file
    funnel through one task). The header is a file of its own that comes first
    by name: all files together, in name order, are the one ordered CSV.
    ``position`` adds the row's place in the order under that name.
    """
    out = filters.project_export(df.where(scope) if scope is not None else df)
    if position is not None:
        out = with_position(out, *EXPORT_ORDER, name=position)
    out.orderBy(*([position] if position else EXPORT_ORDER)).write.mode("overwrite").option("header", False).csv(path)
    write_text(df.sparkSession, f"{path}/{HEADER_FILE}", ",".join(out.columns) + "\n")


def read_export(spark: SparkSession, path: str, position: str | None = None) -> DataFrame:
    schema = EXPORT_SCHEMA + (f", {position} long" if position else "")
    return spark.read.schema(schema).option("pathGlobFilter", "part-*").csv(path)


# The columns of the published region summary, in order.
SUMMARY_HEADER = {"key": "키", "sido": "시도", "sigungu": "시군구", "year": "연도", "med_price": "중위지가", "avg_price": "평균지가", "parcels": "필지수"}


def export_summary(summary: DataFrame, path: str) -> None:
    """The region summary as one ordered CSV (key, year) under the published header."""
    named = summary.select(*[F.col(c).alias(n) for c, n in SUMMARY_HEADER.items()])
    named.orderBy(SUMMARY_HEADER["key"], SUMMARY_HEADER["year"]).write.mode("overwrite").option("header", False).csv(path)
    write_text(summary.sparkSession, f"{path}/{HEADER_FILE}", ",".join(SUMMARY_HEADER.values()) + "\n")


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    types = ["string", "string", "string", "smallint", "long", "long", "long"]
    schema = ", ".join(f"`{n}` {t}" for n, t in zip(SUMMARY_HEADER.values(), types))
    return spark.read.schema(schema).option("pathGlobFilter", "part-*").csv(path)


_NULLS = {"ignoreNullFields": "false"}


def _rows_json(df: DataFrame, by: str, descending: bool = False) -> Column:
    """The (small, aggregated) rows as an array of structs ordered by ``by``
    (missing values last), then by the other fields."""
    measure = F.col(by)
    key = F.struct(measure.isNull(), -measure if descending else measure, *[F.col(c) for c in df.columns if c != by])
    ranked = F.array_sort(F.collect_list(F.struct(key.alias("key"), F.struct(*df.columns).alias("row"))))
    return F.transform(ranked, lambda r: r["row"])


def _as_json(df: DataFrame, by: str, descending: bool = False) -> DataFrame:
    return df.agg(F.to_json(_rows_json(df, by, descending), _NULLS).alias("json"))


def map_report(api: DataFrame) -> DataFrame:
    """S8 (map): ``{"years": [...], "sido": {name: {year: {n, avg, med}}}}``
    from the region x year aggregate (A4); missing means become 0."""
    long = stats.sido_year(api)
    cell = F.struct(F.col("parcels").alias("n"), F.coalesce("avg_p", F.lit(0)).alias("avg"),
                    F.coalesce("med_p", F.lit(0)).alias("med"))
    per_name = long.groupBy("name").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("yr").cast("string"), cell)))).alias("by_year"))
    by_name = F.array_sort(F.collect_list(F.struct("name", "by_year")),
                           lambda a, b: F.when(a["name"] < b["name"], -1).when(a["name"] > b["name"], 1).otherwise(0))
    years = F.array_sort(F.transform(F.array_distinct(F.flatten(F.collect_list(F.map_keys("by_year")))),
                                     lambda y: y.cast("int")))
    out = per_name.agg(years.alias("years"), F.map_from_entries(by_name).alias("sido"))
    return out.select(F.to_json(F.struct("years", "sido")).alias("json"))


def report_sections(fact: DataFrame, api: DataFrame, parcel: str, snapshot_year: int, label: str = "") -> DataFrame:
    """The yearly dashboard report as (section, json) rows.

    Each section is aggregated first (years, provinces, sources: tens of
    rows), so only that bounded result is gathered into one JSON value.
    Provinces come by mean price and sources by rows, largest first; missing
    means are ``null``.
    """
    summary = stats.overall(fact).select(F.col("n_rows").alias("rows"), F.col("n_years").alias("years"), "min_year", "max_year")
    per_year = stats.year_price(api).select(F.col("stdr_year").alias("year"), "parcels",
                                            F.col("avg_price").alias("avg"), F.col("med_price").alias("med"))
    per_sido = stats.sido_snapshot(api, snapshot_year).select(F.col("sido").alias("code"), "name", "parcels",
                                                              F.col("avg_price").alias("avg"))
    series = stats.series_parcel(api, parcel).select(F.col("stdr_year").alias("year"), "price")
    sample = F.struct(F.lit(parcel).alias("pnu"), F.lit(label).alias("label"), _rows_json(series, "year").alias("series"))
    sections = {
        "summary": summary.select(F.to_json(F.struct(*summary.columns), _NULLS).alias("json")),
        "per_year": _as_json(per_year, "year"),
        "per_sido": _as_json(per_sido, "avg", descending=True),
        "sources": _as_json(stats.source_mix(fact), "rows", descending=True),
        "sample_parcel": series.agg(F.to_json(sample, _NULLS).alias("json")),
        "map_sido": map_report(api),
    }
    out = None
    for name, df in sections.items():
        part = df.select(F.lit(name).alias("section"), "json")
        out = part if out is None else out.unionByName(part)
    return out
