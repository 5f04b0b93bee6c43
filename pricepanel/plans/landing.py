"""Landed inputs derived from the driver tables.

The ingest readers need archives and JSON pages. These builders encode the
fixture rows the way the real sources deliver them -- cp949 CSV inside ZIP
(city: keyword headers in two spellings, national: positional columns),
an EUC-KR tab file of region codes, and JSON API pages in several
envelope shapes -- and land them once per application as files in the shared
work folder, which the readers then read from storage. Every Arrow batch (at
most ``spark.sql.execution.arrow.maxRecordsPerBatch`` rows) becomes one archive
of two data members; a repeated task writes the same file again.
"""

from __future__ import annotations

import csv
import io
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricepanel.operators.joins import DEFAULT_BROADCAST_ROWS
from pricepanel.plans import fixtures as fx
from pricepanel.schema import SRC_API, SRC_CITY
from pricepanel.session import ship_package
from pricepanel.sources.api_pages import PAGE_SCHEMA, zero_total_units
from pricepanel.sources.zip_members import open_store

# The city bulk header, in the standard and the alternative
# spelling of the parcel, year and month columns.
CITY_HEADER = ["시도명", "시군구명", "법정동명", "토지코드", "공시지가(원/㎡)", "시군구코드", "법정동코드",
               "필지구분코드", "필지구분명", "본번", "부번", "기준년도", "기준년월"]
CITY_HEADER_ALT = ["시도명", "시군구명", "법정동명", "고유번호", "공시지가(원/㎡)", "시군구코드", "법정동코드",
                   "필지구분코드", "필지구분명", "본번", "부번", "기준연도", "기준월"]
# National bulk: the first four names are checked, the rest is positional.
BULK_HEADER = ["고유번호", "법정동코드", "법정동명", "특수지구분코드", "특수지구분명", "지번", "기준연도",
               "기준월", "공시지가", "공시일자", "표준지여부", "데이터기준일자", "비고"]
CODE_HEADER = "법정동코드\t법정동명\t폐지여부"

def _csv_bytes(header: list[str], rows: list[list[str]], encoding: str) -> bytes:
    text = io.StringIO()
    w = csv.writer(text, lineterminator="\r\n")
    w.writerow(header)
    w.writerows(rows)
    return text.getvalue().encode(encoding)


def write_archive(path: str, members: list[tuple[str, bytes]]) -> None:
    """One archive, put in place by a rename."""
    store, inner = open_store(path)
    folder, name = inner.rsplit("/", 1)
    store.create_dir(folder, recursive=True)
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as out:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
            for member, data in members:
                z.writestr(member, data)
        out.write(buffer.getvalue())
    store.move(draft, inner)


def _landed_members(kind: str, part: str, rows: list[list[str]]) -> list[tuple[str, bytes]]:
    half = (len(rows) + 1) // 2
    if kind == "city":
        return [(f"city_{part}_a.csv", _csv_bytes(CITY_HEADER, rows[:half], "cp949")), ("empty.csv", b""),
                (f"city_{part}_b.csv", _csv_bytes(CITY_HEADER_ALT, rows[half:], "cp949"))]
    return [(f"AL_D151_{part}_a.csv", _csv_bytes(BULK_HEADER, rows[:half], "cp949")), ("readme.txt", "not a data member".encode("cp949")),
            (f"AL_D151_{part}_b.csv", _csv_bytes(BULK_HEADER, rows[half:], "cp949"))]


def _land(kind: str, folder: str):
    def land(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId()
        for i, b in enumerate(batches):
            if b.empty:
                continue
            rows = (b.astype(str) if b.isna().to_numpy().any() else b).values.tolist()  # the cells are texts already
            path = f"{folder}/{kind}_{task}_{i}.zip"
            write_archive(path, _landed_members(kind, f"{task}_{i}", rows))
            yield pd.DataFrame({"path": [path], "n": [len(rows)]})
    return land


def _landed(spark: SparkSession, sf: str, kind: str, cells) -> str:
    """The folder of the archives of ``cells()``, landed once per application."""
    def write(folder: str) -> None:
        ship_package(spark)
        cells().mapInPandas(_land(kind, folder), "path string, n long").agg(F.sum("n")).collect()
    return fx.stored_path(spark, sf, f"landing-{kind}", write)


def _raw_with_months(spark: SparkSession, sf: str, source: str) -> DataFrame:
    return fx.raw_api(spark, sf, month_texts=True).where(F.col("source") == source)


def _city_cells(spark: SparkSession, sf: str) -> DataFrame:
    r = _raw_with_months(spark, sf, SRC_CITY)
    p = F.col("pnu")
    return r.select(F.substring(p, 1, 2).alias("a"), F.substring(p, 1, 5).alias("b"),
                    F.substring(p, 1, 10).alias("c"), p.alias("d"), F.col("pblntfPclnd").alias("e"),
                    F.substring(p, 1, 5).alias("f"), F.substring(p, 1, 10).alias("g"),
                    F.substring(p, 11, 1).alias("h"), F.lit("").alias("i"),
                    F.substring(p, 12, 4).alias("j"), F.substring(p, 16, 4).alias("k"),
                    F.col("stdrYear").alias("l"), F.col("city_mt").alias("m"))


def city_archives(spark: SparkSession, sf: str) -> str:
    """City rows as cp949 CSV (13 columns, keyword header) in ZIPs: their folder."""
    return _landed(spark, sf, "city", lambda: _city_cells(spark, sf))


def _bulk_cells(spark: SparkSession, sf: str) -> DataFrame:
    r = _raw_with_months(spark, sf, SRC_API)
    p = F.col("pnu")
    return r.select(p.alias("a"), F.substring(p, 1, 10).alias("b"), F.lit("").alias("c"),
                    F.lit("1").alias("d"), F.lit("").alias("e"), F.substring(p, 12, 8).alias("f"),
                    F.col("stdrYear").alias("g"), F.col("bulk_mt").alias("h"),
                    F.col("pblntfPclnd").alias("i"), F.col("pblntfDe").alias("j"),
                    F.col("stdLandAt").alias("k"), F.lit("").alias("l"), F.lit("").alias("m"))


def bulk_archives(spark: SparkSession, sf: str) -> str:
    """API rows as national bulk CSV (13 positional columns) in ZIPs: their folder."""
    return _landed(spark, sf, "bulk", lambda: _bulk_cells(spark, sf))


def _land_codes(path: str):
    def land(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lines = [CODE_HEADER]
        for b in batches:
            lines += [f"{c}\t{n}\t{s}" for c, n, s in zip(b["code"], b["name"], b["status"])]
        if len(lines) > 1:
            lines.append("broken line without tabs")
            write_archive(path, [("codes.txt", ("\r\n".join(lines) + "\r\n").encode("euc-kr"))])
            yield pd.DataFrame({"path": [path], "n": [len(lines)]})
    return land


def code_archive(spark: SparkSession, sf: str) -> str:
    """The whole country's region codes as EUC-KR tab-separated text in one ZIP.

    One national list is one file, written by one task: a country has tens of
    thousands of codes, whatever the size of the fact table.
    """
    def write(folder: str) -> None:
        ship_package(spark)
        codes = fx.country_codes(spark, sf).select("code", F.concat(F.lit("동"), F.col("code")).alias("name"), "status")
        codes.coalesce(1).mapInPandas(_land_codes(f"{folder}/codes.zip"), "path string, n long").collect()
    return fx.stored_path(spark, sf, "landing-codes", write) + "/codes.zip"


#: Records that one task makes into pages (one file): what a task sorts fits in memory, whatever the size of the table.
PAGE_TASK_ROWS = 50_000


def _pages(keyed: DataFrame) -> DataFrame:
    """Records (prefix, year, block, seq, xp, rec) as landed JSON pages ``(prefix, year, page_no, body)``.

    A unit is (8-char prefix, year); a page holds the unit's rows of one
    block of arrival numbers, so a page is bounded whatever the unit size.
    ``totalCount`` is the unit's row count (aggregated, then joined back to the
    pages). Envelopes rotate over three shapes, and one-record pages carry a
    bare object instead of a list. The records are dealt to as many tasks as
    their number asks for before they are grouped: most pages hold few records,
    so grouping before the exchange would only sort (and spill) all of them.
    """
    units = keyed.groupBy("prefix", "year").agg(F.count(F.lit(1)).alias("total"))
    held = units.agg(F.count(F.lit(1)).alias("units"), F.coalesce(F.sum("total"), F.lit(0)).alias("records")).first()
    if held.units <= DEFAULT_BROADCAST_ROWS:  # else a shuffle join, which moves the finished pages once more
        units = F.broadcast(units)
    tasks = -(-held.records // PAGE_TASK_ROWS) or 1
    pages = keyed.repartition(tasks, "prefix", "year", "block").groupBy("prefix", "year", "block").agg(
        F.array_sort(F.collect_list(F.struct("seq", "xp", "rec"))).alias("recs"))
    j = pages.join(units, ["prefix", "year"])
    texts = F.transform("recs", lambda r: r["rec"])
    items = F.when(F.size(texts) == 1, F.get(texts, 0)) \
        .otherwise(F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]")))
    as_list = F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]"))
    total = F.col("total").cast("string")
    shape = F.pmod(F.col("block"), F.lit(3))
    body = (F.when(shape == 0, F.concat(F.lit('{"indvdLandPrices":{"resultCode":"OK","totalCount":"'), total,
                                        F.lit('","field":'), items, F.lit("}}")))
            .when(shape == 1, F.concat(F.lit('{"items":'), as_list, F.lit(',"totalCount":'), total, F.lit("}")))
            .otherwise(F.concat(F.lit('{"referLandPrices":{"totalcount":'), total,
                                F.lit(',"resultMsg":"ok","rows":'), as_list, F.lit("}}"))))
    return j.select("prefix", "year", F.col("block").cast("int").alias("page_no"), body.alias("body"))


def _keyed(raw: DataFrame, rec, page_span: int) -> DataFrame:
    return raw.select(F.substring("pnu", 1, 8).alias("prefix"), F.col("stdrYear").cast("int").alias("year"),
                      (F.col("seq") / page_span).cast("long").alias("block"), "seq", "xp", rec.alias("rec"))


def _landed_json(spark: SparkSession, sf: str, name: str, pages) -> str:
    return fx.stored_path(spark, sf, f"landing-{name}", lambda p: pages().write.mode("overwrite").option("compression", "gzip").json(p))


def pages_folder(spark: SparkSession, sf: str, page_span: int = 10_000) -> str:
    """API rows landed once per application as JSON lines of pages: their folder."""
    def build() -> DataFrame:
        raw = fx.raw_api(spark, sf).where(F.col("source") == SRC_API)
        rec = F.to_json(F.struct("pnu", "stdrYear", "stdrMt", "pblntfPclnd", "pblntfDe", "stdLandAt", "lastUpdtDt"))
        return _pages(_keyed(raw, rec, page_span))
    return _landed_json(spark, sf, f"pages-{page_span}", build)


def landed_pages(spark: SparkSession, sf: str, page_span: int = 10_000) -> DataFrame:
    """The landed API pages, read from their files."""
    return spark.read.schema(PAGE_SCHEMA).json(pages_folder(spark, sf, page_span))


#: The year in which every fourth page of a unit was lost.
LOST_PAGES_YEAR = 1997


def pages_with_losses(spark: SparkSession, sf: str, page_span: int = 10_000) -> DataFrame:
    """The landed API pages after a sweep that lost some pages of one year."""
    lost = (F.col("year") == LOST_PAGES_YEAR) & (F.col("page_no") % 4 == 1)
    path = _landed_json(spark, sf, f"pages-lost-{page_span}", lambda: landed_pages(spark, sf, page_span).where(~lost))
    return spark.read.schema(PAGE_SCHEMA).json(path)


def empty_units(spark: SparkSession, sf: str, year: int) -> DataFrame:
    """Units (sgg, stdr_year) whose landed page reports a total of 0: a page for
    every prefix with an abolished code, in one year, in two envelope shapes."""
    def build() -> DataFrame:
        prefixes = fx.region_codes(spark, sf).where("abolished").select(F.substring("code", 1, 8).alias("prefix")).distinct()
        body = F.when(F.col("prefix").endswith("1"), '{"indvdLandPrices":{"resultCode":"OK","totalCount":"0","field":[]}}') \
            .otherwise('{"response":{"totalcount":0,"resultMsg":"no data"}}')
        return prefixes.select("prefix", F.lit(year).alias("year"), F.lit(1).alias("page_no"), body.alias("body"))
    return zero_total_units(spark.read.schema(PAGE_SCHEMA).json(_landed_json(spark, sf, f"empty-pages-{year}", build)))


def landed_standard_pages(spark: SparkSession, sf: str, page_span: int = 10_000) -> DataFrame:
    """Standard-parcel records (the API rows flagged as such) landed as pages of the second record shape."""
    def pick(values: list[str]):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("seq") % len(values) + 1).cast("int"))

    def build() -> DataFrame:
        raw = fx.raw_api(spark, sf).where((F.col("source") == SRC_API) & (F.col("stdLandAt") == "Y"))
        seq = F.col("seq")
        area = F.when(seq % 11 == 0, "").otherwise(F.concat((seq % 5000).cast("string"), F.lit("."), F.lpad((seq % 100).cast("string"), 2, "0")))
        rec = F.to_json(F.struct(
            "pnu", F.substring("pnu", 1, 10).alias("ldCode"), seq.cast("string").alias("stdLandSn"), "stdrYear",
            pick(["대", "전", "임야"]).alias("lndcgrCodeNm"), area.alias("lndpclAr"), pick(["자연녹지지역", "제1종일반주거지역"]).alias("prposArea1Nm"),
            pick(["단독", "전", "상업용", "임야", ""]).alias("ladUseSittnNm"), F.when(seq % 7 != 0, "세로(가)").alias("roadSideCodeNm"),
            "pblntfPclnd", "lastUpdtDt"))
        return _pages(_keyed(raw, rec, page_span))

    return spark.read.schema(PAGE_SCHEMA).json(_landed_json(spark, sf, "standard-pages", build))
