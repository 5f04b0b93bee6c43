"""Land-price views derived from the driver tables.

The driver ships TPC-H-like tables; these builders turn ``lineitem`` into raw
API records (all text, every month/price/flag spelling the normaliser must
handle) and ``part`` into a region-code table. The same definitions exist as
DuckDB SQL in ``plans.oracle`` so each query can be checked row for row.
The builders are projections and aggregates over full table scans; the
public views are written once per application (``stored``) and read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricepanel.functions.normalize import norm_api_row
from pricepanel.operators import revise
from pricepanel.plans.registry import COLLECTED_AT
from pricepanel.schema import SRC_API, SRC_CITY
from pricepanel.session import work_dir
from pricepanel.sources import fact_store, manifest

# Fixture constants: 20 two-digit sido codes, picked by key modulo 20.
SIDO_CODES = ["11", "26", "27", "28", "29", "30", "31", "36", "41", "42",
              "43", "44", "45", "46", "47", "48", "50", "51", "52", "12"]

# Status words of an abolished and of a current region code.
ABOLISHED = "폐지"
EXISTING = "존재"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_STORED: dict[tuple[str, str, str], str] = {}


def stored_path(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """Folder written once per application by ``write(path)`` (any writer,
    e.g. the partitioned fact writer); later calls return the same path."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    path = _STORED.get(key)
    if path is None:
        path = work_dir(spark, f"view-{name}")
        write(path)
        _STORED[key] = path
    return path


#: Row groups of the stored views, as encoded in memory: a scan is split by them, so few large files still give every core work.
ROW_GROUP_BYTES = 16 << 20


def stored(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Derived view written once per application as Parquet in the shared
    work folder, then read like any stored table (multi-file, column
    pruning and filter pushdown). Later queries of the same application
    reuse it; the data is a pure function of the driver tables."""
    path = stored_path(spark, sf_dir, name, lambda p: build().write.mode("overwrite").option("parquet.block.size", ROW_GROUP_BYTES).parquet(p))
    return spark.read.parquet(path)


def _lpad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def _sido_of(key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in SIDO_CODES]), (key % len(SIDO_CODES) + 1).cast("int"))


def fixture_pnu(supp: Column, part: Column) -> Column:
    return F.concat(
        _sido_of(supp),
        _lpad(F.lit(110) + F.lit(10) * (supp % 7), 3),
        _lpad(F.lit(101) + (supp % 9), 3),
        _lpad(F.lit(21) * (part % 2), 2),
        F.lit("1"),
        _lpad(part % 50, 4),
        _lpad(supp % 100, 4),
    )


def _build_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw API-like records: string fields + source + arrival order.

    ``seq`` (order key * 10 + line) is the arrival sequence; ``xp`` breaks
    the remaining ties, ``(seq, xp)`` is unique. ``city_mt`` / ``bulk_mt``
    are the city / national-bulk month spellings of the same line.
    """
    li = table(spark, sf_dir, "lineitem")
    extra = list(_month_text_columns())
    supp, part = F.col("l_suppkey"), F.col("l_partkey")
    pnu = fixture_pnu(supp, part)
    year = F.year("l_shipdate")
    day = F.to_date("l_shipdate").cast("string")
    month = (F.when(F.col("l_linenumber") == 1, "01")
             .when(F.col("l_linenumber") == 2, "1")
             .when(F.col("l_linenumber") == 3, " 7 ")
             .when(F.col("l_linenumber") == 4, "07")
             .when(F.col("l_linenumber") == 5, "")
             .when(F.col("l_linenumber") == 6, "x")
             .when(F.col("l_discount") == 0.05, "3")
             .otherwise("00"))
    price = (F.when(F.col("l_tax") == 0.0, "")
             .when(F.col("l_discount") == 0.1, "0")
             .otherwise(F.concat((F.col("l_quantity").cast("int") * (year - 1990)).cast("string"),
                                 F.lit(","), F.lit("500.9 "))))
    return li.select(
        F.when(supp % 37 == 5, F.concat(F.substring(pnu, 1, 17), F.lit("가"))).otherwise(pnu).alias("pnu"),
        year.cast("string").alias("stdrYear"),
        month.alias("stdrMt"),
        price.alias("pblntfPclnd"),
        day.alias("pblntfDe"),
        F.when(F.col("l_returnflag") == "A", "Y").when(F.col("l_returnflag") == "R", "n")
         .otherwise("").alias("stdLandAt"),
        day.alias("lastUpdtDt"),
        F.when(F.col("l_linestatus") == "F", SRC_API).otherwise(SRC_CITY).alias("source"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        F.col("l_extendedprice").alias("xp"),
        *extra,
    )


def raw_api(spark: SparkSession, sf_dir: str, month_texts: bool = False) -> DataFrame:
    """The raw records, read from their stored copy (see ``stored``)."""
    raw = stored(spark, sf_dir, "raw_api", lambda: _build_raw(spark, sf_dir))
    return raw if month_texts else raw.drop("city_mt", "bulk_mt")


def fact_from_raw(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Normalised rows (N7) with source, last update and arrival order.

    Types follow the fact schema: short year, byte month, long price.
    """
    rows = norm_api_row(raw, strict=strict, keep=("source", "seq", "xp"))
    return rows.select(
        "pnu",
        F.col("stdr_year").cast("short").alias("stdr_year"),
        F.col("stdr_month").cast("byte").alias("stdr_month"),
        "price_per_m2", "pblntf_de", "std_land_yn", "source", "last_updt_dt", "seq", "xp")


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The normalised fact rows as stored (N7 applied once, then written),
    like the stored table the reference's reports read.

    They come from the stored raw records if a query has written those, else
    straight from ``lineitem``: a query of the fact rows alone writes them only.
    """
    def build() -> DataFrame:
        if (spark.sparkContext.applicationId, sf_dir.rstrip("/"), "raw_api") in _STORED:
            return fact_from_raw(raw_api(spark, sf_dir))
        # exploded from an array of one: Spark would put the texts' expressions in the
        # place of every mention of them in the normaliser, and compute each many times
        raw = _build_raw(spark, sf_dir).drop("city_mt", "bulk_mt")
        return fact_from_raw(raw.select(F.explode_outer(F.array(F.struct("*"))).alias("r")).select("r.*"))
    return stored(spark, sf_dir, "fact", build)


def api_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(spark, sf_dir).where(F.col("source") == SRC_API)


def city_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(spark, sf_dir).where(F.col("source") == SRC_CITY)


def partitioned_root(spark: SparkSession, sf_dir: str) -> str:
    """The fact view written by S6 (year/sgg/source units), once per application."""
    return stored_path(spark, sf_dir, "fact_partitioned", lambda p: fact_store.write_fact(
        fact_store.prepare_fact(fact(spark, sf_dir), collected_at=COLLECTED_AT), p))


def fact_table(spark: SparkSession, sf_dir: str, source: str | None = None, **scope) -> DataFrame:
    """The partitioned fact table as S5 reads it; ``scope`` (``manifest.file_scope``) names the files to open."""
    return fact_store.read_fact(spark, partitioned_root(spark, sf_dir), source=source, scope=manifest.file_scope(**scope))


def conflict_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conflict census of the API rows (A12), written once: both
    membership tests of J2 read it."""
    return stored(spark, sf_dir, "conflict_keys", lambda: revise.conflict_keys(api_rows(spark, sf_dir)))


def region_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region-code table (code, status, abolished) from ``part``, stored."""
    return stored(spark, sf_dir, "region_codes", lambda: _build_codes(spark, sf_dir))


def _build_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A code listed several times is abolished if any copy is."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    code = F.concat(
        _sido_of(k),
        _lpad(F.lit(110) + F.lit(10) * (k % 7), 3),
        F.when(k % 11 == 0, F.lit("000")).otherwise(_lpad(F.lit(101) + (k % 9), 3)),
        F.when(k % 3 == 0, F.lit("00")).otherwise(_lpad(F.lit(21) + (k % 5), 2)),
    )
    status = F.when(F.col("p_size") % 5 == 0, ABOLISHED).otherwise(EXISTING)
    return (p.select(code.alias("code"), status.alias("status"))
            .groupBy("code").agg(F.max("status").alias("status"))
            .withColumn("abolished", F.col("status") != EXISTING))


def country_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every district of ``part`` with 10 dong numbers (000: the district itself)
    of 9 ri numbers each (00: the dong itself), as the national code list has
    them; a code's status follows the sizes of the district's parts."""
    k = F.col("p_partkey")
    district = F.concat(_sido_of(k), _lpad(F.lit(110) + F.lit(10) * (k % 7), 3))
    sizes = table(spark, sf_dir, "part").groupBy(district.alias("sgg")).agg(F.sum("p_size").alias("size"))
    grid = (sizes.select("*", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("e"))
            .select("*", F.explode(F.sequence(F.lit(0), F.lit(8))).alias("r")))
    code = F.concat("sgg", F.when(F.col("e") == 0, "000").otherwise(_lpad(F.lit(100) + F.col("e"), 3)),
                    F.when(F.col("r") == 0, "00").otherwise(_lpad(F.lit(20) + F.col("r"), 2)))
    return grid.select(code.alias("code"), F.when((F.col("size") + F.col("e") + F.col("r")) % 5 == 0, ABOLISHED).otherwise(EXISTING).alias("status"))


def month_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month texts as the city and national bulk files spell them.

    ``city_mt`` cycles through date, ``YYYYMM``, bare, dotted, empty, junk
    and zero-padded forms; ``bulk_mt`` is the bare month or empty.
    """
    return raw_api(spark, sf_dir, month_texts=True).select("seq", "xp", "city_mt", "bulk_mt")


def _month_text_columns() -> tuple[Column, Column]:
    ship = F.col("l_shipdate")
    m = F.month(ship).cast("string")
    line = F.col("l_linenumber")
    city = (F.when(line == 1, F.to_date(ship).cast("string"))
            .when(line == 2, F.date_format(ship, "yyyyMM"))
            .when(line == 3, m)
            .when(line == 4, F.concat(F.year(ship).cast("string"), F.lit("."), m))
            .when(line == 5, F.lit(""))
            .when(line == 6, F.lit("abc"))
            .otherwise(F.lpad(m, 2, "0")))
    bulk = F.when(line % 2 == 0, F.lit("")).otherwise(m)
    return city.alias("city_mt"), bulk.alias("bulk_mt")


def monthly_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly district change rates derived from ``lineitem``: the mean
    discount of a district-month shifted to about +-0.5 %, in whole
    ten-millionths (discounts are whole hundredths)."""
    li = table(spark, sf_dir, "lineitem")
    p = fixture_pnu(F.col("l_suppkey"), F.col("l_partkey"))
    cents = F.round(F.col("l_discount") * 100).cast("bigint")
    return (li.groupBy(F.substring(p, 1, 5).alias("sgg"), F.year("l_shipdate").cast("short").alias("stdr_year"),
                       F.month("l_shipdate").alias("month"))
            .agg(F.sum(cents).alias("cents"), F.count(F.lit(1)).alias("n"))
            .select("sgg", "stdr_year", "month", F.expr("(cents * 10000) div n - 50000").alias("rate_e7")))
