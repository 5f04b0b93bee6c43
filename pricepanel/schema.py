"""Fact schema, keys and source names."""

from __future__ import annotations

from pyspark.sql import types as T

FACT_SCHEMA = T.StructType([
    T.StructField("pnu", T.StringType()),
    T.StructField("stdr_year", T.ShortType()),
    T.StructField("stdr_month", T.ByteType()),
    T.StructField("price_per_m2", T.LongType()),
    T.StructField("pblntf_de", T.StringType()),
    T.StructField("std_land_yn", T.BooleanType()),
    T.StructField("source", T.StringType()),
    T.StructField("collected_at", T.DateType()),
])
FACT_COLUMNS = [f.name for f in FACT_SCHEMA.fields]

# Stored layout adds the region column used as a partition directory.
STORED_SCHEMA = T.StructType(FACT_SCHEMA.fields + [T.StructField("sgg", T.StringType())])
PARTITION_COLUMNS = ["stdr_year", "sgg", "source"]

# Merged-view key (one official price per parcel, year and month) and the
# stored key, which keeps sources apart.
KEY = ["pnu", "stdr_year", "stdr_month"]
STORED_KEY = KEY + ["source"]

SRC_CITY = "seoul_opendata"
SRC_API = "vworld_api"
SRC_BULK = "vworld_bulk"
SOURCES = (SRC_CITY, SRC_API, SRC_BULK)

# The fields of a raw API record (all strings on the wire).
API_FIELDS = (
    "pnu", "ldCode", "ldCodeNm", "regstrSeCode", "mnnmSlno",
    "stdrYear", "stdrMt", "pblntfPclnd", "pblntfDe", "stdLandAt", "lastUpdtDt",
)
API_RECORD_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in API_FIELDS])

# The fields of a raw standard-parcel record (all strings on the wire); below, their table.
STANDARD_FIELDS = (
    "pnu", "ldCode", "ldCodeNm", "regstrSeCode", "mnnmSlno", "stdLandSn", "stdrYear", "lndcgrCodeNm", "lndpclAr",
    "prposArea1Nm", "ladUseSittnNm", "roadSideCodeNm", "pblntfPclnd", "lastUpdtDt",
)
STANDARD_RECORD_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in STANDARD_FIELDS])
STANDARD_SCHEMA = T.StructType([
    T.StructField("pnu", T.StringType()),
    T.StructField("std_no", T.StringType()),
    T.StructField("stdr_year", T.ShortType()),
    T.StructField("price_per_m2", T.LongType()),
    T.StructField("area_m2", T.DecimalType(18, 2)),
    T.StructField("land_category", T.StringType()),
    T.StructField("zoning", T.StringType()),
    T.StructField("land_use", T.StringType()),
    T.StructField("road_side", T.StringType()),
    T.StructField("last_updt_dt", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("collected_at", T.DateType()),
    T.StructField("sgg", T.StringType()),
])

FIRST_YEAR = 1990

# Export projection (seven columns, no collection date).
EXPORT_COLUMNS = ["pnu", "stdr_year", "stdr_month", "price_per_m2", "pblntf_de",
                  "std_land_yn", "source"]
