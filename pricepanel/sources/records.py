"""Kinds of landed records: what a page holds, what is stored, and where.

A ``RecordKind`` names the fields of a landed record, those that every record
must state, the normaliser, the key of the latest revision and the stored
schema. The page reader (S4), the schema coercion (N10) and the unit write (S6)
take the kind, so a second series is a second entry of the registry with a table
of its own: individual parcel prices and standard (reference) parcel prices.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricepanel.functions import normalize as N
from pricepanel.functions.pnu import sgg
from pricepanel.operators import revise
from pricepanel.schema import API_RECORD_SCHEMA, PARTITION_COLUMNS, SRC_API, STANDARD_RECORD_SCHEMA, STANDARD_SCHEMA, STORED_SCHEMA
from pricepanel.sources import api_pages, manifest


@dataclass(frozen=True)
class RecordKind:
    name: str
    wire: T.StructType
    required: tuple[str, ...]
    stored: T.StructType
    key: tuple[str, ...]
    normalise: Callable[..., DataFrame]


def _standard_rows(raw: DataFrame, strict: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Standard-parcel records -> typed rows; no month, a record without price, parcel or year is dropped."""
    names = {"std_no": "stdLandSn", "land_category": "lndcgrCodeNm", "zoning": "prposArea1Nm", "land_use": "ladUseSittnNm", "road_side": "roadSideCodeNm"}
    # stripped first, once each, in a projection of their own (see norm_api_row)
    text = raw.where(N.valid_api_row()).select(
        N.strip("pnu").alias("pnu"), N.strip("stdrYear").alias("_year"), N.price_text("pblntfPclnd").alias("_price"),
        N.price_text("lndpclAr").alias("_area"), *[N.strip(wire).alias(f"_{name}") for name, wire in names.items()],
        N.strip(F.coalesce(F.col("lastUpdtDt"), F.lit(""))).alias("last_updt_dt"), *[F.col(k) for k in keep])
    area = F.col("_area")
    area = F.when(area != "", area.cast("decimal(18,2)") if strict else area.try_cast("decimal(18,2)"))
    said = {name: F.nullif(f"_{name}", F.lit("")).alias(name) for name in names}
    return text.select(
        "pnu", said["std_no"], N.cast_text(F.col("_year"), "int", strict).alias("stdr_year"), N.price_of(F.col("_price"), strict).alias("price_per_m2"),
        area.alias("area_m2"), said["land_category"], said["zoning"], said["land_use"], said["road_side"], "last_updt_dt", *[F.col(k) for k in keep])


KINDS: dict[str, RecordKind] = {}


def register_kind(kind: RecordKind) -> RecordKind:
    if KINDS.setdefault(kind.name, kind) is not kind:
        raise ValueError(f"the record kind {kind.name} is known already")
    return kind


INDIVIDUAL = register_kind(RecordKind("individual", API_RECORD_SCHEMA, ("pnu", "stdrYear", "pblntfPclnd"), STORED_SCHEMA,
                                      ("pnu", "stdr_year", "stdr_month"), N.norm_api_row))
STANDARD = register_kind(RecordKind("standard", STANDARD_RECORD_SCHEMA, ("pnu", "stdrYear", "stdLandSn", "pblntfPclnd"), STANDARD_SCHEMA,
                                    ("pnu", "stdr_year"), _standard_rows))


def field_problems(pages: DataFrame, kind: RecordKind) -> DataFrame:
    """(problem, field, records): fields that the kind does not know, and required ones that records lack."""
    records = api_pages.record_texts(pages)
    keys = F.map_keys(api_pages.as_map(F.col("rec")))
    stated = records.select(keys.alias("keys"))
    unknown = stated.select(F.lit("unknown").alias("problem"), F.explode(F.array_except("keys", _names(kind.wire.names))).alias("field"))
    missing = stated.select(F.lit("missing").alias("problem"), F.explode(F.array_except(_names(kind.required), "keys")).alias("field"))
    return unknown.unionByName(missing).groupBy("problem", "field").agg(F.count(F.lit(1)).alias("records"))


def _names(names):
    return F.array(*[F.lit(n) for n in names])


def parse_records(pages: DataFrame, kind: RecordKind) -> DataFrame:
    """S4 for a kind: one row per record of the landed pages, as text fields.

    A record with a field that the kind does not know, or without a required
    one, fails the job and names the fields (``field_problems`` counts them).
    """
    keys = F.map_keys(api_pages.as_map(F.col("rec")))
    unknown, missing = F.array_except(keys, _names(kind.wire.names)), F.array_except(_names(kind.required), keys)
    told = F.concat(F.lit(f"{kind.name} record with unknown fields ["), F.array_join(unknown, ","), F.lit("], without required fields ["),
                    F.array_join(missing, ","), F.lit("]"))
    good = F.when(F.size(unknown) + F.size(missing) > 0, F.raise_error(told).cast("string")).otherwise(F.col("rec"))
    return api_pages.parse_api_pages(pages, schema=kind.wire, check=good)


def coerce(df: DataFrame, kind: RecordKind, source: str, collected_at: dt.date | str) -> DataFrame:
    """N10 for a kind: the stored columns, cast (ANSI casts fail on overflow); month 0 or none becomes 1."""
    given = {"source": F.lit(source), "collected_at": F.lit(str(collected_at)).cast("date"), "sgg": sgg()}
    if "stdr_month" in df.columns:
        given["stdr_month"] = N.month_zero_to_one(F.coalesce("stdr_month", F.lit(1)))
    return df.select(*[given.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in kind.stored.fields])


def check_columns(df: DataFrame, schema: T.StructType) -> None:
    """Fail unless ``df`` has exactly the columns and types of ``schema`` (in any order)."""
    has, wants = {f.name: f.dataType for f in df.schema.fields}, {f.name: f.dataType for f in schema.fields}
    problems = [f"{n} is missing" for n in wants if n not in has] + [f"{n} is unknown" for n in has if n not in wants]
    problems += [f"{n} is {has[n].simpleString()}, not {wants[n].simpleString()}" for n in wants if n in has and has[n] != wants[n]]
    if problems or len(df.columns) != len(has):
        raise ValueError("columns do not fit the table: " + (", ".join(problems) or "a column is repeated"))


def write_records(df: DataFrame, kind: RecordKind, root: str, expected: manifest.State | None = None) -> manifest.State:
    """S6 for a kind: checked against the stored schema, then the units of ``df`` are replaced at once."""
    check_columns(df, kind.stored)
    out = df.select(*kind.stored.names).hint("rebalance", "stdr_year", "sgg").sortWithinPartitions(*PARTITION_COLUMNS, "pnu")

    def write_data(path: str) -> None:
        out.write.option("compression", "zstd").partitionBy(*PARTITION_COLUMNS).parquet(path)

    return manifest.replace_units(df.sparkSession, root, write_data, kind.stored, expected=expected)


def read_records(spark: SparkSession, kind: RecordKind, root: str, scope=None) -> DataFrame:
    """S5 for a kind: the rows in force."""
    return manifest.scan(spark, manifest.current(spark, root), kind.stored, scope)


def ingest_pages(pages: DataFrame, kind: RecordKind, root: str, collected_at: dt.date | str, source: str = SRC_API) -> manifest.State:
    """Landed pages of a kind -> S4 -> normaliser -> latest revision per key (W1) -> N10 -> S6."""
    rows = kind.normalise(parse_records(pages, kind), keep=("page_no", "rec_no"))
    latest = revise.dedup_latest(rows, key=list(kind.key), arrival=("page_no", "rec_no"))
    return write_records(coerce(latest, kind, source, collected_at), kind, root)
