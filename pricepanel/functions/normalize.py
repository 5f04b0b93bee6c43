"""Normalisation of raw text fields into fact values.

All functions return Columns, so they stay inside whole-stage codegen.
``strict=True`` mirrors a hard failure on malformed numbers (ANSI casts
raise); ``strict=False`` turns such values into NULL via ``try_cast``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricepanel.schema import FACT_COLUMNS, FACT_SCHEMA

# Python's str.strip() removes every Unicode whitespace, Spark's trim only
# spaces. Spark's trim also takes a set of characters, so the set of all
# characters Python calls whitespace gives the same result without a regex.
_WHITESPACE = "".join(ch for ch in map(chr, range(0x110000)) if ch.isspace())

# Strings accepted as "standard parcel = yes".
STANDARD_YES = ("Y", "1", "TRUE", "표준지")

# Fixed value: in a city month text, the one or two digits after the first
# date separator, followed by another separator or the end.
CITY_MONTH_PATTERN = r"[-./](\d{1,2})(?:[-./]|$)"

DIGITS = "^[0-9]+$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Strip leading/trailing Unicode whitespace (Python ``str.strip``).

    Text that starts and ends with a visible ASCII character has nothing to
    strip: two comparisons tell, where the trim looks every end up in the set.
    """
    text = _col(c)
    last = F.substring(text, -1, 1)
    bare = (text >= "!") & (text < "\x7f") & (last >= "!") & (last < "\x7f")
    return F.when(bare, text).otherwise(F.trim(text, F.lit(_WHITESPACE)))


def null_if_empty(c) -> Column:
    """Stripped text, or NULL when nothing is left."""
    s = strip(c)
    return F.when(s == "", F.lit(None).cast("string")).otherwise(s)


def cast_text(c: Column, to: str, strict: bool) -> Column:
    return c.cast(to) if strict else c.try_cast(to)


def price_text(c) -> Column:
    """Stripped price text with thousands separators removed."""
    return F.replace(strip(F.coalesce(_col(c), F.lit(""))), F.lit(","), F.lit(""))


def norm_price(c, strict: bool = True) -> Column:
    """``int(float(x))`` -- parse as double, truncate toward zero.

    Empty text gives NULL (callers drop such rows, see ``valid_api_row``).
    """
    return price_of(price_text(c), strict)


def price_of(s: Column, strict: bool) -> Column:
    return F.when(s == "", F.lit(None).cast("long")).otherwise(
        cast_text(cast_text(s, "double", strict), "long", strict))


def norm_month_api(c) -> Column:
    """API month text; digits -> int, anything else (or missing) -> 1."""
    return _month_of(strip(F.coalesce(_col(c), F.lit(""))))


def _month_of(s: Column) -> Column:
    return F.when(s.rlike(DIGITS), s.cast("int")).otherwise(F.lit(1))


def month_zero_to_one(c) -> Column:
    """Month 0 is stored as 1 (the schema coercion rule)."""
    m = _col(c)
    return F.when(m == 0, F.lit(1)).otherwise(m)


def norm_month_multi(c) -> Column:
    """Month from the many city spellings.

    ``YYYY-MM-DD`` / ``YYYY.M`` -> the field after the first separator;
    6+ digits -> characters 5-6; 1-2 digits -> the number; else 1.
    """
    s = strip(F.coalesce(_col(c), F.lit("")))
    sep = F.regexp_extract(s, CITY_MONTH_PATTERN, 1)
    return (F.when(sep != "", sep.cast("int"))
            .when((F.length(s) >= 6) & s.rlike(DIGITS), F.substring(s, 5, 2).cast("int"))
            .when(s.rlike("^[0-9]{1,2}$"), s.cast("int"))
            .otherwise(F.lit(1)))


def norm_month_bulk(c, strict: bool = True) -> Column:
    """``int(x or 1)`` -- only the empty string defaults to 1."""
    raw = F.coalesce(_col(c), F.lit(""))
    return F.when(raw == "", F.lit(1)).otherwise(cast_text(strip(raw), "int", strict))


def norm_bool_yn(c) -> Column:
    """Three-valued standard-parcel flag from text (NULL stays NULL)."""
    return _yes_of(strip(_col(c)))


def _yes_of(s: Column) -> Column:
    return (F.when(s.isNull() | (s == ""), F.lit(None).cast("boolean"))
            .otherwise(F.upper(s).isin(*STANDARD_YES)))


def norm_year(c, strict: bool = True) -> Column:
    return cast_text(strip(_col(c)), "int", strict)


def valid_api_row(pnu="pnu", year="stdrYear", price="pblntfPclnd") -> Column:
    """F1 for API rows: price, pnu and year must be non-empty after strip."""
    return ((price_text(price) != "")
            & (strip(F.coalesce(_col(pnu), F.lit(""))) != "")
            & (strip(F.coalesce(_col(year), F.lit(""))) != ""))


def norm_api_row(raw: DataFrame, strict: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw API records (string fields) -> typed fact rows.

    Keeps ``last_updt_dt`` (stripped, missing = '') for revision choice and
    any extra columns listed in ``keep`` (e.g. an arrival sequence).
    Month 0 is coerced to 1 *before* de-duplication so keys stay unique.

    The texts are stripped in a projection of their own, once each: all in one
    is more code than the JVM compiles of a method, and runs interpreted.
    """
    def given(c):
        return F.coalesce(F.col(c), F.lit(""))

    text = raw.where(valid_api_row()).select(
        strip("pnu").alias("pnu"), strip("stdrYear").alias("_year"), strip(given("stdrMt")).alias("_month"),
        price_text("pblntfPclnd").alias("_price"), strip("pblntfDe").alias("_date"), strip("stdLandAt").alias("_std"),
        strip(given("lastUpdtDt")).alias("last_updt_dt"), *[F.col(k) for k in keep])
    return text.select(
        "pnu",
        cast_text(F.col("_year"), "int", strict).alias("stdr_year"),
        month_zero_to_one(_month_of(F.col("_month"))).alias("stdr_month"),
        price_of(F.col("_price"), strict).alias("price_per_m2"),
        F.nullif("_date", F.lit("")).alias("pblntf_de"),
        _yes_of(F.col("_std")).alias("std_land_yn"),
        "last_updt_dt",
        *[F.col(k) for k in keep])


def to_fact_schema(df: DataFrame, source: str | None = None,
                   collected_at: dt.date | str | None = None,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Cast to the fact schema (ANSI casts fail fast on overflow).

    ``source`` / ``collected_at`` are job parameters, so reruns reproduce
    the same rows; missing month defaults to 1, month 0 becomes 1.
    """
    cols = {}
    for field in FACT_SCHEMA.fields:
        name = field.name
        if name == "source" and source is not None:
            c = F.lit(source)
        elif name == "collected_at" and collected_at is not None:
            c = F.lit(str(collected_at)).cast("date")
        elif name == "collected_at" and name not in df.columns:
            c = F.lit(None)
        elif name == "stdr_month":
            c = month_zero_to_one(F.coalesce(F.col(name), F.lit(1)))
        else:
            c = F.col(name)
        cols[name] = c.cast(field.dataType).alias(name)
    return df.select(*[cols[n] for n in FACT_COLUMNS], *[F.col(k) for k in keep])


def publish_date(c="pblntf_de") -> Column:
    """Derived date from the kept publish-date text (NULL if unparseable)."""
    s = _col(c)
    return F.coalesce(F.try_to_date(s, "yyyy-MM-dd"), F.try_to_date(s, "yyyyMMdd"))
