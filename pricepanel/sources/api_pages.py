"""Landed API pages -> one row per record (S4), all in Column expressions.

A landed page is one row ``(prefix, year, page_no, body)`` with the raw
JSON response text. The envelope is unwrapped defensively:

1. a one-key object whose value is an object is unwrapped;
2. ``resultCode`` (upper-cased) and ``totalCount`` / ``totalcount``
   (non-numeric -> 0) are read from the body;
3. records are the first of ``field, fields, items, item, list`` holding a
   list (its object elements) or a single object; if none yields records,
   the first non-empty list of objects anywhere in the body is used.

``from_json`` into ``map<string,string>`` keeps nested values as JSON text,
so "is a list / is an object" is a prefix test on that text. Raw control
characters inside strings are accepted (``allowUnquotedControlChars``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricepanel.schema import API_RECORD_SCHEMA

# Keys that may hold the records, in the order they are tried,
# and the result codes that mean the key itself was refused.
ROW_KEYS = ("field", "fields", "items", "item", "list")
FATAL_CODES = ("INVALID_KEY", "UNREGISTERED_KEY", "DENIED_KEY", "EXPIRED_KEY")
PAGE_SCHEMA = "prefix string, year int, page_no int, body string"

_JSON_OPTS = {"allowUnquotedControlChars": "true"}
_MAP = "map<string,string>"


def _obj(text: Column) -> Column:
    return F.from_json(text, _MAP, _JSON_OPTS)


def _is_list(v: Column) -> Column:
    return F.coalesce(F.ltrim(v).startswith("["), F.lit(False))


def _is_obj(v: Column) -> Column:
    return F.coalesce(F.ltrim(v).startswith("{"), F.lit(False))


def _objects(list_text: Column) -> Column:
    items = F.from_json(list_text, "array<string>", _JSON_OPTS)
    return F.filter(F.coalesce(items, F.array().cast("array<string>")), _is_obj)


def _unwrap_columns(df: DataFrame, body: str) -> DataFrame:
    """Add ``records`` (array of record JSON texts), ``total_count`` and
    ``result_code``. Each JSON text is parsed once: the stages below are
    separate projections, and Spark does not inline a non-cheap expression
    (``from_json``) into several consumers when it collapses them."""
    top = _obj(F.col(body))
    s1 = df.withColumn("_top", top)
    first_value = F.get(F.map_values("_top"), 0)
    single = (F.size("_top") == 1) & _is_obj(first_value)
    s2 = s1.withColumn("_inner", F.when(single, _obj(first_value)).otherwise(F.col("_top"))).drop("_top")

    inner = F.col("_inner")
    code = F.upper(F.coalesce(inner.getItem("resultCode"), F.lit("")))
    total_text = F.when(F.map_contains_key(inner, "totalCount"), inner.getItem("totalCount")) \
        .otherwise(inner.getItem("totalcount"))
    # The first known key holding a list or an object, as JSON text.
    chosen = F.lit(None).cast("string")
    for key in reversed(ROW_KEYS):
        v = inner.getItem(key)
        chosen = F.when(_is_list(v) | _is_obj(v), v).otherwise(chosen)
    # Fallback: the first list value whose first element is an object.
    fallback = F.get(F.filter(F.map_values(inner), lambda v: _is_list(v) & F.ltrim(v).startswith("[{")), 0)
    s3 = s2.select("*", code.alias("result_code"),
                   F.coalesce(_to_long(total_text), F.lit(0).cast("long")).alias("total_count"),
                   chosen.alias("_chosen"), fallback.alias("_fallback"))
    known = F.when(_is_obj(F.col("_chosen")), F.array("_chosen")).otherwise(_objects(F.col("_chosen")))
    s4 = s3.withColumn("_known", known)
    rows = (F.when(inner.isNull(), F.array().cast("array<string>"))
            .when(F.size("_known") > 0, F.col("_known"))
            .otherwise(_objects(F.col("_fallback"))))
    return s4.withColumn("records", rows).drop("_inner", "_chosen", "_fallback", "_known")


def _to_long(text: Column) -> Column:
    return F.trim(text).try_cast("long")


def page_summary(pages: DataFrame, body: str = "body") -> DataFrame:
    """Per landed page: records array, record count, total count, code."""
    s = _unwrap_columns(pages, body)
    return s.select(*pages.columns, "records", F.size("records").alias("n_rows"), "total_count", "result_code")


def record_texts(pages: DataFrame, body: str = "body", fail_on_fatal: bool = True) -> DataFrame:
    """The records of landed pages as JSON text ``rec``, numbered in their page, next to the page columns.

    An authentication error code fails the job, as it would stop a sweep.
    """
    s = _unwrap_columns(pages, body)
    if fail_on_fatal:
        s = s.withColumn("records", F.when(F.col("result_code").isin(*FATAL_CODES),
                                           F.raise_error(F.concat(F.lit("API key error: "),
                                                                  F.col("result_code"))))
                         .otherwise(F.col("records")))
    page_cols = [c for c in pages.columns if c != body]
    # posexplode_outer + null filter: a plain posexplode makes Spark infer
    # ``size(records) > 0`` and push it below, re-running the unwrap there.
    return s.select(*page_cols, F.posexplode_outer("records").alias("rec_no", "rec")).where(F.col("rec").isNotNull())


def as_map(text: Column) -> Column:
    """A JSON object as a map of its fields' texts."""
    return _obj(text)


def parse_api_pages(pages: DataFrame, body: str = "body", fail_on_fatal: bool = True,
                    schema: T.StructType = API_RECORD_SCHEMA, check: Column | None = None) -> DataFrame:
    """Explode landed pages into raw API records (the text fields of ``schema``).

    Keeps the page columns (request prefix, year, page number) next to the
    record fields. ``check`` may replace the record text ``rec`` (or fail).
    """
    rec = record_texts(pages, body, fail_on_fatal)
    page_cols = [c for c in pages.columns if c != body]
    if check is not None:
        rec = rec.withColumn("rec", check)
    # Exploded from an array of one: a filter on the record's fields stays above an
    # explode, where Spark would push it below a projection and parse the text again there.
    parsed = rec.select(*page_cols, "rec_no", F.explode_outer(F.array(F.from_json("rec", schema, _JSON_OPTS))).alias("_r"))
    return parsed.select(*page_cols, "rec_no", *[F.col("_r").getField(f).alias(f) for f in schema.names])


def zero_total_units(pages: DataFrame, body: str = "body") -> DataFrame:
    """Units whose landed page reported a total count of 0 (finished but
    empty, see ``operators.coverage.done_units``)."""
    s = page_summary(pages, body)
    return (s.where(F.col("total_count") == 0)
            .select(F.substring("prefix", 1, 5).alias("sgg"), F.col("year").alias("stdr_year")).distinct())
