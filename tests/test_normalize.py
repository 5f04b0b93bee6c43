"""Hand-written rows for the normalisers."""

import pytest
from pyspark.sql import functions as F

from pricepanel.functions import normalize as N


def _eval(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_price_truncates_and_strips(spark):
    assert _eval(spark, ["1,200", "0", "1234.9", " 15,500.9 ", "-3.7", ""], N.norm_price) == \
        [1200, 0, 1234, 15500, -3, None]


def test_price_strict_and_lenient(spark):
    with pytest.raises(Exception):
        _eval(spark, ["abc"], N.norm_price)
    assert _eval(spark, ["abc"], lambda c: N.norm_price(c, strict=False)) == [None]


def test_month_api(spark):
    got = _eval(spark, ["01", "1", " 7 ", "07", "", "x", "00", None],
                lambda c: N.month_zero_to_one(N.norm_month_api(c)))
    assert got == [1, 1, 7, 7, 1, 1, 1, 1]


def test_month_city_spellings(spark):
    got = _eval(spark, ["1990-01-01", "1990.7", "199007", "07", "7", "", "abc", "1990-07"],
                N.norm_month_multi)
    assert got == [1, 7, 7, 7, 7, 1, 1, 7]


def test_month_bulk(spark):
    assert _eval(spark, ["", "7", " 1 "], N.norm_month_bulk) == [1, 7, 1]


def test_bool_flag(spark):
    got = _eval(spark, ["Y", "y", "1", "TRUE", "표준지", "N", "", None], N.norm_bool_yn)
    assert got == [True, True, True, True, True, False, None, None]


def test_strip_unicode_whitespace(spark):
    got = _eval(spark, ["　 a\t", "\n b  "], N.strip)
    assert got == ["a", "b"]


def test_null_if_empty(spark):
    assert _eval(spark, ["", "  ", "20240101"], N.null_if_empty) == [None, None, "20240101"]


def test_api_row_drops_and_coerces(spark):
    rows = [("1111010100100010000", "2024", "00", "1,000", "", "Y", "2024-01-01"),
            ("", "2024", "1", "5", "", "", ""),            # no pnu -> dropped
            ("1111010100100010001", "2024", "7", " ", "", "", ""),  # no price -> dropped
            ("1111010100100010002", " ", "1", "5", "", "", "")]     # no year -> dropped
    df = spark.createDataFrame(rows, "pnu string, stdrYear string, stdrMt string, pblntfPclnd string, "
                                     "pblntfDe string, stdLandAt string, lastUpdtDt string")
    out = N.norm_api_row(df).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.stdr_year, r.stdr_month, r.price_per_m2, r.pblntf_de, r.std_land_yn, r.last_updt_dt) == \
        (2024, 1, 1000, None, True, "2024-01-01")


def test_schema_coerce_types(spark):
    df = spark.createDataFrame([("p", 2024, 0, 5, None, None)],
                               "pnu string, stdr_year int, stdr_month int, price_per_m2 long, "
                               "pblntf_de string, std_land_yn boolean")
    out = N.to_fact_schema(df, source="vworld_api", collected_at="2026-07-15")
    assert [f.dataType.simpleString() for f in out.schema.fields] == \
        ["string", "smallint", "tinyint", "bigint", "string", "boolean", "string", "date"]
    assert out.collect()[0].stdr_month == 1


def test_schema_coerce_overflow_fails(spark):
    df = spark.createDataFrame([("p", 2024, 300, 5, None, None)],
                               "pnu string, stdr_year int, stdr_month int, price_per_m2 long, "
                               "pblntf_de string, std_land_yn boolean")
    with pytest.raises(Exception):
        N.to_fact_schema(df, source="x").collect()
