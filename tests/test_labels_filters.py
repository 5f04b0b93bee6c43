"""Labels (N12-N14), PNU parts (N11) and scope filters."""

from pyspark.sql import functions as F

from pricepanel.functions import labels, pnu
from pricepanel.operators import filters


def test_labels(spark):
    df = spark.createDataFrame([("12",), ("42",), ("51",), ("99",)], "c string")
    rows = df.select("c", labels.region_label("c").alias("a"), labels.region_label_merged("c").alias("b")).collect()
    got = {r.c: (r.a, r.b) for r in rows}
    assert got["12"] == ("전남광주", None)
    assert got["42"][1] == got["51"][1] == "강원도"
    assert got["99"] == ("99", None)


def test_region_key(spark):
    df = spark.createDataFrame([("11010", "종로구"), ("99010", "x")], "code string, name string")
    got = [r[0] for r in df.select(labels.region_key("code", "name")).collect()]
    assert got == ["서울|종로구", None]


def test_pnu_parts(spark):
    df = spark.createDataFrame([("1111010100200090004",)], "pnu string")
    r = df.select(*pnu.pnu_parts()).collect()[0]
    assert (r.sido, r.sgg, r.bjd, r.regstr_class, r.main_no, r.sub_no) == \
        ("11", "11110", "1111010100", "2", "0009", "0004")


def test_year_spec():
    assert filters.parse_year_spec("1985-1991,2005") == [1990, 1991, 2005]
    assert filters.parse_year_spec("1990-2000", available=[1995, 2001]) == [1995]


def test_scope_and_region(spark):
    df = spark.createDataFrame([("1111000000000000001", 2000, 1), ("2611000000000000001", 2000, 1),
                                ("1111000000000000002", 2000, 7), ("1111000000000000003", 1999, 1)],
                               "pnu string, stdr_year int, stdr_month int")
    assert df.where(filters.scope(year=2000, sgg="11110")).count() == 1
    assert df.where(filters.scope(year=2000, month=0, sido="11")).count() == 2
    assert df.where(filters.scope(y0=1999, y1=2000, sido="11")).count() == 2
    assert df.where(filters.region_in(exclude_sido=["26"])).count() == 3
    assert df.where(filters.region_in(include_sgg=["26110"])).count() == 1
