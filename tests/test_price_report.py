"""The price reports: one scan, null groups, years outside the usual range."""

import os
import re

from pricepanel.operators import coverage, stats

SCHEMA = "pnu string, stdr_year short, stdr_month byte, price_per_m2 long"
A, B = "1111010100100010000", "2611010100100010000"


def _rows():
    return [(A, 2001, 1, 10), (A, 2001, 1, 10), (B, 2001, 1, 40), (B, 2001, 1, 0), (B, 2001, 7, 900),
            (A, 2031, 7, 5), (A, None, 1, 7), (B, None, 1, None)]


def test_year_price_counts_means_and_medians(spark):
    got = {r.stdr_year: (r.parcels, r.avg_price, r.med_price)
           for r in stats.year_price(spark.createDataFrame(_rows(), SCHEMA)).collect()}
    # 2001: (10, 10, 40); 2031 has no January row; a null year is a group too
    assert got == {2001: (4, 20, 10), 2031: (0, None, None), None: (2, 7, 7)}


def test_distributed_report_equals_the_plain_one(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    for report in (stats.year_price, stats.sido_year, stats.summary_region_year):
        both = [sorted(map(tuple, report(df, distributed=d).collect()), key=str) for d in (True, False)]
        assert both[0] == both[1]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert stats.year_price(empty).collect() == []
    assert stats.data_years(empty) == []


def test_the_input_is_scanned_once(spark, tmp_dir):
    path = os.path.join(tmp_dir, "fact")
    spark.createDataFrame(_rows(), SCHEMA).write.parquet(path)
    report = stats.year_price(spark.read.parquet(path))
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet", plan)) == 1
    assert "ReusedExchange" in plan


def test_years_come_from_the_data(spark):
    df = spark.createDataFrame([(A, 1988, 1, 10), (B, 2031, 1, 20)], SCHEMA)
    years = stats.data_years(df)
    assert years == [1988, 2031]
    wide = {r["name"]: r for r in stats.region_wide(stats.sido_year(df), years).collect()}
    assert wide["서울특별시"]["med_1988"] == 10 and wide["부산광역시"]["avg_2031"] == 20
    districts = spark.createDataFrame([("11110",)], "sgg string")
    todo = coverage.units_todo(coverage.unit_grid(districts, years), coverage.done_units(df))
    assert [tuple(r) for r in todo.collect()] == [("11110", 2031)]
