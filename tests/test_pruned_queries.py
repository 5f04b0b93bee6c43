"""Registered reports read the partitioned fact table; S8 sections; N9 prices."""

import json
import re

import pytest
from pyspark.sql import functions as F

from pricepanel.plans import catalog
from pricepanel.sources import archives, sinks

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name, column", [
    ("filter_scope", "stdr_year"), ("filter_scope_sgg_year", "sgg"), ("filter_region_in", "sgg"), ("series_parcel", "sgg"),
    ("agg_sido_snapshot", "stdr_year"), ("agg_sgg_median", "source"), ("rank_desc", "stdr_year"), ("summary_sgg_year", "source")])
def test_partition_filters(spark, name, column):
    plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert filters and all(column + "#" in f for f in filters), filters


def _facts(spark):
    return spark.createDataFrame(
        [("1111010100100010000", 2024, 1, 100, "vworld_api"), ("2611010100100010000", 2024, 1, 300, "vworld_api"),
         ("2711010100100010000", 2024, 1, 0, "vworld_api"), ("1111010100100010000", 2023, 7, 5, "seoul_opendata")],
        "pnu string, stdr_year short, stdr_month byte, price_per_m2 long, source string")


def test_report_sections_shape(spark):
    fact = _facts(spark)
    api = fact.where(F.col("source") == "vworld_api")
    got = {r.section: json.loads(r.json) for r in
           sinks.report_sections(fact, api, "1111010100100010000", 2024, "a parcel").collect()}
    assert got["summary"] == {"rows": 4, "years": 2, "min_year": 2023, "max_year": 2024}
    assert [(r["code"], r["avg"]) for r in got["per_sido"]] == [("26", 300), ("11", 100), ("27", None)]
    assert got["sources"] == [{"source": "vworld_api", "rows": 3}, {"source": "seoul_opendata", "rows": 1}]
    assert got["sample_parcel"] == {"pnu": "1111010100100010000", "label": "a parcel", "series": [{"year": 2024, "price": 100}]}
    assert got["per_year"] == [{"year": 2024, "parcels": 3, "avg": 200, "med": 200}]


def test_report_sections_of_nothing(spark):
    fact = _facts(spark).where("false")
    got = {r.section: json.loads(r.json) for r in sinks.report_sections(fact, fact, "1", 2024).collect()}
    assert got["summary"] == {"rows": 0, "years": 0, "min_year": None, "max_year": None}
    assert got["per_sido"] == [] and got["sample_parcel"] == {"pnu": "1", "label": "", "series": []}


def test_bulk_price_of_separators_only(spark):
    cells = ["1111010100100010000", "", "", "", "", "", "2024", "1", ",", "", ""]
    rows = spark.createDataFrame([(cells,)], "row array<string>")
    assert archives.bulk_rows(rows, strict=False).first().price_per_m2 is None
    with pytest.raises(Exception, match="price is not a number"):
        archives.bulk_rows(rows).collect()
