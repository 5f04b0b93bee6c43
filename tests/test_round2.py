"""Cases that the first round's fixtures left out."""

from pyspark.sql import functions as F

from pricepanel.operators import filters, revise, stats
from pricepanel.schema import FACT_SCHEMA
from pricepanel.sources import fact_store

import pytest


def test_median_of_fractions_and_null_groups(spark):
    rows = [("a", -0.5), ("a", 0.25), ("a", 0.3), (None, 7.0), ("b", 0.0), ("b", 1e-300)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.median for r in stats.distributed_median(df, ["k"], "v").collect()}
    assert got == {"a": 0.25, None: 7.0, "b": 5e-301}


def test_keep_first_on_a_written_table(spark, tmp_dir):
    rows = [(k, n) for n in range(6) for k in range(200)]
    df = spark.createDataFrame(rows, "k int, n int").select(
        F.format_string("111101010010001%04d", "k").alias("pnu"), F.lit(2000).alias("stdr_year"), F.lit(1).alias("stdr_month"),
        (F.col("n") + 1000).alias("price_per_m2"), F.lit("2000-01-01").alias("pblntf_de"), F.lit(False).alias("std_land_yn"),
        F.lit("vworld_api").alias("source"), "n")
    have = {f.name for f in FACT_SCHEMA.fields}
    typed = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in FACT_SCHEMA.fields],
                      F.substring("pnu", 1, 5).alias("sgg"), "n") if "sgg" not in have else df
    fact_store.write_fact(typed.repartition(5), f"{tmp_dir}/fact", arrival=("n",))
    first = revise.dedup_keep_first(fact_store.read_fact(spark, f"{tmp_dir}/fact"))
    assert [r.price_per_m2 for r in first.collect()] == [1000] * 200


def test_refetched_page_rows_without_record_columns(spark):
    cols = "pnu string, stdr_year int, stdr_month int, price_per_m2 bigint, pblntf_de string, std_land_yn boolean, last_updt_dt string, source string"
    pnu = "1111010100100010001"
    stored = spark.createDataFrame([(pnu, 2000, 1, 5, "d", True, "1", "vworld_api", 1, 1), (pnu, 2000, 1, 6, "d", True, "2", "vworld_api", 1, 2)],
                                   cols + ", seq int, xp int")
    fetched = spark.createDataFrame([(pnu, 2000, 1, 7, "d", True, "3", "vworld_api", 1, 1), (pnu, 2000, 1, 8, "d", True, "3", "vworld_api", 1, 2)],
                                    cols + ", page_no int, rec_no int")
    fixed = revise.fix_revisions(stored, fetched, refetched_arrival=("page_no", "rec_no")).collect()
    assert [r.price_per_m2 for r in fixed] == [7]


def test_year_spec_and_open_scope(spark):
    assert filters.parse_year_spec("1990-1992, 2005,1991") == [1990, 1991, 1992, 2005]
    assert filters.parse_year_spec("", available=[1990]) == []
    with pytest.raises(ValueError):
        filters.parse_year_spec("1990-x")
    df = spark.createDataFrame([(2031, 1), (1995, 1)], "stdr_year int, stdr_month int")
    assert df.where(filters.scope()).count() == 2
