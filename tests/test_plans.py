"""Plan shape checks: de-dup limits map-side, pushdown, no Python workers."""

from pyspark.sql import functions as F

from pricepanel.operators import revise, stats
from pricepanel.plans import fixtures as fx

SF = "/root/testdata/sf0.001"


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_before_shuffle(spark):
    p = revise.dedup_latest(fx.api_rows(spark, SF))._jdf.queryExecution().sparkPlan().toString()
    assert p.count("WindowGroupLimit") >= 2       # partial (map side) + final


def test_stats_single_aggregate_no_python(spark):
    p = _plan(stats.year_price(fx.api_rows(spark, SF)))
    assert "ArrowEvalPython" not in p and "PythonUDF" not in p and "MapInPandas" not in p


def test_parcel_filter_pushed_to_scan(spark, tmp_dir):
    df = spark.createDataFrame([("2612010221100010001", 2000, 1, 5)],
                               "pnu string, stdr_year short, stdr_month byte, price_per_m2 long")
    df.write.parquet(tmp_dir + "/t")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    q = stats.series_parcel(spark.read.parquet(tmp_dir + "/t"), "2612010221100010001")
    p = _plan(q)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "StringStartsWith(pnu,26120)" in p and "EqualTo(pnu,2612010221100010001)" in p


PYTHON_OK = {"src_zip_csv_keyword", "norm_city_row", "src_zip_csv_positional", "norm_bulk_row", "src_region_codes"}


def test_no_python_workers_outside_archive_readers(spark):
    import __spark_entry__ as entry
    for name, fn in entry.queries().items():
        if name in PYTHON_OK or name.startswith(("sink_", "src_fact", "stream_")):
            continue
        plan = fn(spark, SF)._jdf.queryExecution().sparkPlan().toString()
        assert "MapInPandas" not in plan and "PythonUDF" not in plan and "BatchEvalPython" not in plan, name


def test_broadcast_only_within_bound(spark):
    from pricepanel.operators.joins import maybe_broadcast, size_bounded
    big = spark.range(100).withColumnRenamed("id", "k")
    small = spark.range(10).withColumnRenamed("id", "k")
    assert size_bounded(small, 10) and not size_bounded(small, 9)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in old:
        spark.conf.set(k, "-1")
    try:
        hinted = big.join(maybe_broadcast(small, 10), "k")._jdf.queryExecution().executedPlan().toString()
        beyond = big.join(maybe_broadcast(small, 5), "k")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in hinted
        assert "BroadcastHashJoin" not in beyond and "SortMergeJoin" in beyond
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
