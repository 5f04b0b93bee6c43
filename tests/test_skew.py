"""A key holding a third of all rows: results stay whole and exact, and
the plans split or pre-aggregate the hot key instead of funnelling it."""

from pyspark.sql import functions as F

from pricepanel.operators import audit, revise, stats

HOT = "1111010100100010000"


def _skewed(spark, n=30_000):
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(HOT))
         .otherwise(F.concat(F.lit("26110101001"), F.lpad((F.col("id") % 5000).cast("string"), 8, "0"))).alias("pnu"),
        F.lit(2024).cast("short").alias("stdr_year"),
        F.lit(1).cast("byte").alias("stdr_month"),
        ((F.col("id") * 7919) % 100_000).alias("price_per_m2"),
        F.lit(None).cast("string").alias("pblntf_de"),
        F.lit(None).cast("boolean").alias("std_land_yn"),
        F.lit("vworld_api").alias("source"),
        F.date_format(F.date_add(F.lit("2024-01-01"), (F.col("id") % 300).cast("int")), "yyyy-MM-dd").alias("last_updt_dt"),
        F.col("id").alias("seq"), F.lit(0.0).alias("xp"))
    return df.repartition(8)


def test_dedup_hot_key_keeps_one_row_and_limits_map_side(spark):
    df = _skewed(spark)
    out = revise.dedup_latest(df)
    hot = out.where(F.col("pnu") == HOT).collect()
    assert len(hot) == 1
    # newest stamp, then the latest arrival among equal stamps
    expect = df.where(F.col("pnu") == HOT).orderBy(F.col("last_updt_dt").desc(), F.col("seq").desc()).first()
    assert hot[0].seq == expect.seq
    assert audit.audit_key_unique(out).collect()[0].dup_keys == 0
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_census_and_median_on_hot_group(spark):
    df = _skewed(spark)
    r = revise.conflict_census(df).collect()[0]
    assert r.rows == 30_000 and r.keys == 5000 + 1
    exact = {x.stdr_year: x.med_price for x in stats.year_price(df).collect()}
    dist = {x.stdr_year: x.med_price for x in stats.year_price(df, distributed=True).collect()}
    assert exact == dist


def test_cross_check_preaggregates_hot_parcel(spark):
    city = _skewed(spark).withColumn("source", F.lit("seoul_opendata"))
    api = _skewed(spark, 9_000)
    out = audit.cross_source(city, api)
    row = out.collect()[0]
    # brute force: row-level join of the sample with the latest API price
    ref = revise.dedup_latest(api.where(F.col("stdr_month") == 1), key=["pnu", "stdr_year"]) \
        .select("pnu", "stdr_year", F.col("price_per_m2").alias("api_price"))
    j = city.join(ref, ["pnu", "stdr_year"], "left").collect()
    missing = sum(r.api_price is None for r in j)
    match = sum(r.api_price is not None and r.api_price == r.price_per_m2 for r in j)
    assert (row.total, row.match, row.missing, row.mismatch) == (30_000, match, missing, 30_000 - match - missing)
    plan = out._jdf.queryExecution().executedPlan().toString()
    join_at = plan.find("Join")
    assert "partial_count" in plan[join_at:]     # the sample is counted before it reaches the join
