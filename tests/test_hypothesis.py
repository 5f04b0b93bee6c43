"""Property tests (hypothesis): each example set runs as one Spark job."""

from hypothesis import given, settings, strategies as st, HealthCheck
from pyspark.sql import functions as F

from pricepanel.functions import normalize as N
from pricepanel.operators import revise, stats

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

WS = " \t\n\r\x0b\x0c\x1c\x1f\x85\xa0     　"
texts = st.text(alphabet=st.sampled_from(list(WS) + list("ab1,가﻿")), max_size=12)


@SETTINGS
@given(st.lists(texts, min_size=1, max_size=40))
def test_strip_equals_python_strip(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(N.strip("v")).collect()]
    assert got == [v.strip() for v in values]


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-10**9, 10**9) | st.sampled_from([0, 7, 7, 7])),
                min_size=1, max_size=200))
def test_distributed_median_equals_median(spark, rows):
    df = spark.createDataFrame(rows, "g int, v long")
    exact = {r.g: r.m for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    dist = {r.g: r.median for r in stats.distributed_median(df, ["g"], "v").collect()}
    assert dist == exact


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["", "2024-01-01", "2024-02-01"]), st.integers(0, 99)),
                min_size=1, max_size=60), st.randoms())
def test_latest_revision_order_invariant(spark, rows, rnd):
    data = [(f"P{k}", 2024, 1, price, None, None, "vworld_api", upd, i, 0.0) for i, (k, upd, price) in enumerate(rows)]
    cols = ("pnu string, stdr_year short, stdr_month byte, price_per_m2 long, pblntf_de string, "
            "std_land_yn boolean, source string, last_updt_dt string, seq long, xp double")
    shuffled = list(data)
    rnd.shuffle(shuffled)
    a = revise.dedup_latest(spark.createDataFrame(data, cols)).collect()
    b = revise.dedup_latest(spark.createDataFrame(shuffled, cols).repartition(3)).collect()
    assert sorted(a) == sorted(b)
    # the kept row per key: newest stamp, then the last arrival
    best = {}
    for r in data:
        k = r[0]
        if k not in best or (r[7], r[8]) >= (best[k][7], best[k][8]):
            best[k] = r
    assert sorted((r.pnu, r.seq) for r in a) == sorted((k, v[8]) for k, v in best.items())
