"""D2 monthly interpolation against a brute-force product (pandas)."""

from fractions import Fraction

from pyspark.sql import functions as F

from pricepanel.operators import stats


def test_monthly_interpolation_brute_force(spark):
    rates = [("11110", 2024, m, 100_003 * (m % 3) - 100_000) for m in range(1, 13) if m != 5]
    rates_df = spark.createDataFrame(rates, "sgg string, stdr_year short, month int, rate_e7 long")
    fact = spark.createDataFrame([("1111010100100010000", 2024, 1, 1000), ("1111010100100010001", 2024, 7, 5)],
                                 "pnu string, stdr_year short, stdr_month byte, price_per_m2 long")
    out = stats.monthly_interpolation(fact, stats.cumulative_factors(rates_df)).toPandas()
    assert len(out) == 12                      # only the regular-month row expands
    r = {m: rt for _, _, m, rt in rates}
    for row in out.itertuples():
        f = Fraction(1)
        for m in range(2, row.month + 1):
            f *= 1 + Fraction(r.get(m, 0), 10**7)
        assert abs(row.factor_ppm - f * 10**6) <= Fraction(51, 100)
        assert row.price_interp == (1000 * row.factor_ppm + 500_000) // 1_000_000


def test_factors_are_an_ordered_whole_number_fold(spark):
    """One rounding a month, halves up: the exact product in decimal steps."""
    rates = [("a", 2024, m, r) for m, r in [(2, 5), (3, -9_999_999), (4, 4_999_999), (12, 1)]] + [("b", 2024, 1, 777)]
    got = stats.cumulative_factors(spark.createDataFrame(rates, "sgg string, stdr_year short, month int, rate_e7 long")).collect()
    by = {(r.sgg, r.month): r.factor_ppm for r in got}
    assert len(by) == 24 and all(by["b", m] == 10**6 for m in range(1, 13))
    f = 10**10
    for m in range(1, 13):
        f = (f * (10**7 + dict((x[2], x[3]) for x in rates[:4]).get(m, 0)) + 5 * 10**6) // 10**7
        assert by["a", m] == (f + 5000) // 10_000


def test_distributed_median_matches_exact(spark):
    import random
    rnd = random.Random(7)
    rows = []
    for g in range(4):
        n = [1, 2, 7, 500][g]
        for i in range(n):
            v = rnd.choice([0, -5, 3, 3, 3, 1000, 1001, 250_000, 10 ** 9]) if g == 3 else rnd.randint(-50, 10 ** 6)
            rows.append((g, v))
    rows += [(3, 3)] * 400                      # a heavy repeated value
    df = spark.createDataFrame(rows, "g int, v long")
    exact = {r.g: r.m for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    dist = {r.g: r.median for r in stats.distributed_median(df, ["g"], "v").collect()}
    assert dist == exact


def test_distributed_reports_match(spark):
    from pricepanel.plans import fixtures as fx
    api = fx.api_rows(spark, "/root/testdata/sf0.001")
    for fn in (lambda d: stats.sido_year(api, distributed=d),
               lambda d: stats.sgg_median(api, 2000, distributed=d),
               lambda d: stats.summary_region_year(api, "sgg", distributed=d)):
        a, b = fn(False), fn(True)
        assert sorted(a.columns) == sorted(b.columns)
        assert sorted(a.select(*sorted(a.columns)).collect()) == sorted(b.select(*sorted(a.columns)).collect())
