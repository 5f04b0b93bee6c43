"""Revision rules: W1/W2 ties, J1 overrides, J2 membership, Q7/U2."""

from pyspark.sql import functions as F

from pricepanel.operators import audit, revise

COLS = "pnu string, stdr_year short, stdr_month byte, price_per_m2 long, pblntf_de string, " \
       "std_land_yn boolean, source string, last_updt_dt string, seq long, xp double"


def _df(spark, rows):
    return spark.createDataFrame(rows, COLS)


def _row(pnu="P", year=2024, month=1, price=100, date=None, std=None, upd="", seq=1, src="vworld_api"):
    return (pnu, year, month, price, date, std, src, upd, seq, 0.0)


def test_latest_by_update_stamp(spark):
    df = _df(spark, [_row(price=100, upd="2024-01-01", seq=1), _row(price=110, upd="2024-05-01", seq=2)])
    assert revise.dedup_latest(df).collect()[0].price_per_m2 == 110


def test_ties_last_vs_first(spark):
    df = _df(spark, [_row(price=100, upd="2024-01-01", seq=1), _row(price=110, upd="2024-01-01", seq=2)])
    assert revise.dedup_latest(df, tie="last").collect()[0].price_per_m2 == 110
    assert revise.dedup_latest(df, tie="first").collect()[0].price_per_m2 == 100


def test_missing_stamp_loses(spark):
    df = _df(spark, [_row(price=100, upd=None, seq=9), _row(price=110, upd="1990-01-01", seq=1)])
    assert revise.dedup_latest(df).collect()[0].price_per_m2 == 110


def test_dedup_invariant_under_reshuffle(spark):
    rows = [_row(pnu=f"P{i % 7}", month=1 + i % 2, price=i, upd=f"2024-0{1 + i % 3}-01", seq=i) for i in range(60)]
    a = revise.dedup_latest(_df(spark, rows))
    b = revise.dedup_latest(_df(spark, list(reversed(rows))).repartition(5))
    assert sorted(a.collect()) == sorted(b.collect())
    assert audit.audit_key_unique(a).collect()[0].dup_keys == 0


def test_keep_first(spark):
    df = _df(spark, [_row(price=1, seq=5), _row(price=2, seq=3), _row(price=3, month=7, seq=4)])
    got = {(r.stdr_month, r.price_per_m2) for r in revise.dedup_keep_first(df).collect()}
    assert got == {(1, 2), (7, 3)}


def test_merge_sources_priority(spark):
    df = _df(spark, [_row(price=1, src="seoul_opendata", seq=9, upd="2030-01-01"), _row(price=2, src="vworld_api")])
    df = df.withColumn("collected_at", F.lit("2026-07-15").cast("date"))
    assert revise.merge_sources(df).collect()[0].price_per_m2 == 2


def test_override_semantics(spark):
    base = _df(spark, [_row(pnu="A", price=10, date="d0", std=True), _row(pnu="B", price=20, date="d0", std=False)])
    ov = spark.createDataFrame([("A", 2024, 1, None, "d1"), ("B", 2024, 1, 25, None), ("C", 2024, 1, 99, "d9")],
                               "pnu string, stdr_year short, stdr_month byte, price_ov long, pblntf_ov string")
    out = {r.pnu: r for r in revise.apply_overrides(base, ov).collect()}
    assert set(out) == {"A", "B"}                      # override without base row vanishes
    assert (out["A"].price_per_m2, out["A"].pblntf_de, out["A"].std_land_yn) == (10, "d1", True)
    assert (out["B"].price_per_m2, out["B"].pblntf_de, out["B"].std_land_yn) == (25, "d0", False)


def test_override_broadcast_after_size_check(spark):
    base = _df(spark, [_row(pnu="A", price=10)])
    ov = spark.createDataFrame([("A", 2024, 1, 11, None)],
                               "pnu string, stdr_year short, stdr_month byte, price_ov long, pblntf_ov string")
    plan = revise.apply_overrides(base, ov, broadcast_rows=10)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_candidates_two_independent_tests(spark):
    p = "1111010100100010000"
    other = "1111010100100020000"
    conflicts = spark.createDataFrame([(p, 2024, 1, p[:10])], "pnu string, stdr_year short, stdr_month byte, bjd string")
    refetched = _df(spark, [_row(pnu=p, month=1), _row(pnu=p, month=7), _row(pnu=other, month=1),
                            _row(pnu=p, year=2023, month=1)])
    got = sorted((r.pnu, r.stdr_year, r.stdr_month) for r in revise.conflict_candidates(refetched, conflicts).collect())
    assert got == [(p, 2024, 1), (p, 2024, 7)]


def test_fix_revisions_idempotent(spark):
    rows = [_row(pnu="1111010100100010000", price=100, upd="2024-01-01", seq=1),
            _row(pnu="1111010100100010000", price=120, upd="2024-06-01", seq=2),
            _row(pnu="1111010100100010000", price=120, upd="2024-06-01", seq=3),
            _row(pnu="1111010100100020000", price=50, upd="2024-01-01", seq=4),
            _row(pnu="1111010100100020000", price=50, upd="2024-01-01", seq=5)]
    stored = _df(spark, rows)
    once = revise.fix_revisions(stored, stored)
    got = sorted((r.pnu[-5:], r.price_per_m2) for r in once.collect())
    assert got == [("10000", 120), ("20000", 50)]
    twice = revise.fix_revisions(once, once)
    assert sorted(once.collect()) == sorted(twice.collect())
    assert revise.conflict_keys(once).count() == 0


def test_census_formula_vs_true_surplus(spark):
    rows = [_row(price=p, seq=i) for i, p in enumerate([1, 2, 3, 3])]
    r = revise.conflict_census(_df(spark, rows)).collect()[0]
    assert (r.rows, r.keys, r.conflict_keys) == (4, 1, 1)
    assert r.exact_dup == 2 and r.same_price_surplus == 1


def test_merge_staging_only_touches_dirty_years(spark):
    rows = [_row(year=2023, price=1, seq=1), _row(year=2023, price=2, seq=2),
            _row(year=2024, price=1, seq=1), _row(year=2024, price=2, seq=2)]
    ov = spark.createDataFrame([("P", 2024, 1, 7, None), ("P", 2023, 1, 9, None)],
                               "pnu string, stdr_year short, stdr_month byte, price_ov long, pblntf_ov string")
    out = sorted((r.stdr_year, r.price_per_m2) for r in revise.merge_staging(_df(spark, rows), ov, [2024]).collect())
    assert out == [(2023, 1), (2023, 2), (2024, 7)]
