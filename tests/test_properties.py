"""Cross-report invariants on the sf0.001 fixture."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from pricepanel.operators import audit, revise, stats
from pricepanel.plans import fixtures as fx
from pricepanel.sources import fact_store

SF = "/root/testdata/sf0.001"


def test_snapshot_parcels_sum_to_yearly_parcels(spark):
    api = fx.api_rows(spark, SF)
    for year in (1996, 2000):
        a5 = stats.sido_snapshot(api, year).agg(F.sum("parcels")).collect()[0][0]
        a3 = stats.year_price(api).where(F.col("stdr_year") == year).collect()[0].parcels
        assert a5 == a3


def test_source_mix_sums_to_rows(spark):
    fact = fx.fact(spark, SF)
    assert stats.source_mix(fact).agg(F.sum("rows")).collect()[0][0] == stats.overall(fact).collect()[0].n_rows


def test_override_keeps_row_count_and_fix_clears_conflicts(spark):
    api = fx.api_rows(spark, SF)
    ov = revise.authoritative(revise.conflict_candidates(api, revise.conflict_keys(api)))
    assert revise.apply_overrides(api, ov).count() == api.count()
    fixed = revise.fix_revisions(api, api)
    assert audit.audit_key_unique(fixed, key=["pnu", "stdr_year", "stdr_month"]).collect()[0].dup_keys == 0
    assert revise.conflict_keys(fixed).count() == 0


def test_approximate_median_close_to_exact(spark):
    api = fx.api_rows(spark, SF)
    exact = {r.stdr_year: r.med_price for r in stats.year_price(api).collect()}
    approx = {r.stdr_year: r.med_price for r in stats.year_price(api, exact=False).collect()}
    for y, m in exact.items():
        assert abs(approx[y] - m) <= max(1, 0.05 * abs(m))


def test_reference_layout_reader(spark, tmp_dir):
    schema = pa.schema([("pnu", pa.string()), ("stdr_year", pa.int16()), ("stdr_month", pa.int8()),
                        ("price_per_m2", pa.int64()), ("pblntf_de", pa.string()), ("std_land_yn", pa.bool_()),
                        ("source", pa.string()), ("collected_at", pa.date32())])
    for year, sgg, src, price in [(1990, "11110", "vworld_api", 1), (1990, "11110", "seoul_opendata", 2),
                                  (1991, "26110", "vworld_api", 3)]:
        d = os.path.join(tmp_dir, f"stdr_year={year}")
        os.makedirs(d, exist_ok=True)
        t = pa.table({"pnu": [sgg + "01010010001"], "stdr_year": [year], "stdr_month": [1], "price_per_m2": [price],
                      "pblntf_de": [None], "std_land_yn": [None], "source": [src], "collected_at": [None]},
                     schema=schema).drop(["stdr_year"])
        pq.write_table(t, os.path.join(d, f"sgg={sgg}-{src}.parquet"))
    df = fact_store.read_reference_layout(spark, tmp_dir, "vworld_api")
    got = sorted((r.stdr_year, r.sgg, r.price_per_m2) for r in df.collect())
    assert got == [(1990, "11110", 1), (1991, "26110", 3)]
