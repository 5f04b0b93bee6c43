"""End-to-end jobs: landed archives/pages -> fact -> revision fix."""

import os

import pytest
from pyspark.sql import functions as F

from pricepanel.plans import fixtures as fx, jobs, landing
from pricepanel.operators import audit, revise
from pricepanel.schema import SRC_API
from pricepanel.sources import fact_store, manifest
from pricepanel.streaming import pages as stream

SF = "/root/testdata/sf0.001"


def test_city_ingest_job(spark, tmp_dir):
    root = os.path.join(tmp_dir, "fact")
    jobs.ingest_city_archives(spark, landing.city_archives(spark, SF), root, "2026-07-15")
    got = fact_store.read_fact(spark, root)
    assert got.count() == fx.city_rows(spark, SF).count()
    assert got.select("source").distinct().collect()[0][0] == "seoul_opendata"


def test_api_ingest_then_fix(spark, tmp_dir):
    root = os.path.join(tmp_dir, "fact")
    pages = landing.landed_pages(spark, SF)
    jobs.ingest_api_pages(pages, root, "2026-07-15")
    stored = fact_store.read_fact(spark, root, source=SRC_API)
    assert audit.audit_key_unique(stored).collect()[0].dup_keys == 0
    # nothing to fix: the pointer stays
    before = manifest.current(spark, root)
    assert jobs.fix_revisions_job(spark, root, fx.api_rows(spark, SF)) == before == manifest.current(spark, root)


def _with_revisions(spark, root):
    rows = fact_store.prepare_fact(fx.api_rows(spark, SF), collected_at="2026-07-15")
    others = fact_store.prepare_fact(fx.city_rows(spark, SF), collected_at="2026-07-15")
    return fact_store.write_fact(rows.unionByName(others), root)


def test_fix_swaps_the_changed_units_once(spark, tmp_dir):
    root = os.path.join(tmp_dir, "fact")
    before = _with_revisions(spark, root)
    conflicts = revise.conflict_keys(fact_store.read_fact(spark, root, source=SRC_API)).count()
    assert conflicts > 0
    after = jobs.fix_revisions_job(spark, root, fx.api_rows(spark, SF))
    assert after.number == before.number + 1
    fixed = fact_store.read_fact(spark, root, source=SRC_API)
    assert revise.conflict_keys(fixed).count() == 0 and audit.audit_key_unique(fixed).collect()[0].dup_keys == 0
    assert fact_store.read_fact(spark, root).where("source <> 'vworld_api'").count() == fx.city_rows(spark, SF).count()
    kept = manifest.files(spark, after).join(manifest.files(spark, before), "path").count()
    assert 0 < kept < manifest.files(spark, before).count()
    assert jobs.fix_revisions_job(spark, root, fx.api_rows(spark, SF)) == after  # second run: no change


def test_of_two_fixers_one_wins(spark, tmp_dir, monkeypatch):
    root = os.path.join(tmp_dir, "fact")
    _with_revisions(spark, root)
    real, done = manifest.move_pointer, []

    def overtaken(spark, state, name):
        if not done:  # another fixer runs from start to end just before this one moves the pointer
            done.append(True)
            done.append(jobs.fix_revisions_job(spark, root, fx.api_rows(spark, SF)))
        return real(spark, state, name)

    monkeypatch.setattr(manifest, "move_pointer", overtaken)
    with pytest.raises(manifest.LostRace):
        jobs.fix_revisions_job(spark, root, fx.api_rows(spark, SF))
    assert manifest.current(spark, root) == done[1]


def test_stream_then_build_fact(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    landing.landed_pages(spark, SF).write.json(land)
    records = os.path.join(tmp_dir, "records")
    q = stream.start_page_ingest(spark, land, records, os.path.join(tmp_dir, "ckpt"))
    assert q.awaitTermination(600)
    rec = stream.read_records(spark, records)
    assert rec.count() == fx.api_rows(spark, SF).count()
    root = os.path.join(tmp_dir, "fact")
    stream.build_fact(rec, root, "2026-07-15")
    stored = fact_store.read_fact(spark, root)
    expect = revise.dedup_latest(fx.api_rows(spark, SF)).count()
    assert stored.count() == expect
    # a second trigger over the same landing adds nothing (exactly once)
    q2 = stream.start_page_ingest(spark, land, records, os.path.join(tmp_dir, "ckpt"))
    assert q2.awaitTermination(600)
    assert stream.read_records(spark, records).count() == rec.count()


def test_incremental_build_replaces_only_touched_units(spark, tmp_dir):
    pages = landing.landed_pages(spark, SF)
    first_year = pages.agg(F.min("year")).collect()[0][0]
    land = os.path.join(tmp_dir, "landing")
    pages.where(F.col("year") != first_year).write.json(land + "/a")
    records = os.path.join(tmp_dir, "records")
    ckpt = os.path.join(tmp_dir, "ckpt")
    assert stream.start_page_ingest(spark, land + "/*", records, ckpt).awaitTermination(600)
    root = os.path.join(tmp_dir, "fact")
    stream.build_fact(stream.read_records(spark, records), root, "2026-07-15")
    before = fact_store.read_fact(spark, root).where(F.col("stdr_year") != first_year).count()
    # a new landing batch for the first year only
    new = pages.where(F.col("year") == first_year)
    new.write.json(land + "/b")
    assert stream.start_page_ingest(spark, land + "/*", records, ckpt).awaitTermination(600)
    stream.build_fact(stream.read_records(spark, records), root, "2026-07-15", units=stream.units_in_pages(new))
    after = fact_store.read_fact(spark, root)
    assert after.where(F.col("stdr_year") != first_year).count() == before
    expect = revise.dedup_latest(fx.api_rows(spark, SF)).count()
    assert after.count() == expect
