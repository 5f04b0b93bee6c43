"""The unit manifest: atomic replacement, bound readers, pruned scans, lost races."""

import os

import pytest
from pyspark.sql import functions as F
from test_sources import _fact

from pricepanel.operators import filters, stats
from pricepanel.schema import SRC_API, STORED_SCHEMA
from pricepanel.sources import fact_store, manifest

SEOUL, BUSAN = "1111010100100010000", "2611010100100010000"


def rows(df):
    return sorted((r.pnu[:5], r.stdr_year, r.price_per_m2) for r in df.collect())


def test_a_table_without_rows(spark, tmp_dir):
    assert manifest.current(spark, tmp_dir) == manifest.State(tmp_dir)
    assert fact_store.read_fact(spark, tmp_dir).count() == 0 and fact_store.read_fact(spark, tmp_dir).schema == STORED_SCHEMA
    assert fact_store.write_fact(_fact(spark, []), tmp_dir).number == 0


def test_a_writer_lost_before_the_move_leaves_the_old_rows(spark, tmp_dir, monkeypatch):
    fact_store.write_fact(_fact(spark, [(SEOUL, 2024, 1, 10), (BUSAN, 2024, 1, 20)]), tmp_dir)
    before = fact_store.read_fact(spark, tmp_dir)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(manifest, "move_pointer", killed)
        with pytest.raises(KeyboardInterrupt):
            fact_store.write_fact(_fact(spark, [(SEOUL, 2024, 1, 11)]), tmp_dir)
    old = [("11110", 2024, 10), ("26110", 2024, 20)]
    assert rows(before) == old and rows(fact_store.read_fact(spark, tmp_dir)) == old
    fact_store.write_fact(_fact(spark, [(SEOUL, 2024, 1, 12)]), tmp_dir)  # the next writer is not in its way
    assert rows(fact_store.read_fact(spark, tmp_dir)) == [("11110", 2024, 12), ("26110", 2024, 20)]


def test_a_lost_task_or_data_write_leaves_the_old_rows(spark, tmp_dir):
    fact_store.write_fact(_fact(spark, [(SEOUL, 2024, 1, 10)]), tmp_dir)
    broken = _fact(spark, [(SEOUL, 2024, 1, 11), (SEOUL, 2024, 1, 12)]).withColumn(
        "price_per_m2", F.when(F.col("price_per_m2") == 12, F.raise_error(F.lit("lost"))).otherwise(F.col("price_per_m2")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        fact_store.write_fact(broken, tmp_dir)
    assert rows(fact_store.read_fact(spark, tmp_dir)) == [("11110", 2024, 10)]


def test_a_query_reads_one_version_throughout(spark, tmp_dir):
    fact_store.write_fact(_fact(spark, [(SEOUL, 2024, 1, 10), (SEOUL, 2025, 1, 20)]), tmp_dir)
    state, query = manifest.current(spark, tmp_dir), fact_store.read_fact(spark, tmp_dir)
    fact_store.write_fact(_fact(spark, [(SEOUL, 2024, 1, 11), (SEOUL, 2025, 1, 21)]), tmp_dir)
    assert rows(query) == [("11110", 2024, 10), ("11110", 2025, 20)] == rows(fact_store.read_fact(spark, tmp_dir, state=state))
    assert rows(fact_store.read_fact(spark, tmp_dir)) == [("11110", 2024, 11), ("11110", 2025, 21)]


def test_a_table_may_be_read_by_the_plan_that_replaces_its_units(spark, tmp_dir):
    fact_store.write_fact(_fact(spark, [(SEOUL, 2024, 1, 10), (BUSAN, 2024, 1, 20)]), tmp_dir)
    stored = fact_store.read_fact(spark, tmp_dir)
    fact_store.write_fact(stored.withColumn("price_per_m2", F.col("price_per_m2") + 1), tmp_dir)
    assert rows(fact_store.read_fact(spark, tmp_dir)) == [("11110", 2024, 11), ("26110", 2024, 21)]


def test_overtaken_writers(spark, tmp_dir, monkeypatch):
    start = fact_store.write_fact(_fact(spark, [(SEOUL, 2024, 1, 10), (BUSAN, 2024, 1, 20)]), tmp_dir)
    real, done = manifest.move_pointer, []

    def overtaken(spark, state, name):
        if not done:
            done.append(True)
            fact_store.write_fact(_fact(spark, [(BUSAN, 2024, 1, 99), (SEOUL, 2025, 1, 5)]), tmp_dir)
        return real(spark, state, name)

    monkeypatch.setattr(manifest, "move_pointer", overtaken)
    # a plain writer goes on from the newer state: both writers' units are in force
    fact_store.write_fact(_fact(spark, [(SEOUL, 2024, 1, 11)]), tmp_dir)
    assert rows(fact_store.read_fact(spark, tmp_dir)) == [("11110", 2024, 11), ("11110", 2025, 5), ("26110", 2024, 99)]
    with pytest.raises(manifest.LostRace):
        fact_store.write_fact(_fact(spark, [(SEOUL, 2024, 1, 12)]), tmp_dir, expected=start)
    with pytest.raises(manifest.LostRace):
        real(spark, start, "another")
    assert [f for f in os.listdir(f"{tmp_dir}/_pointer") if not f.startswith(".")] == [f"{start.number + 2:010d}"]


def test_scans_open_named_files_only(spark, tmp_dir):
    city = _fact(spark, [(SEOUL, 2024, 1, 7)]).withColumn("source", F.lit("seoul_opendata"))
    made = _fact(spark, [(p, y, 1, 1) for p in (SEOUL, SEOUL[:-1] + "9", BUSAN, "4111010100100010000") for y in (2022, 2023, 2024)])
    state = fact_store.write_fact(made.unionByName(city), tmp_dir)

    def named(**scope):
        return manifest.named_files(spark, state, manifest.file_scope(**scope))

    assert len(named()) == 10 and len(named(source=SRC_API)) == 9
    assert len(named(source=SRC_API, years=(2024,))) == 3 and len(named(y0=2023, y1=2023)) == 3
    assert len(named(source=SRC_API, regions=("11", "41"))) == 6 and len(named(source=SRC_API, regions=("11110",))) == 3
    assert len(named(regions=(BUSAN,))) == 3 and named(regions=("99",)) == [] and named(regions=("1111010100100010010",)) == []
    df = fact_store.read_fact(spark, tmp_dir, scope=manifest.file_scope(years=(2024,), regions=("26110",)))
    assert df.where(filters.scope(year=2024, sgg="26110", partition_col="sgg")).count() == 1 and len(df.inputFiles()) == 1
    one = fact_store.read_fact(spark, tmp_dir, source=SRC_API, scope=manifest.file_scope(regions=(SEOUL,)))
    assert [tuple(r) for r in stats.series_parcel(one, SEOUL).orderBy("stdr_year").collect()] == [(2022, 1), (2023, 1), (2024, 1)]
    assert sum(r["rows"] for r in manifest.files(spark, state).collect()) == 13


def test_superseded_files_go_on_request(spark, tmp_dir):
    fact_store.write_fact(_fact(spark, [(SEOUL, 2024, 1, 10), (BUSAN, 2024, 1, 20)]), tmp_dir)
    fact_store.write_fact(_fact(spark, [(SEOUL, 2024, 1, 11)]), tmp_dir)
    assert manifest.remove_superseded(spark, tmp_dir, older_than_ms=3_600_000) == 0
    assert manifest.remove_superseded(spark, tmp_dir, older_than_ms=0) == 1
    assert os.listdir(f"{tmp_dir}/manifests") == [manifest.current(spark, tmp_dir).manifest]
    assert rows(fact_store.read_fact(spark, tmp_dir)) == [("11110", 2024, 11), ("26110", 2024, 20)]
