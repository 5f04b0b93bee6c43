"""The second record kind: landed pages into a table of its own, checked fields and columns."""

import json

import pytest
from pyspark.sql import functions as F
from test_sources import _pages

from pricepanel.sources import manifest, records

GOOD = {"pnu": "1111010100100010000", "stdLandSn": "7", "stdrYear": "2024", "lndcgrCodeNm": "대", "lndpclAr": "1,234.5",
        "prposArea1Nm": "", "pblntfPclnd": "2,000", "lastUpdtDt": "2024-01-02"}


def landed(spark, *recs):
    return _pages(spark, [json.dumps({"referLandPrices": {"totalCount": len(recs), "field": list(recs)}}, ensure_ascii=False)])


def test_standard_pages_become_a_table(spark, tmp_dir):
    later = GOOD | {"pblntfPclnd": "2500", "lastUpdtDt": "2024-03-01"}
    other = GOOD | {"pnu": "2611010100100010000", "lndpclAr": "", "stdrYear": "2023"}
    no_price = GOOD | {"pnu": "2611010100100010009", "pblntfPclnd": " "}
    state = records.ingest_pages(landed(spark, later, GOOD, other, no_price), records.STANDARD, tmp_dir, "2026-07-15")
    got = records.read_records(spark, records.STANDARD, tmp_dir)
    assert got.schema == records.STANDARD.stored
    rows = sorted((r.pnu[:5], r.stdr_year, r.price_per_m2, r.area_m2 and float(r.area_m2), r.zoning, r.land_category, r.std_no) for r in got.collect())
    assert rows == [("11110", 2024, 2500, 1234.5, None, "대", "7"), ("26110", 2023, 2000, None, None, "대", "7")]
    one = records.read_records(spark, records.STANDARD, tmp_dir, manifest.file_scope(years=(2023,)))
    assert one.count() == 1 and len(one.inputFiles()) == 1
    # a second landing replaces its unit only
    assert records.ingest_pages(landed(spark, GOOD | {"pblntfPclnd": "9"}), records.STANDARD, tmp_dir, "2026-07-16").number == state.number + 1
    assert sorted(r.price_per_m2 for r in records.read_records(spark, records.STANDARD, tmp_dir).collect()) == [9, 2000]


def test_unknown_and_missing_fields(spark, tmp_dir):
    strange = landed(spark, GOOD | {"newField": "1"}, GOOD | {"newField": "2", "other": "3"}, GOOD)
    with pytest.raises(Exception, match=r"unknown fields \[newField"):
        records.ingest_pages(strange, records.STANDARD, tmp_dir, "2026-07-15")
    lacking = landed(spark, {k: v for k, v in GOOD.items() if k != "stdLandSn"}, GOOD)
    with pytest.raises(Exception, match=r"without required fields \[stdLandSn\]"):
        records.ingest_pages(lacking, records.STANDARD, tmp_dir, "2026-07-15")
    assert manifest.current(spark, tmp_dir).number == 0  # nothing was put in force
    found = records.field_problems(strange.unionByName(lacking), records.STANDARD).collect()
    assert sorted(map(tuple, found)) == [("missing", "stdLandSn", 1), ("unknown", "newField", 2), ("unknown", "other", 1)]
    assert records.field_problems(landed(spark, GOOD), records.STANDARD).count() == 0


def test_writes_are_checked_against_the_stored_schema(spark, tmp_dir):
    rows = records.STANDARD.normalise(records.parse_records(landed(spark, GOOD), records.STANDARD))
    good = records.coerce(rows, records.STANDARD, "vworld_api", "2026-07-15")
    for bad, told in [(good.drop("zoning"), "zoning is missing"), (good.withColumn("more", F.lit(1)), "more is unknown"),
                      (good.withColumn("price_per_m2", F.col("price_per_m2").cast("int")), "price_per_m2 is int, not bigint")]:
        with pytest.raises(ValueError, match=told):
            records.write_records(bad, records.STANDARD, tmp_dir)
    assert records.write_records(good.select(*reversed(good.columns)), records.STANDARD, tmp_dir).number == 1


def test_kinds_are_told_apart(spark):
    with pytest.raises(ValueError):
        records.register_kind(records.RecordKind("standard", records.STANDARD.wire, (), records.STANDARD.stored, ("pnu",), records.STANDARD.normalise))
    assert set(records.KINDS) >= {"individual", "standard"}
