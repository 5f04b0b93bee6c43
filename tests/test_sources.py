"""File tests: ZIP/CSV readers, region codes, fact store, CSV export."""

import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from pricepanel.schema import SRC_API
from pricepanel.sources import archives, fact_store, sinks
from pricepanel.functions.normalize import to_fact_schema

CITY_HEADER = "시도명,시군구명,법정동명,토지코드,공시지가(원/㎡),시군구코드,법정동코드,필지구분코드,필지구분명,본번,부번,기준년도,기준년월"


def _zip(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, data in members:
            z.writestr(name, data)


def _city_line(pnu, price, year, ym):
    return f'서울,종로구,청운동,{pnu},"{price}",11110,1111010100,1,일반,0001,0000,{year},{ym}'


def test_city_archive_keyword_mapping(spark, tmp_dir):
    lines = [CITY_HEADER,
             _city_line("1111010100100010000", "1,200", 1990, "1990-01-01"),
             _city_line("1111010100100010001", "0", 1990, "1990.7"),
             _city_line("1111010100100010002", "1234.9", 1990, "199007"),
             _city_line("11110101001003701가", "5", 1990, "abc"),
             _city_line("1111010100100010004", "", 1990, "07"),    # no price: dropped
             _city_line("", "9", 1990, "07"),                       # no pnu: dropped
             "서울,종로구"]                                          # short row: skipped
    _zip(os.path.join(tmp_dir, "a.zip"), [("a.csv", "\r\n".join(lines).encode("cp949")), ("empty.csv", b"")])
    alt = CITY_HEADER.replace("토지코드", "고유번호").replace("기준년도", "기준연도").replace("기준년월", "기준월")
    body = "﻿" + alt + "\r\n" + _city_line("1111010100100010009", "7", 1991, "7") + "\r\n"
    _zip(os.path.join(tmp_dir, "b.zip"), [("b.csv", body.encode("utf-8"))])

    parsed = archives.read_zip_csv(spark, f"{tmp_dir}/" + "a.zip")
    got = sorted(tuple(r) for r in archives.city_rows(parsed).collect())
    assert got == [("1111010100100010000", 1990, 1, 1200), ("1111010100100010001", 1990, 7, 0),
                   ("1111010100100010002", 1990, 7, 1234), ("11110101001003701가", 1990, 1, 5)]
    parsed_b = archives.read_zip_csv(spark, f"{tmp_dir}/" + "b.zip", encoding="utf-8")
    assert [tuple(r) for r in archives.city_rows(parsed_b).collect()] == [("1111010100100010009", 1991, 7, 7)]


def test_city_header_without_keyword_fails(spark, tmp_dir):
    _zip(os.path.join(tmp_dir, "c.zip"), [("c.csv", "a,b,c\r\n1,2,3\r\n".encode("cp949"))])
    parsed = archives.read_zip_csv(spark, f"{tmp_dir}/" + "c.zip")
    with pytest.raises(Exception):
        archives.city_rows(parsed).collect()


BULK_HEADER = "고유번호,법정동코드,법정동명,특수지구분코드,특수지구분명,지번,기준연도,기준월,공시지가,공시일자,표준지여부,데이터기준일자,비고"


def test_bulk_positional(spark, tmp_dir):
    rows = [BULK_HEADER,
            '1111010100100010000,1111010100,청운동,1,일반,1-0,2026,,"25,000",2026-04-30,Y,2026-05-26,',
            "1111010100100010001,1111010100,청운동,1,일반,1-1,2026,7,300,,N,2026-05-26,",
            "1111010100100010002,1111010100,청운동,1,일반,1-2,2026,1,,2026-04-30,Y,2026-05-26,",  # no price
            "1111010100100010003,1111010100"]                                                   # short
    _zip(os.path.join(tmp_dir, "AL_D151_11_20260526.zip"),
         [("x.csv", "\r\n".join(rows).encode("cp949")), ("notes.txt", "skip me".encode("cp949"))])
    parsed = archives.read_zip_csv_positional(spark, tmp_dir)
    got = sorted(tuple(r) for r in archives.bulk_rows(parsed).collect())
    assert got == [("1111010100100010000", 2026, 1, 25000, "2026-04-30", True),
                   ("1111010100100010001", 2026, 7, 300, None, False)]


def test_bulk_header_guard(spark, tmp_dir):
    _zip(os.path.join(tmp_dir, "bad.zip"), [("x.csv", "pnu,code,name,kind\r\n1,2,3,4\r\n".encode("cp949"))])
    with pytest.raises(Exception):
        archives.read_zip_csv_positional(spark, tmp_dir).collect()


def _codes_zip(path, n):
    lines = ["법정동코드\t법정동명\t폐지여부"] + [f"{1111010100 + i}\t동{i}\t{'존재' if i % 2 else '폐지'}"
                                              for i in range(n)] + ["bad", "12345\tshort\t존재"]
    _zip(path, [("codes.txt", "\r\n".join(lines).encode("euc-kr"))])


def test_region_codes(spark, tmp_dir):
    _codes_zip(os.path.join(tmp_dir, "codes.zip"), 12)
    rows = archives.load_region_codes(spark, f"{tmp_dir}/codes.zip", f"{tmp_dir}/codes", min_rows=12).collect()
    assert len(rows) == 12 and sum(r.abolished for r in rows) == 6
    assert rows[0].code == "1111010100" and rows[0].name == "동0"


def test_region_codes_size_guard(spark, tmp_dir):
    _codes_zip(os.path.join(tmp_dir, "codes.zip"), 5)
    with pytest.raises(ValueError, match="5 region codes, expected 10000"):
        archives.load_region_codes(spark, f"{tmp_dir}/codes.zip", f"{tmp_dir}/codes")


def test_one_task_per_member(spark, tmp_dir):
    body = "\r\n".join([CITY_HEADER, *[_city_line(f"11110101001000{i:05d}", "5", 1990, "07") for i in range(3000)]]).encode("cp949")
    _zip(os.path.join(tmp_dir, "two.zip"), [("a.csv", body), ("empty.csv", b""), ("b.csv", body)])
    parsed = archives.read_zip_csv(spark, tmp_dir)
    assert parsed.rdd.getNumPartitions() == 2
    per_member = {r.member: (r.n, r.lo, r.hi, r.tasks) for r in parsed.withColumn("task", F.spark_partition_id()).groupBy("member").agg(
        F.count("*").alias("n"), F.min("row_no").alias("lo"), F.max("row_no").alias("hi"), F.count_distinct("task").alias("tasks")).collect()}
    assert per_member == {"a.csv": (3000, 1, 3000, 1), "b.csv": (3000, 1, 3000, 1)}


def test_bytes_outside_the_encoding_fail(spark, tmp_dir):
    body = CITY_HEADER.encode("cp949") + b"\r\n" + b"\xff\xfe,1\r\n"
    _zip(os.path.join(tmp_dir, "a.zip"), [("a.csv", body)])
    with pytest.raises(Exception, match="decode"):
        archives.read_zip_csv(spark, tmp_dir).collect()


def test_records_of_any_width_quoted_lines_and_long_members(spark, tmp_dir):
    from pricepanel.sources import zip_members
    text = 'a,b,c\r\n1,"x\r\ny, ""z""",3\r\n4\r\n5,6,7,8\r\n,,\r\n' + "".join(f"{i},{'p' * 200},q\r\n" for i in range(60_000))
    _zip(os.path.join(tmp_dir, "a.zip"), [("a.csv", text.encode()), ("only-header.csv", b"a,b\r\n"), ("line.csv", b"a,b\r\n1,2")])
    got = zip_members.read_members(spark, tmp_dir, encoding="utf-8")
    rows = {tuple(r.row) for r in got.where("member = 'a.csv'").collect()}
    assert {("1", 'x\r\ny, "z"', "3"), ("4",), ("5", "6", "7", "8"), ("", "", ""), ("59999", "p" * 200, "q")} < rows and len(rows) == 60_004
    assert got.where("member = 'a.csv'").select("row_no").distinct().count() == 60_004
    assert [tuple(r.row) for r in got.where("member = 'line.csv'").collect()] == [("1", "2")]
    assert got.where("member = 'only-header.csv'").count() == 0


def _fact(spark, rows):
    df = spark.createDataFrame(rows, "pnu string, stdr_year int, stdr_month int, price_per_m2 long")
    return fact_store.prepare_fact(df.withColumn("pblntf_de", F.lit(None).cast("string"))
                                     .withColumn("std_land_yn", F.lit(None).cast("boolean")),
                                   source=SRC_API, collected_at="2026-07-15")


def test_partitioned_write_replaces_only_its_units(spark, tmp_dir):
    root = os.path.join(tmp_dir, "fact")
    fact_store.write_fact(_fact(spark, [("1111010100100010000", 2024, 1, 10), ("2611010100100010000", 2024, 1, 20),
                                        ("1111010100100010000", 2025, 1, 30)]), root)
    fact_store.write_fact(_fact(spark, [("1111010100100010000", 2024, 1, 11)]), root)
    df = fact_store.read_fact(spark, root)
    got = sorted((r.pnu[:5], r.stdr_year, r.price_per_m2) for r in df.collect())
    assert got == [("11110", 2024, 11), ("11110", 2025, 30), ("26110", 2024, 20)]
    assert dict((f.name, f.dataType.simpleString()) for f in df.schema.fields)["stdr_year"] == "smallint"
    plan = fact_store.read_fact(spark, root, source=SRC_API).where(F.col("sgg") == "11110") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "sgg" in plan


def test_export_csv_round_trip(spark, tmp_dir):
    df = to_fact_schema(_fact(spark, [("2", 2024, 1, 1), ("1", 2024, 7, 2), ("1", 2024, 1, 3)]).drop("sgg"))
    path = os.path.join(tmp_dir, "out")
    sinks.export_csv(df, path)
    back = sinks.read_export(spark, path)
    assert [(r.pnu, r.stdr_month) for r in back.collect()] == [("1", 1), ("1", 7), ("2", 1)]


def _pages(spark, bodies):
    return spark.createDataFrame([("11110101", 2024, i, b) for i, b in enumerate(bodies)],
                                 "prefix string, year int, page_no int, body string")


def test_api_page_envelopes(spark):
    from pricepanel.sources import api_pages
    bodies = [
        '{"indvdLandPrices":{"resultCode":"OK","totalCount":"2","field":[{"pnu":"1","stdrYear":"2024"},'
        '{"pnu":"2","stdrYear":2024}]}}',
        '{"indvdLandPrices":{"resultCode":"ok_but_empty"}}',
        '{"x":{"totalCount":1,"field":{"pnu":"3","stdrYear":"2024"}}}',
        '{"x":{"totalcount":"zz","weird":[{"pnu":"4","stdrYear":"2024"}]}}',
        '{"items":[{"pnu":"5","stdrYear":"2024"}],"totalCount":1}',
        '{"x":{"field":[],"other":[{"pnu":"6","stdrYear":"2024"}]}}',
        '{"x":{"field":"","items":[{"pnu":"7\x01x","stdrYear":"2024"}]}}',
        '',
    ]
    s = {r.page_no: (r.n_rows, r.total_count, r.result_code)
         for r in api_pages.page_summary(_pages(spark, bodies)).collect()}
    assert s == {0: (2, 2, "OK"), 1: (0, 0, "OK_BUT_EMPTY"), 2: (1, 1, ""), 3: (1, 0, ""),
                 4: (1, 1, ""), 5: (1, 0, ""), 6: (1, 0, ""), 7: (0, 0, "")}
    recs = sorted((r.page_no, r.rec_no, r.pnu, r.stdrYear) for r in api_pages.parse_api_pages(_pages(spark, bodies)).collect())
    assert recs == [(0, 0, "1", "2024"), (0, 1, "2", "2024"), (2, 0, "3", "2024"), (3, 0, "4", "2024"),
                    (4, 0, "5", "2024"), (5, 0, "6", "2024"), (6, 0, "7\x01x", "2024")]


def test_api_fatal_code_fails(spark):
    from pricepanel.sources import api_pages
    with pytest.raises(Exception):
        api_pages.parse_api_pages(_pages(spark, ['{"indvdLandPrices":{"resultCode":"INVALID_KEY"}}'])).collect()


def test_revision_operators_on_a_stored_table(spark, tmp_dir):
    """W1/W3/W4/U2 on a Parquet table without seq/xp: arrival = file order."""
    from pricepanel.operators import revise
    root = os.path.join(tmp_dir, "fact")
    api = _fact(spark, [("1111010100100010000", 2024, 1, 10), ("1111010100100010000", 2024, 1, 11)])
    city = fact_store.prepare_fact(api.drop("sgg").withColumn("price_per_m2", F.col("price_per_m2") + 100),
                                   source="seoul_opendata", collected_at="2026-07-15")
    fact_store.write_fact(api.unionByName(city), root)
    stored = fact_store.read_fact(spark, root)
    merged = revise.merge_sources(stored).collect()
    assert len(merged) == 1 and merged[0].source == SRC_API
    first = revise.dedup_keep_first(fact_store.read_fact(spark, root, source=SRC_API)).collect()
    assert len(first) == 1 and first[0].price_per_m2 in (10, 11)
    assert "_file" not in revise.dedup_keep_first(stored).columns
    ov = spark.createDataFrame([("1111010100100010000", 2024, 1, 99, None)],
                               "pnu string, stdr_year short, stdr_month byte, price_ov long, pblntf_ov string")
    out = revise.merge_staging(fact_store.read_fact(spark, root, source=SRC_API), ov, [2024]).collect()
    assert [r.price_per_m2 for r in out] == [99]


def test_parcel_series_and_scope_prune_units(spark, tmp_dir):
    from pricepanel.operators import filters, stats
    root = os.path.join(tmp_dir, "fact")
    fact_store.write_fact(_fact(spark, [("2612010221100010001", 2000, 1, 5), ("2612010221100010001", 2001, 1, 6),
                                        ("1111010100100010000", 2000, 1, 7)]), root)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        df = fact_store.read_fact(spark, root)
        q = stats.series_parcel(df, "2612010221100010001", partition_col="sgg")
        assert [tuple(r) for r in q.collect()] == [(2000, 5), (2001, 6)]
        import re
        plan = re.sub(r"#\d+L?", "", q._jdf.queryExecution().executedPlan().toString())
        assert "PartitionFilters: [isnotnull(sgg)" in plan and "(sgg = 26120)" in plan
        assert "StringStartsWith(pnu,26120)" in plan
        e = df.where(filters.scope(year=2000, sgg="26120", partition_col="sgg"))
        assert e.count() == 1
        assert "(sgg = 26120)" in re.sub(r"#\d+L?", "", e._jdf.queryExecution().executedPlan().toString())
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
