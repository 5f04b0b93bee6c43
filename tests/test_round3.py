"""Steps that large tables run through: stripping, landed pages, archives of many members."""

import glob
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from pricepanel.functions import normalize as N
from pricepanel.plans import fixtures as fx
from pricepanel.plans import landing
from pricepanel.sources import api_pages, records, zip_members

SPACES = [ch for ch in map(chr, range(0x110000)) if ch.isspace()]


def plan_of(df, capsys):
    df.explain(extended=False)
    return capsys.readouterr().out


def test_strip_of_every_white_space_and_edge(spark):
    cores = ["", "a", "~", "!", "\x7f", "\x00", "가", "a b", "가 나", "é"]
    texts = sorted({a + c + b for c in cores for a in ["", *SPACES] for b in ["", *SPACES]})
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", N.strip("t").alias("s")).collect()
    assert [(r.t, r.s) for r in got if r.s != r.t.strip()] == [] and len(got) == len(texts)
    assert spark.sql("select cast(null as string) as t").select(N.strip("t")).first()[0] is None


RAW = "pnu string, stdrYear string, stdrMt string, pblntfPclnd string, pblntfDe string, stdLandAt string, lastUpdtDt string"


def test_rows_are_stripped_once_before_they_are_typed(spark, capsys):
    """no regex for the separators, and a projection of strips below the one of types."""
    raw = spark.createDataFrame([(" p\u3000", "2000 ", "x", "1,2,3.9", " ", " y", None), ("q", "1999", "00", " 7", "d ", "", " u"),
                                 ("r", "1999", "2", " , ", "d", "n", "u"), (None, "1999", "2", "5", "d", "n", "u"), ("s", " ", "2", "5", "d", "n", "u")], RAW)
    rows = N.norm_api_row(raw)
    assert [tuple(r) for r in rows.orderBy("pnu").collect()] == [("p", 2000, 1, 123, None, True, ""), ("q", 1999, 1, 7, "d", None, "u")]
    assert [tuple(r) for r in N.norm_api_row(raw.withColumn("stdrYear", F.lit("y")), strict=False).select("stdr_year").distinct().collect()] == [(None,)]
    plan = plan_of(rows, capsys)
    assert "regexp_replace" not in plan and plan.count("Project [") >= 2


@pytest.mark.parametrize("kind", ["individual", "standard"])
def test_a_record_text_is_parsed_once(spark, capsys, kind):
    """the filter on a record's fields does not parse its text again."""
    kind = records.KINDS[kind]
    rec = {"pnu": "p", "stdrYear": "2000", "stdLandSn": "1", "pblntfPclnd": "5", "lastUpdtDt": "u"}
    rec = ",".join(f'"{k}":"{v}"' for k, v in rec.items() if k in kind.wire.names)
    body = '{"a":{"totalCount":3,"field":[{%s},{%s},{%s}]}}' % (rec, rec, rec.replace('"pblntfPclnd":"5"', '"pblntfPclnd":" "'))
    pages = spark.createDataFrame([("1", 2000, 1, body), ("1", 2000, 2, "{}"), ("1", 2000, 3, "{")], api_pages.PAGE_SCHEMA)
    rows = kind.normalise(records.parse_records(pages, kind), keep=("page_no", "rec_no"))
    assert [(r.pnu, r.price_per_m2, r.page_no, r.rec_no) for r in rows.orderBy("rec_no").collect()] == [("p", 5, 1, 0), ("p", 5, 1, 1)]
    assert plan_of(rows, capsys).count("from_json(StructField(pnu") == 1


def test_landed_pages_are_compressed_and_dealt_by_their_number(spark, tmp_dir, monkeypatch):
    """records meet in their page after one exchange, in files that hold a bounded number of them."""
    li = spark.range(4000).select(
        (F.col("id") * 7).alias("l_orderkey"), (F.col("id") % 11).alias("l_partkey"), (F.col("id") % 13).alias("l_suppkey"), (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"),
        F.lit(3.0).alias("l_quantity"), F.col("id").cast("double").alias("l_extendedprice"), F.lit(0.0).alias("l_discount"), F.lit(0.02).alias("l_tax"),
        F.lit("A").alias("l_returnflag"), F.lit("F").alias("l_linestatus"), F.to_timestamp(F.lit("1997-03-04")).alias("l_shipdate"))
    li.write.parquet(f"{tmp_dir}/lineitem.parquet")
    monkeypatch.setattr(landing, "PAGE_TASK_ROWS", 1000)
    files = glob.glob(f"{landing.pages_folder(spark, tmp_dir)}/part-*")
    assert len(files) == 4 and all(f.endswith(".json.gz") for f in files)
    records_of = api_pages.parse_api_pages(landing.landed_pages(spark, tmp_dir)).select("pnu", "stdrYear", "stdrMt", "pblntfPclnd")
    raw = fx.raw_api(spark, tmp_dir).select("pnu", "stdrYear", "stdrMt", "pblntfPclnd")
    assert records_of.count() == 4000 and records_of.exceptAll(raw).isEmpty()


def test_finished_pages_are_not_moved_for_the_totals(spark, capsys):
    """the unit totals are sent to the pages, not left to which stage ends first."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _pages_get_their_totals(spark, capsys)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def _pages_get_their_totals(spark, capsys):
    rows = spark.range(500).select(F.format_string("%08d", F.col("id") % 5).alias("prefix"), F.lit(2000).alias("year"), (F.col("id") % 50).alias("block"),
                                   F.col("id").alias("seq"), F.col("id").cast("double").alias("xp"), F.format_string('{"pnu":"%d"}', "id").alias("rec"))
    pages = landing._pages(rows)
    assert api_pages.page_summary(pages).select("total_count", "n_rows").distinct().collect() == [(100, 10)]
    plan = plan_of(pages, capsys)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_many_small_members_share_tasks(spark, tmp_dir):
    """a task reads several small members in turn; a large one keeps a task of its own."""
    with zipfile.ZipFile(os.path.join(tmp_dir, "a.zip"), "w") as z:
        for i in range(300):
            z.writestr(f"m{i}.csv", f"a,b\r\n{i},x\r\n{i},y\r\n")
        z.writestr("large.csv", "a,b\r\n" + "l,z\r\n" * 3000)
    got = zip_members.read_members(spark, tmp_dir, encoding="utf-8")
    assert got.rdd.getNumPartitions() < 100
    rows = got.select("member", "row_no", F.get("row", F.lit(0)).alias("a"), F.get("row", F.lit(1)).alias("b"), F.spark_partition_id().alias("task"))
    small = {(r.member, r.row_no, r.a, r.b) for r in rows.where("member <> 'large.csv'").collect()}
    assert small == {(f"m{i}.csv", n + 1, str(i), "xy"[n]) for i in range(300) for n in range(2)}
    tasks = {r.task for r in rows.where("member = 'large.csv'").select("task").distinct().collect()}
    assert len(tasks) == 1 and rows.where("member = 'large.csv'").count() == 3000
    assert rows.where(F.col("task").isin(*tasks)).select("member").distinct().count() == 1
