"""What leaves the rows and reaches the disk: able units, packed replicas, bitmaps."""

import glob
import os

import pytest
from pyspark.sql import functions as F

import brute
from pricepanel.llm import license_scan, line_dedup, superminhash, warc_fixity
from pricepanel.llm.tables import stored
from pricepanel.session import checkpoint_root, work_dir

from test_dedup import AWKWARD, documents, near_group
from test_tokens_and_scans import brute_license


def test_only_units_that_can_fit_leave_their_row(spark):
    """common words of the long notices, and single words of a short one, take no unit any further."""
    prose = "the use of the software and the terms of the license or any version of it is for all. "
    notice = "Licensed under the Apache License, Version 2.0"
    rows = [(f"p/{n}", n, prose * (1 + n % 20) + f"word{n}\nthe other line of {n}") for n in range(40)]
    rows += [("q/a", 100, f"{prose * 50}\n\n{notice}\n\n{prose}"), ("q/a", 101, f"# {notice} word7 once"), ("q/b", 102, None), (None, 103, notice)]
    rows += [("q/c", 104, f"{notice}\n{notice} {prose * 3}")]
    docs = spark.createDataFrame(rows, "path string, doc_id bigint, text string")
    held = {r.term: r.df for r in license_scan.term_frequencies(docs).collect()}
    assert held["word7"] == 2 and "word8" not in held and held["apache"] == 4
    weights = license_scan.Weights(len(rows), held, license_scan.MIN_SCORE)
    units = license_scan.able_units(docs, weights, license_scan.MIN_SCORE).collect()
    assert {r.doc_id for r in units} == {100, 101, 103, 104} and len(units) <= 8
    assert all(len(r.others) <= 20 for r in units)
    want = brute_license(rows)
    # a row that stands twice counts in the frequencies, not in its own units
    got = {r.doc_id: (r.license, r.score) for r in license_scan.scores(docs).collect()}
    assert got == {i: (name, pytest.approx(score, abs=2e-6)) for i, (name, score) in want.items() if name}
    twice = {r.doc_id: (r.license, r.score) for r in license_scan.scores(docs.union(docs)).collect()}
    assert twice == {i: (name, pytest.approx(score, abs=2e-6)) for i, (name, score) in brute_license(rows + rows).items() if name}
    assert license_scan.scores(docs.withColumn("text", F.lit(None).cast("string"))).count() == 0


def test_replicas_are_packed_and_their_pages_move_once(spark):
    """packed files, one shuffle for both replicas, the same records as replicas written one by one."""
    rows = [(i, f"http://h/{i}", f"<p>é {i}\r\n\r\nWARC/1.1\r\n" + "some text " * 300) for i in range(60)]
    rows += [(1500, "u\r\nv", ""), (None, "only a url", None), (None, None, "z"), (7, "http://h/7", "<p>again"), (7, "http://h/7", "<p>again")]
    made = warc_fixity.records(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    lost = F.coalesce(F.col("page_id") % 10 == 3, F.lit(False))
    short = F.substring("html", 1, 50)
    path = f"{work_dir(spark, 'test-warc')}/files"
    before = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    warc_fixity.write_replicas(made, path, a=F.col("html"), b=F.when(~lost, short))
    jobs = range(before, spark.sparkContext._jsc.sc().dagScheduler().nextJobId())
    tracker = spark.sparkContext.statusTracker()
    assert len({s for j in jobs for s in tracker.getJobInfo(j).stageIds}) <= 3  # the pages' stage, seen again by AQE, and the writer's
    for name, pages in (("a", made), ("b", made.where(~lost).withColumn("html", short))):
        warc_fixity.write_replica(pages, f"{path}-{name}")
        one, both = (sorted(map(str, warc_fixity.read_replica(spark, p).collect())) for p in (f"{path}-{name}", f"{path}/replica={name}"))
        assert one == both and len(one) == pages.count()
    size = sum(map(os.path.getsize, glob.glob(f"{path}/replica=a/**/part-*", recursive=True)))
    assert size < warc_fixity.read_replica(spark, f"{path}/replica=a").agg(F.sum("length")).first()[0] / 4
    warc_fixity.write_replicas(made.limit(0), path + "-empty", a=F.col("html"))


def test_texts_meet_their_bitmaps_alike_at_any_size(spark, capsys):
    """the bitmaps grow with the documents and are never broadcast, so nothing changes its kind as tables grow."""
    line = "a line of the footer that is long enough to be a key"
    docs = spark.createDataFrame([(i, f"{i}\n{line}") for i in range(8)] + [(None, f"{line}\nx"), (None, None), (3, "other")], "doc_id bigint, text string")
    mapped = line_dedup.with_bitmaps(docs)
    mapped.explain()
    plan = capsys.readouterr().out
    assert "ShuffledHashJoin" in plan and "Broadcast" not in plan and "Sort " not in plan
    out = line_dedup.drop_repeated_lines(docs).collect()
    want = [(i, str(i)) for i in range(7)] + [(7, f"7\n{line}"), (None, "x"), (None, None), (3, "other")]
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, want))


def test_full_sets_move_once_to_their_pairs(spark, capsys):
    """both sides' sets meet the few pairs where they are; only the rows of a pair are shuffled."""
    sets = spark.createDataFrame([(f"s{i}", [*range(i, i + 20)]) for i in range(9)], "set_id string, members array<bigint>")
    pairs = spark.createDataFrame([("s0", f"s{i}") for i in range(1, 9)] + [("s4", "s5")], "a string, b string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables beyond it
    try:
        out = superminhash.compared(stored(pairs, "test-pairs"), stored(sets, "test-sets"))
        out.explain()
        got = {(r.a, r.b): r.common for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("BroadcastHashJoin") == 2
    assert got == {("s0", f"s{i}"): 20 - i for i in range(1, 9)} | {("s4", "s5"): 19}


def test_only_texts_of_repeated_rows_move(spark, capsys):
    """a wanted text comes once, however often its row stands in the table, and is not shuffled for that."""
    rows = [(1, "a b"), (2, "c d"), (2, "c e"), (3, "not wanted"), (None, "f g"), (None, "f h")]
    wanted = [(1, "a b"), (2, "c d"), (None, "f g")]

    def once(some):
        docs = spark.createDataFrame(some, "doc_id bigint, text string").withColumn("text_id", F.xxhash64("text"))
        named = spark.createDataFrame(wanted, "_id bigint, text string").select("_id", F.xxhash64("text").alias("_text"))
        return superminhash._once(docs, docs.drop("text"), named)

    once(rows).explain()
    assert "Exchange hashpartitioning" not in capsys.readouterr().out
    for some in (rows, rows + rows[1:2], rows + rows[4:], rows * 3):
        assert sorted(map(str, once(some).select("doc_id", "text").collect())) == sorted(map(str, spark.createDataFrame(wanted, "doc_id bigint, text string").collect()))


@pytest.mark.parametrize("copies", [1, 2])
def test_bands_leave_the_disk_with_their_buckets(spark, copies):
    """no table of bands is left while the full sets are compared; the groups are those of all pairs."""
    files = f"{checkpoint_root(spark).removeprefix('file://')}/**/*.parquet"
    before = set(glob.glob(files, recursive=True))
    rows = (AWKWARD + near_group(5, 0, 30, 2) + near_group(6, 100, 20, 5)) * copies
    found = superminhash.groups(documents(spark, rows), shingle=2)
    left = set(glob.glob(files, recursive=True)) - before
    assert left and not any("bands" in spark.read.parquet(f).columns for f in left)
    got = found.select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute.near_duplicates(rows, 2), key=str)
