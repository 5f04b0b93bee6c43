"""Code succession (chains, merges, splits, circles), bucketed parcel join, total order of exports."""

import os
import random
import re

import pytest

from pricepanel.operators import codes
from pricepanel.plans import queries_quality, queries_sources
from pricepanel.sources import fact_store, sinks

SF = "/root/testdata/sf0.001"


def closed(spark, changes):
    out = codes.code_succession(spark.createDataFrame(changes, "old string, new string")).collect()
    return {r.old: r.new for r in out}


def applied(code, changes):
    """One step after the other, the longest old code first."""
    rules = dict(changes)
    for _ in range(100):
        for n in (10, 5, 2):
            if len(code) >= n and code[:n] in rules:
                code = rules[code[:n]] + code[n:]
                break
        else:
            return code
    raise AssertionError("no end")


def test_chains_merges_and_splits(spark):
    changes = [("42", "51"), ("51110", "51990"), ("12", "46"), ("46170", "46180"), ("26120", "26130"), ("26140", "26130"),
               ("2612010221", "2699010900"), ("26990", "26995"), ("2699510900", "2699510901"), ("51990", "51991"), ("51991", "51992"), (" 45", "52 ")]
    rules = closed(spark, changes)
    assert rules["42"] == "51" and rules["42110"] == "51992" and rules["51110"] == "51992" and rules["12170"] == "46180"
    assert rules["2612010221"] == "2699510901" and rules["26120"] == rules["26140"] == "26130" and rules["45"] == "52"
    table = spark.createDataFrame([(c + "100010000",) for c in
                                   ["4211010100", "4212010100", "2612010221", "2612010222", "1217010300", "4511110100", "9999910100", "5111010100"]], "pnu string")
    got = codes.crosswalk(table, spark.createDataFrame(list(rules.items()), "old string, new string")).collect()
    plain = [(a.strip(), b.strip()) for a, b in changes]
    assert {r.pnu: r.pnu_current for r in got} == {r.pnu: applied(r.pnu[:10], plain) + r.pnu[10:] for r in got}


def test_a_long_chain_needs_few_rounds(spark):
    changes = [(f"{i:05d}", f"{i + 1:05d}") for i in range(10_000, 10_040)]
    random.Random(1).shuffle(changes)
    assert set(closed(spark, changes).values()) == {"10040"}


def test_refused_changes(spark):
    for changes, told in [([("11", "12"), ("11", "13")], "several successors"), ([("11", "12345")], "lengths"), ([("111", "222")], "lengths"),
                          ([("11", "12"), ("12", "11")], "circle"), ([("11", "12"), ("12", "13"), ("13", "11")], "circle"),
                          ([("42", "51"), ("51110", "42110")], "circle")]:
        with pytest.raises(codes.CodeConflict, match=told):
            closed(spark, changes)
    assert closed(spark, [("11", "11"), ("12", "13"), ("12", "13")]) == {"12": "13"}


def test_bucketed_join_moves_no_row(spark):
    joined = queries_quality.q_join_parcel_geometry_key(spark, SF)
    plan = re.sub(r"#\d+L?", "", joined._jdf.queryExecution().executedPlan().toString())
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    tables = [spark.table(t) for t in queries_quality._TABLES.values()][:2]
    plain = tables[0].hint("shuffle_hash").join(tables[1], "pnu")
    assert fact_store.join_bucketed(*tables).exceptAll(plain).count() == 0 and joined.count() == plain.count()


def test_positions_are_the_places_in_the_order(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(50), rng.choice(["a", "b", None])) for _ in range(5000)]
    got = sinks.with_position(spark.createDataFrame(rows, "k int, s string").repartition(7), "k", "s").collect()
    assert [(r.k, r.s) for r in sorted(got, key=lambda r: r.row_no)] == sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or ""))
    assert sorted(r.row_no for r in got) == list(range(1, 5001))
    assert sinks.with_position(spark.createDataFrame([], "k int"), "k").count() == 0


def test_export_files_are_one_ordered_csv(spark, tmp_dir, monkeypatch):
    paths = []
    monkeypatch.setattr(queries_sources, "work_dir", lambda spark, name: paths.append(f"{tmp_dir}/{name}") or paths[-1])
    got = {r.row_no: r for r in queries_sources.q_sink_scoped_csv(spark, SF).collect()}
    names = sorted(n for n in os.listdir(paths[0]) if n.endswith(".csv"))
    lines = "".join(open(f"{paths[0]}/{n}", encoding="utf-8").read() for n in names).splitlines()
    assert lines[0] == "pnu,stdr_year,stdr_month,price_per_m2,pblntf_de,std_land_yn,source,row_no" and lines.count(lines[0]) == 1
    assert [int(x.split(",")[-1]) for x in lines[1:]] == list(range(1, len(got) + 1))
    assert [x.split(",")[0] for x in lines[1:]] == [got[i].pnu for i in range(1, len(got) + 1)] == sorted(r.pnu for r in got.values())
