"""End-to-end run on one scale of the driver tables.

Landed inputs are derived from the tables by Spark jobs; then: city and
national archives -> fact units, API pages -> streaming records -> fact
units, revision fix into a new root, audits, reports, scoped CSV export.

usage: python tools/demo_pipeline.py [SF_DIR]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pricepanel.operators import audit, filters, revise, stats  # noqa: E402
from pricepanel.plans import fixtures as fx, jobs, landing  # noqa: E402
from pricepanel.session import build_session, work_dir  # noqa: E402
from pricepanel.sources import fact_store, sinks  # noqa: E402
from pricepanel.streaming import pages as stream  # noqa: E402

COLLECTED = "2026-07-15"


def step(name, fn):
    t0 = time.perf_counter()
    out = fn()
    print(f"{name:<34} {time.perf_counter() - t0:6.1f} s", flush=True)
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    root = work_dir(spark, "fact")
    pages_dir, records, ckpt = work_dir(spark, "pages"), work_dir(spark, "records"), work_dir(spark, "ckpt")

    step("city archives -> units", lambda: jobs.ingest_city_archives(
        spark, landing.city_archives(spark, sf), root, COLLECTED))
    step("national archives -> units", lambda: jobs.ingest_bulk_archives(
        spark, landing.bulk_archives(spark, sf), root, COLLECTED))
    step("land API pages", lambda: landing.landed_pages(spark, sf).write.mode("overwrite").json(pages_dir))
    step("stream pages -> records", lambda: stream.start_page_ingest(spark, pages_dir, records, ckpt)
         .awaitTermination(1800))
    step("records -> latest -> units", lambda: stream.build_fact(stream.read_records(spark, records), root, COLLECTED))
    step("fix revisions, swap units", lambda: jobs.fix_revisions_job(spark, root, fx.api_rows(spark, sf)))

    fact, api = fact_store.read_fact(spark, root), fact_store.read_fact(spark, root, source="vworld_api")
    print(json.dumps({
        "sources": {r.source: r.rows for r in stats.source_mix(fact).collect()},
        "format": audit.audit_format(fact).collect()[0].asDict(),
        "dup_keys_after_fix": audit.audit_key_unique(fact).collect()[0].dup_keys,
        "api_conflicts_after_fix": revise.conflict_keys(api).count(),
        "cross_check": audit.cross_source(fact.where("source = 'seoul_opendata'"), api).collect()[0].asDict(),
    }, ensure_ascii=False, indent=1))
    for r in sinks.report_sections(fact, api, "2612010221100010001", 2000).collect():
        print(r.section, r.json[:160])
    out = work_dir(spark, "export")
    step("scoped CSV export", lambda: sinks.export_csv(fact, out, filters.scope(y0=1995, y1=2001, sido="11")))
    print("export rows", sinks.read_export(spark, out).count(), "->", out)
    print(stats.year_price(api, distributed=True).orderBy("stdr_year").collect())
    spark.stop()


if __name__ == "__main__":
    main()
