"""End-to-end batch jobs: landed files -> fact table -> fixes -> reports.

Each job is one Spark plan from its inputs to a written table; lineage is
cut only by writing (a table in the shared folder) or by a reliable
``checkpoint()`` into ``spark.checkpoint.dir`` -- never a local one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricepanel.operators import revise
from pricepanel.schema import SRC_API, SRC_BULK, SRC_CITY
from pricepanel.session import checkpoint_root
from pricepanel.sources import archives, fact_store, manifest, records

OVERRIDE_BROADCAST_ROWS = 2_000_000


def ingest_city_archives(spark: SparkSession, landing: str, fact_root: str, collected_at) -> None:
    """Bulk city ZIPs -> S1 -> N8 -> N10 -> S6 (units replaced atomically)."""
    rows = archives.city_rows(archives.read_zip_csv(spark, landing))
    rows = rows.select("*", F.lit(None).cast("string").alias("pblntf_de"),
                       F.lit(None).cast("boolean").alias("std_land_yn"))
    fact_store.write_fact(fact_store.prepare_fact(rows, SRC_CITY, collected_at), fact_root)


def ingest_bulk_archives(spark: SparkSession, landing: str, fact_root: str, collected_at) -> None:
    """National ZIPs -> S2 (header guard) -> N9 -> N10 -> S6."""
    rows = archives.bulk_rows(archives.read_zip_csv_positional(spark, landing))
    fact_store.write_fact(fact_store.prepare_fact(rows, SRC_BULK, collected_at), fact_root)


def ingest_api_pages(pages: DataFrame, root: str, collected_at, kind: records.RecordKind = records.INDIVIDUAL) -> manifest.State:
    """Landed pages of a record kind -> S4 -> normaliser -> W1 (latest revision) -> S6 into the kind's table."""
    return records.ingest_pages(pages, kind, root, collected_at)


def fix_revisions_job(spark: SparkSession, fact_root: str, refetched: DataFrame,
                      refetched_arrival: tuple[str, ...] | None = None) -> manifest.State:
    """Q7 on the stored API rows: the units that change are written beside the
    old ones, then swapped in by one move of the table's pointer.

    The pointer moves only from the state that this job read, so of two fixers
    one raises ``manifest.LostRace`` and changes nothing. A run that finds
    nothing to change leaves the pointer where it is.

    The conflict census and the override table are checkpointed
    (reliable, shared folder) so the two membership tests, the size check
    and the join do not recompute the census; overrides are
    broadcast only if it holds at most ``OVERRIDE_BROADCAST_ROWS`` rows.
    Arrival order of stored rows = file path, row index.
    """
    checkpoint_root(spark)
    state = manifest.current(spark, fact_root)
    rows = fact_store.read_fact(spark, fact_root, source=SRC_API, state=state)
    stored = revise.with_file_order(rows)
    # Both membership tests of J2 read the census: materialise it once.
    conflicts = revise.conflict_keys(stored).checkpoint(eager=True)
    overrides = revise.authoritative(revise.conflict_candidates(refetched, conflicts), arrival=refetched_arrival).checkpoint(eager=True)
    base = revise.dedup_keep_first(stored, arrival=("_file", "_row"))
    fixed = revise.apply_overrides(base, overrides, broadcast_rows=OVERRIDE_BROADCAST_ROWS).drop("_file", "_row").checkpoint(eager=True)
    units = fact_store.changed_units(fixed, rows).checkpoint(eager=True)
    if units.isEmpty():
        return state
    return fact_store.write_fact(fixed.join(units, manifest.UNIT, "left_semi"), fact_root, expected=state)
