"""Partitioned fact table: scan (S5) and write (S6) through the unit manifest.

Files lie under ``stdr_year=YYYY/sgg=XXXXX/source=NAME/`` of their write's data
folder (zstd), rows sorted by ``pnu`` inside each file so ``startswith``
predicates skip row groups; ``sources.manifest`` says which files are in force.
Reads always pass the schema: inference would type ``sgg`` as int and
``stdr_year`` as int instead of short.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricepanel.functions.normalize import to_fact_schema
from pricepanel.functions.pnu import sgg
from pricepanel.schema import FACT_COLUMNS, PARTITION_COLUMNS, STORED_SCHEMA
from pricepanel.sources import manifest


def read_fact(spark: SparkSession, root: str, source: str | None = None, scope: Column | None = None,
              state: manifest.State | None = None) -> DataFrame:
    """The stored rows of the state in force (or of ``state``).

    Only files named by the manifest are opened; ``source`` and ``scope`` (a
    ``manifest.file_scope``) choose among them before anything is listed.
    Filter the rows by the same scope afterwards.
    """
    state = state or manifest.current(spark, root)
    if source is None:
        return manifest.scan(spark, state, STORED_SCHEMA, scope)
    named = manifest.file_scope(source=source)
    scope = named if scope is None else named & scope
    return manifest.scan(spark, state, STORED_SCHEMA, scope).where(F.col("source") == source)


def read_reference_layout(spark: SparkSession, root: str, source: str) -> DataFrame:
    """S5 on a ``stdr_year=YYYY/sgg=XXXXX-{source}.parquet`` layout, where
    the second level is a file name: a glob keeps year discovery and
    selects one source; ``sgg`` is derived from the parcel number."""
    schema = "pnu string, stdr_year short, stdr_month byte, price_per_m2 long, pblntf_de string, " \
             "std_land_yn boolean, source string, collected_at date"
    df = (spark.read.schema(schema).option("pathGlobFilter", f"*-{source}.parquet")
          .option("recursiveFileLookup", "false").parquet(root))
    return df.withColumn("sgg", sgg())


def prepare_fact(df: DataFrame, source: str | None = None, collected_at=None) -> DataFrame:
    """N10 + the ``sgg`` partition column, cast right before every write
    (a partition written with another type breaks later whole-table reads)."""
    typed = to_fact_schema(df, source=source, collected_at=collected_at)
    return typed.withColumn("sgg", sgg())


def write_fact(df: DataFrame, root: str, max_records_per_file: int = 5_000_000,
               arrival: Sequence[str] = (), expected: manifest.State | None = None) -> manifest.State:
    """Replace the (year, sgg, source) units of ``df`` at once; the rest of the table is untouched.

    ``arrival`` names columns of ``df`` that tell the order in which rows
    arrived; rows of a key are written in that order (the columns are not
    stored), so keep-first (W4) on the files finds the first one.

    ``rebalance`` on (year, sgg) lets AQE split a hot unit over several
    tasks (and merge tiny ones), so a district holding a third of the rows
    does not become one straggler task. Files go into a folder of their own and
    count only when the table's pointer moves (``manifest``), so the plan may read
    the table that it replaces units of, and a lost job leaves the old rows.
    With ``expected`` the pointer moves from that state only.
    """
    key = ["stdr_year", "sgg", "source", *(["pnu", "stdr_month"] if arrival else ["pnu"])]
    out = df.select(*FACT_COLUMNS, "sgg", *arrival)
    if arrival:  # all rows of a key in one task: a unit is not split between them
        out = out.repartition("stdr_year", "sgg", "source", "pnu")
    else:
        out = out.hint("rebalance", "stdr_year", "sgg")
    out = out.sortWithinPartitions(*key, *arrival).select(*FACT_COLUMNS, "sgg")

    def write_data(path: str) -> None:
        (out.write.mode("overwrite").option("compression", "zstd")
            .option("maxRecordsPerFile", max_records_per_file)
            .partitionBy(*PARTITION_COLUMNS).parquet(path))

    return manifest.replace_units(df.sparkSession, root, write_data, STORED_SCHEMA, expected=expected)


def changed_units(df: DataFrame, stored: DataFrame) -> DataFrame:
    """The units (stdr_year, sgg, source) whose rows differ between two tables: count and sum of row hashes."""
    def digests(rows: DataFrame, suffix: str) -> DataFrame:
        digest = F.xxhash64(*FACT_COLUMNS).cast("decimal(38,0)")
        return rows.groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("n" + suffix), F.sum(digest).alias("d" + suffix))

    both = digests(df, "_new").join(digests(stored, "_old"), PARTITION_COLUMNS, "full")
    return both.where(~(F.col("n_new").eqNullSafe(F.col("n_old")) & F.col("d_new").eqNullSafe(F.col("d_old")))).select(*PARTITION_COLUMNS)


def write_bucketed(df: DataFrame, table: str, path: str, key: str = "pnu", buckets: int = 16) -> DataFrame:
    """``df`` as the table ``table`` at ``path``, dealt to ``buckets`` files by ``key`` and sorted by it in each.

    Two tables dealt to the same number of buckets by a key are joined on it
    bucket by bucket, without moving a row. At full size take as many buckets as
    make files of some hundred MB.
    """
    (df.repartition(buckets, key).write.mode("overwrite").option("path", path).option("compression", "zstd")
       .bucketBy(buckets, key).sortBy(key).saveAsTable(table))
    return df.sparkSession.table(table)


def join_bucketed(left: DataFrame, right: DataFrame, key: str = "pnu", how: str = "inner") -> DataFrame:
    """Sort-merge join of two bucketed tables on their bucket key: no exchange on either side."""
    return left.hint("merge").join(right, key, how)
