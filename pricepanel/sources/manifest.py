"""The unit manifest: which files hold which (year, district, source) unit.

A table root holds data folders, manifests and one pointer::

    <root>/data/write=<id>/stdr_year=../sgg=../source=../part-*.parquet
    <root>/manifests/<id>/           rows (unit, file, rows, min and max pnu)
    <root>/_pointer/<number>         one small file naming the manifest in force

Writers put new files into a folder of their own, write a manifest that names
them beside the kept files of all other units, and then move the pointer: a
rename that fails if the next number is taken. Until that rename nothing that
readers see has changed, so a job lost at any moment leaves the old rows; and of
two writers that started from one state only one can win (``LostRace``).

Readers resolve the pointer once and open the files of that manifest only: a
query reads one version throughout, and filters on years, regions, sources and
parcels choose files from manifest rows before anything is listed. Superseded
files stay until ``remove_superseded`` is called.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNIT = ["stdr_year", "sgg", "source"]
MANIFEST_SCHEMA = "stdr_year short, sgg string, source string, path string, rows long, min_pnu string, max_pnu string"
#: Pointer moves tried by a writer that does not insist on the state it started from.
ATTEMPTS = 10


class LostRace(RuntimeError):
    """Another writer moved the pointer first."""


@dataclass(frozen=True)
class State:
    """One version of a table: the number of its pointer and its manifest folder (None: no rows yet)."""

    root: str
    number: int = 0
    manifest: str | None = None


# ------------------------------------------------------------- the pointer

def _hadoop(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return jvm, fs, fs.makeQualified(p)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, replaced if it is there."""
    _, fs, target = _hadoop(spark, path)
    out = fs.create(target)
    out.write(text.encode())
    out.close()


def current(spark: SparkSession, root: str) -> State:
    """The state that the pointer names now."""
    root = root.rstrip("/")
    jvm, fs, folder = _hadoop(spark, f"{root}/_pointer")
    for attempt in range(ATTEMPTS):
        if not fs.exists(folder):
            return State(root)
        numbers = [int(s.getPath().getName()) for s in fs.listStatus(folder) if s.getPath().getName().isdigit()]
        if not numbers:
            return State(root)
        try:
            stream = fs.open(jvm.org.apache.hadoop.fs.Path(folder, f"{max(numbers):010d}"))
        except Exception:  # moved on between the two looks
            if attempt == ATTEMPTS - 1:
                raise
            continue
        try:
            return State(root, max(numbers), bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()
    raise AssertionError


def move_pointer(spark: SparkSession, state: State, manifest: str) -> State:
    """Put ``manifest`` in force, if the pointer still names ``state``."""
    after = State(state.root, state.number + 1, manifest)
    jvm, fs, folder = _hadoop(spark, f"{state.root}/_pointer")
    fs.mkdirs(folder)
    path = jvm.org.apache.hadoop.fs.Path
    draft, target = path(folder, f".next-{uuid.uuid4().hex}"), path(folder, f"{after.number:010d}")
    write_text(spark, draft.toString(), manifest)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(folder.toUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        if current(spark, state.root).number != state.number:
            raise LostRace(f"{state.root}: the table changed since state {state.number} was read")
        context.rename(draft, target, no_options)  # fails if the number is taken
    except LostRace:
        fs.delete(draft, False)
        raise
    except Exception as error:
        fs.delete(draft, False)
        if current(spark, state.root).number > state.number:
            raise LostRace(f"{state.root}: another writer moved state {state.number}") from error
        raise
    fs.delete(path(folder, f"{state.number:010d}"), False)
    return after


# ------------------------------------------------------------- reading

def files(spark: SparkSession, state: State) -> DataFrame:
    """The manifest rows of a state: one per file, with rows and the range of its parcel numbers."""
    if state.manifest is None:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{state.root}/manifests/{state.manifest}")


def file_scope(source: str | None = None, years: Iterable[int] | None = None, y0: int | None = None, y1: int | None = None,
               regions: Iterable[str] = ()) -> Column:
    """Manifest rows whose file may hold a row of the scope.

    ``regions`` are parcel-number prefixes of any length (province, district,
    dong, a whole number); a file is named if one lies in its range.
    """
    pred = F.lit(True)
    if source is not None:
        pred = pred & (F.col("source") == source)
    if years is not None:
        pred = pred & F.col("stdr_year").isin(*[int(y) for y in years])
    if y0 is not None:
        pred = pred & (F.col("stdr_year") >= y0)
    if y1 is not None:
        pred = pred & (F.col("stdr_year") <= y1)
    held = [(F.substring("min_pnu", 1, len(p)) <= p) & (F.col("max_pnu") >= p) for p in regions]
    for i, h in enumerate(held):
        held[i] = h if i == 0 else held[i - 1] | h
    return pred & held[-1] if held else pred


def named_files(spark: SparkSession, state: State, scope: Column | None = None) -> list[str]:
    """Paths of the files of a scope: what a scan of them opens."""
    rows = files(spark, state)
    rows = rows if scope is None else rows.where(scope)
    return [f"{state.root}/data/{r.path}" for r in rows.select("path").orderBy("path").collect()]


def scan(spark: SparkSession, state: State, schema: T.StructType, scope: Column | None = None) -> DataFrame:
    """The rows of the files of ``scope`` (all files without one), with the unit columns.

    ``scope`` chooses files; filter rows as well where a file may hold others.
    """
    paths = named_files(spark, state, scope)
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{state.root}/data").parquet(*paths).select(*schema.names)


# ------------------------------------------------------------- writing

def describe_files(spark: SparkSession, root: str, write: str, schema: T.StructType, key: str) -> DataFrame:
    """Manifest rows of the files of one data folder (reads the ``key`` column only)."""
    rows = spark.read.schema(schema).option("basePath", f"{root}/data").parquet(f"{root}/data/write={write}")
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    local = F.substring_index(path, "/data/write=", -1)
    return (rows.groupBy(*UNIT, F.concat(F.lit("write="), local).alias("path"))
            .agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("min_pnu"), F.max(key).alias("max_pnu")))


def replace_units(spark: SparkSession, root: str, write_data, schema: T.StructType, key: str = "pnu",
                  expected: State | None = None) -> State:
    """Put the units that ``write_data(path)`` writes in the place of the stored ones.

    With ``expected`` the pointer moves from that state only (``LostRace``
    otherwise). Without it a writer that is overtaken builds its manifest anew on
    the newer state: units of both writers stay, of a unit written by both the
    later move decides.
    """
    root = root.rstrip("/")
    write = uuid.uuid4().hex[:12]
    write_data(f"{root}/data/write={write}")
    _, fs, folder = _hadoop(spark, f"{root}/data/write={write}")
    state = expected or current(spark, root)
    if not any(s.isDirectory() for s in fs.listStatus(folder)):  # no row, no unit
        return state
    added = f"{root}/manifests/{write}-units"
    describe_files(spark, root, write, schema, key).write.parquet(added)
    new = spark.read.schema(MANIFEST_SCHEMA).parquet(added)
    for attempt in range(ATTEMPTS):
        manifest = f"{write}-{state.number + 1}"
        kept = files(spark, state).join(new.select(*UNIT).distinct(), UNIT, "left_anti")
        kept.unionByName(new).repartition("stdr_year").write.mode("overwrite").parquet(f"{root}/manifests/{manifest}")
        try:
            return move_pointer(spark, state, manifest)
        except LostRace:
            if expected is not None or attempt == ATTEMPTS - 1:
                raise
            state = current(spark, root)
    return state


def remove_superseded(spark: SparkSession, root: str, older_than_ms: int) -> int:
    """Delete data files that the state in force does not name, and other manifests, if older than the given age; returns the number of data files.

    Call it when no reader of an older state and no writer is under way any more.
    """
    state = current(spark, root)
    now = F.unix_millis(F.current_timestamp())
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{state.root}/data").select("path", "modificationTime")
    local = F.concat(F.lit("write="), F.substring_index("path", "/data/write=", -1))
    old = found.where(now - F.unix_millis("modificationTime") >= older_than_ms).withColumn("local", local)
    unnamed = old.join(files(spark, state).select(F.col("path").alias("local")), "local", "left_anti")
    count = 0
    for row in unnamed.select("path").toLocalIterator():
        jvm, fs, path = _hadoop(spark, row.path)
        count += bool(fs.delete(path, False))
    jvm, fs, folder = _hadoop(spark, f"{state.root}/manifests")
    clock = jvm.java.lang.System.currentTimeMillis()
    for status in fs.listStatus(folder) if fs.exists(folder) else ():
        if status.getPath().getName() != state.manifest and clock - status.getModificationTime() >= older_than_ms:
            fs.delete(status.getPath(), True)
    return count
