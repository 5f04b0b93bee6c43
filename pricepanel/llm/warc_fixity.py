"""Merkle fixity audit of WARC replicas.

``write_replica`` lays records out as WARC files, compressed by gzip, in shared
storage (``write_replicas`` several replicas of the same pages, which move
once), and ``read_replica`` reads a replica's files: records are cut by their
Content-Length and hashed where they are read; only (file, offset, length,
hash, id) moves on. Offsets and lengths are those of the unpacked file. A tree covers one file by fixed offset ranges: the leaf
range of RANGE_BYTES holds the records that start in it, a node holds FAN_OUT
consecutive ranges, up to a root for each file. A node's hash covers its
children's offsets and hashes in order, so records that moved, vanished or
appeared change it like altered bytes do. Ranges are known from the offset
alone: no global numbering, and a file of any size spreads over many groups of
at most FAN_OUT children.

``audit`` compares replicas from the roots down and joins, level by level, only
the children of ranges that differ. The records of those ranges are matched by
their id: first those with equal bytes, wherever they lie, so that a record that
only moved behind a damage is no finding; then the rest, so that altered records
are told from missing and extra ones.

Null payloads hash like empty ones; empty tables give no roots and no
findings; a file that only one replica has differs at its root. Repeated
records (one id, or one file and offset) are matched one to one, so as many
count as there are. Further columns of the records are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricepanel.llm.tables import stored
from pricepanel.session import ship_package

RANGE_BYTES = 1 << 16
FAN_OUT = 16
PAGES_PER_FILE = 1000


WARC_DATE = "2026-07-15T00:00:00Z"


def record_id(page_id: Column, url: Column) -> Column:
    """The URI that names a record: its page, or its address where the page has no id."""
    return F.when(page_id.isNotNull(), F.concat(F.lit("urn:page:"), page_id.cast("string"))).otherwise(
        F.concat(F.lit("urn:md5:"), F.md5(F.coalesce(url, F.lit("")))))


def warc_record(page_id: Column, url: Column, payload: Column, date: str = WARC_DATE) -> Column:
    """A WARC resource record as text: header lines, an empty line, the payload, two line ends."""
    body = F.coalesce(payload, F.lit(""))
    return F.concat(F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <"), record_id(page_id, url), F.lit(">\r\nWARC-Date: " + date),
                    F.lit("\r\nWARC-Target-URI: "), F.regexp_replace(F.coalesce(url, F.lit("")), "[\r\n]+", " "),
                    F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"),
                    F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def file_of(page_id: Column, url: Column, per_file: int = PAGES_PER_FILE) -> Column:
    """The file of a page: one range of ``per_file`` ids, null ids by their url's hash."""
    return F.when(page_id.isNull(), -1 - F.pmod(F.xxhash64(url), F.lit(1 << 20))).otherwise(F.floor(page_id / per_file)).cast("bigint")


def records(pages: DataFrame, per_file: int = PAGES_PER_FILE) -> DataFrame:
    """(file, page_id, url, html) of the pages, dealt to WARC files."""
    page_id, url = F.col("page_id"), F.col("url")
    return pages.select(file_of(page_id, url, per_file).alias("file"), "page_id", "url", F.coalesce("html", F.lit("")).alias("html"))


def _write(dealt: DataFrame, path: str, *folders: str) -> None:
    """The pages' records with ``payload``, as gzip files ``<path>/<folder>=<value>/../part-*`` in order of page_id.

    ``dealt`` holds a file's pages in one partition; Spark's own writer writes it,
    a record's last line end is the writer's line separator.
    """
    record = warc_record(F.col("page_id"), F.col("url"), F.col("payload"))
    out = dealt.select(*folders, "page_id", "url", record.alias("record")).sortWithinPartitions(*folders, "page_id", "url", "record")
    (out.select(*folders, F.expr("substring(record, 1, length(record) - 1)").alias("value"))
     .write.partitionBy(*folders).option("lineSep", "\n").option("compression", "gzip").text(path))


def write_replica(made: DataFrame, path: str) -> None:
    """The records as WARC files ``<path>/file=<n>/part-*.gz``, in order of page_id, each right behind the one before."""
    _write(made.withColumn("payload", F.col("html")).repartition("file"), path, "file")


def write_replicas(made: DataFrame, path: str, **payloads: Column) -> None:
    """Several replicas at once, as WARC files ``<path>/replica=<name>/file=<n>/part-*.gz``.

    ``payloads`` gives a page's payload in each replica; a null one is a record
    that the replica lost. The pages move once for all replicas.
    """
    copies = F.array(*[F.struct(F.lit(name).alias("replica"), payload.alias("payload")) for name, payload in payloads.items()])
    dealt = made.repartition("file").select("file", "page_id", "url", F.inline(copies)).where("payload is not null")
    _write(dealt, path, "replica", "file")


HEADER_LINE = re.compile(rb"([!-9;-~]+):[ \t]*(.*?)\r\n")


def _cut(content: memoryview) -> Iterator[tuple[int, int, dict[bytes, bytes]]]:
    """(offset, length, header fields) of the records of one file."""
    at = 0
    while at < len(content):
        head = re.compile(rb"\r\n\r\n").search(content, at)
        if bytes(content[at:at + 5]) != b"WARC/" or head is None:
            yield at, len(content) - at, {}  # bytes that are no record: one piece up to the end
            return
        fields = {k.lower(): v for k, v in HEADER_LINE.findall(content[at:head.end() - 2])}
        end = head.end() + int(fields.get(b"content-length", b"0")) + 4
        yield at, min(end, len(content)) - at, fields
        at = end


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            packed = content.as_buffer()
            data = memoryview(gzip.decompress(packed) if path.endswith(".gz") else packed)
            file = int(re.search(r"file=(-?\d+)", path)[1])
            rows = [(file, at, n, hashlib.sha256(data[at:at + n]).hexdigest(), f.get(b"warc-record-id", b"").decode().strip("<>"),
                     f.get(b"warc-target-uri", b"").decode(errors="replace")) for at, n, f in _cut(data)]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            names = ["file", "offset", "length", "hash", "record_id", "url"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def read_replica(spark: SparkSession, path: str) -> DataFrame:
    """(file, offset, length, hash, record_id, url) of every record in a replica's files."""
    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(_read, "file bigint, offset bigint, length bigint, hash string, record_id string, url string")


def _node(children: DataFrame, place: Column) -> DataFrame:
    """Nodes over ``children`` (file, at, hash): ordered children hashed together."""
    ordered = F.sort_array(F.collect_list(F.struct("at", "hash")))
    text = F.array_join(F.transform(ordered, lambda c: F.concat(c["at"].cast("string"), F.lit(":"), c["hash"])), ",")
    return children.groupBy("file", place.alias("at_")).agg(F.sha2(text, 256).alias("hash")).withColumnRenamed("at_", "at")


def tree(replica: DataFrame, range_bytes: int = RANGE_BYTES, fan_out: int = FAN_OUT) -> list[DataFrame]:
    """Levels of the replica's trees, leaves' ranges first, one root a file last: (file, at, hash).

    Each level is one grouping with at most ``fan_out`` children a group (a
    leaf range: as many records as start in it), written to the shared folder.
    """
    leaves = replica.select("file", F.col("offset").alias("at"), F.concat("hash", F.lit("/"), F.col("length").cast("string")).alias("hash"))
    levels = [stored(_node(leaves, F.floor(F.col("at") / range_bytes)), "merkle-0")]
    while (top := levels[-1].agg(F.max("at")).first()[0]) is not None and top > 0:
        levels.append(stored(_node(levels[-1], F.floor(F.col("at") / fan_out)), f"merkle-{len(levels)}"))
    return levels


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """(file, at) whose hashes differ or that only one side has."""
    left, right = a.withColumnRenamed("hash", "a_hash"), b.withColumnRenamed("hash", "b_hash")
    return left.join(right, ["file", "at"], "full").where(~F.col("a_hash").eqNullSafe(F.col("b_hash"))).select("file", "at")


def audit(a: DataFrame, b: DataFrame, range_bytes: int = RANGE_BYTES, fan_out: int = FAN_OUT) -> DataFrame:
    """Records of replicas ``a`` and ``b`` that differ.

    Both have (file, offset, length, hash, record_id, url). Returns file,
    record_id, url, finding (altered, missing, extra: seen from ``a``), both
    offsets, lengths and hashes. Rows grow with the damage, not with the data:
    records that only moved are no finding.
    """
    a_levels, b_levels = tree(a, range_bytes, fan_out), tree(b, range_bytes, fan_out)
    height = max(len(a_levels), len(b_levels))
    for levels in (a_levels, b_levels):  # a shorter replica gets roots of the same height
        while len(levels) < height:
            levels.append(stored(_node(levels[-1], F.floor(F.col("at") / fan_out)), f"merkle-{len(levels)}"))
    suspects = stored(_differing(a_levels[-1], b_levels[-1]), "suspects")
    for level in range(height - 2, -1, -1):
        parent = suspects.select(F.col("file"), F.col("at").alias("parent"))

        def below(nodes: DataFrame) -> DataFrame:
            keyed = nodes.withColumn("parent", F.floor(F.col("at") / fan_out))
            return keyed.join(parent, ["file", "parent"], "left_semi").drop("parent")

        suspects = stored(_differing(below(a_levels[level]), below(b_levels[level])), "suspects")
    parent = suspects.select("file", F.col("at").alias("range"))

    def in_ranges(replica: DataFrame) -> DataFrame:
        held = replica.withColumn("range", F.floor(F.col("offset") / range_bytes)).join(parent, ["file", "range"], "left_semi")
        same = Window.partitionBy("file", "record_id", "hash", "length").orderBy("offset")
        held = held.withColumn("record_id", F.coalesce("record_id", F.lit("")))
        return held.select("file", "record_id", "url", "offset", "length", "hash", F.row_number().over(same).alias("copy"))

    left, right = stored(in_ranges(a), "suspect-records"), stored(in_ranges(b), "suspect-records")
    equal = ["file", "record_id", "hash", "length", "copy"]

    def rest(one: DataFrame, other: DataFrame, prefix: str) -> DataFrame:
        order = Window.partitionBy("file", "record_id").orderBy("offset", "hash")
        left_over = one.join(other.select(*equal), equal, "left_anti").withColumn("copy", F.row_number().over(order))
        return left_over.select("file", "record_id", "copy", *[F.col(c).alias(prefix + c) for c in ("url", "offset", "length", "hash")])

    both = rest(left, right, "a_").join(rest(right, left, "b_"), ["file", "record_id", "copy"], "full")
    finding = F.when(F.col("b_hash").isNull(), "missing").when(F.col("a_hash").isNull(), "extra").otherwise("altered")
    return both.select("file", "record_id", F.coalesce("a_url", "b_url").alias("url"), finding.alias("finding"),
                       "a_offset", "b_offset", "a_length", "b_length", "a_hash", "b_hash")


def roots(replica: DataFrame, range_bytes: int = RANGE_BYTES, fan_out: int = FAN_OUT) -> DataFrame:
    """(file, hash) of the roots of one replica's trees."""
    return tree(replica, range_bytes, fan_out)[-1].select("file", "hash")
