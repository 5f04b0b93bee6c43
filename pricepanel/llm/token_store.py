"""Token-id files with Elias-Fano coded document boundaries.

Documents are encoded where they are scanned; their packed ids are dealt to ranges of
document ids (bounds from quantiles of the ids alone) and sorted, and each task appends
blocks to one file of the output folder. Spark's own file writer commits the files,
so a lost executor or a repeated task leaves no half-written file. A block holds

    magic "EFTB" | id width, flags (uint8 each), 2 spare bytes | partition (uint32)
    documents n, null ids, ids total (uint64 each) | first id (int64)
    Elias-Fano sequence of n + 1 document boundaries
    Elias-Fano sequence of the n document ids, less the first
    ids, concatenated, little-endian

An Elias-Fano sequence is: values (uint64) | universe (uint64) | low bits
(uint8) | packed low bits | unary high bits | one bit position (uint64) for
every SAMPLE-th value. ``EliasFano.select`` reads value i from the nearest
sample on; two bits a document plus the low bits are all that is kept, no
table of 64-bit offsets. Blocks end at BLOCK_IDS ids (a longer document is a
block of its own), which bounds a task's memory; a file is a run of blocks, each followed by
one line feed.

Null texts read as empty: such a document holds the end id alone. Rows with a
null id come first (ascending order, nulls first), ties stay in any order of
their equal ids; repeated rows are stored as often as they come. Empty tables
give an empty folder and no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import bisect
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricepanel.llm import arrowtext as T
from pricepanel.llm import bpe
from pricepanel.llm.tables import stored
from pricepanel.session import ship_package, work_dir

MAGIC = b"EFTB"
SAMPLE = 256
BLOCK_IDS = 2_000_000
HEAD = struct.Struct("<4sBBHIQQQq")


class EliasFano:
    """A non-decreasing sequence of integers from 0 up, in near-minimal space."""

    def __init__(self, n: int, universe: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.universe, self.low_bits = n, universe, low_bits
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        universe = int(values[-1]) if n else 0
        low_bits = max(0, (universe // n).bit_length() - 1) if n else 0
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1) if low_bits else np.zeros((n, 0), np.uint64)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        unary[ones] = 1
        return cls(n, universe, low_bits, low, np.packbits(unary, bitorder="little"), ones[::SAMPLE].astype("<u8"))

    def to_bytes(self) -> bytes:
        head = struct.pack("<QQB", self.n, self.universe, self.low_bits)
        return head + self.low.tobytes() + struct.pack("<Q", len(self.high)) + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def read(cls, data: memoryview, at: int) -> tuple[EliasFano, int]:
        n, universe, low_bits = struct.unpack_from("<QQB", data, at)
        at += 17
        low = np.frombuffer(data, np.uint8, (n * low_bits + 7) // 8, at)
        at += len(low)
        (size,) = struct.unpack_from("<Q", data, at)
        high = np.frombuffer(data, np.uint8, size, at + 8)
        at += 8 + size
        samples = np.frombuffer(data, "<u8", (n + SAMPLE - 1) // SAMPLE, at)
        return cls(n, universe, low_bits, low, high, samples), at + 8 * len(samples)

    def _low(self, i: int) -> int:
        begin = i * self.low_bits
        window = int.from_bytes(self.low[begin // 8:(begin + self.low_bits + 7) // 8].tobytes(), "little")
        return window >> begin % 8 & (1 << self.low_bits) - 1

    def select(self, i: int) -> int:
        """Value i, read from the nearest sample before it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        position, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = position // 8
        bits = int(self.high[byte]) >> position % 8 << position % 8
        while (ones := bits.bit_count()) <= left:
            left -= ones
            byte += 1
            bits = int(self.high[byte])
        for _ in range(left):
            bits &= bits - 1
        position = byte * 8 + (bits & -bits).bit_length() - 1
        return position - i << self.low_bits | self._low(i)

    def all(self) -> np.ndarray:
        """Every value, as int64."""
        high = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n] - np.arange(self.n)
        if not self.low_bits:
            return high
        bits = np.unpackbits(self.low, bitorder="little")[:self.n * self.low_bits].reshape(self.n, self.low_bits)
        low = bits.astype(np.int64) @ (np.int64(1) << np.arange(self.low_bits, dtype=np.int64))
        return (high << self.low_bits) + low


def write_block(partition: int, doc_ids: list[int | None], texts: list[bytes], width: int) -> bytes:
    """One block of documents in ascending order of id (nulls first); texts are packed ids."""
    nulls = sum(d is None for d in doc_ids)
    known = np.array(doc_ids[nulls:], dtype=np.int64)
    first = int(known[0]) if len(known) else 0
    sizes = np.array([len(t) // width for t in texts], np.uint64)
    bounds = np.concatenate(([np.uint64(0)], np.cumsum(sizes, dtype=np.uint64)))
    head = HEAD.pack(MAGIC, width, 0, 0, partition, len(doc_ids), nulls, int(bounds[-1]), first)
    above = known.astype(np.uint64) - np.uint64(first % 2**64)
    return b"".join([head, EliasFano.of(bounds).to_bytes(), EliasFano.of(above).to_bytes(), *texts])


class Block:
    """A read block: boundaries, document ids and the concatenated ids."""

    def __init__(self, data: memoryview, at: int):
        magic, width, _, _, self.partition, self.n, self.nulls, self.total, self.first = HEAD.unpack_from(data, at)
        if magic != MAGIC:
            raise ValueError("not a block of token ids")
        self.bounds, at = EliasFano.read(data, at + HEAD.size)
        self.known, at = EliasFano.read(data, at)
        self.ids = np.frombuffer(data, f"<u{width}", self.total, at)
        self.end = at + width * self.total + 1

    def doc_ids(self) -> list[int | None]:
        known = self.known.all().astype(np.uint64) + np.uint64(self.first % 2**64)
        return [None] * self.nulls + known.astype(np.int64).tolist()

    def places(self, doc_id: int) -> range:
        """Places of the documents with this id, by binary search over selects."""
        above, known = doc_id - self.first, self.known
        begin = bisect.bisect_left(range(known.n), above, key=known.select)
        end = bisect.bisect_right(range(known.n), above, lo=begin, key=known.select)
        return range(self.nulls + begin, self.nulls + end)

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document of the block, by two selects."""
        return self.ids[self.bounds.select(i):self.bounds.select(i + 1)]


def blocks(content: bytes) -> Iterator[Block]:
    data, at = memoryview(content), 0
    while at < len(data):
        block = Block(data, at)
        yield block
        at = block.end


class LibraryEncoder(bpe.Encoder):
    """The word cache of ``bpe.Encoder``; words with letters beyond Latin come from the tokenizers library."""

    def __init__(self, content: str):
        from tokenizers import Tokenizer
        super().__init__(bpe.Vocabulary(content))
        self.library = Tokenizer.from_str(content)
        self.library.no_truncation()
        self.library.no_padding()

    def prepare(self, words: list[str]) -> dict[str, bytes]:
        """New words beyond Latin letters go through the library in one call."""
        beyond = dict.fromkeys(w for w in words if not w.isascii() and bpe.BEYOND_LATIN.search(w))
        new = [w for w in beyond if w not in self and w not in self.old]
        made = {w: self.pack(e.ids) for w, e in zip(new, self.library.encode_batch_fast(new, add_special_tokens=False))} if new else {}
        for w, packed in made.items():
            self.keep(w, packed)
        return made


_LIBRARY: dict[int, LibraryEncoder] = {}


def _library(content) -> LibraryEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    key = hash(content.value)
    if key not in _LIBRARY:
        _LIBRARY.clear()
        _LIBRARY[key] = LibraryEncoder(content.value)
    return _LIBRARY[key]


def write_token_files(documents: DataFrame, vocabulary_path: str, end_id: int, path: str,
                      block_ids: int = BLOCK_IDS) -> None:
    """Encode ``documents`` and write the files to ``path`` (shared storage), in order of ``doc_id``."""
    spark = documents.sparkSession
    ship_package(spark)
    content = bpe.read_vocabulary(spark, vocabulary_path)

    width = bpe.Encoder(bpe.Vocabulary(content.value)).kind.itemsize

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _library(content)
        end = enc.pack([end_id])
        for batch in batches:
            for part in T.slices(batch, "text", bpe.LOOKUP_BYTES):
                packed = [ids + end for ids in enc.packed_all(part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(packed, pa.binary())], ["doc_id", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        doc_ids: list[int | None] = []
        texts: list[bytes] = []
        held = 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([write_block(partition, doc_ids, texts, width)], pa.binary())], ["block"])

        for batch in batches:
            for doc_id, value in zip(batch.column("doc_id").to_pylist(), batch.column("packed")):
                packed = value.as_py()
                if doc_ids and held + len(packed) > block_ids * width:
                    yield block()
                    doc_ids, texts, held = [], [], 0
                doc_ids.append(doc_id)
                texts.append(packed)
                held += len(packed)
        if doc_ids:
            yield block()

    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = docs.select("doc_id").where("doc_id is not null").approxQuantile("doc_id", [i / n for i in range(1, n)], 0.2 / n)
    # The range of an id; nulls come first. Equal ids never part.
    below = F.filter(F.lit(sorted(set(bounds))).cast("array<double>"), lambda x: x < F.col("doc_id").cast("double"))
    packed = docs.mapInArrow(encode, "doc_id bigint, packed binary").withColumn("range", F.coalesce(F.size(below), F.lit(0)))
    ordered = packed.repartitionById(n, F.col("range")).sortWithinPartitions(F.col("doc_id").asc_nulls_first()).drop("range")
    (ordered.mapInArrow(run, "block binary").select(F.col("block").cast("string").alias("value"))
     .write.option("lineSep", "\n").option("compression", "none").text(path))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(partition, place in the partition, doc_id, offset, n_tokens, crc of the ids) from the files."""
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                begin, place = 0, 0
                for b in blocks(content.as_buffer()):
                    bounds = np.array([b.bounds.select(i) for i in range(b.n + 1)], np.int64)
                    wide = b.ids.astype("<u4")
                    crc = [zlib.crc32(wide[s:e]) for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([b.partition] * b.n, pa.int32()), pa.array(range(place, place + b.n), pa.int64()),
                         pa.array(b.doc_ids(), pa.int64()), pa.array(bounds[:-1] + begin, pa.int64()),
                         pa.array(np.diff(bounds), pa.int64()), pa.array(crc, pa.int64())],
                        ["partition", "place", "doc_id", "begin", "n_tokens", "ids_crc32"])
                    begin, place = begin + b.total, place + b.n

    return _files(spark, path).mapInArrow(run, "partition int, place bigint, doc_id bigint, begin bigint, n_tokens bigint, ids_crc32 bigint")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def read_document(spark: SparkSession, path: str, doc_id: int) -> DataFrame:
    """(token_ids) of every document with this id: found and cut out of its block by selects alone."""
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                found = [b.document(i).astype(np.int32) for b in blocks(content.as_buffer()) for i in b.places(doc_id)]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32()))], ["token_ids"])

    return _files(spark, path).mapInArrow(run, "token_ids array<int>")


def token_offsets(documents: DataFrame, vocabulary_path: str, end_id: int = 2, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Write the files, read them back: (doc_id, start, n_tokens, ids_crc32) per document row.

    Files follow each other in the order of their partitions, so a document's
    ``start`` is its offset in the file plus the ids of the files before: one
    running sum over one row a file.
    """
    spark = documents.sparkSession
    path = f"{work_dir(spark, 'token-files')}/files"
    write_token_files(documents, vocabulary_path, end_id, path, block_ids)
    rows = stored(read_documents(spark, path), "token-offsets")
    totals = rows.groupBy("partition").agg(F.sum("n_tokens").alias("ids"))
    before = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(totals.select("partition", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base")), "file-starts")
    return rows.join(starts, "partition").select(
        "doc_id", (F.col("base") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")
