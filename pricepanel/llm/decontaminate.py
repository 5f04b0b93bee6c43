"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are word windows of the benchmark items (``window`` consecutive
words; an item of fewer words is one window). Per pattern length one table is
built: the shift table says how far the search may jump past a two-word block,
blocks of shift 0 lead to a bucket of patterns ending in that block, and the
bucket's patterns are compared word by word with the text.

Spark makes the windows and writes the distinct (window, item) pairs. They are
searched in chunks of about ``max_patterns`` pairs, dealt by hash: one chunk a
pass goes through the driver and is broadcast, and the documents with their hits
are written between passes, so only one chunk is alive at a time however large
the benchmark is. A window of several items may lie in several chunks, each time
for the items of that chunk; hits are united row by row.

Nulls and empty texts have no words. Items without words have no windows.
Repeated items count as items of their own when their ids differ; rows that
repeat an (id, text) pair change nothing. A null item id is searched but not
listed. Ties, repeated documents and extra columns need no rule: every
document row is judged alone and only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricepanel.llm import arrowtext as T
from pricepanel.llm.tables import carried, restored, stored
from pricepanel.session import ship_package

WINDOW = 13
MAX_PATTERNS = 500_000
SEED = np.uint64(0xA0761D6478BD642F)


def words_of(text: str | None) -> list[bytes]:
    """The words of one text, lower-cased A-Z, as UTF-8."""
    raw, offsets = T.utf8(pa.array([text], pa.large_string()))
    raw = T.LOWER[raw]
    starts, ends, _ = T.word_spans(raw, offsets, T.ALNUM)
    return [raw[s:e].tobytes() for s, e in zip(starts, ends)]


def item_windows(items: Iterator[tuple[str | None, str | None]], window: int = WINDOW) -> dict[tuple[bytes, ...], set]:
    """Distinct windows and the items that hold them."""
    found: dict[tuple[bytes, ...], set] = {}
    for item_id, text in items:
        words = words_of(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            found.setdefault(tuple(words[i:i + window]), set()).add(item_id)
    return found


def _hash_words(words: list[bytes]) -> np.ndarray:
    lengths = np.array([len(w) for w in words])
    ends = np.cumsum(lengths)
    return T.word_hashes(np.frombuffer(b"".join(words), np.uint8), ends - lengths, ends)


def _blocks(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the block of ``size`` words that ends at each position (from ``size - 1`` on)."""
    return T.shingle_hashes(hashes ^ SEED, size)


class WuManber:
    """Shift and suffix tables for patterns of one length (in words)."""

    def __init__(self, patterns: list[tuple[bytes, ...]]):
        self.length = len(patterns[0])
        self.block = min(2, self.length)
        self.shift: dict[int, int] = {}
        self.bucket: dict[int, list[tuple[int, ...]]] = {}
        self.jump = self.length - self.block + 1
        self.patterns = patterns
        hashes = _hash_words([w for p in patterns for w in p]).reshape(len(patterns), self.length)
        for n, row in enumerate(hashes):
            blocks = _blocks(row, self.block).tolist()
            last = len(blocks) - 1
            for i, b in enumerate(blocks):
                if last - i < self.shift.get(b, self.jump):
                    self.shift[b] = last - i
            self.bucket.setdefault(blocks[last], []).append(n)

    def ends(self, blocks, begin: int, end: int) -> Iterator[tuple[int, list[int]]]:
        """Positions of the last word of possible matches in words ``begin:end``, with their patterns.

        ``blocks[i]`` is the hash of the block that starts at word i.
        """
        shift, jump, back = self.shift, self.jump, self.block - 1
        i = begin + self.length - 1
        while i < end:
            b = blocks[i - back]
            step = shift.get(b, jump)
            if step:
                i += step
            else:
                yield i, self.bucket[b]
                i += 1


class Search:
    """All pattern lengths over word streams; yields confirmed occurrences."""

    def __init__(self, windows: dict[tuple[bytes, ...], list]):
        self.windows = windows
        by_length: dict[int, list] = {}
        for w in windows:
            by_length.setdefault(len(w), []).append(w)
        self.tables = [WuManber(p) for p in by_length.values()]

    def scan(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray):
        """(row, first word, end word, items) of each occurrence; ``rows`` are word offsets per row."""
        if not len(starts):
            return
        hashes = T.word_hashes(raw, starts, ends)
        bounds = rows.tolist()
        for table in self.tables:
            if len(hashes) < table.length:
                continue
            blocks = memoryview(np.ascontiguousarray(_blocks(hashes, table.block)))
            for row in range(len(bounds) - 1):
                for last, candidates in table.ends(blocks, bounds[row], bounds[row + 1]):
                    first = last - table.length + 1
                    here = tuple(raw[s:e].tobytes() for s, e in zip(starts[first:last + 1], ends[first:last + 1]))
                    for n in candidates:
                        if table.patterns[n] == here:
                            yield row, first, last + 1, self.windows[here]


SPANS = "array<struct<start: bigint, end: bigint>>"
SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def united(spans: list[dict]) -> list[dict]:
    """Word ranges in order, overlapping and adjacent ones merged."""
    out: list[dict] = []
    for x in sorted(spans, key=lambda x: (x["start"], x["end"])):
        if out and x["start"] <= out[-1]["end"]:
            out[-1] = {"start": out[-1]["start"], "end": max(out[-1]["end"], x["end"])}
        else:
            out.append(x)
    return out


def _task(windows, names: list[str], keep_text: bool):
    """Adds the hits of one chunk of patterns to ``_spans`` and ``_items``, and sets ``_n_words``."""
    search = None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal search
        if search is None:
            search = Search(windows.value)
        for batch in batches:
            for part in T.slices(batch, "text"):
                raw, offsets = T.utf8(part.column("text"))
                raw = T.LOWER[raw]
                starts, ends, rows = T.word_spans(raw, offsets, T.ALNUM)
                spans, items = part.column("_spans").to_pylist(), part.column("_items").to_pylist()
                touched = set()
                for row, first, end, found in search.scan(raw, starts, ends, rows):
                    touched.add(row)
                    base = int(rows[row])
                    spans[row].append({"start": first - base, "end": end - base})
                    items[row] += [i for i in found if i is not None]
                for row in touched:
                    spans[row], items[row] = united(spans[row]), sorted(set(items[row]))
                own = {"_n_words": pa.array(np.diff(rows), pa.int64()), "_spans": pa.array(spans, SPAN_TYPE),
                       "_items": pa.array(items, pa.list_(pa.string()))}
                out = [n for n in names if keep_text or n != "text"]
                yield pa.RecordBatch.from_arrays([own[n] if n in own else part.column(n) for n in out], out)
    return run


def benchmark_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """(pattern, item_id): the distinct windows of every item, words joined by a space (no word holds one)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch, "text"):
                for item_id, text in zip(part.column("item_id").to_pylist(), part.column("text").to_pylist()):
                    patterns = [b" ".join(w) for w in item_windows(iter([(item_id, text)]), window)]
                    yield pa.RecordBatch.from_arrays([pa.array(patterns, pa.binary()), pa.array([item_id] * len(patterns), pa.string())], ["pattern", "item_id"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return stored(items.mapInArrow(run, "pattern binary, item_id string").distinct(), "benchmark-windows")


def pattern_chunks(windows: DataFrame, max_patterns: int) -> Iterator[tuple[dict, bool]]:
    """Chunks of about ``max_patterns`` rows of ``benchmark_windows`` as pattern tables, and whether more follow."""
    chunks = max(1, -(-windows.count() // max_patterns))
    for k in range(chunks):
        found: dict[tuple[bytes, ...], set] = {}
        for row in windows.where(F.pmod(F.xxhash64("pattern", "item_id"), F.lit(chunks)) == k).collect():
            found.setdefault(tuple(bytes(row.pattern).split(b" ")), set()).add(row.item_id)
        yield found, k < chunks - 1


def _searched(documents: DataFrame, benchmark: DataFrame, window: int, max_patterns: int, keep_text: bool) -> DataFrame:
    """``documents`` with ``_n_words``, ``_spans`` (hit word ranges) and ``_items``.

    One map stage over the scan for each chunk of patterns, so no shuffle; hits
    of earlier chunks travel with their row.
    """
    spark = documents.sparkSession
    ship_package(spark)
    current = (documents.withColumn("text", F.col("text").cast("string")).withColumn("_n_words", F.lit(0).cast("bigint"))
               .withColumn("_spans", F.expr(f"cast(array() as {SPANS})")).withColumn("_items", F.expr("cast(array() as array<string>)")))
    for chunk, more in pattern_chunks(benchmark_windows(benchmark, window), max_patterns):
        keep = keep_text or more
        schema = T.fields_of(f for f in current.schema.fields if keep or f.name != "text")
        table = spark.sparkContext.broadcast(chunk)
        current = current.mapInArrow(_task(table, current.columns, keep), schema)
        if more:  # the pass ends here, and its patterns with it
            current = stored(current, "searched")
            table.unpersist()
    return current


def contamination_spans(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", window: int = WINDOW,
                        max_patterns: int = MAX_PATTERNS) -> DataFrame:
    """(key, n_words, spans of hit words, items found) for every document row."""
    found = _searched(documents.select(F.col(f"`{key}`").alias("_key"), "text"), benchmark, window, max_patterns, keep_text=False)
    return found.select(F.col("_key").alias(key), F.col("_n_words").alias("n_words"),
                        F.col("_spans").alias("spans"), F.col("_items").alias("items"))


def _n_hit(spans: str):
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda a, x: a + x["end"] - x["start"])


def judge(spans: DataFrame) -> DataFrame:
    """Counts, the items' digest and the contamination rule on ``contamination_spans``."""
    return (spans.withColumn("n_hit", _n_hit("spans"))
            .withColumn("n_items", F.size("items").cast("bigint"))
            .withColumn("items_sha256", F.sha2(F.concat_ws(",", "items"), 256))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))))


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                        max_patterns: int = MAX_PATTERNS) -> DataFrame:
    """``documents`` without the rows that the rule calls contaminated; columns unchanged."""
    rows = carried(documents, "text")
    found = _searched(rows, benchmark, window, max_patterns, keep_text=True).withColumn("_n_hit", _n_hit("_spans"))
    clean = ~((F.col("_n_hit") > 0) & (F.col("_n_hit") * 20 >= F.col("_n_words")))
    return restored(found.where(clean), documents)
