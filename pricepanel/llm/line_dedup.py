"""Line dedup over range-partitioned line hashes (DataFrame functions only).

A line's key is the line stripped of white space at both ends, A-Z lower-cased.
Keys of at least MIN_CHARS code points found in at least MIN_DOCUMENTS
documents lose all their lines except in the largest doc_id that holds them.

Only (key hash, document, line positions) leave a row, one for each key of a
document. They are range-partitioned by (hash, salt) and sorted within by
document (largest first); a stream over the sorted runs marks the first
occurrence a document. The salt, a hash of the document, cuts a key that a
third of all lines share into as many runs as there are shuffle partitions; runs
are added up with map-side combine. The answer is one compressed bitmap a
document: for each dropped line the number of kept lines before it
(``keep_bitmap``), a few bytes instead of the text.

Null and empty texts are one empty line, which is kept. Rows that repeat a
(doc_id, text) count as one document; rows with the same doc_id and other texts
as one document with both texts' lines. A null doc_id is smaller than any other.
Keys are compared by two 64-bit hashes. Extra columns are carried by
``drop_repeated_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricepanel.llm.tables import carried, restored, stored

MIN_CHARS = 40
MIN_DOCUMENTS = 5
SPACES = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def occurrences(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, doc_id, text_id, position) of every line whose key is long enough."""
    lines = documents.select("doc_id", F.xxhash64("text").alias("text_id"), F.posexplode(_lines(F.col("text"))).alias("position", "line"))
    key = lines.withColumn("key", F.btrim("line", F.lit(SPACES))).where(F.char_length("key") >= min_chars)
    # lower() is the cheaper form of A-Z to a-z where a line has no other letters
    plain = F.octet_length("key") == F.char_length("key")
    key = key.withColumn("key", F.when(plain, F.lower("key")).otherwise(F.translate("key", UPPER, LOWER)))
    return key.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "text_id", "position").distinct()


def dropped_positions(documents: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(doc_id, text_id, positions) of the documents that lose lines; positions ascend."""
    spark = documents.sparkSession
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = occurrences(documents, min_chars).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
    run = ["h1", "h2", "salt"]
    by_document = [F.col("doc_id").desc_nulls_last(), F.col("position")]
    stream = Window.partitionBy(*run).orderBy(*by_document)
    fresh = F.coalesce(~F.col("doc_id").eqNullSafe(F.lag("doc_id").over(stream)), F.lit(True)) | (F.row_number().over(stream) == 1)
    ranged = stored(salted.repartitionByRange(*run).withColumn("fresh", fresh), "line-hashes")
    first = ranged.where("fresh")
    keys = (first.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))
            .where(F.col("n") >= min_documents).drop("n"))
    keys = stored(keys, "repeated-lines")
    lost = ranged.join(keys, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return lost.groupBy("doc_id", "text_id").agg(F.sort_array(F.collect_set("position")).alias("positions"))


def bitmap(positions: Column) -> Column:
    """Kept lines before each dropped one, from the ascending positions of dropped lines."""
    before = F.concat(F.array(F.lit(-1)), positions)
    gaps = F.zip_with(positions, before, lambda p, q: p - q - 1)
    return F.slice(gaps, F.lit(1), F.size(positions))


def kept_lines(text: Column, keep_bitmap: Column) -> Column:
    """The lines of ``text`` that the bitmap keeps, joined by a line feed; null bitmaps keep all."""
    flags = F.flatten(F.transform(keep_bitmap, lambda n: F.concat(F.array_repeat(F.lit(True), n), F.array(F.lit(False)))))
    marked = F.zip_with(_lines(text), flags, lambda x, keep: F.when(F.coalesce(keep, F.lit(True)), x))
    left = F.filter(marked, lambda x: x.isNotNull())
    return F.when(keep_bitmap.isNull(), F.coalesce(text.cast("string"), F.lit(""))).otherwise(F.array_join(left, "\n"))


def keep_bitmaps(documents: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(doc_id, text_id, n_dropped, keep_bitmap) of the documents that lose lines."""
    lost = dropped_positions(documents, min_chars, min_documents)
    return lost.select("doc_id", "text_id", F.size("positions").cast("bigint").alias("n_dropped"),
                       bitmap(F.col("positions")).alias("keep_bitmap"))


def with_bitmaps(documents: DataFrame, **rule) -> DataFrame:
    """``documents`` with ``_n_dropped`` and ``_keep_bitmap`` (0 and null where nothing is dropped).

    The bitmaps grow with the documents, so they are never broadcast: texts and
    bitmaps meet by one shuffle of each at any size, without a sort of the texts.
    """
    maps = stored(keep_bitmaps(documents.select("doc_id", "text"), **rule), "keep-bitmaps").select(
        F.col("doc_id").alias("_id"), F.col("text_id").alias("_text_id"),
        F.col("n_dropped").alias("_n_dropped"), F.col("keep_bitmap").alias("_keep_bitmap"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_text_id"))
    joined = documents.join(maps.hint("shuffle_hash"), same, "left").drop("_id", "_text_id")
    return joined.withColumn("_n_dropped", F.coalesce("_n_dropped", F.lit(0).cast("bigint")))


def drop_repeated_lines(documents: DataFrame, **rule) -> DataFrame:
    """``documents`` with the repeated lines gone from ``text`` and ``n_chars`` renewed; rows that lose nothing are unchanged."""
    mapped = with_bitmaps(carried(documents, "doc_id", "text", "n_chars"), **rule)
    changed = F.col("_n_dropped") > 0
    text = F.when(changed, kept_lines(F.col("text"), F.col("_keep_bitmap"))).otherwise(F.col("text"))
    out = mapped.withColumn("text", text)
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(changed, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return restored(out, documents)
