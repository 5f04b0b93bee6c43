"""Near-duplicate groups by SuperMinHash signatures, banding and verification.

A document is the set of its distinct word shingles (a text of fewer words is
one shingle, the whole sequence). SuperMinHash walks, for every element, a
random permutation of the signature's slots and offers ``step + u`` at the slot
of each step, so the ranks of one element are correlated and the signature's
variance is lower than with independent permutations. A step offers values in
[step, step + 1), so the walk ends as soon as no slot holds a value beyond the
next step.

Documents of equal sets are one class (128-bit digest of the sorted set).
Classes that share a bucket (a band of equal signature rows) are candidates:

1. Star. A bucket's centre is the member that shares the most buckets with
   others, so the middle of a group. Every member is compared with its centres
   on full sets: linear in the bucket. Components are formed.
2. Rest. Around a centre, the reference set is the centre's set with the
   elements that many of its members hold. Two members s and m that are still
   apart are linked only if one of two things holds (i = elements common with
   the reference). Without a common element outside it, they share at most
   min(i_s, i_m) elements, which bounds m's size: an equi-join on (centre,
   size). Else they share one of the rarest ``n - ceil(P n) + 1`` elements of
   each outside it (prefix filter): an equi-join on (centre, element). These
   pairs are compared on full sets too. Neither join pairs what a component
   already holds, so a group of near copies costs about its size, not its
   square, and no link inside a bucket is lost.

Links satisfy the exact rule ``100 * common >= percent * union``; two sets at
similarity 0.8 share no bucket with probability below 1e-6.

Null and empty texts have no set and link with nothing (n_shingles 0). Repeated
rows and ties fall into one class; a null id counts as an id above all others
(the least known id of a group wins). Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricepanel.llm import arrowtext as T
from pricepanel.llm.components import components
from pricepanel.llm.pairs import with_both
from pricepanel.llm.tables import carried, finished, restored, stored
from pricepanel.operators.joins import maybe_broadcast
from pricepanel.session import ship_package

SHINGLE = 5
PERCENT = 80
BANDS, ROWS = 35, 5
#: Members around a centre from which on an element counts as one of the group's, not of a few members.
HELD_BY_MANY = 32
#: Rows of two numbers that are broadcast to the texts instead of moving these.
MAX_HEADS = 4_000_000
#: Elements whose walks are kept at a time (each keeps a permutation of the slots).
ELEMENTS = 1 << 14


def sets_of(raw: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, concatenated, with row offsets."""
    starts, ends, rows = T.word_spans(raw, offsets, T.NOT_SPACE)
    words = T.word_hashes(raw, starts, ends)
    counts = np.diff(rows)
    grams = T.shingle_hashes(words, size) if len(words) >= size else words[:0]
    row = np.repeat(np.arange(len(counts)), counts)
    whole = np.arange(len(grams))
    inside = whole + size <= rows[1:][row[:len(grams)]]
    keys, owner = grams[inside], row[:len(grams)][inside]
    few = np.flatnonzero((counts > 0) & (counts < size))
    if len(few):
        short = np.array([_sequence(words[rows[r]:rows[r + 1]]) for r in few], np.uint64)
        keys, owner = np.concatenate((keys, short)), np.concatenate((owner, few))
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    keys, owner = keys[fresh], owner[fresh]
    return keys, np.searchsorted(owner, np.arange(len(counts) + 1))


def _sequence(words: np.ndarray) -> np.uint64:
    """A short text's only shingle: its words in order, apart from shingles of full size."""
    return T.mix(T.shingle_hashes(words, len(words)) + np.uint64(len(words)))[0]


def signatures(keys: np.ndarray, offsets: np.ndarray, slots: int) -> np.ndarray:
    """SuperMinHash signature (rows x slots) of every non-empty set; empty sets keep infinity."""
    rows = len(offsets) - 1
    out = np.full((rows, slots), np.inf)
    flat = out.ravel()
    owner = np.repeat(np.arange(rows), np.diff(offsets))
    for begin in range(0, len(keys), ELEMENTS):
        state, own = keys[begin:begin + ELEMENTS].copy(), owner[begin:begin + ELEMENTS]
        perm = np.tile(np.arange(slots, dtype=np.uint16), (len(state), 1))
        at = np.arange(len(state))
        for step in range(slots):
            state = T.mix(state)
            u = (state >> np.uint64(11)).astype(np.float64) / 2.0**53
            state = T.mix(state ^ np.uint64(0x8EBC6AF09C88C6E3))
            pick = step + ((state >> np.uint64(32)) * np.uint64(slots - step) >> np.uint64(32)).astype(np.int64)
            slot = perm[at, pick]
            perm[at, pick] = perm[at, step]
            np.minimum.at(flat, own * slots + slot, step + u)
            worst = out.max(axis=1)
            alive = worst[own] > step + 1  # a later step offers step + 1 at least
            if not alive.all():
                state, own, perm = state[alive], own[alive], perm[alive]
                at = np.arange(len(state))
                if not len(state):
                    break
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key a band, different for every band."""
    bits = signature[:, :bands * rows].view(np.uint64).reshape(len(signature), bands, rows)
    out = T.mix(np.arange(bands, dtype=np.uint64))[None, :] + np.zeros((len(signature), 1), np.uint64)
    for r in range(rows):
        out = T.mix(out * np.uint64(0x9FB21C651E98DF25) + bits[:, :, r])
    return out


def _lowered(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    raw, offsets = T.utf8(part.column("text"))
    return T.LOWER[raw], offsets


def _digest(keys: np.ndarray) -> str:
    return hashlib.blake2b(keys.tobytes(), digest_size=16).hexdigest()


def _signed(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch, "text", T.SLICE_BYTES // 2):
                keys, offsets = sets_of(*_lowered(part), size)
                counts = np.diff(offsets)
                sign = band_keys(signatures(keys, offsets, bands * rows), bands, rows).view(np.int64)
                digests = [_digest(keys[s:e]) if e > s else None for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(counts) + 1) * bands, pa.int32()), pa.array(sign.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), lists],
                    ["doc_id", "text_id", "n_shingles", "set_id", "bands"])
    return run


def _full_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch, "text"):
                keys, offsets = sets_of(*_lowered(part), size)
                ids = [_digest(keys[s:e]) if e > s else None for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), lists], ["set_id", "members"])
    return run


def difference_bits(elements: str):
    """Two 64-bit words with a bit set for every element (by hash): a bound on how far two differences agree."""
    def word(k: int):
        return F.aggregate(elements, F.lit(0).cast("bigint"), lambda acc, e: F.when(
            e.bitwiseAND(F.lit(64)) == 64 * k, acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), e.bitwiseAND(F.lit(63)).cast("int"))))
            .otherwise(acc))
    return F.array(word(0), word(1))


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, na, nb, common, outside, out_bits, miss_bits) of pairs of classes, by their full sets.

    ``outside`` holds the elements of b that a lacks; ``out_bits`` marks them,
    ``miss_bits`` those of a that b lacks. With a column ``around``, they are
    null for pairs where it is false.
    """
    wide = F.col("around") if "around" in pairs.columns else F.lit(True)
    both = with_both(pairs, sets, "set_id", "members")
    both = both.withColumn("outside", F.when(wide, F.array_except("members_b", "members_a")))
    both = both.withColumn("missing", F.when(wide, F.array_except("members_a", "members_b")))
    return both.select(*pairs.columns, F.size("members_a").alias("na"), F.size("members_b").alias("nb"),
                       F.size(F.array_intersect("members_a", "members_b")).alias("common"), "outside",
                       difference_bits("outside").alias("out_bits"), difference_bits("missing").alias("miss_bits"))


def _linked(common: str, one: str, other: str, percent: int):
    """100 * common >= percent * union, from the sizes of the sets."""
    return F.expr(f"{100 + percent} * {common} >= {percent} * ({one} + {other})")


def groups(documents: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT,
           bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, text_id, n_shingles, set_id, component_id, chosen) per document row.

    ``text_id`` digests the text and, with ``doc_id``, names the row's document;
    ``component_id`` is the least doc_id of the group; ``chosen`` is true for
    the rows of exactly one (doc_id, text_id) of each group.
    """
    spark = documents.sparkSession
    ship_package(spark)
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("text_id", F.xxhash64("text"))
    signed = stored(docs.mapInArrow(_signed(shingle, bands, rows),
                                    "doc_id bigint, text_id bigint, n_shingles bigint, set_id string, bands array<bigint>"), "signed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_id")).alias("first")
    classes = stored(signed.where("n_shingles > 0").groupBy("set_id", "n_shingles")
                     .agg(first, F.first("bands").alias("bands")), "classes")
    signed, banded = stored(signed.drop("bands"), "rows"), signed
    finished(banded)  # the bands are most of its bytes
    # Classes go by a number in the bucket tables: 35 rows a class.
    buckets = classes.select(F.xxhash64("set_id").alias("c"), F.explode("bands").alias("bucket"))
    shared = stored(buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    members = stored(buckets.join(shared, "bucket"), "members")
    classes, banded = stored(classes.drop("bands"), "heads"), classes
    weights = stored(members.groupBy("c").agg(F.sum("n").alias("weight")), "weights")
    weighed = stored(members.join(weights, "c").select("bucket", "c", "weight"), "weighed")
    centres = stored(weighed.groupBy("bucket").agg(F.max(F.struct("weight", "c")).alias("centre")), "centres")
    star = weighed.join(centres, "bucket").select(F.col("centre.c").alias("ca"), F.col("c").alias("cb"))
    star = stored(star.where("ca <> cb").distinct(), "star")
    numbered = classes.select(F.xxhash64("set_id").alias("c"), "set_id")
    for side in ("a", "b"):
        star = star.join(numbered.select(F.col("c").alias("c" + side), F.col("set_id").alias(side)), "c" + side)
    star = stored(star.select("a", "b"), "star")
    finished(banded, members, weighed, centres)
    # Full sets of the classes that share a bucket at all, made again from their texts.
    wanted = weights.select("c").join(classes.select(F.xxhash64("set_id").alias("c"), "first"), "c").select(
        F.col("first.doc_id").alias("_id"), F.col("first.text_id").alias("_text")).distinct()
    found = _once(docs, signed, stored(wanted, "wanted")).select("text")
    sets = stored(found.mapInArrow(_full_sets(shingle), "set_id string, members array<bigint>"), "sets")
    star = stored(compared(star, sets), "compared")
    links = star.where(_linked("common", "na", "nb", percent)).select("a", "b")
    labels = components(links)
    rest = stored(pairs_around(star, labels, percent), "rest").withColumn("around", F.lit(False))
    rest = stored(compared(rest, sets).where(_linked("common", "na", "nb", percent)).select("a", "b"), "links")
    finished(sets, star)
    if not rest.isEmpty():
        labels = _merged(labels, rest)
    return _labelled(signed, classes, labels)


def _once(docs: DataFrame, signed: DataFrame, wanted: DataFrame) -> DataFrame:
    """One row of ``docs`` for every (_id, _text) of ``wanted``; no text moves but those of repeated rows."""
    def among(table: DataFrame, names: DataFrame, how: str) -> DataFrame:
        return table.join(maybe_broadcast(names, MAX_HEADS), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_id") == F.col("_text")), how)

    copies = among(signed, wanted, "left_semi").groupBy(F.col("doc_id").alias("_id"), F.col("text_id").alias("_text")).agg(F.count(F.lit(1)).alias("n"))
    repeated = stored(copies.where("n > 1").drop("n"), "repeated")
    found = among(docs, wanted, "left_semi")
    if repeated.isEmpty():
        return found
    return among(found, repeated, "left_anti").unionByName(among(docs, repeated, "left_semi").dropDuplicates(["doc_id", "text_id"]))


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after further links: components of the components that they touch."""
    def label_of(side: str) -> DataFrame:
        return labels.select(F.col("node").alias(side), F.col("label").alias("label_" + side))

    named = links.join(label_of("a"), "a", "left").join(label_of("b"), "b", "left")
    between = named.select("a", "b", F.coalesce("label_a", "a").alias("la"), F.coalesce("label_b", "b").alias("lb"))
    between = stored(between, "links-between")
    joined = components(between.select(F.col("la").alias("a"), F.col("lb").alias("b")))
    # nodes that had no link before stand for themselves
    ends = between.select(F.col("a").alias("node"), F.col("la").alias("label")).unionByName(
        between.select(F.col("b").alias("node"), F.col("lb").alias("label"))).distinct()
    every = labels.unionByName(ends).distinct()
    merged = every.join(joined.select(F.col("node").alias("label"), F.col("label").alias("joined")), "label", "left")
    return stored(merged.select("node", F.coalesce("joined", "label").alias("label")), "labels")


def pairs_around(star: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components around one centre that may still be linked.

    ``star`` as of ``compared``, a the centre. A pair's overlap is at most the centre's
    elements that neither lacks and the outside elements that both may hold; the
    bits of the differences bound both numbers.
    """
    # Centres, members and components go by numbers here; members get their names back at the end.
    named = star.drop("outside", "around").join(labels.withColumnRenamed("node", "b"), "b", "left")
    apart = ~_linked("common", "na", "nb", percent)
    named = stored(named.select(F.xxhash64("a").alias("centre"), F.xxhash64("b").alias("x"), "b", F.col("na").alias("nc"), F.col("nb").alias("n"), "common",
                                F.xxhash64(F.coalesce("label", "b")).alias("label"), apart.alias("apart"), (F.col("nb") - F.col("common")).alias("out"),
                                *[F.col(f"{k}_bits")[i].alias(f"{k}{i}") for k in ("out", "miss") for i in range(2)]), "named")
    several = named.groupBy("centre").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("centre")
    around = stored(named.drop("b").join(several, "centre"), "around")
    # Of two members of different components, one at least is not linked with the centre: s.
    elements = star.select(F.xxhash64("a").alias("centre"), F.xxhash64("b").alias("x"), "outside")
    elements = elements.join(around.select("centre", "x", "label", "apart", "n"), ["centre", "x"])
    elements = elements.select("centre", "x", "label", "apart", "n", F.explode("outside").alias("element"))
    counts = elements.groupBy("centre", "element").agg(F.count(F.lit(1)).alias("held"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    known = stored(elements.join(stored(counts.where("held > 1"), "elements"), ["centre", "element"]), "known-elements")
    # Elements that many members hold join the reference set; what is left outside is rare. Those of one member come first.
    many = F.col("held") >= HELD_BY_MANY
    more = known.groupBy("centre", "x").agg(F.count_if(many).alias("more"), F.count(F.lit(1)).alias("listed"))
    around = around.join(more, ["centre", "x"], "left").withColumn("alone", F.expr("n - common - coalesce(listed, 0)"))
    around = stored(around.withColumn("common", F.expr("cast(common + coalesce(more, 0) as int)")).drop("more", "listed"), "around")

    bits = ["out0", "out1", "miss0", "miss1"]
    s = around.where("apart").select("centre", F.col("x").alias("s"), F.col("label").alias("ls"), F.col("n").alias("ns"), F.col("common").alias("cs"),
                                     "nc", F.col("out").alias("outs"), *[F.col(k).alias(k + "s") for k in bits])
    m = around.select("centre", F.col("x").alias("m"), F.col("label").alias("lm"), F.col("n").alias("nm"), F.col("common").alias("cm"),
                      F.col("out").alias("outm"), *[F.col(k).alias(k + "m") for k in bits])
    left = "nc - bit_count(miss0s | miss0m) - bit_count(miss1s | miss1m)"
    more_s = "outs - bit_count(out0s & ~out0m) - bit_count(out1s & ~out1m)"
    more_m = "outm - bit_count(out0m & ~out0s) - bit_count(out1m & ~out1s)"
    possible = _linked(f"({left} + least({more_s}, {more_m}))", "ns", "nm", percent)
    lo = f"cast(ceil({percent} * ns / 100) as int)"
    hi = f"least(cast(floor({100 + percent} * cs / {percent}) as int) - ns, cast(floor(100 * ns / {percent}) as int))"
    sizes = (s.withColumn("lo", F.expr(lo)).withColumn("hi", F.expr(hi)).where("lo <= hi")
             .withColumn("nm", F.explode(F.sequence("lo", "hi"))))
    inside = (sizes.join(m, ["centre", "nm"])
              .where(F.expr("ls <> lm") & _linked("least(cs, cm)", "ns", "nm", percent) & possible).select("s", "m"))
    # Rarest elements first; sets that differ only outside the prefixes cannot reach the rule.
    place = F.row_number().over(Window.partitionBy("centre", "x").orderBy("held", "element"))
    ranked = known.where(~many).withColumn("place", place).join(around.select("centre", "x", "alone"), ["centre", "x"])
    ranked = ranked.where(f"alone + place <= n - cast(ceil({percent} * n / 100) as int) + 1").where("lo < hi")
    ranked = stored(ranked.select("centre", "element", "x", "label", "apart"), "prefixes")
    beyond = (ranked.where("apart").select("centre", "element", F.col("x").alias("s"), F.col("label").alias("ls"))
              .join(ranked.select("centre", "element", F.col("x").alias("m"), F.col("label").alias("lm")), ["centre", "element"])
              .where("ls <> lm").select("centre", "s", "m")).distinct()
    beyond = beyond.join(s.drop("ls"), ["centre", "s"]).join(m.drop("lm"), ["centre", "m"]).where(possible).select("s", "m")
    pairs = inside.unionByName(beyond).select(F.least("s", "m").alias("s"), F.greatest("s", "m").alias("m")).distinct()
    names = named.select("x", "b").distinct()
    pairs = pairs.join(names.select(F.col("x").alias("s"), F.col("b").alias("a")), "s").join(names.select(F.col("x").alias("m"), "b"), "m")
    return pairs.select("a", "b")


def _labelled(signed: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    named = classes.select("set_id", "first").join(labels.withColumnRenamed("node", "set_id"), "set_id", "left")
    named = stored(named.select("set_id", "first", F.coalesce("label", "set_id").alias("label")), "named-classes")
    heads = named.groupBy("label").agg(F.min("first").alias("head"))
    named = stored(named.join(heads, "label").select("set_id", "head"), "heads")
    head = F.col("head")
    chosen = head["doc_id"].eqNullSafe(F.col("doc_id")) & (head["text_id"] == F.col("text_id"))
    return signed.drop("bands").join(named, "set_id", "left").select(
        "doc_id", "text_id", "n_shingles", "set_id",
        F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(head["doc_id"]).alias("component_id"),
        F.when(F.col("set_id").isNull(), F.lit(True)).otherwise(chosen).alias("chosen"))


def remove_near_duplicates(documents: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``documents`` with one row of each group; rows without words stay as they are.

    Only the (doc_id, text) pairs that go, or that stand in several rows, meet
    the texts: few bytes each. Repeated rows of a chosen document are reduced to one.
    """
    found = groups(documents, shingle, percent).where("set_id is not null")
    pairs = found.groupBy(F.col("doc_id").alias("_id"), F.col("text_id").alias("_text")).agg(
        F.max("chosen").alias("_chosen"), F.count(F.lit(1)).alias("n"))
    special = stored(pairs.where("not _chosen or n > 1").select("_id", "_text", "_chosen"), "special")
    docs = carried(documents, "doc_id", "text").withColumn("_text_id", F.xxhash64(F.col("text").cast("string")))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("_id")) & (F.col("_text_id") == F.col("_text"))
    kept = docs.join(maybe_broadcast(special, MAX_HEADS), same, "left")
    out = kept.where("_chosen is null")
    if not special.where("_chosen").isEmpty():
        out = out.unionByName(kept.where("_chosen").dropDuplicates(["doc_id", "_text_id"]))
    return restored(out, documents)
