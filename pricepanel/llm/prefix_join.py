"""Jaccard links of word n-gram sets by a grouped prefix join.

A document is the set of its distinct shingles (a text of fewer words is one
shingle). All sets are put in one order, rare shingles first. Two sets of sizes
s <= l reach the rule only if they share ``need = ceil(P (s + l) / (100 + P))``
elements, so the first ``s - need + 1`` of one and the first ``l - need + 1`` of
the other have an element in common. That bounds a set's probing prefix
(``n - ceil(P n / 100) + 1``) and its shorter index prefix, used when it is the
smaller of a pair.

1. Order. Tasks count shingles into a sketch, added up by Spark over all
   documents; the levels (log2 of the counts) are broadcast, one byte a counter.
   The sketch has a counter for every ``TEXT_A_SLOT`` bytes of text, ``SLOTS[1]`` at
   most (32 MB). Any order gives the same links; a finer one gives shorter lists.
2. Groups. Equal sets are one class; classes of equal size and identical prefix
   (by 64-bit digest) are one group, and only groups enter the lists.
3. Group pairs. Groups that share an element meet in its list, filtered by their
   sizes and by the places of the element, then by their whole prefixes: up to the
   place where the shorter prefix ends, the common elements are known, beyond it
   at most the smaller rest is common. First a group meets only the likeliest
   centre of its lists, the group that stands in most lists, and its members the
   head of their own group: linear. Then components are formed, and only what they
   leave apart is paired: in lists of up to ``LIST`` members the groups outside
   the commonest component with the others of fitting size; in longer lists, all
   of whose members are compared with the centre, the members that share an
   element outside the centre's set or could be linked without one
   (``superminhash.pairs_around``). So a long list costs about its length, not its square,
   and no link is lost.
4. Expansion. Group pairs become pairs of member classes in different components,
   compared on full sets.

Links satisfy ``100 * common >= percent * union`` on sets of 64-bit hashes.

Null and empty texts have no set and link with nothing (n_shingles 0). Repeated
rows and ties fall into one class; a null id counts as an id above all others.
Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricepanel.llm import arrowtext as T
from pricepanel.llm.components import components
from pricepanel.llm.pairs import with_both
from pricepanel.llm.superminhash import _labelled, _merged, compared, pairs_around, sets_of
from pricepanel.llm.tables import finished, stored
from pricepanel.operators.joins import maybe_broadcast
from pricepanel.session import ship_package

SHINGLE = 3
PERCENT = 90
#: Bytes of text a counter of the sketch, and its least and most counters (powers of two; 4 bytes each in a task).
TEXT_A_SLOT = 64
SLOTS = 1 << 16, 1 << 25
#: Counters that a task sends as one value.
BLOCK = 1 << 16
#: Rows of two numbers that are broadcast to the texts instead of moving these.
MAX_HEADS = 4_000_000
#: Members of a list that are paired directly.
LIST = 32
#: Rounds in which every class meets its likeliest partner and some drawn ones only, before all pairs left are compared.
ROUNDS = 1
#: Other members that a member around a centre meets in a round, and the members among which they are drawn.
DRAWN, POOL = 16, 256


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n + (-percent * n) // 100 + 1


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for part in T.slices(batch, "text"):
            raw, offsets = T.utf8(part.column("text"))
            yield part, *sets_of(T.LOWER[raw], offsets, size)


def _slot(keys: np.ndarray, slots: int) -> np.ndarray:
    return (keys & np.uint64(slots - 1)).astype(np.int64)


def _counted(size: int, slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(slots, np.uint32)
        for _, keys, _ in _sets(batches, size):
            np.add.at(counts, _slot(keys, slots), np.uint32(1))
        # byte by byte, so that the many zero bytes of small counts lie together and compress
        yield from _blocks((i, counts[i:i + BLOCK].view(np.uint8).reshape(-1, 4).T) for i in range(0, slots, BLOCK) if counts[i:i + BLOCK].any())
    return run


def _blocks(blocks) -> Iterator[pa.RecordBatch]:
    for at, values in blocks:
        packed = zlib.compress(values.tobytes(), 1)
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([packed], pa.binary())], ["block", "counters"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """log2 of the added counters of every block; blocks stream in, one array a block is held."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for at, counters in zip(batch.column("block").to_pylist(), batch.column("counters")):
            planes = np.frombuffer(zlib.decompress(counters.as_buffer()), np.uint8).reshape(4, -1)
            counts = np.ascontiguousarray(planes.T).view(np.uint32).ravel().astype(np.uint64)
            sums[at] = sums[at] + counts if at in sums else counts
    yield from _blocks((at, np.log2(np.maximum(s, 1)).astype(np.uint8)) for at, s in sums.items())


def levels(docs: DataFrame, size: int, slots: int) -> np.ndarray:
    """log2 of the summed counts, one byte a counter."""
    partial = docs.select("text").mapInArrow(_counted(size, slots), "block int, counters binary")
    summed = partial.repartition("block").mapInArrow(_summed, "block int, counters binary")
    out = np.zeros(slots, np.uint8)
    for r in summed.collect():  # ``slots`` bytes, compressed
        block = np.frombuffer(zlib.decompress(r.counters), np.uint8)
        out[r.block:r.block + len(block)] = block
    return out


def sketch_size(docs: DataFrame) -> int:
    """Counters of the sketch for the texts of ``docs``."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(max(SLOTS[0], 1 << (size // TEXT_A_SLOT).bit_length()), SLOTS[1])


def _ids(keys: np.ndarray, offsets: np.ndarray) -> list[str | None]:
    return [hashlib.blake2b(keys[s:e].tobytes(), digest_size=16).hexdigest() if e > s else None
            for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def _number(prefix: np.ndarray, n: int) -> int:
    """The 64-bit digest of a prefix and the size of its set."""
    return int.from_bytes(hashlib.blake2b(prefix.tobytes(), digest_size=8, salt=n.to_bytes(8, "little")).digest(), "little", signed=True)


def _described(size: int, percent: int, order):
    """Per row: size and digest of the set, its prefix and the digest of prefix and size.

    An element of a prefix is its level, then 56 bits of its hash, so that the
    common order is the order of the numbers; two shingles that meet in them only
    loosen the filters, full sets decide.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = order.value
        for part, keys, offsets in _sets(batches, size):
            counts = np.diff(offsets)
            owner = np.repeat(np.arange(len(counts)), counts)
            ranked = np.lexsort((keys, level[_slot(keys, len(level))], owner))  # keys: the high bits first
            place = np.arange(len(keys)) - np.repeat(offsets[:-1], counts)
            first = place < np.repeat(prefix_length(counts, percent), counts)
            chosen = keys[ranked][first]
            prefix = level[_slot(chosen, len(level))].astype(np.uint64) << np.uint64(56) | chosen >> np.uint64(8)
            ends = np.concatenate(([0], np.cumsum(np.where(counts > 0, prefix_length(counts, percent), 0))))
            groups = [_number(prefix[s:e], n) if n else None for s, e, n in zip(ends[:-1].tolist(), ends[1:].tolist(), counts.tolist())]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_id"), pa.array(counts, pa.int64()), pa.array(_ids(keys, offsets), pa.string()),
                 pa.array(groups, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(prefix.view(np.int64)))],
                ["doc_id", "text_id", "n_shingles", "set_id", "group_id", "prefix"])
    return run


def _members(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, keys, offsets in _sets(batches, size):
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(_ids(keys, offsets), pa.string()), lists], ["set_id", "members"])
    return run


def _need(s: str, l: str, percent: int) -> str:
    """Least overlap of linked sets of sizes s and l."""
    return f"(({percent} * ({s} + {l}) + {99 + percent}) div {100 + percent})"


def _reaches(a: str, b: str, percent: int) -> str:
    """Sizes n and places pos of a common element leave room for the overlap of a link."""
    need = _need(f"{a}.n", f"{b}.n", percent)
    return f"{a}.pos <= {a}.n - {need} + 1 and {b}.pos <= {b}.n - {need} + 1"


def _compared(pairs: DataFrame, docs: DataFrame, classes: DataFrame, shingle: int) -> DataFrame:
    """``superminhash.compared`` of pairs (a, b, around) of classes, by their full sets (made again from the texts)."""
    pairs = stored(pairs.where("a <> b").groupBy("a", "b").agg(F.max("around").alias("around")), "pairs")
    wanted = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
    heads = stored(wanted.join(classes.select("set_id", "first"), "set_id").select(
        F.col("first.doc_id").alias("_id"), F.col("first.text_id").alias("_text")).distinct(), "wanted")
    found = docs.join(maybe_broadcast(heads, MAX_HEADS), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_id") == F.col("_text")), "left_semi")
    sets = stored(found.select("text").mapInArrow(_members(shingle), "set_id string, members array<bigint>"), "sets")
    ids = sets.groupBy("set_id").agg(F.count(F.lit(1)).alias("n"))
    if not ids.where("n > 1").isEmpty():  # one (doc_id, text) in several rows
        sets = stored(sets.dropDuplicates(["set_id"]), "sets")
    out = stored(compared(pairs, sets), "compared")
    finished(sets)
    return out


def _linked(found: DataFrame, percent: int) -> DataFrame:
    return found.where(f"{100 + percent} * common >= {percent} * (na + nb)").select("a", "b")


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that are linked."""
    return _linked(_compared(pairs.select("a", "b", F.lit(False).alias("around")), docs, classes, shingle), percent)


def _may_link(pairs: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """The pairs (ga, gb) of groups whose whole prefixes leave room for the overlap of a link, with that room."""
    both = with_both(pairs, groups, "group_id", "n", "prefix", a="gb", b="ga")
    both = both.withColumn("until", F.least(F.element_at("prefix_ga", -1), F.element_at("prefix_gb", -1)))

    def rest(side: str):
        return F.col(f"n_{side}") - F.size(F.filter(f"prefix_{side}", lambda x: x <= F.col("until")))

    need = F.expr(_need("n_ga", "n_gb", percent))
    both = both.withColumn("reach", F.size(F.array_intersect("prefix_ga", "prefix_gb")) + F.least(rest("ga"), rest("gb")))
    return both.where(F.col("reach") >= need).select(*pairs.columns, (F.col("reach") / need).alias("odds"))


def _posts(groups: DataFrame, percent: int) -> DataFrame:
    """(element, m, group_id, n, pos, indexed): the lists that hold two members (m) or more, one of them indexed."""
    last = F.expr(f"n - {_need('n', 'n', percent)} + 1")  # places up to here are indexed
    entries = groups.select("group_id", "members", last.alias("last"), F.posexplode("prefix").alias("pos", "element"))
    shared = entries.groupBy("element").agg(F.sum("members").alias("m"), F.max(F.col("pos") < F.col("last")).alias("ix"))
    shared = stored(shared.where("m > 1 and ix").select("element", "m"), "elements")
    listed = entries.select("element", "group_id", (F.col("pos") + 1).alias("pos")).join(shared, "element")
    posts = listed.join(groups.select("group_id", "n", last.alias("last")), "group_id").withColumn("indexed", F.col("pos") <= F.col("last"))
    return stored(posts.drop("last"), "posts")


def _star(posts: DataFrame, groups: DataFrame, classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of classes (a, b, around): members with the head of their group, with the head of their likeliest
    centre and, marked ``around``, with the heads of all centres of longer lists; and the group pairs
    (ga, gb, odds) of all groups with their centres that may hold a link."""
    weights = stored(posts.groupBy("group_id").agg(F.count(F.lit(1)).alias("weight")), "weights")
    weighed = posts.join(weights, "group_id")
    centres = stored(weighed.groupBy("element").agg(F.max(F.struct("weight", "group_id", "n", "pos")).alias("c")), "centres")
    near = posts.alias("g").join(centres.select("element", "c.*").alias("c"), "element")
    near = near.where(F.expr(f"c.group_id <> g.group_id and {_reaches('c', 'g', percent)}"))
    near = near.select(F.col("g.group_id").alias("ga"), F.col("c.group_id").alias("gb"), F.col("c.weight").alias("weight")).distinct()
    near = stored(_may_link(stored(near, "near"), groups, percent), "near")
    best = near.groupBy("ga").agg(F.max(F.struct("weight", "gb")).alias("c"))
    heads = groups.select(F.col("group_id").alias("centre"), F.col("head").alias("a"))
    of_centre = best.select(F.col("ga").alias("group_id"), F.col("c.gb").alias("centre")).join(heads, "centre").select("group_id", "a")
    of_group = groups.where("members > 1").select("group_id", F.col("head").alias("a"))
    long = posts.where(F.col("m") > LIST).join(centres.select("element", F.col("c.group_id").alias("centre")), "element")
    of_long = long.select("group_id", "centre").distinct().join(heads, "centre").select("group_id", "a", F.lit(True).alias("around"))
    met = of_centre.unionByName(of_group).withColumn("around", F.lit(False)).unionByName(of_long)
    met = stored(met.groupBy("group_id", "a").agg(F.max("around").alias("around")), "met")
    pairs = met.join(classes.select("group_id", F.col("set_id").alias("b")), "group_id").select("a", "b", "around")
    return pairs, near.select(F.least("ga", "gb").alias("ga"), F.greatest("ga", "gb").alias("gb"), "odds").distinct()


def _rest(posts: DataFrame, near: DataFrame, groups: DataFrame, classes: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes in different components whose groups may hold a link, from lists and groups of up to ``LIST`` members.

    Lists of two groups hold the pair with their centre only, which is in ``near``.
    """
    named = classes.select("set_id", "group_id").join(labels.withColumnRenamed("node", "set_id"), "set_id", "left")
    named = stored(named.select("set_id", "group_id", F.coalesce("label", "set_id").alias("label")), "named")
    ranges = stored(named.groupBy("group_id").agg(F.min("label").alias("lo"), F.max("label").alias("hi")), "ranges")
    lists = posts.where(F.col("m").between(3, LIST)).join(ranges, "group_id").withColumn("label", F.expr("case when lo = hi then lo end"))
    lists = stored(lists, "lists")
    several = lists.groupBy("element").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo < hi").select("element")
    several = stored(several, "several")
    lists = stored(lists.select("element", "group_id", "n", "pos", "indexed", "label").join(several, "element"), "open-lists")
    counts = lists.where("label is not null").groupBy("element", "label").agg(F.count(F.lit(1)).alias("n"))
    most = counts.groupBy("element").agg(F.max(F.struct("n", "label")).alias("most")).select("element", F.col("most.label").alias("most"))
    outside = lists.join(stored(most, "commonest"), "element", "left").where("label is null or most is null or label <> most").drop("most")

    size_class = "cast(floor(ln({}) * 50) as int)"  # sizes within 2 %; the bounds below are exact
    room = f"cast(floor((n - pos + 1) * {100 + percent} / {percent}) as bigint) - n"
    as_longer = outside.withColumn("lo", F.expr(f"cast(ceil({percent} * n / 100) as bigint)")).withColumn("hi", F.expr(f"least(n, {room})"))
    as_shorter = outside.where("indexed").withColumn("lo", F.col("n")).withColumn("hi", F.expr(f"least(cast(floor(100 * n / {percent}) as bigint), {room})"))

    def met(side: DataFrame, others: DataFrame, sizes: str) -> DataFrame:
        side = side.where("lo <= hi").withColumn("class", F.explode(F.expr(f"sequence({size_class.format('lo')}, {size_class.format('hi')})")))
        others = others.withColumn("class", F.expr(size_class.format("n")))
        pairs = side.alias("x").join(others.alias("y"), ["element", "class"]).where(F.expr(
            f"x.group_id <> y.group_id and {sizes} and coalesce(x.label <> y.label, true) and {_reaches('x', 'y', percent)}"))
        return pairs.select(F.least("x.group_id", "y.group_id").alias("ga"), F.greatest("x.group_id", "y.group_id").alias("gb"))

    pairs = met(as_longer, lists.where("indexed"), "y.n <= x.n").union(met(as_shorter, lists, "y.n >= x.n")).distinct()
    pairs = stored(_may_link(stored(pairs, "group-pairs"), groups, percent).union(near).distinct(), "group-pairs")
    one = named.select(F.col("group_id").alias("ga"), F.col("set_id").alias("a"), F.col("label").alias("la"))
    other = named.select(F.col("group_id").alias("gb"), F.col("set_id").alias("b"), F.col("label").alias("lb"))
    across = pairs.join(one, "ga").join(other, "gb").where("la <> lb").select("a", "b", "odds")
    # Inside a group of several components: its members outside the commonest one with all others.
    small = groups.where(F.col("members") <= LIST).select("group_id")
    mixed = named.join(ranges.where("lo < hi").select("group_id").join(small, "group_id"), "group_id")
    most = mixed.groupBy("group_id", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("group_id").agg(F.max(F.struct("n", "label")).alias("most"))
    few = mixed.join(most, "group_id").where(F.col("label") != F.col("most.label"))
    inside = few.alias("x").join(mixed.alias("y"), "group_id").where("x.label <> y.label").select(F.col("x.set_id").alias("a"), F.col("y.set_id").alias("b"), F.lit(2.0))
    return across.union(inside).groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("odds").alias("odds"))


def _still_apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    for side in ("a", "b"):
        pairs = pairs.join(labels.select(F.col("node").alias(side), F.col("label").alias("label_" + side)), side, "left")
    apart = F.coalesce("label_a", "a") != F.coalesce("label_b", "b")
    return pairs.where(apart).select("a", "b", "odds")


def _likeliest(pairs: DataFrame) -> DataFrame:
    """For every class the pair with its likeliest partner."""
    ends = pairs.select("odds", "a", "b").union(pairs.select("odds", "b", "a"))
    best = ends.groupBy("a").agg(F.max(F.struct("odds", "b")).alias("best"))
    return best.select(F.least("a", "best.b").alias("a"), F.greatest("a", "best.b").alias("b")).distinct()


def _passing(pairs: DataFrame, classes: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose groups' prefixes leave room for a link."""
    for side in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("set_id").alias(side), F.col("group_id").alias("g" + side)), side)
    pairs = stored(pairs, "pairs")
    same = pairs.where("ga = gb").select("a", "b")
    apart = pairs.where("ga <> gb").select("ga", "gb").distinct()
    return pairs.join(_may_link(apart, groups, percent), ["ga", "gb"]).select("a", "b").unionByName(same)


def _drawn(around: DataFrame, labels: DataFrame, seed: int) -> DataFrame:
    """Pairs of members in different components around one centre, ``DRAWN`` a member, drawn by hash.

    A centre's members are dealt to pools of about ``POOL`` by hash, so that a
    large group is not one task.
    """
    named = around.select(F.col("a").alias("centre"), F.col("b").alias("x")).join(labels.withColumnRenamed("node", "x"), "x", "left")
    named = named.select("centre", "x", F.coalesce("label", "x").alias("label"))
    open_ = named.groupBy("centre").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo < hi")
    drawn = F.xxhash64(F.lit(seed), "x")
    dealt = named.join(open_.select("centre", "n"), "centre").withColumn("pool", F.pmod(drawn, F.ceil(F.col("n") / POOL)))
    order = Window.partitionBy("centre", "pool").orderBy(F.xxhash64(F.lit(seed + 1000), "x"), "x")
    member = F.struct("x", "label").alias("member")
    others = F.array(*[F.lead("member", i).over(order) for i in range(1, DRAWN + 1)])
    pairs = dealt.withColumn("member", member).select("x", "label", others.alias("others")).select("x", "label", F.explode("others").alias("y"))
    pairs = pairs.where(F.col("y").isNotNull() & (F.col("y.label") != F.col("label")))
    return pairs.select(F.least("x", "y.x").alias("a"), F.greatest("x", "y.x").alias("b")).distinct()


def groups(documents: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, slots: int | None = None) -> DataFrame:
    """(doc_id, text_id, n_shingles, set_id, component_id, chosen) per document row.

    ``component_id`` is the least doc_id reachable by links, the row's own
    without a set; ``text_id`` digests the text; ``chosen`` is true for the rows
    of exactly one (doc_id, text_id) of each component.
    """
    spark: SparkSession = documents.sparkSession
    ship_package(spark)
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("text_id", F.xxhash64("text"))
    order = spark.sparkContext.broadcast(levels(docs, shingle, slots or sketch_size(docs)))
    described = stored(docs.mapInArrow(_described(shingle, percent, order), "doc_id bigint, text_id bigint, n_shingles bigint, "
                                       "set_id string, group_id bigint, prefix array<bigint>"), "described")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_id")).alias("first")
    classes = stored(described.where("n_shingles > 0").groupBy("set_id", F.col("n_shingles").alias("n"), "group_id")
                     .agg(first, F.first("prefix").alias("prefix")), "classes")
    grouped = stored(classes.groupBy("group_id", "n").agg(F.min("set_id").alias("head"), F.count(F.lit(1)).alias("members"),
                                                          F.first("prefix").alias("prefix")), "groups")
    posts = _posts(grouped, percent)
    met, near = _star(posts, grouped, classes, percent)
    star = _compared(met, docs, classes, shingle)
    labels = components(_linked(star, percent))
    done = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = stored(_rest(posts, near, grouped, classes, labels, percent).join(done, ["a", "b"], "left_anti"), "candidates")
    around = stored(star.where("around"), "around")
    finished(posts, star)
    for round_ in range(ROUNDS + 1):  # the last round compares all pairs that are left
        last = round_ == ROUNDS
        tried = pairs.select("a", "b") if last else stored(_likeliest(pairs), "likeliest")
        if not around.isEmpty():
            drawn = pairs_around(around, labels, percent) if last else _drawn(around, labels, round_)
            tried = stored(tried.unionByName(_passing(drawn, classes, grouped, percent)), "tried")
        more = _verified(tried, docs, classes, shingle, percent)
        if not more.isEmpty():
            labels = _merged(labels, more)
        if not last:  # pairs inside a component need no comparison any more
            pairs = stored(_still_apart(pairs.join(tried, ["a", "b"], "left_anti"), labels), "candidates")
    return _labelled(described.drop("group_id", "prefix").withColumn("bands", F.lit(None)), classes, labels)
