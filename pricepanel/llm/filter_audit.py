"""How filters interact, from one relation of failing ids per filter.

``relations`` writes for every filter the table of the ids that fail it. What a
prefix of an order removes does not depend on the order inside the prefix, so
the prefixes of all orders are the subsets of the filters:

- survivors: the ids that survive a subset, left-anti joined with a further
  filter's relation, survive the subset with that filter, so five joins list the
  survivors of all subsets;
- removed by the next filter: the survivors, left-semi joined with its relation;
- redundant: what else the relation holds (failing, removed earlier);
- failing one filter only: removed by it after all others.

Only ids, counts and labels travel through the joins, never texts. Ids are
distinct (repeated rows are counted into one id first), so an id is met once per
subset at most and no join key is hot; counts per part combine map-side. Every
survivor table is written before the next join reads it, so a lost executor
repeats one join.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricepanel.llm.tables import stored

SPACES = " \t\n\x0b\f\r"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Pieces of a text that many documents share, so that one task never holds all of its copies.
SALTS = 64


def text_rules(text: Column) -> dict[str, Column]:
    """Failure conditions A-D of a text that is not null."""
    trimmed = F.btrim(text, F.lit(SPACES))
    words = F.split(trimmed, r"[\x20\x09-\x0D]+")
    n_words = F.when(trimmed == "", 0).otherwise(F.size(words))
    n_distinct = F.when(trimmed == "", 0).otherwise(F.size(F.array_distinct(words)))
    capitals = F.char_length(text) - F.char_length(F.translate(text, LETTERS, ""))
    return {"A": n_words < 50,
            "B": 100 * n_distinct.cast("bigint") < 65 * n_words.cast("bigint"),
            "C": 100 * capitals.cast("bigint") > 5 * F.char_length(text).cast("bigint"),
            "D": text.rlike("[#$%&*|]")}


def units(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per distinct (doc_id, text, source): id, part, doc_id, digest, fails A-D, n rows, good, toxic.

    A null text reads as empty, a null source as the part ''. ``good`` and
    ``toxic`` are the rows with a label row quality = 1 / toxic = 1 for their
    doc_id (several label rows: any of them); a null doc_id has no label.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"),
                            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"))
    measured = docs.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"),
                           *[c.alias(k) for k, c in text_rules(F.col("text")).items()])
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.hex("digest"), "part")
    counted = measured.groupBy("doc_id", "part", "digest", "A", "B", "C", "D").agg(F.count(F.lit(1)).alias("n"))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("is_good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("is_toxic"))
    joined = stored(counted, "audit-rows").join(stored(known, "audit-labels"), "doc_id", "left")
    return joined.select(F.unhex(F.md5(key)).alias("id"), "part", "doc_id", "digest", "A", "B", "C", "D", "n",
                         F.when(F.col("is_good"), F.col("n")).otherwise(0).alias("good"),
                         F.when(F.col("is_toxic"), F.col("n")).otherwise(0).alias("toxic"))


def copies(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """E: the ids whose text a smaller doc_id has too, anywhere in the table.

    Least ids are combined map-side; rows meet the least id of their text in
    ``salts`` pieces. A null doc_id is neither smaller nor larger than another.
    """
    first = rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    several = first.where("first < last").select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    dealt = rows.select("id", "digest", "doc_id", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("salt"))
    return dealt.join(several, ["digest", "salt"]).where("doc_id > first").select("id")


def relations(rows: DataFrame) -> dict[str, DataFrame]:
    """The failing-id table of every filter A-E."""
    tables = {k: rows.where(F.col(k)).select("id") for k in "ABCD"} | {"E": copies(rows)}
    return {k: stored(t, f"failing-{k}") for k, t in tables.items()}


def prefix_counts(rows: DataFrame, failing: dict[str, DataFrame]) -> DataFrame:
    """(part, mask, filter, n, good, toxic) for the subsets of the filters.

    ``rows`` has id, part, n, good, toxic. ``mask`` has bit i set for the i-th
    filter of ``failing``. Rows with a null filter hold what is left after the
    subset, the others what that filter removes after it. Ids in no relation
    survive every subset and are counted once; the others are listed once per
    subset that they survive, half of all subsets at most.
    """
    names, measures = list(failing), ("n", "good", "toxic")
    rows = rows.select("id", "part", *measures)
    any_filter = reduce(DataFrame.union, failing.values())
    mask = F.col("mask")

    def counted(found: DataFrame, name: str | None, *keys: str) -> DataFrame:
        return found.groupBy("part", *keys).agg(*[F.sum(c).alias(c) for c in measures]).withColumn("filter", F.lit(name).cast("string"))

    clean = counted(rows.join(any_filter, "id", "left_anti"), None)
    clean = clean.withColumn("mask", F.explode(F.sequence(F.lit(0), F.lit((1 << len(names)) - 1))))
    left = stored(rows.join(any_filter, "id", "left_semi").withColumn("mask", F.lit(0)), "survivors")
    for i, k in enumerate(names):
        passed = left.join(failing[k], "id", "left_anti").withColumn("mask", mask + (1 << i))
        left = stored(left.unionByName(passed), "survivors")
    removed = [counted(left.where(mask.bitwiseAND(1 << i) == 0).join(failing[k], "id", "left_semi"), k, "mask") for i, k in enumerate(names)]
    return stored(reduce(DataFrame.unionByName, [*removed, counted(left, None, "mask"), clean]), "prefix-counts")


def interactions(counts: DataFrame, parts: DataFrame, names: str) -> DataFrame:
    """One row, zeros included, per part, order of ``names`` and step.

    ``counts`` as of ``prefix_counts``; ``parts`` lists the parts. Columns:
    part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley (the filter's removed, summed over all orders).
    """
    spark = counts.sparkSession
    bit = {k: 1 << i for i, k in enumerate(names)}
    full = (1 << len(names)) - 1
    measures = ("n", "good", "toxic")
    cells = [(m, k) for m in range(full + 1) for k in [None, *(k for k in names if not m & bit[k])]]
    zeros = parts.select("part", F.inline(F.array(*[
        F.struct(F.lit(m).alias("mask"), F.lit(k).cast("string").alias("filter")) for m, k in cells])))
    zeros = zeros.select("*", *[F.lit(0).cast("bigint").alias(c) for c in measures])
    totals = stored(counts.unionByName(zeros).groupBy("part", "mask", "filter").agg(*[F.sum(c).alias(c) for c in measures]), "totals")
    steps = [("".join(p), i + 1, p[i], sum(bit[k] for k in p[:i])) for p in permutations(names) for i in range(len(p))]
    steps = spark.createDataFrame([(o, s, k, m, m | bit[k], full & ~bit[k]) for o, s, k, m in steps],
                                  "filter_order string, step int, filter string, mask int, after int, others int")
    removed = totals.where("filter is not null").select("part", "mask", "filter", F.col("n").alias("removed"),
                                                        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"))
    kept = totals.where("filter is null").select("part", F.col("mask").alias("after"), F.col("n").alias("kept"))
    failing = removed.where("mask = 0").select("part", "filter", F.col("removed").alias("failing"))
    alone = removed.select("part", F.col("mask").alias("others"), "filter", F.col("removed").alias("unique_fails"))
    rows = (removed.join(F.broadcast(steps), ["mask", "filter"]).join(kept, ["part", "after"])  # steps: 5 rows an order
            .join(failing, ["part", "filter"]).join(alone, ["part", "filter", "others"]))
    every = rows.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    return rows.join(every, ["part", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", (F.col("failing") - F.col("removed")).alias("redundant"),
        "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The interactions of filters A-E over ``documents``, per part (source).

    Nulls, repeated rows and repeated labels as in ``units`` and ``copies``. An
    empty table has no part and gives no row. Only doc_id, text and source of
    the documents and doc_id, quality, toxic of the labels are read, so further
    columns of any name do no harm.
    """
    rows = stored(units(documents, labels), "audit-units")
    failing = relations(rows)
    counts = prefix_counts(rows, failing)
    return interactions(counts, rows.select("part").distinct(), "".join(failing))


def oracle_sql(names: str = "ABCDE") -> str:
    """The same rows from one bit pattern per document and sums over the patterns."""
    words = "list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
    cells = []
    for p in permutations(names):
        for i, k in enumerate(p):
            before = reduce(or_, [1 << names.index(x) for x in p[:i]], 0)
            cells.append(f"('{''.join(p)}', {i + 1}, {1 << names.index(k)}, {before})")
    full = (1 << len(names)) - 1
    return f"""
with d as (select doc_id, coalesce(source, '') part, coalesce(text, '') t from documents),
f as (select doc_id, part, t, {words} w, min(doc_id) over (partition by t) first from d),
g as (select doc_id, part,
        (len(w) < 50)::int + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::int
        + 4 * (100 * (length(t) - length(translate(t, '{LETTERS}', ''))) > 5 * length(t))::int
        + 8 * regexp_matches(t, '[#$%&*|]')::int + 16 * coalesce(doc_id > first, false)::int pattern from f),
l as (select doc_id, max((coalesce(quality, 0) = 1)::int) good, max((coalesce(toxic, 0) = 1)::int) toxic from labels group by doc_id),
p as (select part, pattern, count(*) n, sum(coalesce(good, 0)) good, sum(coalesce(toxic, 0)) toxic from g left join l using (doc_id) group by part, pattern),
s(filter_order, step, bit, before) as (values {', '.join(cells)}),
r as (select part, filter_order, step, bit,
        coalesce(sum(n) filter (pattern & (before | bit) = 0), 0) kept,
        coalesce(sum(n) filter (pattern & bit <> 0 and pattern & before = 0), 0) removed,
        coalesce(sum(n) filter (pattern & bit <> 0 and pattern & before <> 0), 0) redundant,
        coalesce(sum(n) filter (pattern & {full} = bit), 0) unique_fails,
        coalesce(sum(good) filter (pattern & bit <> 0 and pattern & before = 0), 0) good_lost,
        coalesce(sum(toxic) filter (pattern & bit <> 0 and pattern & before = 0), 0) toxic_lost
      from p, s group by part, filter_order, step, bit)
select part, filter_order, step::int step, kept::bigint kept, removed::bigint removed, redundant::bigint redundant, unique_fails::bigint unique_fails,
       good_lost::bigint good_lost, toxic_lost::bigint toxic_lost, (sum(removed) over (partition by part, bit))::bigint shapley from r
"""
