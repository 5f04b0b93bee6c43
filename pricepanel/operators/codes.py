"""Region-code operators.

The code table is a dimension (one row per legal-dong / ri code), so these
plans are small; they still run as distributed aggregates and joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricepanel.functions import normalize as N
from pricepanel.functions.pnu import code_parts
from pricepanel.operators.joins import DEFAULT_BROADCAST_ROWS, maybe_broadcast
from pricepanel.session import work_dir


def with_code_parts(codes: DataFrame) -> DataFrame:
    return codes.select("*", *code_parts("code"))


def drop_parents_with_ri(pool: DataFrame) -> DataFrame:
    """Drop dong rows (ri = '00') whose 8-char prefix has ri children."""
    with_ri = pool.where(F.col("ri") != "00").select("prefix8").distinct()
    dongs = pool.where(F.col("ri") == "00").join(with_ri, "prefix8", "left_anti")
    return pool.where(F.col("ri") != "00").unionByName(dongs)


# Lengths of a province, a district and a legal-dong code, longest first.
CODE_LENGTHS = (10, 5, 2)


def leaf_codes(codes: DataFrame, include_abolished: bool = True) -> DataFrame:
    """Codes parcels attach to.

    Pool = codes below sgg level (emd != '000'); with
    ``include_abolished=False`` abolished codes leave the pool *before* the
    child test, so a dong whose ri are all abolished becomes a leaf.
    """
    pool = with_code_parts(codes).where(F.col("emd") != "000")
    if not include_abolished:
        pool = pool.where(~F.col("abolished"))
    return drop_parents_with_ri(pool)


def codes_by_sgg(leaves: DataFrame) -> DataFrame:
    """A10: leaf codes grouped by sgg (count + sorted list as text).

    A group is one district's codes (bounded by the 5-digit code space).
    """
    return leaves.groupBy("sgg").agg(
        F.count(F.lit(1)).alias("n_codes"),
        F.array_join(F.sort_array(F.collect_list("code")), ",").alias("codes"))


def prefixes_by_sgg(leaves: DataFrame) -> DataFrame:
    """Distinct sorted 8-character query prefixes by sgg."""
    return leaves.groupBy("sgg").agg(
        F.count_distinct("prefix8").alias("n_prefixes"),
        F.array_join(F.sort_array(F.collect_set("prefix8")), ",").alias("prefixes"))


def crosswalk(df: DataFrame, mapping: DataFrame, col: str = "pnu",
              max_mapping_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Longest-prefix code crosswalk (old -> current region codes).

    ``mapping(old, new)`` holds 10-, 5- or 2-character prefixes of equal
    old/new length. Three equi-joins (one per prefix length, each side a
    small dimension) and a ``coalesce`` keep the longest match; parcels
    without a match keep their code. Adds ``<col>_current``. The mapping
    is broadcast after a size check (``max_mapping_rows``; None = leave
    the choice to AQE).
    """
    if max_mapping_rows is not None:
        mapping = maybe_broadcast(mapping, max_mapping_rows)
    out = df
    picks = []
    for n in (10, 5, 2):
        m = (mapping.where(F.length("old") == n)
             .select(F.col("old").alias(f"_old{n}"), F.col("new").alias(f"_new{n}")))
        out = out.join(m, F.substring(F.col(col), 1, n) == F.col(f"_old{n}"), "left")
        picks.append(F.when(F.col(f"_new{n}").isNotNull(),
                            F.concat(F.col(f"_new{n}"), F.substring(F.col(col), n + 1, 1 << 20))))
    out = out.withColumn(f"{col}_current", F.coalesce(*picks, F.col(col)))
    return out.drop(*[f"_{k}{n}" for n in (10, 5, 2) for k in ("old", "new")])


def _written(df: DataFrame) -> DataFrame:
    """A round's rules, written in the shared folder and read back."""
    path = f"{work_dir(df.sparkSession, 'code-rules')}/data"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class CodeConflict(ValueError):
    """A table of code changes that no code history can have."""


def _check_changes(changes: DataFrame) -> DataFrame:
    """Distinct changes; wrong lengths and codes with several successors are refused."""
    c = changes.select(N.strip("old").alias("old"), N.strip("new").alias("new")).distinct()
    bad = c.where(~F.coalesce((F.length("old") == F.length("new")) & F.length("old").isin(*CODE_LENGTHS), F.lit(False)))
    split = c.groupBy("old").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    told = [f"{r.old}->{r.new} (lengths)" for r in bad.orderBy("old", "new").limit(5).collect()]
    told += [f"{r.old} (several successors)" for r in split.orderBy("old").limit(5).collect()]
    if told:
        raise CodeConflict("code changes refused: " + ", ".join(told))
    return c


def _longest_rule(rows: DataFrame, col: str, rules: DataFrame, out: str) -> DataFrame:
    """Adds ``out``, the rule (old, new) of the longest old code that ``col`` starts with."""
    picks = []
    for n in CODE_LENGTHS:
        rule = rules.where(F.length("old") == n).select(F.col("old").alias(f"_o{n}"), F.struct("old", "new").alias(f"_r{n}"))
        rows = rows.join(rule, (F.length(col) >= n) & (F.substring(col, 1, n) == F.col(f"_o{n}")), "left").drop(f"_o{n}")
        picks.append(F.col(f"_r{n}"))
    return rows.withColumn(out, F.coalesce(*picks)).drop(*[f"_r{n}" for n in CODE_LENGTHS])


def code_succession(changes: DataFrame) -> DataFrame:
    """(old, new) with the code that every old code, or part of it, has in the end.

    ``changes(old, new)`` lists single steps between codes of 2, 5 or 10
    characters. A step may start where another one ended: a code renamed twice, a
    province renamed after one of its districts, or a district renamed after its
    province was (then the district's first code gets a rule of its own). Merges
    are several codes with one successor; a split is told by its 10-character
    parts. Steps are composed by pointer jumping (every round doubles the steps
    that a rule has gone), so the rounds follow the logarithm of the longest
    chain. Codes with several successors, steps between codes of different
    lengths and cycles are refused (``CodeConflict``). Use the result as the
    mapping of ``crosswalk``.
    """
    rules = _written(_check_changes(changes).where("old <> new"))
    first, rounds = rules, 2
    n = rules.count()
    while (1 << (rounds - 2)) <= n:
        rounds += 1
    for _ in range(rounds):
        jumped = _longest_rule(rules, "new", rules, "next")
        jumped = jumped.select("old", F.coalesce(F.concat("next.new", F.expr("substring(new, length(next.old) + 1)")), "new").alias("new"))
        # parts of a renamed code that were renamed later: old part -> later name
        later = rules.select(F.col("old").alias("b_old"), F.col("new").alias("b_new"))
        parts = None
        for n_long in CODE_LENGTHS:
            for n_short in (m for m in CODE_LENGTHS if m < n_long):
                whole = rules.where(F.length("new") == n_short)
                found = whole.join(later.where(F.length("b_old") == n_long), F.col("new") == F.substring("b_old", 1, n_short))
                found = found.select(F.concat("old", F.expr(f"substring(b_old, {n_short + 1})")).alias("part"), F.col("old").alias("by"),
                                     F.col("b_new").alias("part_new"))
                parts = found if parts is None else parts.unionByName(found)
        own = _longest_rule(parts, "part", rules, "own").where(F.col("own.old") == F.col("by"))  # a nearer rule of its own comes first
        after = _written(jumped.unionByName(own.select(F.col("part").alias("old"), F.col("part_new").alias("new"))).distinct())
        ring = after.where("old = new").orderBy("old").limit(5).collect()
        if ring:
            raise CodeConflict("code changes go in a circle: " + ", ".join(r.old for r in ring))
        settled = after.exceptAll(rules).isEmpty() and after.count() == rules.count()
        rules = after
        if settled:
            return rules
    raise CodeConflict(f"code changes go in a circle: no end after {rounds} rounds over {first.count()} changes")
