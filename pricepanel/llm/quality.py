"""Quality rules with thresholds learnt per language and source (DataFrame functions only).

Every text gives a few counts (``profile``). A fixed base rule rejects short and
mostly repeated texts. The other limits are not fixed: per (lang, source) a
mergeable quantile sketch (KLL) of each measure gives the quartiles, and a
document is an outlier beyond the far fence ``q3 + FENCE * (q3 - q1)``
(``q1 - ...`` below, for word length). Groups of fewer than MIN_GROUP documents
take the merged sketch of their language, small languages that of all. A
measure short of its guard is never an outlier, so a group of almost equal
texts does not reject its ordinary members; the guards are parameters.

Sketches are combined map-side, so a source with a third of all rows is one
small row a task; quartiles are written once, and the same limits hold for
every row of a run. They join back on (lang, source), broadcast after a size
check.

Null and empty texts have no words and fail the base rule. Null languages and
sources are groups of their own. Repeated rows count as often as they come;
equal values on a limit are kept (the rule is "beyond"). Extra columns are
carried by ``keep_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricepanel.llm.tables import carried, restored, stored
from pricepanel.operators.joins import maybe_broadcast

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

FENCE = 3.0
MIN_GROUP = 100
SKETCH_K = 1024
MAX_GROUPS = 100_000
#: Measures with the side of their fence and the guard up to which a value is always in order.
MEASURES = {
    "symbols_per_word": ("high", 0.2),
    "dup_line_share": ("high", 0.5),
    "repeat_word_share": ("high", 0.45),
    "word_length": ("high", 12.0),
    "word_length_low": ("low", 2.0),
}
_SOURCE = {"word_length_low": "word_length"}

_INDEX = 0x7FFFFFFF


def profile(documents: DataFrame) -> DataFrame:
    """``documents`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words.

    Words in repeated windows are counted without leaving the row: window
    hashes are sorted together with their position (the hash's upper half, so
    the sort runs on plain longs), equal neighbours are compared by the whole
    hash, and the covered words are counted from the sorted positions: n log n
    for any length of text. Steps are columns of their own so that each is
    made once.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = documents.withColumn("_text", text).withColumn("_inner", F.btrim("_text", F.lit(SPACES)))
    df = df.withColumn("_words", F.when(F.col("_inner") == "", F.expr("cast(array() as array<string>)"))
                       .otherwise(F.split("_inner", "[\\x20\\x09-\\x0D]+"))).drop("_inner")
    lines = F.filter(F.split("_text", "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    df = df.withColumn("_lines", lines)
    df = (df.withColumn("n_words", F.size("_words").cast("bigint"))
          .withColumn("word_chars", F.char_length(F.array_join("_words", "")).cast("bigint"))
          .withColumn("n_symbols", F.regexp_count("_text", F.lit(f"[{SYMBOLS}]")).cast("bigint"))
          .withColumn("n_lines", F.size("_lines").cast("bigint"))
          .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"))).drop("_lines", "_text")

    def window(i: Column) -> Column:
        return F.xxhash64(*[F.get("_words", i + k) for k in range(3)])

    upper, index = F.lit(~_INDEX), F.lit(_INDEX)
    starts = F.when(F.size("_words") > 2, F.sequence(F.lit(0), F.size("_words") - 3)).otherwise(F.expr("cast(array() as array<int>)"))
    packed = F.transform(starts, lambda i: window(i).bitwiseAND(upper).bitwiseOR(i.cast("bigint")))
    df = df.withColumn("_packed", F.sort_array(packed))
    near = F.filter(F.zip_with("_packed", _next("_packed"), lambda a, b: F.when(
        a.bitwiseAND(upper) == b.bitwiseAND(upper), F.array(a, b))), lambda x: x.isNotNull())
    df = df.withColumn("_maybe", F.array_distinct(F.flatten(near)))
    full = F.transform("_maybe", lambda v: F.struct(window(v.bitwiseAND(index).cast("int")).alias("h"),
                                                    v.bitwiseAND(index).cast("int").alias("i")))
    df = df.withColumn("_full", F.sort_array(full))
    same = F.filter(F.zip_with("_full", _next("_full"), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))),
                    lambda x: x.isNotNull())
    df = df.withColumn("_at", F.sort_array(F.array_distinct(F.flatten(same))))
    steps = F.zip_with("_at", _next("_at"), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)))
    df = df.withColumn("n_repeat_words", F.aggregate(steps, F.lit(0).cast("bigint"), lambda s, x: s + x))
    return df.drop("_words", "_packed", "_maybe", "_full", "_at")


def _next(column: str) -> Column:
    return F.slice(column, F.lit(2), F.greatest(F.size(column), F.lit(1)))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def measures() -> dict[str, Column]:
    """The measures by name, null for a text without words."""
    words = F.nullif(F.col("n_words"), F.lit(0)).cast("double")
    lines = F.nullif(F.col("n_lines"), F.lit(0)).cast("double")
    return {"symbols_per_word": F.col("n_symbols") / words, "dup_line_share": F.col("n_dup_lines") / lines,
            "repeat_word_share": F.col("n_repeat_words") / words, "word_length": F.col("word_chars") / words}


def limits(profiles: DataFrame, fence: float = FENCE, min_group: int = MIN_GROUP, k: int = SKETCH_K) -> DataFrame:
    """(lang, source, one limit a measure): far fences of the quartile sketches, never inside the guards."""
    values = measures()
    sketches = [F.kll_sketch_agg_double(c, k).alias(n) for n, c in values.items()]
    by_group = stored(profiles.where("n_words > 0").groupBy("lang", "source")
                      .agg(F.count(F.lit(1)).alias("n"), *sketches), "sketches")
    merged = [F.kll_merge_agg_double(n, k).alias(n) for n in values]
    # Pools of three levels: the group, its language, all. Each group is judged by the first that is large enough.
    merged = [F.kll_merge_agg_double(n, k).alias(n) for n in values]
    nothing = F.lit(None).cast("string")
    level = F.explode(F.array(F.struct(F.lit(0).alias("level"), F.col("lang").alias("p_lang"), F.col("source").alias("p_source")),
                              F.struct(F.lit(1).alias("level"), F.col("lang").alias("p_lang"), nothing.alias("p_source")),
                              F.struct(F.lit(2).alias("level"), nothing.alias("p_lang"), nothing.alias("p_source"))))
    pools = by_group.withColumn("pool", level).select("pool.*", "n", *values)
    pools = stored(pools.groupBy("level", "p_lang", "p_source").agg(F.sum("n").alias("pool_n"), *merged), "pools")
    by_lang = pools.where("level = 1").select(F.col("p_lang").alias("l_lang"), F.col("pool_n").alias("l_n"))
    chosen = by_group.select("lang", "source", "n").join(by_lang, F.col("lang").eqNullSafe(F.col("l_lang")))
    use = F.when(F.col("n") >= min_group, 0).when(F.col("l_n") >= min_group, 1).otherwise(2)
    chosen = (chosen.withColumn("use", use).withColumn("u_lang", F.when(F.col("use") < 2, F.col("lang")))
              .withColumn("u_source", F.when(F.col("use") < 1, F.col("source"))))
    same = ((F.col("use") == F.col("level")) & F.col("u_lang").eqNullSafe(F.col("p_lang"))
            & F.col("u_source").eqNullSafe(F.col("p_source")))
    chosen = chosen.join(pools, same).select("lang", "source", *values)

    def limit(name: str) -> Column:
        side, guard = MEASURES[name]
        sketch = F.col(_SOURCE.get(name, name))
        q1, q3 = (F.kll_sketch_get_quantile_double(sketch, F.lit(q)) for q in (0.25, 0.75))
        if side == "high":
            return F.greatest(q3 + (q3 - q1) * fence, F.lit(guard))
        return F.least(q1 - (q3 - q1) * fence, F.lit(guard))

    return stored(chosen.select("lang", "source", *[limit(n).alias("limit_" + n) for n in MEASURES]), "limits")


def _judged(profiles: DataFrame, bounds: DataFrame, max_groups: int) -> DataFrame:
    """``profiles`` with base_failed and kept."""
    bounds = bounds.withColumnRenamed("lang", "_lang").withColumnRenamed("source", "_source")
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    joined = profiles.join(maybe_broadcast(bounds, max_groups), same, "left")
    values, beyond = measures(), F.lit(False)
    for name, (side, _) in MEASURES.items():
        value, bound = values[_SOURCE.get(name, name)], F.col("limit_" + name)
        beyond = beyond | F.coalesce(value > bound if side == "high" else value < bound, F.lit(False))
    judged = joined.withColumn("base_failed", base_failed()).withColumn("kept", ~(F.col("base_failed") | beyond))
    return judged.drop("_lang", "_source", *["limit_" + n for n in MEASURES])


def verdicts(documents: DataFrame, max_groups: int = MAX_GROUPS, **sketching) -> DataFrame:
    """(doc_id, lang, source, counts, base_failed, kept) per row; the counts are made once and written."""
    profiles = stored(profile(documents.select("doc_id", "lang", "source", "text")).drop("text"), "profiles")
    return _judged(profiles, limits(profiles, **sketching), max_groups)


def keep_documents(documents: DataFrame, max_groups: int = MAX_GROUPS, **sketching) -> DataFrame:
    """``documents`` without the rejected rows; columns unchanged, whatever they are called.

    The counts are made twice, once for the limits and once beside the text,
    which saves a shuffle or a copy of all texts.
    """
    bounds = limits(profile(documents.select("lang", "source", "text")).drop("text"), **sketching)
    judged = _judged(profile(carried(documents, "lang", "source", "text")), bounds, max_groups)
    # One sum over both sides of the join: a condition on the counts alone would be pushed below
    # it and the steps of the profile be made once for every mention.
    lost = F.col("base_failed").cast("int") + (~F.col("kept")).cast("int")
    return restored(judged.where(lost == 0), documents)
