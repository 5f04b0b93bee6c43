"""Registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """The vocabulary file of the queries (a parameter of the operators)."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@register("op6_bpe")
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricepanel.llm import bpe
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encoded(docs, vocabulary(), with_ids=False)


@register("op9_token_store")
def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricepanel.llm import token_store
    return token_store.token_offsets(table(spark, sf_dir, "documents"), vocabulary(), end_id=2)


@register("op10_decontamination", sql="""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w from benchmark),
p as (select distinct item_id, least(len(w), 13) n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') g
      from b, unnest(range(1, greatest(len(w) - 13, 0) + 2)) t(i) where len(w) > 0),
lens as (select distinct n from p),
g as (select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') g from d, lens, unnest(range(1, len(w) - n + 2)) t(i)),
h as (select g.doc_id, g.i, g.n, p.item_id from g join p using (n, g)),
hit as (select doc_id, count(distinct i + k) n_hit from h, unnest(range(0, n)) t(k) group by doc_id),
it as (select doc_id, count(*) n_items, string_agg(item_id, ',' order by item_id) items from (select distinct doc_id, cast(item_id as varchar) item_id from h) group by doc_id)
select d.doc_id, cast(len(w) as bigint) n_words, cast(coalesce(n_hit, 0) as bigint) n_hit, cast(coalesce(n_items, 0) as bigint) n_items,
       sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
from d left join hit using (doc_id) left join it using (doc_id)
""")
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricepanel.llm import decontaminate
    spans = decontaminate.contamination_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.judge(spans).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@register("op3_superminhash")
def op3_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricepanel.llm import superminhash
    found = superminhash.groups(table(spark, sf_dir, "documents"), shingle=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", F.expr("doc_id <=> component_id").alias("kept"))


_WORDS = "list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _limit_sql(name: str) -> str:
    from pricepanel.llm import quality
    side, guard = quality.MEASURES[name]
    x = quality._SOURCE.get(name, name)
    v = f"case when gn >= {quality.MIN_GROUP} then g_{x} when ln >= {quality.MIN_GROUP} then l_{x} else o_{x} end"
    q1, q3 = (f"({v})[cast(greatest(1, ceil(len({v}) * {q})) as bigint)]" for q in (0.25, 0.75))
    fence = f"({q3} - {q1}) * {quality.FENCE}"
    return f"greatest({q3} + {fence}, {guard}::double)" if side == "high" else f"least({q1} - {fence}, {guard}::double)"


def _quality_sql() -> str:
    from pricepanel.llm import quality
    names = ["symbols_per_word", "dup_line_share", "repeat_word_share", "word_length"]
    lists = {p: ", ".join(f"list_sort(list({n})) {p}_{n}" for n in names) for p in "glo"}
    beyond = " or ".join(
        f"coalesce({quality._SOURCE.get(n, n)} {'>' if side == 'high' else '<'} limit_{n}, false)" for n, (side, _) in quality.MEASURES.items())
    return f"""
with d as (select *, {_WORDS} w, coalesce(text, '') t from documents),
win as (select doc_id, i, array_to_string(w[i:i + 2], ' ') g from d, unnest(range(1, greatest(len(w) - 2, 0) + 1)) u(i)),
rep as (select doc_id, count(distinct i + k) n from (select doc_id, i, count(*) over (partition by doc_id, g) c from win), unnest(range(0, 3)) u(k) where c > 1 group by doc_id),
lines as (select doc_id, x from d, unnest(string_split(t, chr(10))) u(x) where trim(x, {_SPACES}) <> ''),
ln as (select doc_id, count(*) n, count(*) - count(distinct x) dup from lines group by doc_id),
p as (select d.doc_id, lang, source, len(w)::bigint n_words, length(array_to_string(w, ''))::bigint word_chars,
             (length(t) - length(translate(t, '{quality.SYMBOLS}', '')))::bigint n_symbols, coalesce(ln.n, 0)::bigint n_lines,
             coalesce(ln.dup, 0)::bigint n_dup_lines, coalesce(rep.n, 0)::bigint n_repeat_words
      from d left join rep using (doc_id) left join ln using (doc_id)),
m as (select *, n_symbols / nullif(n_words, 0)::double symbols_per_word, n_dup_lines / nullif(n_lines, 0)::double dup_line_share,
             n_repeat_words / nullif(n_words, 0)::double repeat_word_share, word_chars / nullif(n_words, 0)::double word_length from p),
g as (select lang, source, count(*) gn, {lists['g']} from m where n_words > 0 group by lang, source),
l as (select lang, count(*) ln, {lists['l']} from m where n_words > 0 group by lang),
o as (select {lists['o']} from m where n_words > 0),
b as (select g.lang, g.source, {', '.join(f'{_limit_sql(n)} limit_{n}' for n in quality.MEASURES)}
      from g join l on g.lang is not distinct from l.lang cross join o),
j as (select m.*, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed, {beyond} outlier
      from m left join b on m.lang is not distinct from b.lang and m.source is not distinct from b.source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not (base_failed or outlier) kept from j
"""


@register("op5_adaptive_quality", sql=_quality_sql())
def op5_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricepanel.llm import quality
    return quality.verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@register("op7_line_dedup", sql=f"""
with l as (select doc_id, i, u.s[i] line, trim(translate(u.s[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_SPACES}) k
           from (select doc_id, string_split(coalesce(text, ''), chr(10)) s from documents) u, unnest(range(1, len(u.s) + 1)) t(i)),
r as (select k, max(doc_id) keeper from l where length(k) >= 40 group by k having count(distinct doc_id) >= 5)
select l.doc_id, count(*)::bigint n_lines, count(*) filter (r.k is not null and l.doc_id <> r.keeper)::bigint n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (r.k is null or l.doc_id = r.keeper), '')) kept_sha256
from l left join r using (k) group by l.doc_id
""")
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricepanel.llm import line_dedup
    mapped = line_dedup.with_bitmaps(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = line_dedup.kept_lines(F.col("text"), F.col("_keep_bitmap"))
    return mapped.select("doc_id", F.size(line_dedup._lines(F.col("text"))).cast("bigint").alias("n_lines"),
                         F.col("_n_dropped").alias("n_dropped"), F.sha2(kept, 256).alias("kept_sha256"))


@register("op4_guess_cost")
def op4_guess_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricepanel.llm import guess_cost
    found = guess_cost.secret_spans(table(spark, sf_dir, "documents"), words=guess_cost.vocabulary_words(vocabulary()))

    def count(kind: str):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"), "base_sha256", F.col("listed").alias("spans"))


# The second replica of the query: some pages altered in place, cut short or lost before it was written.
_DAMAGE = {"altered": (97, 13), "cut": (89, 5), "lost": (101, 50)}

_RECORD = """'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10)
        || 'WARC-Date: 2026-07-15T00:00:00Z' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
        || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen({h}) || chr(13) || chr(10) || chr(13) || chr(10) || {h}
        || chr(13) || chr(10) || chr(13) || chr(10)"""


@register("op2_warc_fixity", sql=f"""
with p as (select page_id, url, coalesce(html, '') h, floor(page_id / 1000)::bigint file,
        case when page_id % 97 = 13 then replace(coalesce(html, ''), 'e', 'f') when page_id % 89 = 5 then left(coalesce(html, ''), greatest(length(html) - 40, 0)) else coalesce(html, '') end d
        from pages),
r as (select *, {_RECORD.format(h='h')} record, {_RECORD.format(h='d')} damaged from p),
a as (select *, coalesce(sum(strlen(record)) over (partition by file order by page_id rows between unbounded preceding and 1 preceding), 0)::bigint a_offset from r),
b as (select page_id, coalesce(sum(strlen(damaged)) over (partition by file order by page_id rows between unbounded preceding and 1 preceding), 0)::bigint b_offset from r where page_id % 101 <> 50)
select file, 'urn:page:' || page_id record_id, url, case when b_offset is null then 'missing' else 'altered' end finding, a_offset, b_offset,
       strlen(record)::bigint a_length, case when b_offset is not null then strlen(damaged)::bigint end b_length,
       sha256(record) a_hash, case when b_offset is not null then sha256(damaged) end b_hash
from a left join b using (page_id) where b_offset is null or record <> damaged
""")
def op2_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricepanel.llm import warc_fixity as W
    from pricepanel.llm.tables import stored
    from pricepanel.session import work_dir

    def struck(kind: str):
        every, rest = _DAMAGE[kind]
        return F.coalesce(F.col("page_id") % every == rest, F.lit(False))

    made = W.records(table(spark, sf_dir, "pages"))
    html = (F.when(struck("altered"), F.replace("html", F.lit("e"), F.lit("f")))
            .when(struck("cut"), F.substr("html", F.lit(1), F.greatest(F.char_length("html") - 40, F.lit(0)))).otherwise(F.col("html")))
    path = f"{work_dir(spark, 'warc')}/files"
    W.write_replicas(made, path, a=F.col("html"), b=F.when(~struck("lost"), html))
    return W.audit(*[stored(W.read_replica(spark, f"{path}/replica={name}"), "replica") for name in "ab"])


def document_paths(documents: DataFrame) -> DataFrame:
    """Paths for ``documents``: source, language, then the id by two digits a level."""
    digits = F.regexp_replace(F.col("doc_id").cast("string"), r"(\d\d)(?=\d)", "$1/")
    return documents.withColumn("path", F.concat_ws("/", F.coalesce("source", F.lit("_")), F.coalesce("lang", F.lit("_")), digits))


@register("op8_license_scan")
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricepanel.llm import license_scan
    return license_scan.licenses(document_paths(table(spark, sf_dir, "documents")))


@register("op1_html_suffix_array")
def op1_html_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricepanel.llm import html_extract
    return html_extract.main_text(table(spark, sf_dir, "pages"))


@register("op11_prefix_join")
def op11_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricepanel.llm import prefix_join
    return prefix_join.groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def _vector_codes_sql() -> str:
    from pricepanel.llm import vector_codes
    return vector_codes.oracle_sql()


@register("op12_orchard_codes", sql=_vector_codes_sql())
def op12_orchard_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricepanel.llm import vector_codes
    return vector_codes.compressed(table(spark, sf_dir, "embeddings"))


def _filter_audit_sql() -> str:
    from pricepanel.llm import filter_audit
    return filter_audit.oracle_sql()


@register("op13_filter_audit", sql=_filter_audit_sql())
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricepanel.llm import filter_audit
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
