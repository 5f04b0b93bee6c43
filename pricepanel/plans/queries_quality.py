"""Revision fixes, region codes, audits and coverage queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pricepanel.operators import audit, codes, coverage, revise, stats
from pricepanel.plans import fixtures as fx, landing
from pricepanel.plans.oracle import with_views
from pricepanel.plans.registry import DIRTY_YEARS, EMPTY_PAGE_YEAR, FACT_COLS, register
from pricepanel.sources import fact_store

# ------------------------------------------------------------ overrides

_CONF = """conf as (select pnu, stdr_year, stdr_month, substr(pnu,1,10) as bjd from api
                   group by 1, 2, 3 having min(price_per_m2) < max(price_per_m2))"""
_CAND = """cand as (select * from api a
  where exists (select 1 from conf c where c.bjd = substr(a.pnu,1,10) and c.stdr_year = a.stdr_year)
    and a.pnu in (select pnu from conf))"""
_OV = """ov as (select pnu, stdr_year, stdr_month, price_per_m2 as price_ov, pblntf_de as pblntf_ov from (
  select *, row_number() over (partition by pnu, stdr_year, stdr_month
                               order by coalesce(last_updt_dt,'') desc, seq asc, xp asc) as rn
  from {src} where price_per_m2 is not null) t where rn = 1)"""
_KEEP_FIRST = """base as (select * from (
  select *, row_number() over (partition by pnu, stdr_year, stdr_month order by seq, xp) as rn
  from {src}) t where rn = 1)"""
_APPLY = """select b.pnu, b.stdr_year, b.stdr_month, coalesce(o.price_ov, b.price_per_m2) as price_per_m2,
       coalesce(o.pblntf_ov, b.pblntf_de) as pblntf_de, b.std_land_yn, b.source, b.last_updt_dt, b.seq, b.xp
from {base} b left join ov o on b.pnu = o.pnu and b.stdr_year = o.stdr_year and b.stdr_month = o.stdr_month"""


def _overrides(spark, sf):
    return revise.authoritative(revise.conflict_candidates(fx.api_rows(spark, sf), fx.conflict_keys(spark, sf)))


@register("join_conflict_candidates", with_views("api") + f", {_CONF}, {_CAND} select {FACT_COLS} from cand")
def q_join_conflict_candidates(spark, sf):
    return revise.conflict_candidates(fx.api_rows(spark, sf), fx.conflict_keys(spark, sf))


@register("join_override", with_views("api") + f""", {_CONF},
conf_rows as (select a.* from api a semi join conf c
              on a.pnu = c.pnu and a.stdr_year = c.stdr_year and a.stdr_month = c.stdr_month),
{_OV.format(src="conf_rows")}
{_APPLY.format(base="api")}""")
def q_join_override(spark, sf):
    api = fx.api_rows(spark, sf)
    conflicts = fx.conflict_keys(spark, sf)
    rows = api.join(conflicts.select("pnu", "stdr_year", "stdr_month"),
                    ["pnu", "stdr_year", "stdr_month"], "left_semi")
    return revise.apply_overrides(api, revise.authoritative(rows))


_Q7_SQL = with_views("api") + f""", {_CONF}, {_CAND}, {_OV.format(src="cand")},
{_KEEP_FIRST.format(src="api")}
{_APPLY.format(base="base")}"""


@register("fix_revisions", _Q7_SQL)
def q_fix_revisions(spark, sf):
    api = fx.api_rows(spark, sf)
    return revise.fix_revisions(api, api, conflicts=fx.conflict_keys(spark, sf))


_DIRTY = ", ".join(str(y) for y in DIRTY_YEARS)


@register("merge_staging", with_views("api") + f""", {_CONF}, {_CAND}, {_OV.format(src="cand")},
dirty as (select * from api where stdr_year in ({_DIRTY})),
{_KEEP_FIRST.format(src="dirty")}
select {FACT_COLS} from api where stdr_year not in ({_DIRTY})
union all
{_APPLY.format(base="base")} where b.stdr_year in ({_DIRTY})""")
def q_merge_staging(spark, sf):
    api = fx.api_rows(spark, sf)
    return revise.merge_staging(api, _overrides(spark, sf), DIRTY_YEARS)


@register("union_sources", with_views("api", "city") + """
select source, stdr_year, count(*) as rows from (select * from api union all select * from city) t
group by 1, 2""")
def q_union_sources(spark, sf):
    u = fx.api_rows(spark, sf).unionByName(fx.city_rows(spark, sf))
    return u.groupBy("source", "stdr_year").agg(F.count(F.lit(1)).alias("rows"))


@register("distinct_keys", with_views("api") + """
select stdr_year, count(*) as keys from (select distinct stdr_year, pnu, stdr_month from api) t group by 1""")
def q_distinct_keys(spark, sf):
    return (fx.api_rows(spark, sf).select("stdr_year", "pnu", "stdr_month").distinct()
            .groupBy("stdr_year").agg(F.count(F.lit(1)).alias("keys")))


# ---------------------------------------------------------------- codes

_POOL = """pool as (select code, status, abolished, substr(code,1,5) as sgg, substr(code,6,3) as emd,
                  substr(code,9,2) as ri, substr(code,1,8) as prefix8 from bjd where substr(code,6,3) <> '000' {extra})"""
_LEAF = """leaf as (select * from pool where ri <> '00'
   or prefix8 not in (select prefix8 from pool where ri <> '00'))"""
_LEAF_COLS = "code, status, abolished, sido, sgg, emd, ri, prefix8"
_LEAF_SEL = f"select code, status, abolished, substr(code,1,2) as sido, sgg, emd, ri, prefix8 from leaf"


@register("agg_leaf_codes", with_views("bjd") + f", {_POOL.format(extra='')}, {_LEAF} {_LEAF_SEL}")
def q_agg_leaf_codes(spark, sf):
    return codes.leaf_codes(fx.region_codes(spark, sf)).select(*_LEAF_COLS.split(", "))


@register("agg_leaf_codes_active",
          with_views("bjd") + f", {_POOL.format(extra='and not abolished')}, {_LEAF} {_LEAF_SEL}")
def q_agg_leaf_codes_active(spark, sf):
    return codes.leaf_codes(fx.region_codes(spark, sf), include_abolished=False).select(*_LEAF_COLS.split(", "))


@register("join_leaf_anti", with_views("bjd") + f", {_POOL.format(extra='')}, {_LEAF} {_LEAF_SEL}")
def q_join_leaf_anti(spark, sf):
    pool = codes.with_code_parts(fx.region_codes(spark, sf)).where(F.col("emd") != "000")
    return codes.drop_parents_with_ri(pool).select(*_LEAF_COLS.split(", "))


@register("agg_codes_by_sgg", with_views("bjd") + f", {_POOL.format(extra='')}, {_LEAF}" + """
select sgg, count(*) as n_codes, string_agg(code, ',' order by code) as codes from leaf group by sgg""")
def q_agg_codes_by_sgg(spark, sf):
    return codes.codes_by_sgg(codes.leaf_codes(fx.region_codes(spark, sf)))


@register("agg_prefixes_by_sgg", with_views("bjd") + f", {_POOL.format(extra='')}, {_LEAF}" + """
select sgg, count(distinct prefix8) as n_prefixes,
       string_agg(distinct prefix8, ',' order by prefix8) as prefixes from leaf group by sgg""")
def q_agg_prefixes_by_sgg(spark, sf):
    return codes.prefixes_by_sgg(codes.leaf_codes(fx.region_codes(spark, sf)))


# --------------------------------------------------------------- audits

@register("audit_format", with_views("fact") + """
select count(*) filter (where length(pnu) < 19) as pnu_too_short,
       count(*) filter (where price_per_m2 <= 0) as nonpositive_price,
       count(*) filter (where stdr_month not in (1, 7)) as odd_month from fact""")
def q_audit_format(spark, sf):
    return audit.audit_format(fx.fact(spark, sf))


@register("audit_code_exists", with_views("fact", "bjd") + """
select count(*) as n_rows, count(*) filter (where b.code is null) as n_unknown_rows,
       count(distinct case when b.code is null then substr(f.pnu,1,10) end) as n_unknown_bjd
from fact f left join bjd b on substr(f.pnu,1,10) = b.code""")
def q_audit_code_exists(spark, sf):
    return audit.audit_code_exists(fx.fact(spark, sf), fx.region_codes(spark, sf))


@register("audit_key_unique", with_views("fact") + """
select count(*) as dup_keys, coalesce(sum(n - 1), 0)::bigint as surplus_rows from (
  select count(*) as n from fact group by pnu, stdr_year, stdr_month, source having count(*) > 1) t""")
def q_audit_key_unique(spark, sf):
    return audit.audit_key_unique(fx.fact(spark, sf))


@register("audit_key_unique_after_dedup", with_views("fact") + """
, latest as (select * from (
  select *, row_number() over (partition by pnu, stdr_year, stdr_month, source
                               order by coalesce(last_updt_dt,'') desc, seq desc, xp desc) as rn
  from fact) t where rn = 1)
select count(*) as dup_keys, coalesce(sum(n - 1), 0)::bigint as surplus_rows from (
  select count(*) as n from latest group by pnu, stdr_year, stdr_month, source having count(*) > 1) t""")
def q_audit_key_unique_after_dedup(spark, sf):
    return audit.audit_key_unique(revise.dedup_latest(fx.fact(spark, sf)))


_DIP = """select {outer} stdr_year, rows, prev_rows, next_rows, pct as pct_of_neighbours, pct <= 50 as dip from (
  select *, cast(round(rows * 100.0 / ((coalesce(prev_rows,0) + coalesce(next_rows,0)) * 1.0 /
        ((prev_rows is not null)::int + (next_rows is not null)::int))) as bigint) as pct
  from (select *, lag(rows) over (partition by {win} order by stdr_year) as prev_rows,
                  lead(rows) over (partition by {win} order by stdr_year) as next_rows
        from (select {inner} stdr_year, count(*) as rows from api group by {grp}) c) t) u"""


@register("audit_year_dip", with_views("api") + _DIP.format(
    outer="sgg,", inner="substr(pnu,1,5) as sgg,", win="sgg", grp="1, 2"))
def q_audit_year_dip(spark, sf):
    return audit.audit_year_dip(fx.api_rows(spark, sf), per="sgg")


@register("audit_year_dip_national", with_views("api") + _DIP.format(
    outer="", inner="", win="1", grp="stdr_year"))
def q_audit_year_dip_national(spark, sf):
    return audit.audit_year_dip(fx.api_rows(spark, sf), per="national")


_J3 = """, jan as (select * from (
  select *, row_number() over (partition by pnu, stdr_year
                               order by coalesce(last_updt_dt,'') desc, seq desc, xp desc) as rn
  from api where stdr_month = 1) t where rn = 1),
j as (select c.price_per_m2, a.price_per_m2 as api_price from city c
      left join jan a on c.pnu = a.pnu and c.stdr_year = a.stdr_year where c.stdr_month = 1)
select count(*) as total,
       count(*) filter (where api_price is not null and api_price = price_per_m2) as match,
       count(*) filter (where api_price is not null and api_price <> price_per_m2) as mismatch,
       count(*) filter (where api_price is null) as missing,
       cast(round(count(*) filter (where api_price is not null and api_price = price_per_m2) * 1000.0
                  / count(*)) as bigint) as match_permille
from j"""


@register("join_cross_source", with_views("api", "city") + _J3)
def q_join_cross_source(spark, sf):
    return audit.cross_source(fx.city_rows(spark, sf), fx.api_rows(spark, sf))


@register("join_cross_source_first", with_views("api", "city") + _J3.replace(
    "order by coalesce(last_updt_dt,'') desc, seq desc, xp desc", "order by seq, xp"))
def q_join_cross_source_first(spark, sf):
    """J3 against the first arrival of each parcel and year."""
    return audit.cross_source(fx.city_rows(spark, sf), fx.api_rows(spark, sf), revision="first")


# ------------------------------------------------------------- coverage

_GRID = f""", {_POOL.format(extra='')}, {_LEAF},
grid as (select sgg, y.stdr_year from (select distinct sgg from leaf) s,
         (select distinct cast(stdr_year as int) as stdr_year from fact) y)"""
_FILLED = """, done as (select substr(pnu,1,5) as sgg, cast(stdr_year as int) as stdr_year, count(*) as rows
         from fact group by 1, 2)"""
_DONE = f""", done as (select sgg, stdr_year, cast(sum(rows) as bigint) as rows from (
  select substr(pnu,1,5) as sgg, cast(stdr_year as int) as stdr_year, count(*) as rows from api group by 1, 2
  union all
  select distinct substr(code,1,5), {EMPTY_PAGE_YEAR}, 0 from bjd where abolished) t group by 1, 2)"""


def _done(spark, sf):
    """Units with API rows, and units whose page reported none."""
    return coverage.done_units(fx.api_rows(spark, sf), landing.empty_units(spark, sf, EMPTY_PAGE_YEAR))


def _grid(spark, sf):
    years = stats.data_years(fx.fact(spark, sf))
    return coverage.unit_grid(codes.leaf_codes(fx.region_codes(spark, sf)), years)


@register("join_units_todo", with_views("api", "bjd") + _GRID + _DONE + """
select g.sgg, g.stdr_year from grid g anti join done d on g.sgg = d.sgg and g.stdr_year = d.stdr_year""")
def q_join_units_todo(spark, sf):
    return coverage.units_todo(_grid(spark, sf), _done(spark, sf))


@register("audit_empty_units", with_views("fact", "bjd") + _GRID + _FILLED + """
select g.sgg, g.stdr_year from grid g anti join done d on g.sgg = d.sgg and g.stdr_year = d.stdr_year""")
def q_audit_empty_units(spark, sf):
    return coverage.empty_units(_grid(spark, sf), fx.fact(spark, sf))


@register("coverage_by_year", with_views("api", "bjd") + _DONE + """
select stdr_year, count(*) as units, cast(sum(rows) as bigint) as rows from done group by 1""")
def q_coverage_by_year(spark, sf):
    return coverage.coverage_by_year(_done(spark, sf))


@register("coverage_ratio", with_views("api", "bjd") + _GRID + _DONE + """
select count(d.rows) as done_units, count(*) as total_units, cast(coalesce(sum(d.rows), 0) as bigint) as rows,
       cast(round(count(d.rows) * 1000.0 / count(*)) as bigint) as done_permille
from grid g left join done d on g.sgg = d.sgg and g.stdr_year = d.stdr_year""")
def q_coverage_ratio(spark, sf):
    return coverage.coverage_ratio(_grid(spark, sf), _done(spark, sf))


# ------------------------------------------------------- parcel key join

#: Folder of a bucketed table -> its name in the catalogue.
_TABLES: dict[str, str] = {}

@register("join_parcel_geometry_key", with_views("api", "city") + """
, parcels as (select pnu, min(stdr_year) as first_city_year, count(*) as city_rows from city group by pnu),
latest as (select * from (
  select *, row_number() over (partition by pnu, stdr_year, stdr_month, source
                               order by coalesce(last_updt_dt,'') desc, seq desc, xp desc) as rn
  from api where stdr_month = 1) t where rn = 1)
select l.pnu, l.stdr_year, l.price_per_m2, p.first_city_year, p.city_rows
from latest l join parcels p on l.pnu = p.pnu""")
def q_join_parcel_geometry_key(spark, sf):
    """Yearly prices joined to a per-parcel table on ``pnu``.

    Both tables are written once, bucketed and sorted by ``pnu``; the join reads
    them bucket by bucket. The parcel side has one row per parcel, so the join
    cannot multiply rows for a hot parcel.
    """
    def bucketed(name, build):
        table = f"{name}_{uuid.uuid4().hex[:8]}"
        path = fx.stored_path(spark, sf, name, lambda p: fact_store.write_bucketed(build(), table, p))
        _TABLES.setdefault(path, table)
        return spark.table(_TABLES[path])

    parcels = bucketed("bucketed_parcels", lambda: fx.city_rows(spark, sf).groupBy("pnu").agg(
        F.min("stdr_year").alias("first_city_year"), F.count(F.lit(1)).alias("city_rows")))
    latest = bucketed("bucketed_prices", lambda: revise.dedup_latest(fx.api_rows(spark, sf).where(F.col("stdr_month") == 1)))
    return fact_store.join_bucketed(latest, parcels).select("pnu", "stdr_year", "price_per_m2", "first_city_year", "city_rows")
