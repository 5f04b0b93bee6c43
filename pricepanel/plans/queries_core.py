"""Core queries: normalisation, de-duplication, statistics, conflicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricepanel.operators import revise, stats
from pricepanel.plans import fixtures as fx
from pricepanel.plans.oracle import SIDO_BOUNDARY_CASE, SIDO_SHORT_CASE, with_views
from pricepanel.plans.registry import FACT_COLS, SNAPSHOT_YEAR, register
from pricepanel.schema import SRC_API, SRC_BULK, SRC_CITY

# --------------------------------------------------------------- normalise


@register("norm_api_row", with_views("fact") + f"select {FACT_COLS} from fact")
def q_norm_api_row(spark, sf):
    return fx.fact_from_raw(fx.raw_api(spark, sf))


# ------------------------------------------------------------ de-duplicate

_W1_SQL = with_views("fact") + f"""
select {FACT_COLS} from (
  select *, row_number() over (partition by pnu, stdr_year, stdr_month, source
                               order by coalesce(last_updt_dt,'') desc, seq desc, xp desc) as rn
  from fact) t where rn = 1"""


@register("dedup_latest", _W1_SQL)
def q_dedup_latest(spark, sf):
    return revise.dedup_latest(fx.fact(spark, sf))


@register("dedup_latest_strict", with_views("fact") + f"""
select {FACT_COLS} from (
  select *, row_number() over (partition by pnu, stdr_year, stdr_month, source
                               order by coalesce(last_updt_dt,'') desc, seq asc, xp asc) as rn
  from fact where price_per_m2 is not null) t where rn = 1""")
def q_dedup_latest_strict(spark, sf):
    return revise.dedup_latest(fx.fact(spark, sf).where(F.col("price_per_m2").isNotNull()), tie="first")


@register("dedup_keep_first", with_views("api") + f"""
select {FACT_COLS} from (
  select *, row_number() over (partition by pnu, stdr_year, stdr_month order by seq, xp) as rn
  from api) t where rn = 1""")
def q_dedup_keep_first(spark, sf):
    return revise.dedup_keep_first(fx.api_rows(spark, sf))


# Collection dates of the three sources: the API rows came in two runs, before and after the national bulk.
_COLLECTED = {SRC_BULK: "2026-06-15", SRC_CITY: "2026-07-20"}
_API_RUNS = ("2026-07-15", "2026-05-01")


@register("merge_sources", with_views("fact") + f"""
, dated as (
  select *, cast(case when source = '{SRC_CITY}' then '{_COLLECTED[SRC_CITY]}' when seq % 2 = 0 then '{_API_RUNS[0]}' else '{_API_RUNS[1]}' end as date) as collected_at
  from fact
  union all
  select * replace ('{SRC_BULK}' as source, price_per_m2 + 1 as price_per_m2), date '{_COLLECTED[SRC_BULK]}' from fact where source = '{SRC_API}')
select {FACT_COLS}, collected_at from (
  select *, row_number() over (partition by pnu, stdr_year, stdr_month
      order by case when source in ('vworld_api','vworld_bulk') then 0 when source='seoul_opendata' then 1 else 2 end,
               collected_at desc, coalesce(last_updt_dt,'') desc, seq desc, xp desc, source, price_per_m2 desc) as rn
  from dated) t where rn = 1""")
def q_merge_sources(spark, sf):
    """W3 over three sources: between API and national bulk the later collection decides."""
    fact = fx.fact(spark, sf)
    api = F.when(F.col("seq") % 2 == 0, _API_RUNS[0]).otherwise(_API_RUNS[1])
    dated = fact.withColumn("collected_at", F.when(F.col("source") == SRC_CITY, _COLLECTED[SRC_CITY]).otherwise(api).cast("date"))
    bulk = fact.where(F.col("source") == SRC_API).withColumns({
        "source": F.lit(SRC_BULK), "price_per_m2": F.col("price_per_m2") + 1, "collected_at": F.lit(_COLLECTED[SRC_BULK]).cast("date")})
    return revise.merge_sources(dated.unionByName(bulk))


# ------------------------------------------------------------- statistics

@register("agg_overall", with_views("fact") + """
select count(*) as n_rows, count(distinct stdr_year) as n_years,
       min(stdr_year) as min_year, max(stdr_year) as max_year from fact""")
def q_agg_overall(spark, sf):
    return stats.overall(fx.fact(spark, sf))


@register("agg_year_summary", with_views("fact") + """
select stdr_year, count(*) as rows, count(distinct substr(pnu,1,2)) as n_sido,
       count(*) filter (where stdr_month = 7) as july_rows,
       min(price_per_m2) as min_price, cast(round(avg(price_per_m2)) as bigint) as avg_price,
       max(price_per_m2) as max_price
from fact group by stdr_year""")
def q_agg_year_summary(spark, sf):
    return stats.year_summary(fx.fact(spark, sf))


@register("agg_year_price", with_views("api") + """
select stdr_year, count(*) filter (where stdr_month=1) as parcels,
       cast(round(avg(price_per_m2) filter (where stdr_month=1 and price_per_m2>0)) as bigint) as avg_price,
       cast(round(median(price_per_m2) filter (where stdr_month=1 and price_per_m2>0)) as bigint) as med_price
from api group by stdr_year""")
def q_agg_year_price(spark, sf):
    return stats.year_price(fx.api_rows(spark, sf))


_A4_SQL = with_views("api") + f"""
select {SIDO_BOUNDARY_CASE} as name, stdr_year as yr, count(*) as parcels,
       cast(round(avg(price_per_m2) filter (where price_per_m2>0)) as bigint) as avg_p,
       cast(round(median(price_per_m2) filter (where price_per_m2>0)) as bigint) as med_p
from api where stdr_month=1 and {SIDO_BOUNDARY_CASE} is not null
group by 1, 2"""


@register("agg_sido_year", _A4_SQL)
def q_agg_sido_year(spark, sf):
    return stats.sido_year(fx.api_rows(spark, sf))


_A5_SQL = with_views("api") + f"""
select sido, {SIDO_SHORT_CASE.format(c='sido')} as name, parcels, avg_price from (
  select substr(pnu,1,2) as sido, count(*) as parcels,
         cast(round(avg(price_per_m2) filter (where price_per_m2>0)) as bigint) as avg_price
  from api where stdr_year={SNAPSHOT_YEAR} and stdr_month=1 group by 1) t"""


@register("agg_sido_snapshot", _A5_SQL)
def q_agg_sido_snapshot(spark, sf):
    return stats.sido_snapshot(fx.fact_table(spark, sf, SRC_API, years=(SNAPSHOT_YEAR,)), SNAPSHOT_YEAR)


@register("agg_sgg_median", with_views("api") + f"""
select substr(pnu,1,5) as sgg, cast(round(median(price_per_m2)) as bigint) as med_price, count(*) as parcels
from api where stdr_year={SNAPSHOT_YEAR} and stdr_month=1 and price_per_m2>0 group by 1""")
def q_agg_sgg_median(spark, sf):
    return stats.sgg_median(fx.fact_table(spark, sf, SRC_API, years=(SNAPSHOT_YEAR,)), SNAPSHOT_YEAR)


@register("agg_source_mix", with_views("fact") + "select source, count(*) as rows from fact group by source")
def q_agg_source_mix(spark, sf):
    return stats.source_mix(fx.fact(spark, sf))


# -------------------------------------------------------------- conflicts

@register("agg_conflict_keys", with_views("api") + """
select pnu, stdr_year, stdr_month, substr(pnu,1,10) as bjd, count(*) as n_rows
from api group by pnu, stdr_year, stdr_month having count(distinct price_per_m2) > 1""")
def q_agg_conflict_keys(spark, sf):
    return revise.conflict_keys(fx.api_rows(spark, sf))


@register("agg_conflict_census", with_views("api") + """
, k as (select stdr_year, pnu, stdr_month, count(*) as n, count(distinct price_per_m2) as d
        from api group by 1, 2, 3)
select stdr_year, cast(sum(n) as bigint) as rows, count(*) as keys,
       count(*) filter (where d > 1) as conflict_keys,
       cast(sum(n) - count(*) - count(*) filter (where d > 1) as bigint) as exact_dup,
       cast(sum(n - d) as bigint) as same_price_surplus
from k group by stdr_year""")
def q_agg_conflict_census(spark, sf):
    return revise.conflict_census(fx.api_rows(spark, sf))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Raw API records -> N7 -> latest revision (W1) -> yearly A3 report."""
    api = fx.fact_from_raw(fx.raw_api(spark, sf)).where(F.col("source") == "vworld_api")
    return stats.year_price(revise.dedup_latest(api))


@register("flagship_year_price", with_views("api") + """
, latest as (select * from (
  select *, row_number() over (partition by pnu, stdr_year, stdr_month, source
                               order by coalesce(last_updt_dt,'') desc, seq desc, xp desc) as rn
  from api) t where rn = 1)
select stdr_year, count(*) filter (where stdr_month=1) as parcels,
       cast(round(avg(price_per_m2) filter (where stdr_month=1 and price_per_m2>0)) as bigint) as avg_price,
       cast(round(median(price_per_m2) filter (where stdr_month=1 and price_per_m2>0)) as bigint) as med_price
from latest group by stdr_year""")
def q_flagship(spark, sf):
    return flagship(spark, sf)


@register("agg_year_price_distributed", with_views("api") + """
select stdr_year, count(*) filter (where stdr_month=1) as parcels,
       cast(round(avg(price_per_m2) filter (where stdr_month=1 and price_per_m2>0)) as bigint) as avg_price,
       cast(round(median(price_per_m2) filter (where stdr_month=1 and price_per_m2>0)) as bigint) as med_price
from api group by stdr_year""")
def q_agg_year_price_distributed(spark, sf):
    """A3 with the bucketed exact median (no group gathered in one task)."""
    return stats.year_price_distributed(fx.api_rows(spark, sf))


@register("agg_conflict_keys_cross_source", with_views("fact") + """
select count(*) as conflicting_keys from (
  select pnu, stdr_year, stdr_month from fact group by 1, 2, 3 having count(distinct price_per_m2) > 1) t""")
def q_agg_conflict_keys_cross_source(spark, sf):
    """A12 across sources: merged-view keys whose sources disagree on price."""
    return revise.conflict_keys(fx.fact(spark, sf)).agg(F.count(F.lit(1)).alias("conflicting_keys"))


@register("agg_year_price_median_map", with_views("api") + """
select stdr_year, count(*) filter (where stdr_month=1) as parcels,
       cast(round(avg(price_per_m2) filter (where stdr_month=1 and price_per_m2>0)) as bigint) as avg_price,
       cast(round(median(price_per_m2) filter (where stdr_month=1 and price_per_m2>0)) as bigint) as med_price
from api group by stdr_year""")
def q_agg_year_price_median_map(spark, sf):
    """A3 with Spark's one-aggregate median (per-group distinct-value map)."""
    return stats.year_price(fx.api_rows(spark, sf), distributed=False)
