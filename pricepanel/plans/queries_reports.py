"""Normaliser, filter, report and extension queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricepanel.functions import labels, normalize as N, pnu as P
from pricepanel.operators import codes, filters, revise, stats
from pricepanel.plans import fixtures as fx
from pricepanel.plans.oracle import BOUNDARY_PREFIX_CASE, CITY_MONTH, PNU, SIDO_BOUNDARY_CASE, SIDO_SHORT_CASE, with_views
from pricepanel.plans.registry import (COLLECTED_AT, EXPECTED_YEARS, SAMPLE_PARCEL, SAMPLE_ROWS, SNAPSHOT_YEAR,
                                       TOP_K, register)
from pricepanel.schema import SRC_API
from pricepanel.sources import sinks

# ------------------------------------------------------------ normalisers


@register("norm_price", with_views("raw_api") + """
select seq, xp, cast(trunc(cast(replace(trim(pblntfpclnd),',','') as double)) as bigint) as price_per_m2
from raw_api where trim(pblntfpclnd) <> ''""")
def q_norm_price(spark, sf):
    raw = fx.raw_api(spark, sf)
    return raw.where(N.price_text("pblntfPclnd") != "").select(
        "seq", "xp", N.norm_price("pblntfPclnd").alias("price_per_m2"))


@register("norm_month_api", with_views("raw_api") + """
select seq, xp, stdrmt as stdr_mt,
       case when regexp_full_match(trim(stdrmt), '[0-9]+') then cast(trim(stdrmt) as int) else 1 end as stdr_month
from raw_api""")
def q_norm_month_api(spark, sf):
    raw = fx.raw_api(spark, sf)
    return raw.select("seq", "xp", F.col("stdrMt").alias("stdr_mt"), N.norm_month_api("stdrMt").alias("stdr_month"))


@register("norm_month_multi", with_views("months") + f"""
select seq, xp, city_mt, {CITY_MONTH.format(c='city_mt')} as stdr_month from months""")
def q_norm_month_multi(spark, sf):
    m = fx.month_spellings(spark, sf)
    return m.select("seq", "xp", "city_mt", N.norm_month_multi("city_mt").alias("stdr_month"))


@register("norm_month_bulk", with_views("months") + """
select seq, xp, bulk_mt, cast(coalesce(nullif(bulk_mt, ''), '1') as int) as stdr_month from months""")
def q_norm_month_bulk(spark, sf):
    m = fx.month_spellings(spark, sf)
    return m.select("seq", "xp", "bulk_mt", N.norm_month_bulk("bulk_mt").alias("stdr_month"))


@register("norm_bool_yn", with_views("raw_api") + """
select seq, xp, case when trim(stdlandat) = '' then null
                     else upper(trim(stdlandat)) in ('Y','1','TRUE','표준지') end as std_land_yn
from raw_api""")
def q_norm_bool_yn(spark, sf):
    return fx.raw_api(spark, sf).select("seq", "xp", N.norm_bool_yn("stdLandAt").alias("std_land_yn"))


@register("norm_null_if_empty", with_views("raw_api") + """
select seq, xp, nullif(trim(stdlandat), '') as std_land_text, nullif(trim(pblntfde), '') as pblntf_de
from raw_api""")
def q_norm_null_if_empty(spark, sf):
    return fx.raw_api(spark, sf).select("seq", "xp", N.null_if_empty("stdLandAt").alias("std_land_text"),
                                        N.null_if_empty("pblntfDe").alias("pblntf_de"))


@register("norm_schema_coerce", with_views("fact") + f"""
select pnu, stdr_year, stdr_month, price_per_m2, pblntf_de, std_land_yn, source,
       date '{COLLECTED_AT}' as collected_at from fact""")
def q_norm_schema_coerce(spark, sf):
    return N.to_fact_schema(fx.fact(spark, sf), collected_at=COLLECTED_AT)


@register("pnu_parts", with_views("fact") + """
select pnu, substr(pnu,1,2) as sido, substr(pnu,1,5) as sgg, substr(pnu,1,10) as bjd,
       substr(pnu,11,1) as regstr_class, substr(pnu,12,4) as main_no, substr(pnu,16,4) as sub_no
from (select distinct pnu from fact) t""")
def q_pnu_parts(spark, sf):
    return fx.fact(spark, sf).select("pnu").distinct().select("pnu", *P.pnu_parts("pnu"))


@register("region_label", with_views("fact") + f"""
select sido, {SIDO_SHORT_CASE.format(c='sido')} as name
from (select distinct substr(pnu,1,2) as sido from fact) t""")
def q_region_label(spark, sf):
    s = fx.fact(spark, sf).select(P.sido().alias("sido")).distinct()
    return s.select("sido", labels.region_label("sido").alias("name"))


@register("region_label_merged", with_views("fact") + f"""
select sido, {SIDO_BOUNDARY_CASE.replace('substr(pnu,1,2)', 'sido')} as name
from (select distinct substr(pnu,1,2) as sido from fact) t""")
def q_region_label_merged(spark, sf):
    s = fx.fact(spark, sf).select(P.sido().alias("sido")).distinct()
    return s.select("sido", labels.region_label_merged("sido").alias("name"))


@register("region_key", with_views("bjd") + f"""
select sgg, {BOUNDARY_PREFIX_CASE} || '|' || substr(sgg,3,3) as sgg_key
from (select distinct substr(code,1,5) as sgg from bjd) t""")
def q_region_key(spark, sf):
    d = fx.region_codes(spark, sf).select(F.substring("code", 1, 5).alias("sgg")).distinct()
    return d.select("sgg", labels.region_key(F.col("sgg"), F.substring("sgg", 3, 3)).alias("sgg_key"))


# ---------------------------------------------------------------- filters

@register("filter_valid_rows", with_views("raw_api") + """
select seq, xp, source from raw_api where trim(pblntfpclnd)<>'' and trim(pnu)<>'' and trim(stdryear)<>''""")
def q_filter_valid_rows(spark, sf):
    return fx.raw_api(spark, sf).where(N.valid_api_row()).select("seq", "xp", "source")


_EXPORT = "pnu, stdr_year, stdr_month, price_per_m2, pblntf_de, std_land_yn, source"


@register("filter_scope", with_views("fact") + f"""
select {_EXPORT} from fact where stdr_year between 1996 and 2000 and stdr_month = 1
  and substr(pnu,1,2) = '11'""")
def q_filter_scope(spark, sf):
    f = fx.fact_table(spark, sf, y0=1996, y1=2000, regions=("11",)).where(filters.scope(y0=1996, y1=2000, month=1, sido="11"))
    return filters.project_export(f)


@register("filter_scope_sgg_year", with_views("fact") + f"""
select {_EXPORT} from fact where stdr_year = {SNAPSHOT_YEAR} and substr(pnu,1,5) = '26120'""")
def q_filter_scope_sgg_year(spark, sf):
    f = fx.fact_table(spark, sf, years=(SNAPSHOT_YEAR,), regions=("26120",)).where(
        filters.scope(year=SNAPSHOT_YEAR, month=0, sgg="26120", partition_col="sgg"))
    return filters.project_export(f)


_YEAR_SPEC = "1985-1996,1999,2001"


@register("filter_year_spec", with_views("fact") + """
select stdr_year, count(*) as rows from fact where stdr_year between 1990 and 1996 or stdr_year in (1999, 2001)
group by 1""")
def q_filter_year_spec(spark, sf):
    years = filters.parse_year_spec(_YEAR_SPEC)
    return (fx.fact(spark, sf).where(filters.year_in(years))
            .groupBy("stdr_year").agg(F.count(F.lit(1)).alias("rows")))


@register("filter_positive_regular", with_views("fact") + """
select source, stdr_year, count(*) as rows from fact where stdr_month = 1 and price_per_m2 > 0 group by 1, 2""")
def q_filter_positive_regular(spark, sf):
    return (fx.fact(spark, sf).where(filters.positive_regular())
            .groupBy("source", "stdr_year").agg(F.count(F.lit(1)).alias("rows")))


_INCLUDE = ("11110", "26120", "41150", "47140", "27130")


@register("filter_region_in", with_views("fact") + """
select substr(pnu,1,5) as sgg, count(*) as rows from fact
where substr(pnu,1,5) in ('11110','26120','41150','47140','27130') and substr(pnu,1,2) not in ('26')
group by 1""")
def q_filter_region_in(spark, sf):
    return (fx.fact_table(spark, sf, regions=_INCLUDE).where(filters.region_in(_INCLUDE, ("26",), partition_col="sgg"))
            .groupBy("sgg").agg(F.count(F.lit(1)).alias("rows")))


@register("project_export", with_views("fact") + f"select {_EXPORT} from fact")
def q_project_export(spark, sf):
    return filters.project_export(fx.fact(spark, sf))


#: The place of a row in the export's order, in DuckDB text.
PLACE = "row_number() over (order by pnu, stdr_year, stdr_month, source, price_per_m2, pblntf_de nulls first, std_land_yn nulls first) as row_no"


@register("order_export", with_views("fact") + f"""
select {_EXPORT}, {PLACE} from fact where stdr_year between 1990 and 2026 and stdr_month = 1""")
def q_order_export(spark, sf):
    """O3: the rows with their place in the total order."""
    f = fx.fact(spark, sf).where(filters.scope(y0=1990, y1=2026, month=1))
    return sinks.with_position(filters.project_export(f), *sinks.EXPORT_ORDER)


# ---------------------------------------------------------------- reports

_A4 = f"""a4 as (select {SIDO_BOUNDARY_CASE} as name, stdr_year as yr, count(*) as parcels,
       cast(round(avg(price_per_m2) filter (where price_per_m2>0)) as bigint) as avg_p,
       cast(round(median(price_per_m2) filter (where price_per_m2>0)) as bigint) as med_p
from api where stdr_month=1 and {SIDO_BOUNDARY_CASE} is not null group by 1, 2)"""
_WIDE_COLS = ", ".join(f"max(case when yr={y} then med_p end) as med_{y}, max(case when yr={y} then avg_p end) as avg_{y}"
                       for y in EXPECTED_YEARS)
_WIDE = f"wide as (select name, {_WIDE_COLS} from a4 group by name)"


def _wide(spark, sf):
    api = fx.api_rows(spark, sf)
    return stats.region_wide(stats.sido_year(api), stats.data_years(api))


@register("agg_region_wide", with_views("api") + f", {_A4}, {_WIDE} select * from wide")
def q_agg_region_wide(spark, sf):
    return _wide(spark, sf)


_FEATURE_COLS = ", ".join(f"w.med_{y}, w.avg_{y}" for y in EXPECTED_YEARS)


@register("join_region_attributes", with_views("api", "bjd") + f""", {_A4}, {_WIDE},
features as (select distinct {SIDO_BOUNDARY_CASE.replace('substr(pnu,1,2)', 'substr(code,1,2)')} as name from bjd)
select f.name, {_FEATURE_COLS} from features f left join wide w on f.name = w.name where f.name is not null""")
def q_join_region_attributes(spark, sf):
    wide = _wide(spark, sf)
    features = (fx.region_codes(spark, sf)
                .select(labels.region_label_merged(F.substring("code", 1, 2)).alias("name"))
                .where(F.col("name").isNotNull()).distinct())
    return features.join(wide, "name", "left")


@register("agg_unit_rows", with_views("fact") + """
select stdr_year, substr(pnu,1,5) as sgg, source, count(*) as rows from fact group by 1, 2, 3""")
def q_agg_unit_rows(spark, sf):
    return stats.unit_rows(fx.fact(spark, sf))


@register("agg_month_distribution", with_views("raw_api") + """
select trim(coalesce(stdrmt, '?')) as stdr_mt, count(*) as rows from raw_api group by 1""")
def q_agg_month_distribution(spark, sf):
    return stats.month_distribution(fx.raw_api(spark, sf))


@register("agg_year_coverage", with_views("raw_api") + """
select stdryear as stdr_year, count(*) as rows, arg_min(pblntfpclnd, (seq, xp)) as sample_price,
       arg_min(stdrmt, (seq, xp)) as sample_month from raw_api group by 1""")
def q_agg_year_coverage(spark, sf):
    return stats.year_coverage(fx.raw_api(spark, sf))


_A5 = f"""a5 as (select sido, {SIDO_SHORT_CASE.format(c='sido')} as name, parcels, avg_price from (
  select substr(pnu,1,2) as sido, count(*) as parcels,
         cast(round(avg(price_per_m2) filter (where price_per_m2>0)) as bigint) as avg_price
  from api where stdr_year={SNAPSHOT_YEAR} and stdr_month=1 group by 1) t)"""


@register("max_ratio_share", with_views("api") + f""", {_A5}
select *, cast(round(avg_price * 100.0 / max(avg_price) over ()) as bigint) as share_pct from a5""")
def q_max_ratio_share(spark, sf):
    return stats.max_ratio_share(stats.sido_snapshot(fx.fact_table(spark, sf, SRC_API, years=(SNAPSHOT_YEAR,)), SNAPSHOT_YEAR))


@register("region_gap", with_views("api") + f""", {_A5}
select arg_max(name, (avg_price, name)) as top_name, max(avg_price) as top_value,
       arg_min(name, (avg_price, name)) as bottom_name, min(avg_price) as bottom_value,
       cast(round(max(avg_price) * 1.0 / min(avg_price)) as bigint) as gap
from a5 where avg_price is not null""")
def q_region_gap(spark, sf):
    return stats.region_gap(stats.sido_snapshot(fx.fact_table(spark, sf, SRC_API, years=(SNAPSHOT_YEAR,)), SNAPSHOT_YEAR))


@register("series_growth", with_views("api") + """
, a3 as (select stdr_year,
       cast(round(median(price_per_m2) filter (where stdr_month=1 and price_per_m2>0)) as bigint) as med_price
  from api group by 1)
select min(stdr_year) as first_year, max(stdr_year) as last_year,
       arg_min(med_price, stdr_year) as first_value, arg_max(med_price, stdr_year) as last_value,
       cast(round(arg_max(med_price, stdr_year) * 1000.0 / arg_min(med_price, stdr_year)) as bigint)
         as growth_permille
from a3 where med_price is not null""")
def q_series_growth(spark, sf):
    return stats.series_growth(stats.year_price(fx.api_rows(spark, sf)))


@register("series_parcel", with_views("api") + f"""
select stdr_year, max(price_per_m2) as price from api where pnu = '{SAMPLE_PARCEL}' and stdr_month = 1
group by 1""")
def q_series_parcel(spark, sf):
    return stats.series_parcel(fx.fact_table(spark, sf, SRC_API, regions=(SAMPLE_PARCEL,)), SAMPLE_PARCEL, partition_col="sgg")


@register("sample_rows", with_views("city") + f"""
select pnu, stdr_year, price_per_m2 from city where stdr_month = 1
order by ((seq % 1000003) * 48271) % 1000003, seq, xp limit {SAMPLE_ROWS}""")
def q_sample_rows(spark, sf):
    jan = fx.city_rows(spark, sf).where(F.col("stdr_month") == 1)
    return stats.sample_rows(jan, SAMPLE_ROWS, key=stats.sample_key()).select("pnu", "stdr_year", "price_per_m2")


@register("rank_desc", with_views("api") + f"""
select substr(pnu,1,5) as sgg, cast(round(median(price_per_m2)) as bigint) as med_price, count(*) as parcels
from api where stdr_year={SNAPSHOT_YEAR} and stdr_month=1 and price_per_m2>0 group by 1
order by med_price desc, sgg limit {TOP_K}""")
def q_rank_desc(spark, sf):
    return stats.rank_desc(stats.sgg_median(fx.fact_table(spark, sf, SRC_API, years=(SNAPSHOT_YEAR,)), SNAPSHOT_YEAR), "med_price", TOP_K, ("sgg",))


# ------------------------------------------------------------- extensions

@register("code_crosswalk", with_views("api") + """
select stdr_year, case substr(pnu,1,2) when '42' then '51' when '45' then '52' else substr(pnu,1,2) end as sido,
       count(*) as rows from api group by 1, 2""")
def q_code_crosswalk(spark, sf):
    mapping = spark.createDataFrame([("42", "51"), ("45", "52")], "old string, new string")
    cw = codes.crosswalk(fx.api_rows(spark, sf), mapping)
    return cw.groupBy("stdr_year", F.substring("pnu_current", 1, 2).alias("sido")) \
             .agg(F.count(F.lit(1)).alias("rows"))


# Single steps of the code history: a province, a district of it renamed later, a merge, a dong moved by a split and renamed again.
CODE_CHANGES = [("42", "51"), ("45", "52"), ("51110", "51990"), ("12", "46"), ("46170", "46180"), ("26120", "26130"),
                ("2612010221", "2699010900"), ("26990", "26995"), ("2699510900", "2699510901")]


@register("code_succession", with_views("api") + f"""
, rules(old, new) as (values {', '.join(map(str, CODE_CHANGES))}),
c0 as (select distinct substr(pnu,1,10) as code, substr(pnu,1,10) as now from api),
""" + ",\n".join(f"""c{i + 1} as (select code, coalesce(a.new, b.new || substr(now,6), c.new || substr(now,3), now) as now from c{i}
  left join rules a on a.old = now left join rules b on b.old = substr(now,1,5) left join rules c on c.old = substr(now,1,2))""" for i in range(5)) + """
select stdr_year, substr(now,1,5) as sgg, count(*) as rows, count(distinct now || substr(pnu,11)) as parcels
from api join c5 on code = substr(pnu,1,10) group by 1, 2""")
def q_code_succession(spark, sf):
    """Steps closed into chains, then the longest-prefix match over all rows."""
    mapping = codes.code_succession(spark.createDataFrame(CODE_CHANGES, "old string, new string"))
    cw = codes.crosswalk(fx.api_rows(spark, sf), mapping)
    return cw.groupBy("stdr_year", F.substring("pnu_current", 1, 5).alias("sgg")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("pnu_current").alias("parcels"))


_D4 = """select sido || '|' || sigungu as key, sido, sigungu, year, med_price, avg_price, parcels from (
  select substr(pnu,1,2) as sido, {sg} as sigungu, stdr_year as year,
         cast(round(median(price_per_m2)) as bigint) as med_price,
         cast(round(avg(price_per_m2)) as bigint) as avg_price, count(*) as parcels
  from api where stdr_month = 1 and price_per_m2 > 0 group by 1, 2, 3) t"""


@register("summary_sido_year", with_views("api") + _D4.format(sg="''"))
def q_summary_sido_year(spark, sf):
    return stats.summary_region_year(fx.fact_table(spark, sf, SRC_API), "sido")


@register("summary_sgg_year", with_views("api") + _D4.format(sg="substr(pnu,1,5)"))
def q_summary_sgg_year(spark, sf):
    return stats.summary_region_year(fx.fact_table(spark, sf, SRC_API), "sgg")


@register("dedup_file_order", """
select l_orderkey, l_linenumber from (
  select l_orderkey, l_linenumber, row_number() over (partition by l_orderkey order by arrived) as rn
  from (select l_orderkey, l_linenumber, row_number() over () as arrived from lineitem) t) u where rn = 1""")
def q_dedup_file_order(spark, sf):
    """W4 with the real arrival order of a Parquet scan (file, row index).
    The oracle numbers the rows as DuckDB reads them: in file order too."""
    li = revise.with_file_order(fx.table(spark, sf, "lineitem"))
    return revise.dedup_keep_first(li, key=["l_orderkey"], arrival=("_file", "_row")) \
        .select("l_orderkey", "l_linenumber")


_D2_SQL = with_views("api") + f"""
, rates as (select substr({PNU},1,5) as sgg, year(l_shipdate) as stdr_year, month(l_shipdate) as month,
                   (sum(cast(round(l_discount * 100) as bigint)) * 10000) // count(*) - 50000 as rate from lineitem group by 1, 2, 3),
grid as (select sgg, stdr_year, unnest(range(1, 13)) as month from (select distinct sgg, stdr_year from rates) u),
listed as (select sgg, stdr_year, list(case when g.month = 1 then 0 else coalesce(cast(rate as bigint), 0) end order by g.month) as rs
           from grid g left join rates r using (sgg, stdr_year, month) group by 1, 2),
factors as (select sgg, stdr_year, m as month,
                   (list_reduce(rs[1:m], lambda f, r: (f * (10000000 + r) + 5000000) // 10000000, 10000000000) + 5000) // 10000 as ppm
            from listed, range(1, 13) t(m)),
latest as (select * from (
  select *, row_number() over (partition by pnu, stdr_year, stdr_month, source
                               order by coalesce(last_updt_dt,'') desc, seq desc, xp desc) as rn
  from api where stdr_month = 1) t where rn = 1),
months as (select unnest(range(1, 13)) as month)
select l.pnu, l.stdr_year, cast(m.month as int) as month, l.price_per_m2 as base_price, coalesce(f.ppm, 1000000) as factor_ppm,
       (l.price_per_m2 * coalesce(f.ppm, 1000000) + 500000) // 1000000 as price_interp
from latest l, months m left join factors f on f.sgg = substr(l.pnu,1,5) and f.stdr_year = l.stdr_year and f.month = m.month"""


@register("monthly_interpolation", _D2_SQL)
def q_monthly_interpolation(spark, sf):
    """Monthly rates folded in order in whole numbers."""
    factors = stats.cumulative_factors(fx.monthly_rates(spark, sf))
    latest = revise.dedup_latest(fx.api_rows(spark, sf).where(F.col("stdr_month") == 1))
    return stats.monthly_interpolation(latest, factors)
