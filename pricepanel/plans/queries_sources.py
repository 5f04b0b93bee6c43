"""Ingest and sink queries: archives, API pages, fact store, exports.

Queries that write put their output under the shared work root
(``spark.checkpoint.dir``) and return the read-back: S7 and the stream into
fresh folders, S6 into the partitioned fact table written once per
application (``fixtures.partitioned_root``), which the S5 scan query also reads.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pricepanel.functions import normalize as N
from pricepanel.operators import audit, filters, stats
from pricepanel.plans import fixtures as fx
from pricepanel.plans import landing
from pricepanel.plans.oracle import CITY_MONTH, SIDO_BOUNDARY_CASE, SIDO_SHORT_CASE, with_views
from pricepanel.plans.queries_reports import PLACE
from pricepanel.plans.registry import COLLECTED_AT, SAMPLE_PARCEL, SNAPSHOT_YEAR, register
from pricepanel.schema import SRC_API, SRC_BULK
from pricepanel.session import work_dir
from pricepanel.sources import api_pages, archives, records, sinks

_CITY_SQL = with_views("raw_api", "months") + f""", c as (
  select trim(r.pnu) as pnu, cast(trim(r.stdryear) as smallint) as stdr_year,
         {CITY_MONTH.format(c='m.city_mt')} as mm,
         cast(trunc(cast(replace(trim(r.pblntfpclnd),',','') as double)) as bigint) as price_per_m2
  from raw_api r join months m on r.seq = m.seq and r.xp = m.xp
  where r.source = 'seoul_opendata' and trim(r.pnu) <> '' and replace(trim(r.pblntfpclnd),',','') <> '')
select pnu, stdr_year, cast(case when mm = 0 then 1 else mm end as tinyint) as stdr_month, price_per_m2 from c"""


def _typed(df):
    return df.select("pnu", F.col("stdr_year").cast("short").alias("stdr_year"),
                     F.col("stdr_month").cast("byte").alias("stdr_month"), "price_per_m2")


def _city(spark, sf):
    return _typed(archives.city_rows(archives.read_zip_csv(spark, landing.city_archives(spark, sf))))


@register("src_zip_csv_keyword", _CITY_SQL)
def q_src_zip_csv_keyword(spark, sf):
    """S1 + N8: cp949 ZIP members, header keywords -> city rows."""
    return _city(spark, sf)


@register("norm_city_row", _CITY_SQL)
def q_norm_city_row(spark, sf):
    return _city(spark, sf)


_BULK_SQL = with_views("raw_api", "months") + """, b as (
  select trim(r.pnu) as pnu, cast(trim(r.stdryear) as smallint) as stdr_year,
         cast(coalesce(nullif(m.bulk_mt, ''), '1') as int) as mm,
         cast(trunc(cast(replace(trim(r.pblntfpclnd),',','') as double)) as bigint) as price_per_m2,
         nullif(trim(r.pblntfde), '') as pblntf_de,
         case when trim(r.stdlandat) = '' then null
              else upper(trim(r.stdlandat)) in ('Y','1','TRUE','표준지') end as std_land_yn
  from raw_api r join months m on r.seq = m.seq and r.xp = m.xp
  where r.source = 'vworld_api' and trim(r.pnu) <> '' and trim(r.pblntfpclnd) <> '')
select pnu, stdr_year, cast(case when mm = 0 then 1 else mm end as tinyint) as stdr_month, price_per_m2,
       pblntf_de, std_land_yn, 'vworld_bulk' as source from b"""


def _bulk(spark, sf):
    rows = archives.bulk_rows(archives.read_zip_csv_positional(spark, landing.bulk_archives(spark, sf)))
    return N.to_fact_schema(rows, source=SRC_BULK).drop("collected_at")


@register("src_zip_csv_positional", _BULK_SQL)
def q_src_zip_csv_positional(spark, sf):
    """S2 + N9: national bulk archives with the header-prefix guard."""
    return _bulk(spark, sf)


@register("norm_bulk_row", _BULK_SQL)
def q_norm_bulk_row(spark, sf):
    return _bulk(spark, sf)


@register("src_region_codes", with_views("country") + """
select code, '동' || code as name, status, status <> '존재' as abolished from country""")
def q_src_region_codes(spark, sf):
    """S3: the EUC-KR tab file of the whole country, with its size guard."""
    codes = archives.load_region_codes(spark, landing.code_archive(spark, sf), work_dir(spark, "region-codes"))
    return codes.select("code", "name", "status", "abolished")


_API_COLS = "pnu, stdr_year, stdr_month, price_per_m2, pblntf_de, std_land_yn, last_updt_dt"


@register("src_api_pages", with_views("api") + f"select {_API_COLS} from api")
def q_src_api_pages(spark, sf):
    """S4 + N7: landed JSON pages -> records -> typed rows."""
    rec = api_pages.parse_api_pages(landing.landed_pages(spark, sf))
    rows = N.norm_api_row(rec)
    return rows.select("pnu", F.col("stdr_year").cast("short").alias("stdr_year"),
                       F.col("stdr_month").cast("byte").alias("stdr_month"),
                       "price_per_m2", "pblntf_de", "std_land_yn", "last_updt_dt")


@register("audit_pagination", with_views("raw_api") + f"""
, p as (select substr(pnu,1,8) as prefix, cast(stdryear as int) as year, cast(floor(seq / 10000) as bigint) as page from raw_api where source = 'vworld_api'),
k as (select *, year = {landing.LOST_PAGES_YEAR} and page % 4 = 1 as lost from p)
select prefix, year, count(*) filter (not lost) as fetched, count(*) as total, count(distinct page) filter (not lost) as pages,
       count(*) filter (lost) as loss
from k group by 1, 2 having count(*) filter (not lost) > 0""")
def q_audit_pagination(spark, sf):
    """Q3: fetched rows per (prefix, year) against the server total, after a sweep that lost pages."""
    return audit.audit_pagination(api_pages.page_summary(landing.pages_with_losses(spark, sf)))


@register("standard_parcel_table", with_views("raw_api") + f"""
, s as (select *, row_number() over (partition by trim(pnu), stdryear order by lastupdtdt desc, seq desc, xp desc) as rn
  from raw_api where source = 'vworld_api' and stdlandat = 'Y' and trim(pnu) <> '' and trim(pblntfpclnd) <> '')
select trim(pnu) as pnu, cast(seq as string) as std_no, cast(stdryear as smallint) as stdr_year,
       cast(trunc(cast(replace(trim(pblntfpclnd),',','') as double)) as bigint) as price_per_m2,
       case when seq % 11 <> 0 then cast((seq % 5000) || '.' || lpad(cast(seq % 100 as string), 2, '0') as decimal(18,2)) end as area_m2,
       ['대','전','임야'][cast(seq % 3 + 1 as int)] as land_category, ['자연녹지지역','제1종일반주거지역'][cast(seq % 2 + 1 as int)] as zoning,
       nullif(['단독','전','상업용','임야',''][cast(seq % 5 + 1 as int)], '') as land_use,
       case when seq % 7 <> 0 then '세로(가)' end as road_side, lastupdtdt as last_updt_dt, 'vworld_api' as source,
       date '{COLLECTED_AT}' as collected_at, substr(trim(pnu),1,5) as sgg
from s where rn = 1""")
def q_standard_parcel_table(spark, sf):
    """D3: landed pages of the second record kind -> its own partitioned table, read back."""
    root = fx.stored_path(spark, sf, "standard_parcels", lambda p: records.ingest_pages(
        landing.landed_standard_pages(spark, sf), records.STANDARD, p, COLLECTED_AT))
    return records.read_records(spark, records.STANDARD, root)


_STORED_SQL = with_views("fact") + f"""
select pnu, stdr_year, stdr_month, price_per_m2, pblntf_de, std_land_yn, source,
       date '{COLLECTED_AT}' as collected_at, substr(pnu,1,5) as sgg from fact"""


@register("sink_partitioned", _STORED_SQL)
def q_sink_partitioned(spark, sf):
    """S6 then S5: partitioned write, whole-table read with schema."""
    return fx.fact_table(spark, sf)


@register("src_fact_scan", with_views("fact") + f"""
select pnu, stdr_year, stdr_month, price_per_m2, pblntf_de, std_land_yn, source,
       date '{COLLECTED_AT}' as collected_at, substr(pnu,1,5) as sgg from fact
where source = 'vworld_api' and stdr_year = {SNAPSHOT_YEAR}""")
def q_src_fact_scan(spark, sf):
    """S5 over the partitioned fact table (written by S6 once per application):
    only the files that the manifest names for the source and the year are opened."""
    return fx.fact_table(spark, sf, SRC_API, years=(SNAPSHOT_YEAR,)).where(F.col("stdr_year") == SNAPSHOT_YEAR)


@register("sink_scoped_csv", with_views("fact") + f"""
select pnu, stdr_year, stdr_month, price_per_m2, pblntf_de, std_land_yn, source, {PLACE} from fact
where stdr_year between 1995 and 2001 and stdr_month = 1 and substr(pnu,1,2) = '41'""")
def q_sink_scoped_csv(spark, sf):
    """Scoped, totally ordered CSV export with the rows' places, read back."""
    path = work_dir(spark, "export_csv")
    sinks.export_csv(fx.fact(spark, sf), path, filters.scope(y0=1995, y1=2001, month=1, sido="41"), position="row_no")
    return sinks.read_export(spark, path, position="row_no")


_A4_JSON = f"""select {SIDO_BOUNDARY_CASE} as name, stdr_year as yr, count(*) as n,
       coalesce(cast(round(avg(price_per_m2) filter (where price_per_m2>0)) as bigint), 0) as avg,
       coalesce(cast(round(median(price_per_m2) filter (where price_per_m2>0)) as bigint), 0) as med
from api where stdr_month=1 and {SIDO_BOUNDARY_CASE} is not null group by 1, 2"""


@register("sink_json_report", with_views("fact", "api") + f"""
, per_year as (select stdr_year as year, count(*) filter (where stdr_month=1) as parcels,
       cast(round(avg(price_per_m2) filter (where stdr_month=1 and price_per_m2>0)) as bigint) as avg,
       cast(round(median(price_per_m2) filter (where stdr_month=1 and price_per_m2>0)) as bigint) as med from api group by 1),
per_sido as (select sido as code, {SIDO_SHORT_CASE.format(c='sido')} as name, parcels, avg from (
  select substr(pnu,1,2) as sido, count(*) as parcels, cast(round(avg(price_per_m2) filter (where price_per_m2>0)) as bigint) as avg
  from api where stdr_year={SNAPSHOT_YEAR} and stdr_month=1 group by 1) t),
sources as (select source, count(*) as rows from fact group by 1),
series as (select stdr_year as year, max(price_per_m2) as price from api where pnu = '{SAMPLE_PARCEL}' and stdr_month = 1 group by 1),
a4 as ({_A4_JSON}),
named as (select name, map_from_entries(list((cast(yr as varchar), struct_pack(n := n, avg := avg, med := med)) order by yr)) as by_year from a4 group by 1)
select 'summary' as section, cast(to_json(struct_pack(rows := count(*), years := count(distinct stdr_year), min_year := min(stdr_year), max_year := max(stdr_year))) as varchar) as json from fact
union all select 'per_year', cast(to_json(list(struct_pack(year := year, parcels := parcels, avg := avg, med := med) order by year)) as varchar) from per_year
union all select 'per_sido', cast(to_json(list(struct_pack(code := code, name := name, parcels := parcels, avg := avg) order by avg desc nulls last, code)) as varchar) from per_sido
union all select 'sources', cast(to_json(list(struct_pack(source := source, rows := rows) order by rows desc, source)) as varchar) from sources
union all select 'sample_parcel', cast(to_json(struct_pack(pnu := '{SAMPLE_PARCEL}', label := '', series := list(struct_pack(year := year, price := price) order by year))) as varchar) from series
union all select 'map_sido', cast(to_json(struct_pack(years := (select list(distinct yr order by yr) from a4), sido := map_from_entries(list((name, by_year) order by name)))) as varchar) from named""")
def q_sink_json_report(spark, sf):
    """Nested report sections as JSON text, in their order and with their nulls."""
    return sinks.report_sections(fx.fact(spark, sf), fx.api_rows(spark, sf), SAMPLE_PARCEL, SNAPSHOT_YEAR)


@register("stream_api_pages", with_views("api") + f"select {_API_COLS} from api")
def q_stream_api_pages(spark, sf):
    """Structured Streaming: landed page files -> records table (append,
    exactly once), run to completion with an available-now trigger."""
    from pricepanel.streaming import pages as stream

    landing_dir = landing.pages_folder(spark, sf)
    records = work_dir(spark, "records")
    q = stream.start_page_ingest(spark, landing_dir, records, work_dir(spark, "stream-ckpt"))
    q.awaitTermination()
    rows = stream.read_records(spark, records)
    return rows.select("pnu", F.col("stdr_year").cast("short").alias("stdr_year"),
                       F.col("stdr_month").cast("byte").alias("stdr_month"),
                       "price_per_m2", "pblntf_de", "std_land_yn", "last_updt_dt")


@register("summary_csv", with_views("api", "country") + f"""
, t as (select substr(pnu,1,2) as c2, substr(pnu,1,5) as c5, stdr_year as year, cast(round(median(price_per_m2)) as bigint) as med_price,
  cast(round(avg(price_per_m2)) as bigint) as avg_price, count(*) as parcels
  from api where stdr_month = 1 and price_per_m2 > 0 group by 1, 2, 3),
named as (select {SIDO_SHORT_CASE.format(c='c2')} as sido, coalesce('동' || code, c5) as sigungu, t.* from t left join country on code = c5 || '00000')
select sido || '|' || sigungu as "키", sido as "시도", sigungu as "시군구", year as "연도", med_price as "중위지가", avg_price as "평균지가", parcels as "필지수"
from named""")
def q_summary_csv(spark, sf):
    """District summary with names as CSV, read back."""
    named = stats.named_summary(stats.summary_region_year(fx.fact_table(spark, sf, SRC_API), "sgg"), _district_names(spark, sf))
    path = work_dir(spark, "summary_csv")
    sinks.export_summary(named, path)
    return sinks.read_summary(spark, path)


def _district_names(spark, sf):
    """(sgg, name) of the landed code file: the codes that end in five zeros."""
    codes = archives.read_region_codes(spark, landing.code_archive(spark, sf)).where(F.col("code").endswith("00000"))
    return codes.select(F.substring("code", 1, 5).alias("sgg"), "name")
