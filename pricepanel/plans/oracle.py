"""DuckDB text of the fixture views, for the oracle side of each query.

These mirror ``plans.fixtures`` (same formulas, DuckDB dialect): DuckDB
rounds double -> bigint, so prices are truncated explicitly, and its
``trim`` is enough here because the fixture only pads with spaces.
"""

from __future__ import annotations

from pricepanel.functions.labels import BOUNDARY_PREFIX_SHORT, SIDO_BOUNDARY, SIDO_SHORT
from pricepanel.functions.normalize import CITY_MONTH_PATTERN
from pricepanel.plans.fixtures import SIDO_CODES

_SIDO = "([" + ", ".join(f"'{c}'" for c in SIDO_CODES) + "])"

PNU = (f"{_SIDO}[cast(1+(l_suppkey%20) as int)]"
       " || lpad(cast(110+10*(l_suppkey%7) as string),3,'0')"
       " || lpad(cast(101+(l_suppkey%9) as string),3,'0')"
       " || lpad(cast(21*(l_partkey%2) as string),2,'0') || '1'"
       " || lpad(cast(l_partkey%50 as string),4,'0') || lpad(cast(l_suppkey%100 as string),4,'0')")

RAW_API = f"""
select case when l_suppkey%37=5 then substr({PNU},1,17) || '가' else {PNU} end as pnu,
 cast(year(l_shipdate) as string) as stdryear,
 case l_linenumber when 1 then '01' when 2 then '1' when 3 then ' 7 ' when 4 then '07' when 5 then '' when 6 then 'x'
      else case when l_discount=0.05 then '3' else '00' end end as stdrmt,
 case when l_tax=0.0 then '' when l_discount=0.1 then '0'
      else cast(cast(l_quantity as int)*(year(l_shipdate)-1990) as string) || ',' || '500.9 ' end as pblntfpclnd,
 cast(cast(l_shipdate as date) as string) as pblntfde,
 case l_returnflag when 'A' then 'Y' when 'R' then 'n' else '' end as stdlandat,
 cast(cast(l_shipdate as date) as string) as lastupdtdt,
 case when l_linestatus='F' then 'vworld_api' else 'seoul_opendata' end as source,
 l_orderkey*10+l_linenumber as seq, l_extendedprice as xp
from lineitem"""

FACT = """
select pnu, cast(y as smallint) as stdr_year, cast(case when m=0 then 1 else m end as tinyint) as stdr_month,
       price_per_m2, pblntf_de, std_land_yn, source, lastupdtdt as last_updt_dt, seq, xp
from (select pnu, cast(stdryear as int) as y,
        case when regexp_full_match(trim(stdrmt), '[0-9]+') then cast(trim(stdrmt) as int) else 1 end as m,
        cast(trunc(cast(replace(trim(pblntfpclnd),',','') as double)) as bigint) as price_per_m2,
        nullif(trim(pblntfde),'') as pblntf_de,
        case when trim(stdlandat)='' then null else upper(trim(stdlandat)) in ('Y','1','TRUE','표준지') end as std_land_yn,
        source, lastupdtdt, seq, xp
      from raw_api where trim(pblntfpclnd)<>'' and trim(pnu)<>'' and trim(stdryear)<>'') t"""

API = "select * from fact where source='vworld_api'"
CITY = "select * from fact where source='seoul_opendata'"

BJD = f"""
select code, max(status) as status, max(status) <> '존재' as abolished from (
 select {_SIDO}[cast(1+(p_partkey%20) as int)]
   || lpad(cast(110+10*(p_partkey%7) as string),3,'0')
   || case when p_partkey%11=0 then '000' else lpad(cast(101+(p_partkey%9) as string),3,'0') end
   || case when p_partkey%3=0 then '00' else lpad(cast(21+(p_partkey%5) as string),2,'0') end as code,
   case when p_size%5=0 then '폐지' else '존재' end as status
 from part) t group by code"""

COUNTRY = f"""
select sgg || case when e = 0 then '000' else lpad(cast(100 + e as string), 3, '0') end
           || case when r = 0 then '00' else lpad(cast(20 + r as string), 2, '0') end as code,
       case when (size + e + r) % 5 = 0 then '폐지' else '존재' end as status
from (select {_SIDO}[cast(1+(p_partkey%20) as int)] || lpad(cast(110+10*(p_partkey%7) as string),3,'0') as sgg, sum(p_size) as size
      from part group by 1) d, range(10) t(e), range(9) u(r)"""

VIEWS = {"raw_api": RAW_API, "fact": FACT, "api": API, "city": CITY, "bjd": BJD, "country": COUNTRY}
ORDER = ["raw_api", "fact", "api", "city", "bjd", "country"]


def with_views(*names: str) -> str:
    """``WITH`` prefix defining the named fixture views (and their inputs)."""
    need = set(names)
    if need & {"fact", "api", "city"}:
        need |= {"raw_api", "fact"}
    parts = [f"{n} as ({VIEWS[n]})" for n in ORDER if n in need]
    return "with " + ",\n".join(parts) + "\n"


# SQL text shared by several queries.
def case_sql(names: dict[str, str], code: str, otherwise: str = "null") -> str:
    """A literal map of ``functions.labels`` as a SQL CASE over ``code``."""
    whens = " ".join(f"when '{k}' then '{v}'" for k, v in names.items())
    return f"case {code} {whens} else {otherwise} end"


SIDO_BOUNDARY_CASE = case_sql(SIDO_BOUNDARY, "substr(pnu,1,2)")
SIDO_SHORT_CASE = case_sql(SIDO_SHORT, "{c}", "{c}")
BOUNDARY_PREFIX_CASE = case_sql(BOUNDARY_PREFIX_SHORT, "substr(sgg,1,2)")

MONTHS = """
select l_orderkey*10+l_linenumber as seq, l_extendedprice as xp,
  case l_linenumber when 1 then cast(cast(l_shipdate as date) as string)
       when 2 then strftime(l_shipdate, '%Y%m')
       when 3 then cast(month(l_shipdate) as string)
       when 4 then cast(year(l_shipdate) as string) || '.' || cast(month(l_shipdate) as string)
       when 5 then '' when 6 then 'abc'
       else lpad(cast(month(l_shipdate) as string), 2, '0') end as city_mt,
  case when l_linenumber % 2 = 0 then '' else cast(month(l_shipdate) as string) end as bulk_mt
from lineitem"""
VIEWS["months"] = MONTHS
ORDER.append("months")

# N3 in DuckDB text, for a column named {c}; the pattern is the normaliser's.
_MONTH = "regexp_extract(trim({c}), '" + CITY_MONTH_PATTERN.replace("{", "{{").replace("}", "}}") + "', 1)"
CITY_MONTH = f"""case when {_MONTH} <> '' then cast({_MONTH} as int)
     when length(trim({{c}})) >= 6 and regexp_full_match(trim({{c}}), '[0-9]+') then cast(substr(trim({{c}}),5,2) as int)
     when regexp_full_match(trim({{c}}), '[0-9]{{{{1,2}}}}') then cast(trim({{c}}) as int)
     else 1 end"""
