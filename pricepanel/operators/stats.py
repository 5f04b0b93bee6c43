"""Statistics over the fact table.

Every measure of one report is one ``agg`` with conditional inputs, so a
single scan and a single (map-side combined) shuffle feed all of them.
Medians (interpolated, equal to DuckDB ``median``) default to
``distributed_median``: exact, and no group's values are gathered into one
task. ``distributed=False`` uses Spark's ``median`` instead (one aggregate;
its buffer is a distinct price -> count map per group, merged in one task
per group), ``exact=False`` the bounded ``percentile_approx`` sketch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricepanel.functions.labels import region_label, region_label_merged
from pricepanel.functions.pnu import region_prefix_filter, sgg, sido
from pricepanel.operators.joins import maybe_broadcast

PRICE = "price_per_m2"
PPM = 1_000_000


def median(c: Column, exact: bool = True, accuracy: int = 10000) -> Column:
    return F.median(c) if exact else F.percentile_approx(c, 0.5, accuracy)


def rounded(c: Column) -> Column:
    """Round half away from zero to a whole number (as a long)."""
    return F.round(c).cast("long")


def _regular() -> Column:
    return F.col("stdr_month") == 1


def _positive() -> Column:
    return F.col(PRICE) > 0


def _price_report(df: DataFrame, keys: dict[str, Column], counted: Column, population: Column,
                  names: tuple[str, str, str], exact: bool, distributed: bool) -> DataFrame:
    """Per group: rows ``counted``, rounded mean and median price of the rows
    in ``population``, under the three ``names``.

    The distributed form counts the rows per (group, price) once; the mean
    and the median both read that shuffle, so the input is scanned once.
    """
    n_name, avg_name, med_name = names
    counted = F.coalesce(counted, F.lit(False))
    rows = df.select(*[c.alias(k) for k, c in keys.items()], counted.alias("_in"),
                     F.when(population, F.col(PRICE)).alias("_v"))
    if not exact or not distributed:
        return rows.groupBy(*keys).agg(F.count_if("_in").alias(n_name), rounded(F.avg("_v")).alias(avg_name),
                                       rounded(median(F.col("_v"), exact)).alias(med_name))
    # One struct as the key: structs with null fields are equal in joins, null columns are not.
    counts = rows.groupBy(F.struct(*keys).alias("_g"), "_in", "_v").agg(F.count(F.lit(1)).alias("_n"))
    valued = F.when(F.col("_v").isNotNull(), F.col("_n"))
    base = counts.groupBy("_g").agg(F.coalesce(F.sum(F.when(F.col("_in"), F.col("_n"))), F.lit(0).cast("long")).alias(n_name),
                                    rounded(F.sum(F.col("_v") * F.col("_n")) / F.sum(valued)).alias(avg_name))
    out = base.join(_median_of_counts(counts), "_g", "left")
    return out.select(*[F.col("_g")[k].alias(k) for k in keys], n_name, avg_name,
                      rounded(F.col("_median")).alias(med_name))


def data_years(df: DataFrame) -> list[int]:
    """The years present in the data, ascending (a few dozen at most)."""
    return sorted(r[0] for r in df.select("stdr_year").where("stdr_year is not null").distinct().collect())


def overall(df: DataFrame) -> DataFrame:
    """A1: rows, distinct years, first and last year."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_distinct("stdr_year").alias("n_years"),
                  F.min("stdr_year").alias("min_year"),
                  F.max("stdr_year").alias("max_year"))


def year_summary(df: DataFrame) -> DataFrame:
    """A2: per year rows, provinces, July rows, min / avg / max price."""
    return df.groupBy("stdr_year").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(sido()).alias("n_sido"),
        F.count_if(F.col("stdr_month") == 7).alias("july_rows"),
        F.min(PRICE).alias("min_price"),
        rounded(F.avg(PRICE)).alias("avg_price"),
        F.max(PRICE).alias("max_price"))


def year_price(df: DataFrame, exact: bool = True, distributed: bool = True) -> DataFrame:
    """A3: per year regular-month parcels, mean and median positive price."""
    return _price_report(df, {"stdr_year": F.col("stdr_year")}, _regular(), _regular() & _positive(),
                         ("parcels", "avg_price", "med_price"), exact, distributed)


def sido_year(df: DataFrame, exact: bool = True, distributed: bool = True) -> DataFrame:
    """A4: merged boundary region x year: parcels, mean, median (month 1).

    Codes without a boundary name (e.g. 12) are dropped.
    """
    name = region_label_merged(sido())
    return _price_report(df.where(_regular() & name.isNotNull()), {"name": name, "yr": F.col("stdr_year")},
                         F.lit(True), _positive(), ("parcels", "avg_p", "med_p"), exact, distributed)


def sido_snapshot(df: DataFrame, year: int) -> DataFrame:
    """A5: one year, month 1: parcels and positive mean by sido, mean desc."""
    out = (df.where((F.col("stdr_year") == year) & _regular())
           .groupBy(sido().alias("sido"))
           .agg(F.count(F.lit(1)).alias("parcels"),
                rounded(F.avg(F.when(_positive(), F.col(PRICE)))).alias("avg_price")))
    return out.select("sido", region_label(F.col("sido")).alias("name"), "parcels", "avg_price") \
              .orderBy(F.col("avg_price").desc_nulls_last(), "sido")


def sgg_median(df: DataFrame, year: int, exact: bool = True, distributed: bool = True) -> DataFrame:
    """One year, month 1, positive prices: median and count by sgg."""
    jan = df.where((F.col("stdr_year") == year) & _regular() & _positive())
    out = _price_report(jan, {"sgg": sgg()}, F.lit(True), F.lit(True),
                        ("parcels", "avg_price", "med_price"), exact, distributed)
    return out.select("sgg", "med_price", "parcels").orderBy(F.col("med_price").desc(), "sgg")


def source_mix(df: DataFrame) -> DataFrame:
    """Rows by source, largest first."""
    return df.groupBy("source").agg(F.count(F.lit(1)).alias("rows")).orderBy(F.col("rows").desc())


def region_wide(long: DataFrame, years: Sequence[int], key: str = "name",
                year: str = "yr", med: str = "med_p", avg: str = "avg_p") -> DataFrame:
    """Long (key, year, med, avg) -> wide ``med_YYYY`` / ``avg_YYYY``.

    The year list is passed explicitly, so Spark skips the distinct-values
    job; years without data stay NULL.
    """
    wide = (long.groupBy(key).pivot(year, list(years))
            .agg(F.first(med).alias("med"), F.first(avg).alias("avg")))
    renamed = [F.col(key)]
    for y in years:
        renamed += [F.col(f"{y}_med").alias(f"med_{y}"), F.col(f"{y}_avg").alias(f"avg_{y}")]
    return wide.select(*renamed)


def unit_rows(df: DataFrame, by_source: bool = True) -> DataFrame:
    """Rows per (year, sgg[, source]) unit -- the load checkpoint."""
    keys = [F.col("stdr_year"), sgg().alias("sgg")] + ([F.col("source")] if by_source else [])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))


def month_distribution(raw: DataFrame, month: str = "stdrMt") -> DataFrame:
    """Rows by raw (stripped) month text, over the whole input."""
    from pricepanel.functions.normalize import strip
    m = strip(F.coalesce(F.col(month), F.lit("?")))
    return raw.groupBy(m.alias("stdr_mt")).agg(F.count(F.lit(1)).alias("rows"))


def year_coverage(raw: DataFrame, year: str = "stdrYear", order: Sequence[str] = ("seq", "xp")) -> DataFrame:
    """Per year rows plus the first record's price and month text.

    "First" is the minimum of an explicit order key (``min_by``), so the
    sample is deterministic and combines map-side.
    """
    o = F.struct(*order)
    return raw.groupBy(F.col(year).alias("stdr_year")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min_by("pblntfPclnd", o).alias("sample_price"),
        F.min_by("stdrMt", o).alias("sample_month"))


def max_ratio_share(agg: DataFrame, value: str = "avg_price") -> DataFrame:
    """Value as a percentage of the largest value (bar length).

    Applied to a per-region aggregate (tens of rows), so the global window
    holds a bounded frame.
    """
    w = Window.partitionBy()
    return agg.withColumn("share_pct", rounded(F.col(value) * 100.0 / F.max(value).over(w)))


def series_growth(per_year: DataFrame, value: str = "med_price", year: str = "stdr_year") -> DataFrame:
    """first/last year of a series and last/first ratio (x1000)."""
    v = per_year.where(F.col(value).isNotNull())
    return v.agg(F.min(year).alias("first_year"), F.max(year).alias("last_year"),
                 F.min_by(value, year).alias("first_value"),
                 F.max_by(value, year).alias("last_value")) \
            .withColumn("growth_permille",
                        rounded(F.col("last_value") * 1000.0 / F.col("first_value")))


def region_gap(per_region: DataFrame, value: str = "avg_price", name: str = "name") -> DataFrame:
    """Highest and lowest regional mean, names and their ratio."""
    v = per_region.where(F.col(value).isNotNull())
    return v.agg(F.max_by(name, F.struct(value, name)).alias("top_name"),
                 F.max(value).alias("top_value"),
                 F.min_by(name, F.struct(value, name)).alias("bottom_name"),
                 F.min(value).alias("bottom_value")) \
            .withColumn("gap", rounded(F.col("top_value") / F.col("bottom_value")))


def series_parcel(df: DataFrame, pnu: str, month: int = 1,
                  partition_col: str | None = None) -> DataFrame:
    """O1: one parcel's yearly price (max over revisions), by year.

    The point predicate is ``pnu = x`` plus a pushed-down prefix filter,
    which prunes the ``sgg`` partition when the table has one.
    """
    pred = region_prefix_filter(pnu[:5], "pnu", partition_col) & (F.col("pnu") == pnu)
    return (df.where(pred & (F.col("stdr_month") == month))
            .groupBy("stdr_year").agg(F.max(PRICE).alias("price"))
            .orderBy("stdr_year"))


def sample_key(seq: str = "seq", modulus: int = 1_000_003, mult: int = 48271) -> Column:
    """Portable pseudo-random order key (Lehmer step), same in any SQL."""
    return F.pmod(F.pmod(F.col(seq), F.lit(modulus)) * mult, F.lit(modulus))


def sample_rows(df: DataFrame, n: int, key: Column | None = None,
                ties: Sequence[str] = ("seq", "xp")) -> DataFrame:
    """O2: deterministic sample of ``n`` rows (``TakeOrderedAndProject``:
    each task keeps its own top ``n``, the driver merges ``n`` per task)."""
    k = key if key is not None else F.xxhash64(*[F.col(c) for c in ties])
    return df.orderBy(k, *ties).limit(n)


def rank_desc(agg: DataFrame, by: str, k: int, ties: Sequence[str] = ()) -> DataFrame:
    """Top-k of an aggregate by a measure, largest first."""
    return agg.orderBy(F.col(by).desc_nulls_last(), *ties).limit(k)


def summary_region_year(df: DataFrame, level: str = "sido", exact: bool = True,
                        distributed: bool = True) -> DataFrame:
    """Median / mean / count by region and year (month 1, positive).

    ``level='sido'`` uses the 2-digit code, ``'sgg'`` the 5-digit code;
    ``key`` is ``sido|sgg`` (sgg empty at province level).
    """
    sg = F.lit("") if level == "sido" else sgg()
    keys = {"sido": sido(), "sigungu": sg, "year": F.col("stdr_year")}
    out = _price_report(df.where(_regular() & _positive()), keys, F.lit(True), F.lit(True),
                        ("parcels", "avg_price", "med_price"), exact, distributed)
    return out.select(F.concat_ws("|", "sido", "sigungu").alias("key"), "sido", "sigungu", "year",
                      "med_price", "avg_price", "parcels")


def named_summary(summary: DataFrame, districts: DataFrame) -> DataFrame:
    """D4 with names: province labels and, from ``districts(sgg, name)``, district
    names in the place of codes (a code without a name stays); the key follows."""
    known = districts.groupBy(F.col("sgg").alias("sigungu")).agg(F.min("name").alias("_name"))
    out = summary.join(known, "sigungu", "left").withColumns({
        "sido": region_label(F.col("sido")), "sigungu": F.coalesce("_name", "sigungu")})
    return out.select(F.concat_ws("|", "sido", "sigungu").alias("key"), "sido", "sigungu", "year", "med_price", "avg_price", "parcels")


#: Rates are whole 1/RATE_SCALE; factors are compounded in whole 1/FACTOR_SCALE (up to 90-fold) and told in PPM.
RATE_SCALE, FACTOR_SCALE = 10**7, 10**10


def cumulative_factors(rates: DataFrame, months: int = 12) -> DataFrame:
    """D2 helper: per (sgg, year) the compounded change since month 1.

    ``rates(sgg, stdr_year, month, rate_e7)`` holds monthly change rates as whole
    ten-millionths, one a month; missing months count as 0 and month 1 is the
    base (factor 1). The months of a district-year (12 numbers) are folded in
    order in whole numbers, halves rounded up, so every engine gets the same
    factor. Factors are whole parts per million (``factor_ppm``).
    """
    by_month = rates.where(F.col("month").between(2, months) & F.col("rate_e7").isNotNull())
    units = rates.select("sgg", "stdr_year").distinct()
    listed = by_month.groupBy("sgg", "stdr_year").agg(F.map_from_entries(F.collect_list(F.struct(F.col("month").cast("int"), F.col("rate_e7").cast("bigint")))).alias("rates"))
    start = F.array(F.lit(FACTOR_SCALE).cast("bigint"))

    def compounded(done, month):
        rate = F.coalesce(F.get(F.array(F.try_element_at("rates", month)), F.lit(0)), F.lit(0).cast("bigint"))
        return F.array_append(done, _div(F.element_at(done, -1) * (rate + RATE_SCALE) + RATE_SCALE // 2, RATE_SCALE))

    factors = F.aggregate(F.sequence(F.lit(2), F.lit(months)), start, compounded)
    folded = units.join(listed, ["sgg", "stdr_year"], "left").select("sgg", "stdr_year", F.posexplode(factors).alias("at", "factor"))
    step = FACTOR_SCALE // PPM
    return folded.select("sgg", "stdr_year", (F.col("at") + 1).alias("month"), _div(F.col("factor") + step // 2, step).alias("factor_ppm"))


def _div(number: Column, by: int) -> Column:
    """Whole quotient of a positive number."""
    return F.call_function("div", number, F.lit(by).cast("bigint"))


def monthly_interpolation(regular: DataFrame, factors: DataFrame, max_factor_rows: int = 2_000_000) -> DataFrame:
    """Monthly price series = regular (month 1) price x compounded
    district change rate, one row per parcel, year and month; stored
    apart from the official prices. Keyed 1:12 expansion on (sgg, year).

    The factor table (12 rows per district-year) is broadcast after its
    size check, so a district-year holding a third of the parcels is
    expanded where it is read instead of in one reducer.
    """
    base = regular.where(F.col("stdr_month") == 1).select(
        "pnu", sgg().alias("sgg"), "stdr_year", F.col(PRICE).alias("base_price"))
    j = base.join(maybe_broadcast(factors, max_factor_rows), ["sgg", "stdr_year"], "left")
    # a district-year without rates keeps its price for all months
    months = F.when(F.col("month").isNull(), F.sequence(F.lit(1), F.lit(12))).otherwise(F.array("month"))
    j = j.withColumn("month", F.explode(months)).withColumn("factor_ppm", F.coalesce("factor_ppm", F.lit(PPM).cast("long")))
    price = F.expr(f"(base_price * factor_ppm + {PPM // 2}) div {PPM}")
    return j.select("pnu", "stdr_year", "month", "base_price", "factor_ppm", price.alias("price_interp"))


def _value_bucket(v: Column, per_octave: int = 64) -> Column:
    """Monotone bucket of a number: ``per_octave`` log-scale buckets per
    power of two (each ~1.1 % wide), sign-aware, 0 on its own.

    ``log`` is semi-monotonic, so larger values never get smaller buckets.
    """
    # no double is below 2**-1074, so fractions get positive buckets too
    mag = F.floor((F.log2(F.abs(v)) + 1075) * per_octave).cast("long") + 1
    return F.when(v > 0, mag).when(v == 0, F.lit(0).cast("long")).otherwise(-mag)


def distributed_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median") -> DataFrame:
    """Exact median per group (interpolated, same as ``median``) without
    gathering a group's values into one task.

    1. rows per (group, value) -- a map-side combined aggregate, the only
       shuffle of the input -- summed up per (group, value bucket);
    2. a window over the buckets of each group (bounded by the bucket
       count) finds the bucket holding each middle rank;
    3. only the values of those buckets are ranked (a bucket spans ~1.1 %
       of the value range; repeated values arrive as counts).
    A group holding a third of all rows is just larger counts here.
    """
    named = list(keys)
    group = F.struct(*named) if named else F.struct(F.lit(0).alias("_all"))
    v = df.where(F.col(value).isNotNull()).select(group.alias("_g"), F.col(value).alias("_v"))
    found = _median_of_counts(v.groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_n")))
    return found.select(*[F.col("_g")[k].alias(k) for k in named], F.col("_median").alias(out))


#: Bucket of rows without a value. It is a value and not null, so that no null filter is pushed
#: below the counts and every reader of the counts shares one shuffle.
_NO_BUCKET = -2**62


def _median_of_counts(counts: DataFrame) -> DataFrame:
    """(_g, _median) from the rows ``_n`` per group ``_g`` (a struct) and
    value ``_v``; null values don't count, groups without values are absent."""
    bucketed = counts.select("_g", "_v", F.when(F.col("_v").isNotNull(), F.col("_n")).otherwise(F.lit(0)).alias("_n"),
                             F.coalesce(_value_bucket(F.col("_v")), F.lit(_NO_BUCKET)).alias("_b"))
    per_bucket = bucketed.groupBy("_g", "_b").agg(F.sum("_n").alias("_c"))
    group = Window.partitionBy("_g")
    before = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    located = per_bucket.select("_g", "_b", "_c", F.sum("_c").over(group).alias("_all"),
                                F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"))
    middle = F.array(F.floor((F.col("_all") - 1) / 2), F.ceil((F.col("_all") - 1) / 2))
    local = F.filter(F.transform(middle, lambda r: r.cast("long") - F.col("_before")), lambda r: (r >= 0) & (r < F.col("_c")))
    wanted = located.select("_g", "_b", local.alias("_ranks")).where(F.size("_ranks") > 0)
    inside = Window.partitionBy("_g", "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = bucketed.join(wanted, ["_g", "_b"]).select(
        "_g", "_v", "_n", "_ranks", F.coalesce(F.sum("_n").over(inside), F.lit(0)).alias("_at"))
    hits = F.size(F.filter("_ranks", lambda r: (r >= F.col("_at")) & (r < F.col("_at") + F.col("_n"))))
    return (ranked.select("_g", F.col("_v").cast("double").alias("_v"), hits.alias("_hits")).where("_hits > 0")
            .groupBy("_g").agg((F.sum(F.col("_v") * F.col("_hits")) / 2).alias("_median")))


def year_price_distributed(df: DataFrame) -> DataFrame:
    """A3 with the distributed exact median (for very large years)."""
    return year_price(df, distributed=True)
