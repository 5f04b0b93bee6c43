"""Region-code leaf rules (A9-A11, J4) and coverage."""

from pricepanel.operators import codes, coverage


def _codes(spark, rows):
    return spark.createDataFrame(rows, "code string, status string, abolished boolean")


def test_leaf_codes_both_modes(spark):
    rows = [("1111000000", "존재", False), ("1111010100", "존재", False),
            ("4182025000", "존재", False), ("4182025021", "존재", False),
            ("4182026000", "존재", False), ("4182026021", "폐지", True)]
    df = _codes(spark, rows)
    all_ = {r.code for r in codes.leaf_codes(df).collect()}
    active = {r.code for r in codes.leaf_codes(df, include_abolished=False).collect()}
    assert all_ == {"1111010100", "4182025021", "4182026021"}
    assert active == {"1111010100", "4182025021", "4182026000"}


def test_codes_and_prefixes_by_sgg(spark):
    df = _codes(spark, [("4182025021", "존재", False), ("4182025022", "존재", False), ("4182031000", "존재", False)])
    leaves = codes.leaf_codes(df)
    r = codes.codes_by_sgg(leaves).collect()[0]
    assert (r.sgg, r.n_codes, r.codes) == ("41820", 3, "4182025021,4182025022,4182031000")
    p = codes.prefixes_by_sgg(leaves).collect()[0]
    assert (p.n_prefixes, p.prefixes) == (2, "41820250,41820310")


def test_crosswalk_longest_prefix(spark):
    df = spark.createDataFrame([("4211012345",), ("4511000000",), ("1111000000",)], "pnu string")
    mp = spark.createDataFrame([("42", "51"), ("42110", "51999"), ("45", "52")], "old string, new string")
    got = {r.pnu: r.pnu_current for r in codes.crosswalk(df, mp).collect()}
    assert got == {"4211012345": "5199912345", "4511000000": "5211000000", "1111000000": "1111000000"}


def test_units_todo_with_empty_page(spark):
    districts = spark.createDataFrame([("11110",), ("11140",)], "sgg string")
    grid = coverage.unit_grid(districts, [1990, 1991])
    fact = spark.createDataFrame([("1111010100100010000", 1990)], "pnu string, stdr_year short")
    empty = spark.createDataFrame([("11140", 1990)], "sgg string, stdr_year int")
    done = coverage.done_units(fact, empty)
    todo = sorted(tuple(r) for r in coverage.units_todo(grid, done).collect())
    assert todo == [("11110", 1991), ("11140", 1991)]
    assert sorted(tuple(r) for r in coverage.empty_units(grid, fact).collect()) == \
        [("11110", 1991), ("11140", 1990), ("11140", 1991)]
    r = coverage.coverage_ratio(grid, done).collect()[0]
    assert (r.done_units, r.total_units, r.rows, r.done_permille) == (2, 4, 1, 500)


def test_zero_total_pages_mark_units_done(spark):
    from pricepanel.sources import api_pages
    pages = spark.createDataFrame(
        [("11140101", 1990, 1, '{"indvdLandPrices":{"resultCode":"OK","totalCount":"0"}}'),
         ("11110101", 1990, 1, '{"indvdLandPrices":{"totalCount":"1","field":{"pnu":"1111010100100010000"}}}')],
        "prefix string, year int, page_no int, body string")
    empty = api_pages.zero_total_units(pages)
    assert [tuple(r) for r in empty.collect()] == [("11140", 1990)]
    districts = spark.createDataFrame([("11110",), ("11140",)], "sgg string")
    fact = spark.createDataFrame([("1111010100100010000", 1990)], "pnu string, stdr_year short")
    todo = coverage.units_todo(coverage.unit_grid(districts, [1990]), coverage.done_units(fact, empty))
    assert todo.count() == 0
