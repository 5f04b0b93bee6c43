"""Every registered query against its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as entry
from pricepanel.plans import catalog
from pricepanel.plans.compare import compare, duck_connect

SF = "/root/testdata/sf0.001"
QUERIES = catalog.queries()
ORACLE = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name not in ORACLE:
        assert df.count() >= 0
        return
    res = compare(df, ORACLE[name], con)
    assert res["ok"], res


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields] == ["stdr_year", "parcels", "avg_price", "med_price"]
