"""Every registered query against its DuckDB SQL on the smallest driver tables."""

import pytest

import __spark_entry__ as E
from corpusprep.plans.catalog import QUERIES
from oracle import compare, duck

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    if name not in SQL:
        assert E.queries()[name](spark, SF).count() >= 0
        return
    r = compare(spark, SF, E.queries()[name], SQL[name], con)
    assert r["cols_match"], r
    assert r["rows"][0] == r["rows"][1], r
    assert r["hash_match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["oare_id", "transliteration_clean", "transliteration_with_annotations"]
