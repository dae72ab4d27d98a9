"""Every oracle-checked query against its DuckDB SQL (small scale factor)."""
import pytest

import __spark_entry__ as E
from tests.oracle_harness import compare, duck, strict_compare

KEYS = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_every_query_is_registered_with_callable():
    qs = E.queries()
    assert len(qs) >= 54
    assert set(E.oracle_sql()) <= set(qs)
    assert all(callable(f) for f in qs.values())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, sf_small, key):
    res = compare(spark, con, sf_small, key, E.queries()[key], E.oracle_sql()[key])
    assert res["columns_match"], res
    assert res["values_match"], res
    # the same result also matches value for value as plain text via pandas
    assert strict_compare(spark, con, sf_small, E.queries()[key], E.oracle_sql()[key])


@pytest.mark.parametrize("key", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_rows_only_queries_run(spark, sf_small, key):
    assert E.queries()[key](spark, sf_small).count() >= 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["customer_id", "customer_name", "txn_count", "total_amount", "sales_rank"]
    assert 0 < len(rows) <= 10
