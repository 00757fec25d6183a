"""Every registered query against its DuckDB oracle (sf0.001), and the
rows-only queries for a clean run."""

import pytest

from ladle.plans import oracle_sql, queries
from tests.conftest import SMALL
from tests.oracle_check import compare

ORACLE = sorted(oracle_sql())
ROWS_ONLY = sorted(set(queries()) - set(ORACLE))


def test_every_query_has_a_name_and_callable():
    qs = queries()
    assert len(qs) >= 50
    assert set(oracle_sql()) <= set(qs)


@pytest.mark.parametrize("name", ORACLE)
def test_oracle_match(spark, name):
    res = compare(spark, SMALL, [name], verbose=False)[name]
    assert res.startswith("ok"), res


def test_every_query_has_an_oracle():
    assert ROWS_ONLY == []


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["recipecategory", "n", "recipeid", "name", "images", "review_count"]
