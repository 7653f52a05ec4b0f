"""Every registered query against its SQL, over whole tables; the rest must give rows."""

import __spark_entry__ as entry
import pytest
from compare import compare

QUERIES = entry.queries()
SQL = entry.oracle_sql()


def test_sql_names_are_query_names():
    assert set(SQL) <= set(QUERIES)


def test_entry_gives_all_tiers(spark):
    rows = entry.entry(spark).collect()
    assert [r["risk_label"] for r in sorted(rows, key=lambda r: r["priority"])] == ["critical", "high", "moderate", "low"]
    assert sum(r["count"] for r in rows) == 1000


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf, name):
    assert compare(QUERIES[name](spark, sf), SQL[name], sf) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_gives_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0
