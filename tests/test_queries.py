"""Every driver query against DuckDB on the same tables."""

import duckdb
import pytest

from rosterweave.plans import growth_queries, more_queries, queries, rule_queries  # noqa: F401
from tests.conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in at)) for r in rows)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, db, name):
    df, sql = queries.QUERIES[name](spark, SF), db.sql(queries.SQL[name])
    assert sorted(df.columns) == sorted(sql.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(sql.columns, sql.fetchall())


def test_every_query_has_sql():
    assert set(queries.QUERIES) == set(queries.SQL)


def test_no_nested_loop_and_no_python_in_plans(spark):
    """Joins are equi-joins, and hot paths stay in the JVM."""
    for name, query in queries.QUERIES.items():
        plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan, name
        if name not in ("html_to_text", "search_payload", "listing_payload", "page_harvest", "sanitized_records", "person_names", "same_site_links", "page_links", "page_emails"):  # entities, relative links
            assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan, name


def test_filters_and_columns_reach_the_scan(spark):
    plan = queries.QUERIES["delta_one_key"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate)" in plan and "o_totalprice" not in plan


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).schema == entry.entry(spark).schema
