"""Driver queries against DuckDB on rows that the small tables do not hold."""

import duckdb
import pytest

from rosterweave.functions import names
from rosterweave.operators import similarity
from rosterweave.plans import growth_queries, more_queries, queries, rule_queries  # noqa: F401
from tests.conftest import SF
from tests.test_queries import rows_of


@pytest.fixture
def agrees(spark, tmp_path):
    """Runs a query and its SQL over tables of the rows given, and returns Spark's rows."""

    def run(name, **tables):
        con = duckdb.connect()
        for t, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{t}.parquet")
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
        df, sql = queries.QUERIES[name](spark, str(tmp_path)), con.sql(queries.SQL[name])
        got = [tuple(r) for r in df.collect()]
        assert rows_of(df.columns, got) == rows_of(sql.columns, sql.fetchall())
        return got

    return run


def test_html_to_text_leaves_unclosed_entities(agrees):
    pages = ["<h1>Tea &amp; cake &amp</h1><p>&quot;a&quot b &copy 1 &copy; 2 &middot;</p>", "<p>&amp;quot; &am</p><td>x\u2009y\u00a0 z\u3000</td>", None, "", "<p>&amp;amp;copy;&lt;b&gt;</p>"]
    got = dict(agrees("html_to_text", pages=(list(enumerate(pages)), "page_id long, html string")))
    assert got[0] == 'Tea & cake &amp\n"a&quot b &copy 1 © 2 ·' and got[2] is None and got[3] == ""


def test_split_addresses_keeps_numbers_with_zeros(agrees):
    got = dict(agrees("split_addresses", supplier=([(k,) for k in (0, 1, 2, 3, 10000, 20000, 50001, 100000, 100001, 100002, 100003, 1000000)], "s_suppkey long")))
    assert got[10000] == "sales10000@firm.dk" and got[100001] == "info@firm100001.dk" and got[100002] == ""


def test_similar_names_meet_few_others(spark, monkeypatch):
    """Numbered names have a thousand grams between them: under pairs of frequent ones, a name meets fewer than 80 of 40,000, similar ones more than once."""
    made, landed = {}, similarity.landed
    monkeypatch.setattr(similarity, "landed", lambda df, path: made.setdefault(path.rsplit("/", 1)[-1], landed(df, path)))
    met = []
    for n in (10_000, 40_000):
        made.clear()
        known = spark.range(n).selectExpr("concat('customer', lpad(id * 7919 % 1000000, 9, '0')) AS name")
        found = similarity.similar_names(known.limit(500), known, "name", "name", 85)
        assert found.filter("left_key = right_key AND shared = grams").count() == 500
        met.append(made["left-keys"].join(made["right-keys"].select("key"), "key").count() / 500)
    assert met[1] < n / 500 and met[1] < 4.5 * met[0]


def test_best_candidates_fold_names_before_they_meet(spark):
    """Names are folded in the scans of supplier and customer, not in what their joins give."""
    for name in ("best_candidates", "name_match_score"):
        plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString().splitlines()
        last = max(i for i, line in enumerate(plan) if "Join" in line.split("(")[0] and "s_suppkey" in line or "c_custkey" in line and "Join" in line)
        first = min(i for i, line in enumerate(plan) if "Join" in line)
        assert last >= first and not any("regexp_replace" in line for line in plan[: first + 1]), name


def test_persons_are_cleaned_once(spark, one):
    """A person's expression names its text a dozen times; each step of it stands in the plan a few times, not 1,596 regular expressions in all."""
    plan = spark.createDataFrame([("John Smith", "JOHN SMITH;Anna Berg")], "a string, b string").select(names.merge_persons("a", "b"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") < 30
    assert one(names.merge_persons("a", "b"), a="John Smith; ", b="JOHN SMITH;Anna Berg;john  smith") == "John Smith;Anna Berg" and one(names.merge_persons("a", "b"), a=None, b=None) == ""
