"""Operators on small tables; results must not depend on how the rows are dealt."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rosterweave.operators import dedup, delta, gates, queues, ranking, upsert

T0 = dt.datetime(2024, 1, 1)


def now():
    return F.lit("2024-01-01 00:10:00").cast("timestamp")


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


@pytest.fixture(params=[1, 5])
def dealt(spark, request):
    """A table from rows, dealt over one partition or five."""
    return lambda data, schema: spark.createDataFrame(data, schema).repartition(request.param)


RECORDS = "site_ord int, seq long, orgnr string, company_name string, representative string, website string, phone string, address string, emails array<string>"


def records():
    return [
        (0, 1, "1", "Acme", "", "", "", "", ["a@acme.dk"]),
        (0, 2, "1", "ACME A/S", "Anna Lee", "https://acme.dk", "", "", ["b@acme.dk", "a@acme.dk"]),
        (1, 1, "2", "acme", "Bo Ek", "", "12345678", "Road 1", ["c@acme.dk"]),
        (1, 2, "", "Zed", "Cy Po", "https://zed.dk", "", "", []),
    ]


def test_first_wins(dealt):
    got = dedup.first_wins(dealt(records(), RECORDS), F.lower("company_name"), ["site_ord", "seq"])
    assert rows(got, "company_name", "seq") == [("ACME A/S", 2), ("Acme", 1), ("Zed", 2)]


def test_best_wins_and_ties_keep_the_first(dealt):
    df = dealt([("k", 1, 5, "a"), ("k", 2, 5, "b"), ("k", 3, 4, "c"), ("j", 4, 0, "d")], "key string, seq long, score int, v string")
    assert rows(dedup.best_wins(df, F.col("key"), [F.col("score")], ["seq"]), "key", "v") == [("j", "d"), ("k", "a")]


def test_union_of_addresses(dealt):
    got = dedup.best_with_union(dealt(records(), RECORDS), F.lower(F.substring("company_name", 1, 4)), dedup.record_score(), ["site_ord", "seq"])
    row = got.filter("lower(company_name) like 'acme%'").first()
    assert row["emails"] == ["b@acme.dk", "a@acme.dk", "c@acme.dk"] and row["company_name"] == "ACME A/S"


def test_grouped_unions_are_distinct_before_they_are_collected(dealt):
    """Null arrays, null elements, null keys, two unions at once, a key without elements, and one key with nearly all rows."""
    data = [("k", i, f"v{i}", [f"e{i % 3}", None, f"e{i % 2}"], None if i % 2 else ["x"]) for i in range(200)]
    data += [(None, 1, "n", ["b", "a"], []), (None, 0, "m", ["a"], []), ("empty", 5, None, None, None)]
    df = dealt(data, "key string, seq int, v string, one array<string>, two array<string>")
    at = F.struct("seq")
    got = dedup.grouped(df, ["key"], {"first": (F.min_by, F.col("v"), at), "last": (F.max_by, F.col("v"), at)}, {"a": (F.col("one"), at), "b": (F.col("two"), at)})
    assert {r["key"]: tuple(r)[1:] for r in got.collect()} == {
        "k": ("v0", "v199", ["e0", None, "e1", "e2"], ["x"]),
        None: ("m", "n", ["a", "b"], []),
        "empty": (None, None, [], []),
    }
    partial = got._jdf.queryExecution().executedPlan().toString().split("collect_list")[-1]  # below the last step: one row an element
    assert "partial_min_by" in partial and "Window" not in partial


def test_two_levels(dealt):
    got = dedup.two_level(dealt(records(), RECORDS), "orgnr", "company_name", ["site_ord", "seq"], ["company_name", "representative", "website", "phone", "address"])
    row = got.filter("company_name = 'Acme'").first()
    assert (row["representative"], row["phone"], row["emails"]) == ("Anna Lee", "12345678", ["a@acme.dk", "b@acme.dk", "c@acme.dk"])


def test_composite(dealt):
    df = dealt([(0, 1, "", "A社", "社長 山田", "https://a.co.jp", "", "", ["x@a.co.jp"]), (0, 2, "", "A社", "代表取締役 山田", "http://www.a.co.jp/x", "1", "", ["y@a.co.jp"]), (0, 3, "", "A社", "山田", "", "", "港区", [])], RECORDS)
    got = dedup.composite(df, ["site_ord", "seq"], ["company_name", "representative", "website", "phone", "address"])
    assert sorted(map(tuple, got.select("representative", "phone", "emails").collect())) == [("山田", "", []), ("社長 山田", "1", ["x@a.co.jp", "y@a.co.jp"])]


def test_regroup(dealt):
    df = dealt([("7", 1, "Ab", "https://a.dk/x/y", "2024-01-01", "p@a.dk"), ("007", 2, "Abc", "https://a.dk", "2024-02-01", "q@a.dk; p@a.dk")], "id string, seq long, name string, url string, at string, mails string")
    got = dedup.regroup(df, F.regexp_replace("id", "^0+", ""), {"name": "longest", "url": "shallowest", "at": "latest", "mails": "joined"}, ["seq"])
    assert tuple(got.first()) == ("7", "Abc", "https://a.dk", "2024-02-01", "p@a.dk; q@a.dk")


def test_register_match(dealt):
    df = dealt([("q1", "Acme Ltd", "ACME LIMITED", True), ("q1", "Acme Ltd", "Acme Ltd", False), ("q2", "Bravo Works", "Bravo Works Limited", True), ("q2", "Bravo Works", "Bravo Works Limitd", True), ("q3", "Same", "Same", True), ("q3", "Same", "SAME", True)], "k string, q string, n string, active boolean")
    got = dedup.unique_best(df.withColumn("s", dedup.register_score("q", "n", "active")[0]).filter("s > 0"), "k", dedup.register_score("q", "n", "active"))
    assert rows(got, "k", "n") == [("q1", "Acme Ltd"), ("q2", "Bravo Works Limited")]


def test_deltas(dealt):
    now = dealt([("name|a", "domain|a.dk", 1), ("name|b", "domain|x.dk", 2), ("name|c", "", 3)], "nk string, dk string, id long")
    base = dealt([("name|a",), ("domain|x.dk",), ("",)], "key string")
    assert rows(delta.new_by_two_keys(now, base, "nk", "dk"), "id") == [(3,)]
    assert rows(delta.seen_by_two_keys(now, base, "nk", "dk", "id"), "id") == [(1,), (2,)]
    plan = delta.new_by_two_keys(now, base, "nk", "dk")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan


def test_cache_and_contacts(dealt):
    tasks = dealt([(1, "a.dk", "pending", ["x"]), (2, "b.dk", "pending", ["x"]), (3, "a.dk", "done", ["x"])], "id long, domain string, status string, emails array<string>")
    cache = dealt([("a.dk", ["y", "x"])], "domain string, emails array<string>")
    assert [tuple(r) for r in delta.with_cache(tasks, cache).select("id", "status", "emails").collect()] == [(1, "done", ["x", "y"])]
    c = delta.contact_sources(dealt([("A", ""), ("B", "b.dk")], "company_name string, domain string"), dealt([("a.dk", ["i@a.dk"], ["g@a.dk"], ["i@a.dk"])], "domain string, domain_emails array<string>, generic_emails array<string>, person_emails array<string>"), dealt([("A", "a.dk")], "company_name string, domain string"))
    assert sorted(map(tuple, c.select("company_name", "emails").collect())) == [("A", ["i@a.dk", "g@a.dk"]), ("B", [])]


def test_upsert_policies(dealt):
    old = dealt([("1", "Acme", "old@a.dk", "x", "3"), ("2", "Bo", "", "y", "1")], "id string, name string, email string, note string, n string")
    new = dealt([("1", 1, "", "new@a.dk", "", "2"), ("1", 2, "-", "new@a.dk; old@a.dk", "z", "9"), ("3", 3, "Cy", "c@c.dk", "w", "1")], "id string, seq long, name string, email string, note string, n string")
    got = upsert.fold(old, new, ["id"], {"name": "non_blank_or_dash", "email": "join", "note": "overwrite", "n": "greatest"})
    assert rows(got, "id", "name", "note", "n") == [("1", "Acme", "z", "9"), ("2", "Bo", "y", "1"), ("3", "Cy", "w", "1")]
    assert rows(upsert.fold(old, new, ["id"], {"name": "keep_old", "extra": "non_blank"}), "id", "name", "extra") == [("1", "Acme", ""), ("2", "Bo", ""), ("3", "Cy", "")]
    assert upsert.true_inserts(old, new, ["id"]) == 1
    assert rows(upsert.insert_ignore(old.select("id", "name"), new.select("id", "name", "seq"), "id", ["seq"]), "id", "name") == [("1", "Acme"), ("2", "Bo"), ("3", "Cy")]


def test_final_rows_and_merge(dealt):
    r = dealt([("1", "Acme", "Anna Lee", ["a@a.dk", "b@a.dk"]), ("2", "Bo", "Holding ApS", ["c@b.dk"]), ("3", "Cy", "Cy Po", [])], "orgnr string, company_name string, representative string, emails array<string>")
    assert rows(upsert.final_rows(r), "orgnr", "email") == [("1", "a@a.dk"), ("1", "b@a.dk")]
    old = dealt([("1", "Acme Ltda", "Old Rep", ["a@a.dk"], "")], "id string, company_name string, representative string, emails array<string>, website string")
    other = dealt([("1", "Other", "", ["b@a.dk"], "https://a.dk")], "id string, company_name string, representative string, emails array<string>, website string")
    prev = dealt([("1", "Acme Ltda", "Old Rep", ["a@a.dk"], "")], "id string, company_name string, representative string, emails array<string>, website string")
    assert rows(upsert.final_merge(old, other, "id", prev), "company_name") == [("Acme Ltda",)]  # not complete: the final row stays
    assert rows(upsert.final_merge(old, other.withColumn("company_name", F.lit("ACME ltda.")), "id"), "company_name", "representative") == [("ACME ltda.", "Old Rep")]


def test_stage_and_migration(dealt):
    r = dealt([("1", "a", "x", "pending"), ("2", "b", "y", "pending")], "id string, website string, phone string, s string")
    got = upsert.stage_applied(r, dealt([("1", "", "z")], "id string, website string, phone string"), "id", ["website", "phone"], "s", overwrite=("website",))
    assert rows(got, "id", "website", "phone", "s") == [("1", "", "z", "done"), ("2", "b", "y", "pending")]
    m, v = upsert.migrated(dealt([("done", "", "w"), ("done", "r", "w")], "email_status string, representative string, website string"), 0)
    assert v == 1 and rows(m, "email_status") == [("done",), ("rep_pending",)]
    assert upsert.migrated(m, 1)[1] == 1


def test_precedence_and_dual_key(one):
    assert one(upsert.by_precedence("a", "b", "c"), a="", b="m", c="r") == "m" and one(upsert.by_precedence("a", "b", "c", F.lit(True)), a="s", b="m", c="r") == "m"
    assert one(upsert.dual_key("n", "c", "a"), n="1234567890123", c="x", a="y") == "n|1234567890123" and one(upsert.dual_key("n", "c", "a"), n="12", c="x ", a="y") == "a|x|y"


def test_gates(dealt):
    df = dealt([("wizasnov", "A", "a@a.dk", '[{"name":"Bo"}]', "", "done", ""), ("wizasnov", "A", "a@a.dk", "bad", "", "done", ""), ("hidubai", "A", "", "", "w.ae", "done", "done"), ("hidubai", "A", "", "", "", "done", "done")], "site string, company_name string, emails string, people_json string, website string, email_status string, gmap_status string")
    assert rows(df.filter(gates.site_done()), "site", "website") == [("hidubai", "w.ae"), ("wizasnov", "")]
    assert df.filter(gates.site_filter("HiDubai; x")).count() == 2 and df.filter(gates.site_filter(None)).count() == 4
    healed = gates.healed(dealt([("", "done", "pending"), ("w", "pending", "pending")], "website string, gmap_status string, email_status string"))
    assert rows(healed, "gmap_status", "email_status") == [("done", "done"), ("done", "pending")]
    clean, dep = gates.purge_dirty(dealt([(1, "https://facebook.com/x", "done"), (2, "https://a.dk", "done")], "id long, website string, gmap_status string"), dealt([(1,), (2,)], "id long"), "id")
    assert rows(clean, "id", "website", "gmap_status") == [(1, "", "pending"), (2, "https://a.dk", "done")] and rows(dep) == [(2,)]


def queue(dealt):
    return dealt(
        [(1, "pending", T0 + dt.timedelta(minutes=3), None, 0, "", "Maria Silva"), (2, "pending", T0 + dt.timedelta(minutes=1), T0 + dt.timedelta(hours=9), 0, "w", ""), (3, "running", T0 + dt.timedelta(minutes=10), None, 2, "", ""),
         (4, "pending", T0 + dt.timedelta(minutes=3), T0, 1, "w", "Anna"), (5, "failed", T0, None, 3, "", "")],
        "id long, status string, updated_at timestamp, next_run_at timestamp, retries int, website string, representative string",
    )


def test_claims(dealt):
    q = queue(dealt)
    assert [r["id"] for r in ranking.claim(q, now(), 2).collect()] == [1, 4]
    assert [r["id"] for r in ranking.claim_with_site_first(q, 2).collect()] == [2, 4]
    assert [r["id"] for r in ranking.claim_reranked(q.withColumn("company_name", F.lit("Acme Ltda")), 2, first=2).collect()] == [1, 2]


def test_queue_rules(dealt):
    q = queue(dealt)
    assert {r["id"]: r["status"] for r in queues.requeue_stale(q, now()).collect()}[3] == "pending" and {r["id"]: r["status"] for r in queues.requeue_stale(q, now(), inclusive=False).collect()}[3] == "running"
    assert {r["id"]: (r["status"], r["retries"]) for r in queues.requeue_failed(q).collect()}[5] == ("pending", 0)
    f = queues.failed_once_more(q.filter("id in (3, 4)"), now(), 3, 300, F.lit("x" * 900)).collect()
    got = {r["id"]: r for r in f}
    assert got[3]["status"] == "failed" and got[4]["status"] == "pending" and got[4]["next_run_at"] == dt.datetime(2024, 1, 1, 0, 10, 4) and len(got[4]["last_error"]) == 500


@pytest.mark.parametrize(
    ("domain", "status", "emails", "retry", "updated", "want"),
    [(" ", None, None, None, None, ("wait", 60.0)), ("a", None, None, None, None, ("claimed", None)), ("a", "done", ["x"], None, None, ("done", None)), ("a", "done", [], 5, None, ("claimed", None)), ("a", "done", [], 20, None, ("done", 600.0)),
     ("a", "pending", [], 20, None, ("wait", 600.0)), ("a", "running", [], None, 5, ("wait", 15.0)), ("a", "running", [], None, -30, ("claimed", None)), ("a", "pending", [], None, None, ("claimed", None))],
)
def test_cache_decision(spark, domain, status, emails, retry, updated, want):
    at = lambda m: None if m is None else T0 + dt.timedelta(minutes=m)
    df = spark.createDataFrame([(domain, status, emails, at(retry), at(updated))], "domain string, status string, emails array<string>, next_retry_at timestamp, updated_at timestamp")
    assert tuple(df.select(queues.cache_decision(now()).alias("d")).first()["d"]) == want


def test_segments(dealt):
    f = dealt([("r1", "", 100), ("r2", "", 5), ("n1", "r1", 60), ("n2", "r1", 40), ("x1", "n1", 60), ("n3", "r2", 5)], "scope string, parent string, hits long")
    assert rows(queues.segments(f, 50, 3), "scope", "level", "truncated") == [("n2", 1, False), ("r2", 0, False), ("x1", 2, True)]
    assert ("r1",) in rows(queues.segments(f, 50, 3, keep_cut=True), "scope")
    assert rows(queues.pages(dealt([("a", 3), ("b", 0)], "q string, total int"), "total"), "q", "page") == [("a", 1), ("a", 2), ("a", 3)]


def test_days():
    assert queues.check_day("day1", "Japan", []) == (1, 0) and queues.check_day("DAY3", "Japan", ["Japan_day001", "Japan_day002", "x"]) == (3, 2) and queues.check_day("day2", "Japan", ["Japan_day002"]) == (2, 1)
    for label, have in (("day2", []), ("day4", ["Japan_day002"]), ("day1", ["Japan_day002"]), ("day0", []), ("2", [])):
        with pytest.raises(ValueError):
            queues.check_day(label, "Japan", have)
    assert queues.day_folder("Japan", 7) == "Japan_day007"


def test_other_rules(spark, one, dealt):
    assert one(queues.next_stage("n", "r", "e", "s"), n="a", r="b", e="c", s="") == "done" and one(queues.next_stage("n", "r", "e", "s"), n="a", r="", e="", s="w") == "email" and one(queues.next_stage("n", "r", "e", "s"), n="a", r="", e="", s="") == "map"
    assert tuple(one(queues.retry_rule(F.lit("HTTP 429"), F.lit(9)))) == ("usage limit", 60, True, True) and tuple(one(queues.retry_rule(F.lit("boom"), F.lit(6)))) == ("other", 0, False, False)
    assert one(queues.start_page(F.lit(4), F.lit("running"), F.lit(10), F.lit(100))) == 5 and one(queues.start_page(F.lit(4), F.lit("done"), F.lit(10), F.lit(100))) == 1
    assert one(queues.backoff(F.lit(3), 300)) == 8.0 and one(queues.backoff(F.lit(90), 300)) == 300.0
    chunks = queues.chunked(spark.range(25), ["id"], 10).groupBy("chunk").count().collect()
    assert sum(c["count"] for c in chunks) == 25 and max(c["count"] for c in chunks) <= 10


def test_candidates_and_contacts(dealt):
    c = dealt([(1, "Acme", "Acme Tools", "", "", 0), (1, "Acme", "Zed", "https://acme.dk", "", 1), (1, "Acme", "Acme", "", "", 2), (2, "Bo", "Zed", "", "", 0)], "k long, q string, name string, website string, phone string, pos int")
    assert rows(ranking.best_candidate(c, "k", "q"), "k", "pos", "score") == [(1, 1, 100)]
    people = dealt([("A", n, t) for n, t in [("p1", "CEO"), ("p2", "Director"), ("p3", "Founder"), ("p4", "President"), ("p5", "Owner"), ("p6", "CFO"), ("p7", "Accountant"), ("p8", "Assistant to CEO"), ("p9", "Cook"), ("p1", "CEO")]], "company string, name string, title string")
    top = ranking.selected_contacts(ranking.contacts(people, "company"), "company")
    assert rows(top, "family", "name") == [("accounting", "p7"), ("finance", "p6"), ("leader", "p1"), ("leader", "p3"), ("leader", "p4"), ("leader", "p5")]
    officers = dealt([("1", "SMITH, Anna", True, 0), ("1", "ACME NOMINEES LTD", True, 1), ("1", "OLD, Bo", False, 2), ("2", "ACME LTD", True, 0)], "k string, name string, is_active boolean, pos int")
    assert rows(ranking.representatives(officers, "k"), "k", "representative") == [("1", "SMITH, Anna"), ("2", "ACME LTD")]


def test_fallback_and_seeds(dealt):
    got = queues.with_fallback(dealt([("1", "a"), ("2", "b")], "id string, name string"), dealt([("1", "A!"), ("3", "c")], "id string, name string"), "id", ["name"])
    assert rows(got, "id", "name", "from_detail") == [("1", "A!", True), ("2", "b", False)]
    assert queues.next_seed(dealt([(1, "done"), (2, "working"), (3, "open"), (4, "open")], "pos int, status string")).first()["pos"] == 3


def test_directory_pages_give_the_sites_own_addresses_alone(spark):
    """AG11."""
    from rosterweave.operators import dedup

    many = [f"p{k}@firm{k % 6}.dk" for k in range(9)]
    pages = spark.createDataFrame([("a", "https://a.dk", 2, ["x@a.dk", "y@b.dk"]), ("a", "https://a.dk", 1, ["info@a.dk", "x@a.dk"]), ("a", "https://a.dk", 3, many), ("b", "https://b.dk", 1, None)], "site string, website string, n int, found array<string>")
    got = {r["site"]: r["emails"] for r in dedup.page_emails(pages, "site", "website", "found", "n").collect()}
    assert got["a"][:2] == ["info@a.dk", "x@a.dk"] and set(got["a"]) == {"info@a.dk", "x@a.dk", "y@b.dk"} and got["b"] == []


def test_full_replace_and_rejects(spark, tmp_path):
    """UP11, UP9."""
    from rosterweave.operators import upsert

    path = str(tmp_path / "t")
    for rows in ([(1, "a"), (2, "b")], [(3, "c")]):
        upsert.replaced(spark.createDataFrame(rows, "k int, v string"), path)
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(3, "c")]
    there, new = spark.createDataFrame([("n|1", "Acme", "Road")], "key string, name string, address string"), spark.createDataFrame([("n|1", "Acme", "Road"), ("a|x", "Acme", "Road"), ("a|y", "Other", "Road"), (None, "Acme", "Road")], "key string, name string, address string")
    assert [r["key"] for r in upsert.dual_key_rejects(new, there, "key", ["name", "address"]).collect()] == ["a|x"]


def test_predicate_hook_and_slots_of_hosts(spark):
    """UX1, TK10."""
    from rosterweave.operators import gates, ranking

    df = spark.createDataFrame([("a", 1, False), ("test", 1, False), ("test", 1, True), ("b", None, False)], "name string, n int, free boolean")
    keep = lambda **options: [(r["name"], r["free"]) for r in gates.qualified(df, F.col("n").isNotNull(), **options).collect()]
    assert keep() == [("a", False), ("test", False), ("test", True)] and keep(suspicious=lambda: F.col("name") == "test") == [("a", False)]
    assert keep(suspicious=lambda: F.col("name") == "test", exempt=F.col("free")) == [("a", False), ("test", True)]
    slots = [r["s"] for r in spark.createDataFrame([("A.dk",), ("a.dk",), ("b.dk",), ("c.dk",)], "h string").select(ranking.slot_of(F.col("h"), 4).alias("s")).collect()]
    assert slots[0] == slots[1] and all(0 <= s < 4 for s in slots)


def test_page_bundles(spark, tmp_path):
    """UR15, SC15."""
    from rosterweave.sources import readers

    rows = [(1, " https://a.dk/x ", "y" * 30, "text/html"), (2, "", "<p>", None), (3, "https://a.dk/f.pdf", "<p>", "application/pdf"), (4, "https://a.dk/e", " \n", "text/html"), (5, "https://a.dk/s", "short", None), (6, None, None, None)]
    df = spark.createDataFrame(rows, "page_id int, url string, html string, kind string")
    got = {r["page_id"]: (r["url"], r["html"]) for r in readers.page_bundle(df, 10).collect()}
    assert got == {1: ("https://a.dk/x", "y" * 5 + readers.PAGE_CUT + "y" * 5), 5: ("https://a.dk/s", "short")}
    assert {r["page_id"]: len(r["html"]) for r in readers.page_bundle(df, None).collect()} == {1: 30, 5: 5}
    df.write.parquet(str(tmp_path / "pages"))
    assert {r["page_id"] for r in readers.landed_pages(spark, str(tmp_path / "pages"), "kind").collect()} == {1, 5}
