"""Sources, sinks and whole days of delivery on folders."""

import json

import pytest
from pyspark.sql import functions as F

from rosterweave.plans import delivery
from rosterweave.sources import decode, readers, sinks
from rosterweave.sources.cursor import CursorSource

SCHEMA = "company_name string, representative string, website string, phone string, address string, emails array<string>"


def company(name, rep="Anna Lee", site="", mails=("info@firm.dk",), **more):
    return {"company_name": name, "representative": rep, "website": site, "phone": "", "address": "", "emails": list(mails)} | more


@pytest.fixture
def records(spark):
    def make(rows, orgnr=True):
        data = [(0, i, r.get("orgnr", ""), *(r[c] for c in ("company_name", "representative", "website", "phone", "address", "emails"))) for i, r in enumerate(rows)]
        return spark.createDataFrame(data, "site_ord int, seq long, orgnr string, " + SCHEMA)

    return make


def lines(path):
    return path.read_text(encoding="utf-8-sig").splitlines()


def test_jsonl_sites(spark, tmp_path):
    for site, file, names in (("b", "final_companies.jsonl", ["B1", "B2"]), ("a", "companies_with_emails.jsonl", ["A1"]), ("delivery", "final_companies.jsonl", ["no"])):
        (tmp_path / site).mkdir()
        (tmp_path / site / file).write_text("\n\n".join(json.dumps(company(n)) for n in names))
    (tmp_path / "b" / "companies_with_emails.jsonl").write_text(json.dumps(company("ignored")))
    df = readers.jsonl_sites(spark, str(tmp_path), SCHEMA)
    assert [(r["source"], r["site_ord"], r["company_name"]) for r in df.orderBy("site_ord", "seq").collect()] == [("a", 0, "A1"), ("b", 1, "B1"), ("b", 1, "B2")]
    (tmp_path / "a" / "companies_with_emails.jsonl").write_text("{bad")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.jsonl_sites(spark, str(tmp_path), SCHEMA).collect()
    assert readers.jsonl_sites(spark, str(tmp_path / "none"), SCHEMA) is None


def test_discovered_columns(spark):
    df = spark.createDataFrame([(2, "B", "b@b.dk"), (1, "A", None)], "id int, company_name string, email string")
    got = readers.discovered(df, ["company_name", "website", "emails"])
    assert [tuple(r) for r in got.orderBy("seq").collect()] == [("A", "", "", 1), ("B", "", "b@b.dk", 2)]
    assert readers.table_or_empty(spark, "/nowhere/t", "a string").count() == 0


def test_key_files(spark, tmp_path):
    (tmp_path / "keys.txt").write_text("acme|acme.dk\nname|bo\n\ndomain|c.dk\nplain\n|only.dk\n")
    got = {r["key"] for r in readers.key_file(spark, str(tmp_path / "keys.txt")).collect()}
    assert got == {"name|acme", "domain|acme.dk", "name|bo", "domain|c.dk", "plain", "domain|only.dk"}
    (tmp_path / "w.txt").write_text(" b.dk \na.dk\n\nb.dk\n")
    assert [r[0] for r in readers.website_list(spark, str(tmp_path / "w.txt")).collect()] == ["a.dk", "b.dk"]


def test_history_csv_round_trip(spark, tmp_path, records):
    folder = sinks.prepared(spark, str(tmp_path), "X_day001")
    tricky = company('A "quoted", Ltd', address="Road 1\nFloor 2", mails=("a@a.dk", "b@a.dk"))
    sinks.delta_csv(records([tricky]), folder, "companies.csv", ["company_name", "emails", "address"], bom=True)
    assert (tmp_path / "X_day001" / "companies.csv").read_bytes().startswith(b"\xef\xbb\xbf")
    back = readers.csv_history(spark, [str(tmp_path / "X_day001" / "companies.csv")], "company_name string, emails string, address string").first()
    assert (back["company_name"], back["emails"], back["address"]) == (tricky["company_name"], ["a@a.dk", "b@a.dk"], tricky["address"])


def test_sitemaps(spark):
    files = spark.createDataFrame(
        [("https://f.dk/robots.txt", "User-agent: *\nSitemap: https://f.dk/s.xml"), ("https://f.dk/s.xml", "<sitemapindex><loc>https://f.dk/s2.xml</loc><loc>https://f.dk/s.xml</loc></sitemapindex>"),
         ("https://f.dk/s2.xml", "<urlset><loc> https://f.dk/b </loc><loc>https://other.dk/x</loc><loc>https://f.dk/a.pdf</loc><loc><![CDATA[https://f.dk/a]]></loc></urlset>")],
        "url string, body string",
    )
    assert [r["page"] for r in readers.sitemap_urls(files, "https://f.dk").collect()] == ["https://f.dk/a", "https://f.dk/b"]


def test_decode(spark):
    assert decode.decode("日本".encode("cp932")) == "日本" and decode.decode("æ".encode(), "text/html; charset=utf-8") == "æ" and decode.decode(b'<meta charset="iso-8859-1">\xe6').endswith("æ") and decode.decode(None) == ""
    df = spark.createDataFrame([(bytearray("日本".encode("shift_jis")), None)], "c binary, t string")
    assert df.select(decode.decoded("c", "t")).first()[0] == "日本"


def test_embedded_json(one):
    page = '<script id="__NEXT_DATA__" type="application/json">{"a": 1}</script><script type="application/ld+json">{"b": 2}</script>'
    assert one(readers.embedded_json("v"), v=page) == '{"a": 1}' and one(readers.linked_data("v"), v=page) == ['{"b": 2}'] and one(readers.guarded_json("v"), v=")]}'\n[1]") == "[1]" and one(readers.guarded_json("v"), v="x {1} y") == "{1}"


def test_cursor_source(spark, tmp_path):
    pages = {"start": {"items": [{"n": 1}, {"n": 2}], "last_sort": "c1"}, "c1": {"items": [{"n": 3}], "last_sort": "c2"}, "c2": {"items": [], "last_sort": "c3"}, "c3": {"items": [{"n": 9}]}}
    for cursor, page in pages.items():
        (tmp_path / f"page_{cursor}.json").write_text(json.dumps(page))
    from rosterweave.shipping import ship

    ship(spark)
    spark.dataSource.register(CursorSource)
    assert [(r["cursor"], r["item"]) for r in spark.read.format("cursor_pages").option("path", str(tmp_path)).load().collect()] == [("start", '{"n": 1}'), ("start", '{"n": 2}'), ("c1", '{"n": 3}')]


@pytest.mark.parametrize("country", ["England", "Brazil", "Japan", "Finland"])
def test_three_days(spark, tmp_path, records, country):
    mails = ("info@firm.dk",)
    go = lambda label, names: delivery.deliver_country(spark, country, records([company(n, site="https://firm.dk", mails=mails) for n in names]), str(tmp_path), label)
    assert go("day1", ["Acme", "Bravo"])["delta_companies"] == 2
    assert go("day2", ["Acme", "Bravo", "Cyan"])["delta_companies"] == 1
    assert [x.split(",")[0] for x in lines(tmp_path / f"{country}_day002" / "companies.csv")] == ["company_name", "Cyan"]
    assert go("day2", ["Acme", "Cyan"])["delta_companies"] == 1  # the day again
    assert any((tmp_path / ".trash").iterdir())
    again = go("day3", ["Bravo"])
    # keys of today alone forget a company that was away for a day; the union does not
    assert again["delta_companies"] == (1 if delivery.COUNTRIES[country.lower()].key_policy == "current" else 0)
    with pytest.raises(ValueError):
        go("day5", ["Acme"])


def test_empty_delta_leaves_no_files_and_keys_are_found_further_back(spark, tmp_path, records):
    go = lambda label, names: delivery.deliver_country(spark, "Germany", records([company(n) for n in names]), str(tmp_path), label)
    go("day1", ["Acme"])
    assert go("day2", ["Acme"])["delta_companies"] == 0 and [p.name for p in sorted((tmp_path / "Germany_day002").iterdir()) if not p.name.startswith(".")] == ["summary.json"]
    assert go("day3", ["Acme"])["delta_companies"] == 0


def test_country_rules(spark, tmp_path, records):
    rows = [company("Acme", site="https://acme.dk", mails=("a@acme.dk", "x@gmail.com"), orgnr="1"), company("ACME ", rep="", site="", mails=("b@acme.dk",), orgnr="1"), company("NoRep", rep="", orgnr="2"), company("Corp", rep="Holding ApS", orgnr="3")]
    current, new = delivery.day(records(rows), spark.createDataFrame([], "key string"), delivery.COUNTRIES["denmark"])
    assert [(r["key"], r["emails"]) for r in current.collect()] == [("acme", "a@acme.dk; b@acme.dk")] and new.count() == 1
    with pytest.raises(ValueError):
        delivery.deliver_country(spark, "Atlantis", records(rows), str(tmp_path), "day1")


def test_websites_days(spark, tmp_path):
    w = lambda *s: {"wiza": spark.createDataFrame([(x,) for x in s], "website string")}
    assert delivery.deliver_websites(spark, w("a.dk", " b.dk ", ""), str(tmp_path), "day1", "Italy")["delta_websites"] == 2
    got = delivery.deliver_websites(spark, w("a.dk", "c.dk"), str(tmp_path), "day2", "Italy")
    assert got["delta_websites"] == 1 and got["sites"] == {"wiza": {"qualified_current": 2, "delta": 1}}
    assert lines(tmp_path / "Italy_websites_day002" / "wiza.keys.txt") == ["a.dk", "c.dk"] and lines(tmp_path / "Italy_websites_day002" / "wiza.csv") == ["website", "c.dk"]
    assert delivery.deliver_websites(spark, w("a.dk", "c.dk"), str(tmp_path), "day3", "Italy")["skipped_sites_no_delta"] == ["wiza"]


def test_site_days(spark, tmp_path, records):
    spec = delivery.COUNTRIES["japan"]
    sites = lambda **names: {s: records([company(n, site="https://firm.dk") for n in ns]) for s, ns in names.items()}
    go = lambda label, tables, **more: delivery.deliver_sites(spark, tables, str(tmp_path), label, spec, **more)
    assert go("day1", sites(a=["A1", "A2"], b=["B1"]))["sites"] == {"a": {"qualified_current": 2, "delta": 2}, "b": {"qualified_current": 1, "delta": 1}}
    got = go("day2", sites(a=["A1", "A3"], b=["B1"]))
    assert got["skipped_sites_no_delta"] == ["b"] and got["delta_companies"] == 1 and not (tmp_path / "Japan_day002" / "b.keys.txt").exists()
    assert go("day2", sites(a=["A1"], b=["B1", "B2"]), only="b", keep=True)["sites"] == {"a": {"qualified_current": 3, "delta": 1}, "b": {"qualified_current": 2, "delta": 1}}
    assert go("day2", {}, summary_only=True)["delta_companies"] == 2
    assert go("day3", sites(a=["A2"], b=["B1"]))["delta_companies"] == 0  # keys are found further back


def test_product(spark, tmp_path, capsys):
    from rosterweave.plans import product

    for site, names in (("proff", ["Acme", "Bravo"]), ("virk", ["acme", "Cyan"])):
        (tmp_path / "data" / site).mkdir(parents=True)
        (tmp_path / "data" / site / "final_companies.jsonl").write_text("\n".join(json.dumps({"company_name": n, "representative": f"Rep {site}", "homepage": "https://firm.dk", "email": f"info@firm.dk;{site}@firm.dk"}) for n in names))
        (tmp_path / "data" / site / "websites.txt").write_text("a.dk\nb.dk\n")
    got = product.run(spark, "Denmark", "companies", "day1", str(tmp_path / "data"), str(tmp_path / "out"))
    assert got["delta_companies"] == 3
    acme = next(x for x in lines(tmp_path / "out" / "Denmark_day001" / "companies.csv") if x.startswith("Acme"))
    assert acme.split(",")[:3] == ["Acme", "Rep proff", "info@firm.dk; proff@firm.dk; virk@firm.dk"]
    assert product.run(spark, "Denmark", "websites", "day1", str(tmp_path / "data"), str(tmp_path / "out"))["delta_websites"] == 4
    assert product.run(spark, "Germany", "companies", "day1", str(tmp_path / "data"), str(tmp_path / "out2"))["sites"].keys() == {"proff", "virk"}
    with pytest.raises(ValueError):
        product.run(spark, "Atlantis", "companies", "day1", str(tmp_path / "data"), str(tmp_path / "out"))
    assert product.main(["x"]) == 2


def test_shared_engine(spark, records):
    today = records([company("Acme", site="https://acme.dk"), company("ACME!", site="https://other.dk"), company("株式", site="https://k.jp"), company("Gone", rep="")])
    old = records([company("Old", site="https://old.dk"), company("Never", site="https://never.dk")])
    base = spark.createDataFrame([("domain|old.dk",), ("name|zed",)], "key string")
    kept, new = delivery.engine_delivery(today, old, base)
    assert sorted(r["key"] for r in kept.collect()) == ["domain|k.jp", "name|acme", "name|old"] and sorted(r["key"] for r in new.collect()) == ["domain|k.jp", "name|acme"]


def test_snapshots(spark, tmp_path, records):
    df = records([company("A", mails=("a@a.dk", "b@a.dk")), company("B", site=" b.dk ", mails=())])
    sinks.jsonl_snapshot(df, str(tmp_path / "snap"), per_email="emails")
    assert spark.read.json(str(tmp_path / "snap")).count() == 2
    folder = readers.Folder(spark, str(tmp_path))
    sinks.websites_txt(df, folder)
    assert lines(tmp_path / "websites.txt") == ["b.dk"]
    sinks.cleared(folder, "websites.txt", "absent.txt")
    assert not (tmp_path / "websites.txt").exists()
    assert [r[0] for r in sinks.full_export(df.withColumn("x", F.lit(1)), ["company_name"], ["company_name"]).collect()] == ["A", "B"]


def test_sqlite_files_of_several_sites(spark, tmp_path):
    """Rows in order of id, missing columns blank, email for emails, no table no rows."""
    import sqlite3

    def base(name, columns, rows, table="companies"):
        with sqlite3.connect(tmp_path / name) as db:
            db.execute(f"CREATE TABLE {table} ({columns})")
            db.executemany(f"INSERT INTO {table} VALUES ({', '.join('?' * len(rows[0]))})", rows)
        db.close()
        return str(tmp_path / name)

    a = base("a.db", "id INTEGER, company_name TEXT, email TEXT", [(2, "B", "b@b.dk"), (1, "A", None)])
    b = base("b.db", "company_name TEXT, emails TEXT, website TEXT, employees INTEGER", [("D", "d@d.dk", "https://d.dk", 7), ("C", "", "x", None)])
    base("c.db", "x TEXT", [("y",)], "other")
    wanted = ["company_name", "emails", "website", "employees"]
    got = readers.sqlite_sites(spark, {"first": a, "second": b, "third": str(tmp_path / "c.db")}, "companies", wanted).orderBy("site_ord", "seq").collect()
    assert [(r["source"], *(r[c] for c in wanted)) for r in got] == [("first", "A", "", "", ""), ("first", "B", "b@b.dk", "", ""), ("second", "C", "", "x", ""), ("second", "D", "d@d.dk", "https://d.dk", "7")]
    assert readers.sqlite_files(spark, str(tmp_path / "*.db"), "companies", wanted).count() == 4
    assert readers.sqlite_files(spark, a, 'comp"anies', wanted).count() == 0
