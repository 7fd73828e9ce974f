"""Payload and page parsers."""

import json

from pyspark.sql import functions as F

from rosterweave.functions import html_parsers, payloads


def test_listing_and_profile(spark, one):
    page = {"currentPageNumber": 1, "totalPages": "1,200", "pageSize": 50, "candidatesMatchedQuantityInt": "60,000", "companyInformationGeos": [{"name": "North", "href": "a.br.north", "quantity": "1,000"}],
            "companyInformationCompany": [{"duns": "1", "primaryName": "A &amp; B", "companyNameUrl": "a-b.1", "primaryAddress": {"postalCode": "9", "streetAddress": {"line1": "Road"}}}, {"duns": "2", "primaryName": "C", "primaryAddress": None}]}
    df = spark.createDataFrame([("x", json.dumps(page)), ("y", "not json")], "industry string, payload string")
    p = payloads.listing_pages(df, "payload", "industry").filter("industry = 'x'").first()
    assert (p["total_pages"], p["matched"], p["geos"][0]["quantity"]) == (1200, 60000, 1000)
    c = payloads.listing_companies(df, "payload", "industry").orderBy("pos").collect()
    assert [(r["company_name"], r["postal_code"], bool(r["detail_url"])) for r in c] == [("A & B", "9", True), ("C", "", False)]
    prof = {"overview": {"primaryName": "Acme", "keyPrincipal": "?????", "website": "/acme.dk"}, "contacts": {"contacts": [{"name": "Contact 1"}, {"name": "Anna  Lee"}]}}
    got = one(payloads.profile("v"), v=json.dumps(prof))
    assert (got["representative"], got["website"], got["phone"]) == ("Anna Lee", "https://acme.dk", "")


def test_search_and_facets(spark):
    p = {"hits": 2, "companies": [{"orgnr": "1", "name": "Acme", "email": "INFO@acme.dk", "contactPerson": {"name": "Bo", "role": "CEO"}, "address": {"addressLine": "Road", "zipCode": "1", "postPlace": "Town"}}, {"orgnr": "", "name": "x"}, {"orgnr": "2", "legalName": "Legal"}],
         "filters": [{"filterType": "Industry", "filters": [{"displayName": "Food", "hits": 5}, {"displayName": "Food", "hits": 9}]}, {"filterType": "other", "filters": []}]}
    df = spark.createDataFrame([(1, json.dumps(p))], "id int, payload string")
    assert [tuple(r) for r in payloads.search_companies(df, "payload", ["id"]).select("orgnr", "company_name", "representative", "address", "email").orderBy("orgnr").collect()] == [("1", "Acme", "Bo", "Road, 1, Town", "info@acme.dk"), ("2", "Legal", "", "", "")]
    assert [tuple(r)[:3] for r in payloads.search_facets(df, "payload", ["id"], "industry").collect()] == [(1, "Food", 5)]


def test_register(one):
    d = {"personkreds": {"personkredser": [{"rolle": {"name": "BESTYRELSE"}, "personRoller": [{"senesteNavn": "Board"}]}, {"rolle": {"name": "direktion", "funktionsVaerdi": ["Adm. dir."]}, "personRoller": [{"senesteNavn": ""}, {"navn": "Anna"}]}]}, "ejerforhold": {"aktiveLegaleEjere": [{"senesteNavn": "Owner", "enhedstype": "PERSON"}]}}
    got = one(payloads.register_detail("v"), v=json.dumps(d))
    assert (got["representative"], got["representative_role"]) == ("Anna", "Adm. dir.") and json.loads(got["owners_json"])[0]["name"] == "Owner"
    assert one(payloads.register_detail("v"), v=json.dumps({"ejerforhold": d["ejerforhold"]}))["representative"] == "Owner"
    assert one(payloads.register_detail("v"), v=json.dumps({"ejerforhold": {"aktiveLegaleEjere": [{"navn": "X", "enhedstype": "VIRKSOMHED"}]}}))["representative"] == ""
    e = one(payloads.register_entry("v"), v=json.dumps({"cvr": 7, "senesteNavn": "Acme", "beliggenhedsadresse": "a\nb", "hovedbranche": "620100 Computer programming"}))
    assert (e["cvr"], e["address"], e["industry_code"], e["industry_name"]) == ("7", "a, b", "620100", "Computer programming")


def test_job_in_languages(one):
    j = {"id": 5, "title": {"values": {"sv": "S", "en": "E"}}, "employer": {"businessName": {"values": {"sv": "Bolag"}}, "businessId": "1-2"}, "recruiting": [{"firstName": " Anna", "lastName": "Lee ", "email": "A@B.FI"}], "externalLinks": [{"url": ""}, {"url": "https://b.fi"}], "regions": ["1", "2"]}
    got = one(payloads.job("v"), v=json.dumps(j))
    assert (got["title"], got["company_name"], got["representative"], got["email"], got["homepage"], got["region"]) == ("E", "Bolag", "Anna Lee", "a@b.fi", "https://b.fi", "1,2")


def test_prospects_and_extraction(spark, one):
    d = {"data": [{"first_name": "Anna", "last_name": "Lee", "position": "CEO", "hash": "h"}, {"name": "anna lee", "title": "ceo"}, {"name": "Bo"}, {"name": "Cy", "job_title": "CFO", "links": {"search_emails": "/p"}}]}
    df = spark.createDataFrame([(1, json.dumps(d))], "id int, payload string")
    assert [tuple(r) for r in payloads.prospects(df, "payload", ["id"]).select("name", "title", "prospect_hash", "email_lookup_path").orderBy("pos").collect()] == [("Anna Lee", "CEO", "h", ""), ("Cy", "CFO", "", "/p")]
    for wrapped in ({"emails": ["A@b.dk", "x"]}, {"data": {"emails": ["a@b.dk"]}}, {"data": {"extract": {"email": "A@b.dk"}}}, {"result": {"emails": ["a@b.dk", "A@B.dk"]}}):
        assert one(payloads.extracted_emails("v"), v=json.dumps(wrapped)) == ["a@b.dk"]
    assert one(payloads.people_json(F.array(F.struct(F.lit("A").alias("name"), F.lit("t").alias("title"), F.array(F.lit("e")).alias("emails"))))) == '[{"name":"A","title_zh":"t","emails":["e"]}]'
    assert payloads.name_and_site(spark.createDataFrame([(1, '[{"name":" A ","website":"w"},{"name":""}]')], "id int, p string"), "p", ["id"]).collect()[0]["company_name"] == "A"


PAGE = """<html><h1>Acme</h1><table><tr><th>代表者</th><td>山田</td></tr><tr><td>Phone:</td><td>+45 12 34 56 78</td></tr></table><dl><dt>Site</dt><dd><a href="https://acme.dk">home</a></dd></dl>
<script type="application/ld+json">{"hiringOrganization": {"name": "Acme Ltd", "sameAs": "https://acme.ltd"}}</script><p>mail <a href="mailto:Jobs@acme.dk?x=1">us</a> or info@acme.dk</p>"""


def test_html_parsers(spark):
    row = html_parsers.company_detail(PAGE, "https://dir.dk/1", {"representative": ("代表", "代表者"), "phone": ("Phone",)})[0]
    assert row == {"representative": "山田", "phone": "+45 12 34 56 78", "company_name": "Acme Ltd", "website": "https://acme.ltd"}
    assert html_parsers.first_external_link(html_parsers.tree(PAGE), "https://dir.dk") == "https://acme.dk" and html_parsers.labelled_link(html_parsers.tree(PAGE), ("home",)) == "https://acme.dk"
    assert html_parsers.job_detail(PAGE, "")[0]["emails"] == "jobs@acme.dk;info@acme.dk"
    cards = html_parsers.company_cards('<ul><li><a href="/c/1">A</a> text</li><li><a href="/c/1">A</a></li><li><a href="/x">n</a></li></ul>', "https://d.jp", "^/c/")
    assert cards == [{"company_name": "A", "detail_url": "https://d.jp/c/1", "summary": "A text"}]
    df = spark.createDataFrame([(1, "https://dir.dk/1", PAGE), (2, "https://dir.dk/2", None)], "page_id long, url string, html string")
    got = html_parsers.parse_table(df, html_parsers.job_detail, ["email", "phone"]).orderBy("page_id").collect()
    assert [tuple(r) for r in got] == [(1, 0, "jobs@acme.dk", "+45 12 34 56 78"), (2, 0, "", "")]


def test_register_pages():
    results = '<ul id="results"><li><a href="/company/123">ACME LTD</a></li><li><a href="/company/9X">OLD</a> Dissolved on</li><li><a href="/x">n</a></li></ul>'
    assert [(r["company_number"], r["is_active"]) for r in html_parsers.register_results(results, "https://r.uk")] == [("123", "true"), ("9X", "false")]
    officers = '<div class="appointments-list"><div class="appointment-1"><h2 class="heading-medium">LEE, Anna</h2><span class="status-tag">Active</span><dd id="officer-role-1">Director</dd></div><div class="appointment-2"><h2 class="heading-medium">B</h2><span class="status-tag">Resigned</span></div></div>'
    assert [(r["name"], r["role"], r["is_active"]) for r in html_parsers.register_officers(officers, "")] == [("LEE, Anna", "Director", "true"), ("B", "", "false")]
    blocks = '<a href="/c/a/1">Acme &amp; Co</a> x <a href="https://acme.com">w</a><a href="/c/b/2">Bo</a> none <a href="/c/a/3">ACME &amp; CO</a> https://dup.com'
    assert html_parsers.blocks_between_links(blocks, "https://us.dir.com", r"/c/[^\"']+") == [{"company_name": "Acme & Co", "website": "https://acme.com"}]


def test_nested_payload_and_pagers():
    deep = ["0x1:0x2", "Acme", ["https://acme.dk"]]
    for _ in range(300):
        deep = [deep]
    assert json.loads(html_parsers.place_entries(")]}'\n" + json.dumps(deep))[-1]["strings"]) == ["0x1:0x2", "Acme", "https://acme.dk"] and html_parsers.place_entries("x") == []
    assert html_parsers.pager('<a href="?page=3">3</a><a href="?page=12">12</a>')[0]["total_pages"] == "12" and html_parsers.pager("1,001 results", per_page=50)[0] == {"total_pages": "21", "total_results": "1001"}
    assert html_parsers.codes("<a href='?code=b'>x</a><a href='?x=1&code=a'>y</a><a href='?code=b'>z</a>") == [{"code": "b"}, {"code": "a"}]
    assert html_parsers.to_markdown("<h2>T</h2><p>a <a href='/b'>b</a></p><script>x</script><ul><li>c</ul>") == "## T\n\na [b](/b)\n\n- c"
    assert len(html_parsers.to_markdown("<p>" + "x" * 500 + "</p>", most=100)) < 120


def test_leaves_of_any_shape(spark):
    from rosterweave.functions import variants

    def plain(v, path="$", name=""):
        if isinstance(v, dict):
            return [x for k, w in v.items() for x in plain(w, f"{path}.{k}", k)]
        if isinstance(v, list):
            return [x for i, w in enumerate(v) for x in plain(w, f"{path}[{i}]", name)]
        return [] if v is None else [(path, name, {True: "true", False: "false"}.get(v, str(v)) if isinstance(v, bool) else str(v))]

    shapes = [{"a": 1, "b": {"c": ["x", None, {"d": True}], "e": {}}, "f": []}, [1, [2, ["three"]]], "text", 5, None, {}, {"name": "Ünï", "deep": {"x": {"y": {"z": [[["end"]]]}}}}]
    df = spark.createDataFrame([(i, json.dumps(s)) for i, s in enumerate(shapes)] + [(90, "{not json"), (91, None), (92, "")], "id int, p string")
    want = sorted((i, *x) for i, s in enumerate(shapes) for x in plain(s))
    assert sorted(map(tuple, variants.leaves(df, "p", ["id"]).collect())) == want
    assert sorted(r["path"] for r in variants.leaves(df, "p", ["id"], depth=1).filter("id = 0").collect()) == ["$.a"]
    assert [tuple(r) for r in variants.named(df, "p", ["id"], ("d", "name")).orderBy("id").collect()] == [(0, "$.b.c[2].d", "true"), (6, "$.name", "Ünï")]
    v = df.select("id", variants.first_of(variants.parsed("p"), "$.zzz", "$.b.c[0]", "$.name").alias("x"), variants.first_of(variants.parsed("p"), "$.name", "$.a", kind="int").alias("n"))
    assert {r["id"]: (r["x"], r["n"]) for r in v.filter("x is not null or n is not null").collect()} == {0: ("x", 1), 6: ("Ünï", None)}
    plan = variants.leaves(df, "p", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan
