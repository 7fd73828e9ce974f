"""Scalar functions, by examples written for this repository."""

import pytest
from pyspark.sql import functions as F

from rosterweave.functions import emails, names, text, urls


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("Info@Firm-One.DK", "info@firm-one.dk"), ("mailto:sales%40firm.dk", "sales@firm.dk"), ("u003ehello@firm.dk", "hello@firm.dk"), ("office[at]firm(dot)dk", "office@firm.dk"),
        ("kontakt at firm dot dk", "kontakt@firm.dk"), ("a​b@firm.dk", "ab@firm.dk"), ("(info@firm.dk).", "info@firm.dk"), ("logo@2x.png", ""), ("noreply@firm.dk", ""), ("jo@example.com", ""),
        ("https://u:p@firm.dk/x", ""), (".a@firm.dk", ""), ("a..b@firm.dk", ""), ("a@firm..dk", ""), ("", ""), (None, ""), ("no address", ""), ("100%@firm.dk", "100%@firm.dk"), ("a+b@firm.dk", "a+b@firm.dk"),
    ],
)
def test_normalize_email(one, raw, want):
    assert one(emails.normalize("v"), v=raw) == want


@pytest.mark.parametrize(
    ("email", "want"),
    [
        ("info@firm.dk", False), ("test@firm.dk", True), ("xxxxx@firm.dk", True), ("aaaa@firm.dk", True), ("sample12@firm.dk", True), ("john@yourdomain.com", True), ("john@testing.dk", True), ("john@co.uk", True),
        ("john@firm.co.uk", False), ("abcxxxxdef@firm.dk", True), ("john.x@firm.dk", False), ("john.xx@firm.dk", True), ("mytestaddressverylong@firm.dk", False), ("no-at", True), ("john@00.dk", True),
    ],
)
def test_placeholder(one, email, want):
    assert one(emails.is_placeholder("v"), v=email) is want


def test_split_keeps_order_and_drops_prefixed(one):
    assert one(emails.split("v"), v="b@firm.dk; atinfo@firm.dk, info@firm.dk;b@firm.dk;test@firm.dk") == ["b@firm.dk", "info@firm.dk"]
    assert one(emails.split("v"), v=None) == []


def test_priority_order(one):
    got = one(emails.prioritized("v"), v=["zed9@a.dk", "anna@a.dk", "in-fo@a.dk", "info@a.dk", "mysales@a.dk", "anna.b@a.dk"])
    assert got == ["info@a.dk", "in-fo@a.dk", "mysales@a.dk", "anna@a.dk", "anna.b@a.dk", "zed9@a.dk"]


@pytest.mark.parametrize(("v", "want"), [("https://www.shop.firm.co.jp/x", "firm.co.jp"), ("a.b.firm.com.br", "com.br"), ("firm.dk:8080", "firm.dk"), ("localhost", "localhost"), ("", ""), ("https://firm.dk?x=1", "firm.dk"), ("co.uk", "co.uk")])
def test_registrable(one, v, want):
    assert one(emails.registrable("v"), v=v) == want


def test_site_filters(one):
    found = ["a@other.com", "info@firm.dk", "posted@other.com", "b@gmail.com", "c@mail.firm.dk"]
    assert one(emails.for_site(F.lit("https://firm.dk"), "v"), v=found) == ["info@firm.dk", "c@mail.firm.dk", "a@other.com", "b@gmail.com"]
    assert one(emails.for_site(F.lit(""), "v"), v=found)[0] == "info@firm.dk"
    assert one(emails.for_country(F.lit("https://www.firm.dk"), "v"), v=[*found, "x@ab.dk"]) == ["info@firm.dk", "c@mail.firm.dk"]
    assert one(emails.matches_site(F.lit("firm.dk"), F.lit("a@notfirm.dk"))) is False


@pytest.mark.parametrize(("a", "b", "want"), [("firm.dk", "firm.dk", True), ("firm.dk", "mail.firm.dk", True), ("firm-one.dk", "firmone.com", True), ("café.fr", "cafe.com", True), ("ab.dk", "abc.dk", False), ("firm.dk", "other.dk", False), ("", "x.dk", False)])
def test_related(one, a, b, want):
    assert one(emails.related("a", "b"), a=a, b=b) is want


def test_profile_of_directory(one):
    many = [f"p{i}@site{i}.dk" for i in range(8)]
    assert one(emails.profile(F.lit("https://firm.dk"), "v"), v=many)["directory_like"] is True
    assert one(emails.profile(F.lit("https://site1.dk"), "v"), v=many)["directory_like"] is False


def test_harvest(one):
    page = "<p>A &amp; B: info@firm.dk</p><!-- x@gone.dk --><script>y@gone.dk</script><a href='mailto:sales%40firm%2Edk'>INFO@firm.dk</a> hi [at] firm [dot] dk"
    assert one(emails.harvest("v"), v=page) == ["info@firm.dk", "sales@firm.dk", "hi@firm.dk"]
    assert one(emails.decode_cloudflare("v"), v="".join(f"{b:02x}" for b in [0x2A, *(c ^ 0x2A for c in b"me@firm.dk")])) == "me@firm.dk"
    assert one(emails.decode_cloudflare("v"), v="zz") == ""
    assert one(emails.parse("v"), v="not json") == [] and one(emails.parse("v"), v='["a"]') == ["a"] and one(emails.dump("v"), v=["a", "a", " "]) == '["a"]'


@pytest.mark.parametrize(
    ("v", "want"),
    [("WWW.Firm.dk/", "https://firm.dk"), ("http://firm.dk/a?b=1#c", "https://firm.dk/a?b=1"), ("//firm.dk", "https://firm.dk"), ("firm", ""), ("firm..dk", ""), ("ünï.dk", ""), ("firm.d1", ""), ("", ""), ("fi rm.dk", "https://firm.dk")],
)
def test_url_normalize(one, v, want):
    assert one(urls.normalize("v"), v=v) == want


def test_url_parts(one):
    assert one(urls.clean_website("v"), v="https://facebook.com/firm") == "" and one(urls.clean_website("v"), v="firm.dk/logo.png") == "" and one(urls.clean_website("v"), v="firm.dk") == "https://firm.dk"
    assert one(urls.is_blocked("v"), v="maps.google.com") and one(urls.is_blocked("v"), v="city.gov.br") and not one(urls.is_blocked("v"), v="firm.dk")
    assert one(urls.unwrap("v"), v="https://www.google.com/url?q=https%3A%2F%2Ffirm.dk%2Fa&x=1") == "https://firm.dk/a"
    assert one(urls.depth("v"), v="https://firm.dk/a//b/?x=/c") == 2
    assert one(urls.score(F.lit("https://f.dk/"), "v"), v="https://f.dk") == 1000 and one(urls.score(F.lit("https://f.dk/"), "v"), v="https://f.dk/contact") == 97
    assert one(urls.keywords("v"), v="https://f.dk/About-Us/x/about-us") == ["aboutus"]
    key = urls.task_key(F.lit("bakery"), F.lit(""), F.lit("food"))
    assert one(key) == "bakery||industry=food" and tuple(one(urls.parse_task_key("v"), v="bakery||filter=x||industry=food")) == ("bakery", "x", "food")


def test_links(one):
    page = "<a href='/a'>A</a><a href=\"b.html#t\">B</a><a href='https://other.dk/'>O</a><a href='x.pdf'>F</a><a href='mailto:a@b.dk'>m</a><a href='/a'>again</a><a href='https://m.firm.dk/z'>s</a>"
    assert one(urls.same_site_links("v", F.lit("https://firm.dk/dir/")), v=page) == ["https://firm.dk/a", "https://firm.dk/dir/b.html"]
    assert one(urls.same_site_links("v", F.lit("https://firm.dk/dir/"), subdomains=True), v=page)[-1] == "https://m.firm.dk/z"
    assert one(urls.same_site_links("v", F.lit("https://firm.dk/dir/"), limit=1), v=page) == ["https://firm.dk/a"]


def test_lines(one):
    assert one(urls.to_lines("v"), v="<h1>T &amp; U</h1><p>a<br>b</p><script>x</script><td>c</td>") == "T & U\na\nb\nc"


@pytest.mark.parametrize(
    ("v", "want"),
    [("Mr. JOHN O'BRIEN-SMITH", "John O'Brien-Smith"), ("Contact Person: anna lee, CEO", "Anna Lee"), ("Acme Trading LLC", ""), ("Jhn Brtkrs", ""), ("n/a", ""), ("bob 12345", ""), ("sales team", ""), ("www.firm.ae", ""), ("Al", "Al")],
)
def test_person(one, v, want):
    assert one(names.person("v"), v=v) == want


def test_persons(one):
    assert one(names.merge_persons(F.lit("john doe;Anna Lee"), F.lit("JOHN DOE;Bo Ek"))) == "John Doe;Anna Lee;Bo Ek"
    assert one(names.person("v", F.lit("Anna Lee")), v="anna lee") == ""
    assert one(names.looks_like_person("v"), v="Maria da Silva") and not one(names.looks_like_person("v"), v="Silva Comercio Ltda") and not one(names.looks_like_person("v"), v="Maria") and not one(names.looks_like_person("v"), v="Maria 2 Silva")
    assert one(names.is_human_officer("v"), v="SMITH, Anna") and not one(names.is_human_officer("v"), v="SMITH NOMINEES LIMITED")


def test_keys(one):
    assert one(names.key_engine(F.lit("Åcme 1"), F.lit("x.dk"))) == "name|cme1" and one(names.key_engine(F.lit("株式"), F.lit("https://www.x.dk/"))) == "domain|x.dk"
    assert one(names.key_alnum("v"), v="Åcme-1 株") == "åcme1株" and one(names.key_three(F.lit(" A"), F.lit("B "), F.lit(""))) == "a | b | "
    assert one(names.key_merge(F.lit("A社"), F.lit("代表取締役社長 山田"), F.lit("https://www.a.co.jp"), F.lit(""))) == "a社|山田|a.co.jp"
    assert one(names.key_merge(F.lit("A"), F.lit(""), F.lit(""), F.lit("b"))) == "a|||b"
    assert one(names.seed_id("v"), v=" Acme ") == __import__("hashlib").md5(b"acme").hexdigest()[:16]


def test_sanitized(one):
    good = dict(n="A &amp; B", r="Anna Lee", p="☎ +45 12(34)x")
    got = one(names.sanitized("n", "r", F.array(F.lit("info@firm.dk"), F.lit("test@firm.dk")), "p"), **good)
    assert tuple(got) == ("A & B", "Anna Lee", "info@firm.dk", "+45 12(34)")
    for bad in (good | {"r": "Holding ApS"}, good | {"n": "x"}, good | {"r": " "}):
        assert one(names.sanitized("n", "r", F.array(F.lit("info@firm.dk")), "p"), **bad) is None
    long = "word " * 40
    assert one(names.sanitized("n", "r", F.array(F.lit("info@firm.dk")), "p"), **good | {"n": long})["company_name"] == long[:150].rsplit(" ", 1)[0]
    assert not one(names.has_corporate_suffix("v"), v="Asta Agger") and one(names.has_corporate_suffix("v"), v="Foo A/S")


def test_scores(one):
    s = lambda q, n, w="", p="": one(names.candidate_score(F.lit(q), F.lit(n), F.lit(w), F.lit(p)))
    assert s("Acme Ltd.", "ACME") == 100 and s("Acme", "Acme Tools") == 70 and s("Acmex", "Acme Tools") == 45 and s("Acme", "Zed") == 0
    assert s("Acme", "Zed", "https://www.acme.dk") == 100 and s("Acme", "Zed", "acmetools.dk") == 80 and s("Blue Acme", "Zed", "acme.dk") == 95
    assert s("Acme", "Acme", "https://zed.hk") == 40 and s("Acme", "Acme", "", "+86 1") == 40 and s("Acme", "Acme one two three") == 25
    assert one(names.without_uk_suffix("v"), v="Acme & Sons UK Ltd") == "acme and sons"
    assert one(names.phone("v"), v="+45 12 34 56 78") == "+45 12 34 56 78" and one(names.phone("v"), v="12") == ""
    assert one(names.local_name_score("v"), v="한국전기") > 0 and one(names.local_name_score("v"), v="Acme") == -10000


def test_text(one):
    assert one(text.trim("v"), v="　\t a \n") == "a" and one(text.clean("v"), v="a ???? b") == "" and one(text.fold_marks("v"), v="éＡ") == "eA"
    assert one(text.middle_cut("v", 4, "-"), v="abcdefgh") == "ab-gh" and one(text.number("v"), v="1,234") == 1234 and one(text.number("v"), v="x") == 0
    assert one(text.tokens_supported(F.lit("Anna Lee"), F.lit("by anna"))) is True and one(text.tokens_supported(F.lit("Anna Lee"), F.lit("by bo"))) is False
    assert one(names.inline_representative("v"), v="代表取締役: 山田太郎") == "山田太郎" and one(names.inline_representative("v"), v="代表: 電話") == ""
    assert one(names.address("a", "b", "c"), a="x", b=" ", c="x") == "x" and one(names.jp_prefix("v"), v="東京都港区芝1-2") == "東京都港区" and one(names.keyword_seed("v"), v="株式会社青空") == "株式会社青"


def test_addresses_take_time_in_proportion(spark):
    """A million letters without @, and texts where an address ends inside a run."""
    import time

    from rosterweave.functions import emails

    df = spark.createDataFrame([("a" * 1_000_000,), ("x@b.co1y@d.com, z@e.dk",), ("a.b@c" * 50_000,)], "t string").cache()
    df.count()
    start = time.time()
    got = [r["e"] for r in df.select(emails.harvest_json("t").alias("e")).collect()]
    assert time.time() - start < 10 and got[0] == [] and got[1] == ["x@b.co", "1y@d.com", "z@e.dk"]
