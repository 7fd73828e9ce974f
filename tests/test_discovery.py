"""From a site's pages to its addresses and representative."""

from rosterweave.functions import html_parsers
from rosterweave.plans import discovery

SCHEMA = "site string, website string, start string, url string, html string"


def test_discover(spark):
    page = lambda site, path, html: (site, f"https://{site}", f"https://{site}/", f"https://{site}{path}", html)
    rows = [
        page("a.jp", "/", "<p>hello</p>"), page("a.jp", "/contact", "<p>info@a.jp</p><p>sales@other.jp</p><p>profile@dir.jp</p>"), page("a.jp", "/about", "<table><tr><td>代表取締役</td></tr><tr><td>山田 太郎</td></tr></table>"),
        page("a.jp", "/x/y/z", "<p>hidden@a.jp</p>"), page("b.jp", "/", "<p>代表者：佐藤 花子</p>"), page("b.jp", "/team", " "), page("c.jp", "/", " ".join(f"<p>p{i}@s{i}.jp</p>" for i in range(9))),
    ]
    second = spark.createDataFrame([("b.jp", ["found@b.jp"]), ("a.jp", ["no@a.jp"])], "site string, emails array<string>")
    got = {r["site"]: r for r in discovery.discover(spark.createDataFrame(rows, SCHEMA), second, limit=3).collect()}
    assert got["a.jp"]["emails"] == ["info@a.jp", "sales@other.jp"] and got["a.jp"]["representative"] == "山田 太郎" and got["a.jp"]["evidence_url"] == "https://a.jp/about"
    assert got["b.jp"]["emails"] == ["found@b.jp"] and got["b.jp"]["representative"] == "佐藤 花子" and got["b.jp"]["retry_hours"] is None
    assert got["c.jp"]["emails"] == [] and got["c.jp"]["retry_hours"] == 12  # looks like a directory


def test_a_page_that_breaks_a_parser_is_a_row(spark):
    def parser(page, url):
        return [{"n": str(1 / (len(page) - 1))}]

    df = spark.createDataFrame([(1, "u", "xx"), (2, "u", "x")], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in html_parsers.parse_table(df, parser, ["n"], errors=True).collect()}
    assert got[1]["n"] == "1.0" and got[2]["error"].startswith("ZeroDivisionError")
