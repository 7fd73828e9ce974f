"""Names by similarity, snapshots by buckets, keys by an index, paged and spreadsheet sources, slots for many tasks: each against a plain version."""

import gzip
import json
import random
import re
import sqlite3
import time
import zipfile
from pathlib import Path

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from rosterweave.functions import html_parsers, keywords
from rosterweave.operators import closure, limits, ranking, similarity
from rosterweave.operators.snapshot import Snapshot
from rosterweave.operators.upsert import fold
from rosterweave.shipping import ship
from rosterweave.sources import decode, excel, readers
from rosterweave.sources.cursor import CursorSource
from rosterweave.sources.key_index import KeyIndex
from rosterweave.sources.paged import PagedSource

# ---- names


def plain_grams(name, q=3):
    return {name} - {""} if len(name) <= q else {name[k : k + q] for k in range(len(name) - q + 1)}


def names(seed, n):
    rnd = random.Random(seed)
    parts = ["nordic", "steel", "works", "data", "trade", "house", "north", "sea", "fish", "bank"]
    made = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 4))) + rnd.choice(["", "", str(rnd.randrange(40))]) for _ in range(n)]
    return [*made, *[m[:-1] + "x" for m in made[: n // 4]], None, "", "a", "ab", "株式会社山田製作所", "山田製作所"]


@pytest.mark.parametrize("of", [40, 60, 80, 100])
@pytest.mark.parametrize("hot", [2, 10_000])
def test_similar_names(spark, of, hot, monkeypatch):
    """Recall and precision of 1 against all pairs, with most grams frequent or none; no plan compares all with all."""
    monkeypatch.setattr(similarity, "HOT", hot)
    left, right = (spark.createDataFrame([(k, n) for k, n in enumerate(names(seed, 120))], "id long, name string").repartition(3) for seed in (1, 2))
    found = similarity.similar_names(left, right, "name", "name", of, fold=F.col)
    want = set()
    for a in {n for n in names(1, 120) if n}:
        for b in {n for n in names(2, 120) if n}:
            x, y = plain_grams(a), plain_grams(b)
            if 100 * len(x & y) >= of * len(x | y):
                want.add((a, b, len(x & y), len(x | y)))
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_found_by_name_gives_rows_and_scores(spark):
    known = spark.createDataFrame([(1, "Nordic Steel Ltd", "https://nordicsteel.dk", ""), (2, "Nordic Steel Works", "", ""), (3, "Other", "", ""), (4, "Nordic Steel Ltd", "", "")], "id long, name string, website string, phone string")
    found = similarity.found_by_name(spark.createDataFrame([(9, "NORDIC STEEL")], "q long, query string"), known, "query", "name", of=40)
    assert sorted((r["id"], r["name_score"]) for r in found.collect()) == sorted({(r["id"], r["name_score"]) for r in found.collect()}) and {1, 4} <= {r["id"] for r in found.collect()}
    best = ranking.best_candidate(found.select("q", "query", "name", "website", "phone", F.col("id").alias("pos")), "q", "query").first()
    assert best["pos"] == 1


# ---- snapshots


def files(path):
    return sorted(str(p.relative_to(path)) for p in Path(path).rglob("*.parquet"))


POLICY = {"name": "non_blank", "tags": "join", "n": "overwrite"}


def batches(seed, n, keys):
    rnd = random.Random(seed)
    return [(str(rnd.choice(keys)), s, rnd.choice(["", f"name{rnd.randrange(9)}"]), rnd.choice(["", "a", "b; c"]), rnd.randrange(100)) for s in range(n)]


SCHEMA = "id string, seq long, name string, tags string, n int"


def test_a_batch_touches_its_buckets_alone(spark, tmp_path):
    keys = list(range(3000))
    first = spark.createDataFrame(batches(1, 6000, keys), SCHEMA)
    shot = Snapshot(spark, str(tmp_path / "s"), ["id"], POLICY, n=64)
    assert shot.table() is None and len(shot.apply(first, 0)) == 64
    before, whole = files(tmp_path), fold(None, first, ["id"], POLICY)
    second = spark.createDataFrame(batches(2, 12, [3, 4, 5001]), SCHEMA)
    hit = shot.apply(second, 1)
    new = sorted(set(files(tmp_path)) - set(before))
    assert 0 < len(hit) <= 3 and {re.search(r"bucket=(\d+)", f)[1] for f in new} == {str(b) for b in hit} and set(before) <= set(files(tmp_path))
    plan = shot.table(hit)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("bucket=") <= 2 * len(hit) + 2  # the scan names the folders of these buckets
    want = fold(whole, second, ["id"], POLICY)
    assert sorted(map(tuple, shot.table().collect())) == sorted(map(tuple, want.collect()))
    assert shot.apply(second, 1) == []  # given again
    again = Snapshot(spark, str(tmp_path / "s"), ["id"], POLICY)
    assert again.at.n == 64 and sorted(map(tuple, again.table().collect())) == sorted(map(tuple, want.collect()))
    gone = again.vacuum()
    assert sorted(gone) == sorted(f"v0/bucket={b}" for b in hit if f"v0/bucket={b}/" in " ".join(before))
    assert sorted(map(tuple, again.table().collect())) == sorted(map(tuple, want.collect()))


def test_a_batch_that_dies_leaves_the_last_manifest(spark, tmp_path):
    shot = Snapshot(spark, str(tmp_path / "s"), ["id"], POLICY, n=4)
    shot.apply(spark.createDataFrame([("a", 0, "x", "", 1)], SCHEMA), 0)
    (tmp_path / "s" / "v1" / "bucket=0").mkdir(parents=True)  # written, and no manifest
    (tmp_path / "s" / "v1" / "bucket=0" / "part-0.parquet").write_bytes(b"half a file")
    again = Snapshot(spark, str(tmp_path / "s"), ["id"], POLICY)
    assert [tuple(r) for r in again.table().collect()] == [("a", "x", "", 1)]
    again.apply(spark.createDataFrame([("a", 1, "y", "t", 2), (None, 2, "z", "", 3)], SCHEMA), 1)
    assert sorted(map(repr, map(tuple, again.table().collect()))) == sorted(map(repr, [("a", "y", "t", 2), (None, "z", "", 3)]))


# ---- keys


def test_days_add_their_own_keys(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "k"), ranges=8, bits=14)
    rnd, seen = random.Random(4), {}
    for day in range(1, 5):
        today = [f"name|{rnd.randrange(300 * day)}" for _ in range(120)]
        rows = spark.createDataFrame([(k, n) for n, k in enumerate([*today, None])], "key string, n long")
        fresh = {r["key"] for r in index.undelivered(rows).collect()}
        assert fresh == {k for k in [*today, None] if k not in seen}
        before = files(tmp_path / "k" / "keys")
        index.add(rows, day)
        new = [f for f in files(tmp_path / "k" / "keys") if f not in before]
        assert new and all(f.startswith(f"day={day}/") for f in new)
        for k in today:
            seen.setdefault(k, day)
        assert {(r["key"], r["day"]) for r in index.keys().collect()} == set(seen.items())
        index.add(rows, day)  # given again
        assert {(r["key"], r["day"]) for r in index.keys().collect()} == set(seen.items())
    assert {r["key"] for r in index.keys(until=2).collect()} == {k for k, d in seen.items() if d <= 2}
    index.rebuilt()
    asked = spark.createDataFrame([(k,) for k in seen] + [("name|never",)], "key string")
    assert [r["key"] for r in index.undelivered(asked).collect()] == ["name|never"]


def test_new_rows_meet_no_keys(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "k"), ranges=16)
    index.add(spark.createDataFrame([(f"k{n}",) for n in range(500)], "key string"), 1)
    rows = spark.createDataFrame([(f"new{n}",) for n in range(2000)], "key string")
    assert index.split(rows).filter("_maybe").count() <= 2 and index.undelivered(rows).count() == 2000
    one = index.keys(ranges=[3])
    assert 0 < one.count() < 120 and all("range=3" in f for f in one.inputFiles())
    two = spark.createDataFrame([("k1", "other"), ("fresh", "k2"), ("fresh", None), (None, "fresh")], "a string, b string")
    assert sorted(map(repr, map(tuple, index.undelivered_by_two(two, "a", "b").collect()))) == sorted(map(repr, [("fresh", None), (None, "fresh")]))


# ---- pages by offset, chains


@pytest.fixture
def pages(spark, tmp_path):
    ship(spark)
    spark.dataSource.register(PagedSource)
    spark.dataSource.register(CursorSource)
    for page in range(1, 26):
        (tmp_path / f"page_{page}.json").write_text(json.dumps({"items": [{"n": 10 * (page - 1) + k} for k in range(10 if page < 25 else 3)], "total": 243, "page_size": 10}))
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    yield tmp_path
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_pages_are_partitions(spark, pages):
    df = spark.read.format("offset_pages").option("path", str(pages)).option("pagesPerPartition", 4).load()
    assert df.rdd.getNumPartitions() == 7
    assert sorted(json.loads(r["item"])["n"] for r in df.collect()) == list(range(243))
    assert spark.read.format("offset_pages").option("path", f"file://{pages}").load().count() == 243


def test_filters_spare_pages(spark, pages):
    for page in (2, 9, 20, 24):
        (pages / f"page_{page}.json").unlink()  # reading one of them would fail
    load = lambda: spark.read.format("offset_pages").option("path", str(pages)).option("pagesPerPartition", 4).load()
    got = lambda f: sorted({r["page"] for r in load().filter(f).collect()})
    assert got("page = 7") == [7] and got("page >= 3 and page < 9") == [3, 4, 5, 6, 7, 8] and got("page in (1, 25, 90)") == [1, 25] and got("page > 24") == [25] and got("page > 90") == []
    assert load().filter("page between 10 and 12").rdd.getNumPartitions() == 1
    with pytest.raises(PythonException, match="page (2|9|20|24) of"):
        load().collect()
    assert spark.read.format("offset_pages").option("path", str(pages)).option("allowMissing", "true").load().count() == 203
    assert spark.read.format("offset_pages").option("path", str(pages / "none")).load().count() == 0


def test_a_chain_ends_where_it_ends_and_a_ring_is_an_error(spark, pages):
    for k in range(300):
        (pages / f"page_{'start' if not k else f'c{k}'}.json").write_text(json.dumps({"items": [k], "last_sort": f"c{k + 1}" if k < 299 else ""}))
    chain = spark.read.format("cursor_pages").option("path", str(pages)).load()
    assert chain.count() == 300
    (pages / "page_c299.json").write_text(json.dumps({"items": [1], "last_sort": "c5"}))
    with pytest.raises(PythonException, match="comes back"):
        chain.count()


# ---- spreadsheets

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def book(path, sheets, shared, active=0):
    """sheets: name -> XML of the rows."""
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {MAIN}><bookViews><workbookView activeTab="{active}"/></bookViews><sheets>' + "".join(f'<sheet name="{n}" sheetId="{k + 1}" r:id="rId{k + 1}"/>' for k, n in enumerate(sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="rId{k + 1}" Target="{"/xl/" if k else ""}worksheets/s{k}.xml"/>' for k in range(len(sheets))) + "</Relationships>")
        for k, rows in enumerate(sheets.values()):
            z.writestr(f"xl/worksheets/s{k}.xml", f"<worksheet {MAIN}><sheetData>{rows}</sheetData></worksheet>")
        z.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>" + "".join(f"<si>{s}</si>" for s in shared) + "</sst>")


SHARED = ["<t>Company Name</t>", "<t xml:space='preserve"+"'> Acme &amp; Co </t>", "<r><t>Nordic </t></r><r><t>Steel</t></r><rPh><t>reading</t></rPh>", "<t>acme &amp; co</t>", "<t>www.a.dk</t>", "<t>post@a.dk</t>", "<t>https://b.dk</t>"]
NAMES = '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row r="3"><c r="B3" t="s"><v>2</v></c><c r="AA3" t="inlineStr"><is><t>Inline</t></is></c><c r="AB3"/></row><row><c t="s"><v>3</v></c><c><v>42.5</v></c><c t="b"><v>1</v></c></row>'
SITES = '<row r="1"><c r="A1" t="s"><v>0</v></c></row><row r="2"><c r="A2" t="s"><v>4</v></c><c r="D2" t="s"><v>5</v></c></row><row r="3"><c r="D3" t="s"><v>5</v></c></row><row r="4"><c r="A4" t="s"><v>6</v></c></row>'


def test_spreadsheets(spark, tmp_path):
    book(tmp_path / "a.xlsx", {"names": NAMES, "sites": SITES}, SHARED, active=1)
    table = {(r["title"], r["row"], r["col"]): r["value"] for r in excel.excel_table(spark, str(tmp_path)).collect()}
    assert table["names", 1, 3] == " Acme & Co " and table["names", 3, 2] == "Nordic Steel" and table["names", 3, 27] == "Inline" and table["names", 4, 1] == "acme & co" and table["names", 4, 2] == "42.5" and table["names", 4, 3] == "True"
    assert sorted((r["website"], r["email"]) for r in excel.excel_rows(spark, str(tmp_path)).collect()) == [("https://b.dk", ""), ("https://www.a.dk", "post@a.dk")]
    book(tmp_path / "b.xlsx", {"names": NAMES}, SHARED)
    found = [r["company_name"] for r in excel.excel_cells(spark, [str(tmp_path / "a.xlsx"), str(tmp_path / "b.xlsx")]).collect()]
    assert sorted(found) == sorted(["Acme & Co", "Nordic Steel", "Inline", "42.5", "True", "www.a.dk", "post@a.dk", "https://b.dk"])


def test_many_rows_leave_in_batches_and_odd_files_are_named(spark, tmp_path):
    rows = "".join(f'<row r="{n}"><c r="A{n}"><v>{n}</v></c></row>' for n in range(1, 25_001))
    book(tmp_path / "big.xlsx", {"s": rows}, [])
    assert excel.excel_table(spark, str(tmp_path / "big.xlsx")).agg(F.count(F.lit(1)), F.max("row")).first()[:] == (25_000, 25_000)
    (tmp_path / "no.xlsx").write_bytes(b"not a zip")
    with pytest.raises(PythonException, match=r"no\.xlsx is no spreadsheet"):
        excel.excel_table(spark, str(tmp_path / "no.xlsx")).count()


# ---- slots


def plain_slots(tasks, slots, now, limit):
    """Picking one by one."""
    out = []
    for pool in {t[0] for t in tasks}:
        own = [dict(zip(("pool", "idx", "in_flight", "last_used", "cooling_until", "disabled"), s, strict=True)) for s in slots if s[0] == pool]
        clock = now
        for _, task in sorted(t for t in tasks if t[0] == pool):
            free = [s for s in own if not s["disabled"] and (s["cooling_until"] is None or s["cooling_until"] <= now) and (s["in_flight"] or 0) < limit]
            if not free:
                break
            s = min(free, key=lambda s: (s["in_flight"] or 0, s["last_used"] or 0, s["idx"]))
            out.append((pool, task, s["idx"], s["in_flight"] or 0))
            clock += 1
            s["in_flight"], s["last_used"] = (s["in_flight"] or 0) + 1, clock
    return out


@pytest.mark.parametrize("seed", range(3))
def test_many_tasks_to_slots(spark, seed):
    rnd = random.Random(seed)
    slots = [(f"p{p}", k, rnd.choice([None, 0, 0, 1, 2, 3, 5]), rnd.choice([None, *range(1, 9)]), rnd.choice([None, None, 5, 500]), rnd.choice([None, False, False, True])) for p in range(4) for k in range(rnd.randrange(0, 14))]
    tasks = [(f"p{rnd.randrange(5)}", n) for n in range(150)]
    s = spark.createDataFrame(slots or [("x", 0, 9, 1, 1, True)], "pool string, idx int, in_flight int, last_used int, cooling_until int, disabled boolean").repartition(3)
    t = spark.createDataFrame(tasks, "pool string, task long").repartition(4)
    got = ranking.assigned(t, s, "pool", F.lit(100), 4, [F.col("task")])
    assert sorted(map(tuple, got.collect())) == sorted(plain_slots(tasks, slots, 100, 4))
    first = {(r["pool"], r["idx"]) for r in ranking.least_loaded(s, "pool", F.lit(100), disabled="disabled", limit=4).collect()}
    assert {(p, i) for p, n, i, _ in plain_slots(tasks, slots, 100, 4) if n == min(k for q, k in tasks if q == p)} <= first


def test_ranks_by_range(spark, tmp_path):
    rnd = random.Random(1)
    rows = [(rnd.choice(["a", "a", "a", "b", None]), n) for n in range(2000)]
    got = ranking.ranked_by_range(spark.createDataFrame(rows, "g string, n long").repartition(5), ["g"], [F.desc("n")], "r", str(tmp_path / "r"))
    want = [(g, n, r) for x in ("a", "b", None) for r, (g, n) in enumerate(sorted((row for row in rows if row[0] == x), key=lambda row: -row[1]))]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


# ---- closures, limits, deep pages, packed sitemaps, databases in place


def test_reached_levels(spark):
    edges = [(f"n{k}", f"n{k + 1}") for k in range(50)] + [("n50", "n0"), ("n5", "n3"), ("n0", "n40"), ("x", "y"), ("n1", None), (None, "n9")]
    e, s = spark.createDataFrame(edges, "src string, dst string"), spark.createDataFrame([("n0",), (None,), ("alone",)], "node string")
    got = {r["node"]: r["level"] for r in closure.reached(e, s, 60).collect()}
    want, at, level = {"n0": 0, "alone": 0}, ["n0", "alone"], 0
    while at:
        level += 1
        at = [b for b in dict.fromkeys(b for a, b in edges if a in at and b is not None) if b not in want]
        want |= dict.fromkeys(at, level)
    assert got == want
    assert {r["node"] for r in closure.reached(e, s, 2).collect()} == {n for n, k in want.items() if k <= 2}


def test_a_chain_of_50_sitemaps(spark):
    index = lambda *locs: "<sitemapindex>" + "".join(f"<loc>{x}</loc>" for x in locs) + "</sitemapindex>"
    files = [("https://f.dk/robots.txt", "Sitemap: https://f.dk/s0.xml")] + [(f"https://f.dk/s{k}.xml", index(f"https://f.dk/s{k + 1}.xml", "https://f.dk/s0.xml")) for k in range(50)] + [("https://f.dk/s50.xml", "<urlset><loc>https://f.dk/deep</loc></urlset>")]
    table = spark.createDataFrame(files, "url string, body string")
    assert [r["page"] for r in readers.sitemap_urls(table, "https://f.dk", depth=50).collect()] == ["https://f.dk/deep"]
    assert readers.sitemap_urls(table, "https://f.dk", depth=49).collect() == []


def test_packed_bytes(spark):
    ship(spark)
    whole = gzip.compress(b"<urlset/>" * 9000)
    rows = spark.createDataFrame([(1, bytearray(whole)), (2, bytearray(b"plain")), (3, None), (4, bytearray(whole[: len(whole) // 2]))], "n int, c binary")
    got = {r["n"]: r["c"] for r in rows.select("n", decode.unpacked("c").alias("c")).collect()}
    assert got[1] == b"<urlset/>" * 9000 and got[2] == b"plain" and got[3] is None and (b"<urlset/>" * 9000).startswith(got[4])


def test_deep_pages_keep_their_markdown():
    depth = 3000
    page = "<div>" * depth + '<h2>Title</h2><p>see <a href="/x">this</a></p><ul><li>one</li><li>two</li></ul>' + "</div>" * depth
    flat = html_parsers.to_markdown('<div><h2>Title</h2><p>see <a href="/x">this</a></p><ul><li>one</li><li>two</li></ul></div>')
    assert flat.startswith("## Title") and "[this](/x)" in flat and "- one" in flat and html_parsers.to_markdown(page) == flat


def test_a_record_that_hangs_costs_its_limit(spark):
    def parser(page, url):
        if page == "hang":
            while True:
                time.sleep(0.01)
        if page == "fatal":
            raise MemoryError("out")
        if page == "bad":
            raise ValueError("odd")
        return [{"v": page.upper()}]

    pages = lambda *texts: spark.createDataFrame([(k, "u", t) for k, t in enumerate(texts)], "page_id long, url string, html string").repartition(1)
    start = time.time()
    got = html_parsers.parse_table(pages("a", "hang", "b", "bad", "c"), parser, ["v"], errors=True, seconds=1.0).collect()
    assert {(r["page_id"], r["v"], r["error"]) for r in got} == {(0, "A", ""), (1, "", "RecordTimeout: took over 1 seconds"), (2, "B", ""), (3, "", "ValueError: odd"), (4, "C", "")}
    assert time.time() - start < 30
    with pytest.raises(PythonException, match="MemoryError"):
        html_parsers.parse_table(pages("a", "fatal"), parser, ["v"], errors=True).collect()


def test_an_action_that_hangs_is_interrupted(spark):
    ship(spark)

    def slow(batches):
        for b in batches:
            time.sleep(120)
            yield b

    start = time.time()
    with pytest.raises(TimeoutError, match="interrupted after 3"):
        limits.within(spark, 3, lambda: spark.range(4).mapInPandas(slow, "id long").count())
    assert time.time() - start < 60
    assert limits.within(spark, 60, lambda: spark.range(7).count()) == 7
    with pytest.raises(ZeroDivisionError):
        limits.within(spark, 60, lambda: 1 / 0)


def test_databases_in_place(spark, tmp_path):
    for n in range(2):
        with sqlite3.connect(tmp_path / f"{n}.db") as db:
            db.execute("CREATE TABLE companies (id INTEGER, company_name TEXT)")
            db.executemany("INSERT INTO companies VALUES (?, ?)", [(k, f"c{n}{k}") for k in range(30)])
    held, placed = (sorted((r["file"].split("/")[-1], r["seq"], r["company_name"]) for r in readers.sqlite_files(spark, str(tmp_path / "*.db"), "companies", ["company_name", "emails"], mounted=m).collect()) for m in (False, True))
    assert held == placed and len(placed) == 60


# ---- many words


@pytest.mark.parametrize("block", [7, 10**6])
def test_many_words_at_once(spark, block):
    rnd = random.Random(3)
    words = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 5))) for _ in range(60)})
    texts = [(k, "".join(rnd.choice("abcd ") for _ in range(rnd.randrange(80)))) for k in range(40)] + [(90, None), (91, ""), (None, "abcabc")]
    df, w = spark.createDataFrame(texts, "id int, t string"), spark.createDataFrame([(x,) for x in [*words, *words[:3], None, ""]], "word string")
    got = keywords.found_words(df, "t", ["id"], w, block=block)
    want = [(i, x, n) for i, t in texts for x in words if (n := sum((t or "").startswith(x, k) for k in range(len(t or ""))))]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    counts = {r["word"]: (r["rows"], r["n"]) for r in keywords.word_counts(got, keywords.word_counts(got)).collect()}
    assert counts[words[0]] == (2 * sum(x == words[0] for _, x, _ in want), 2 * sum(n for _, x, n in want if x == words[0]))
    none = {r["id"] for r in keywords.holding_none(df, "t", ["id"], spark.createDataFrame([("ab",), ("cc",)], "word string")).collect()}
    assert none == {i for i, t in texts if not any(x in (t or "") for x in ("ab", "cc"))}
    assert keywords.found_words(df, "t", ["id"], w.limit(0)).collect() == []


def test_ten_thousand_words_in_one_pass(spark):
    words = spark.range(10_000).select(F.concat(F.lit("w"), F.lpad(F.col("id").cast("string"), 5, "0"), F.lit("e")).alias("word"))
    df = spark.range(200).select("id", F.concat(F.lit("x w"), F.lpad((F.col("id") * 7).cast("string"), 5, "0"), F.lit("e w00000e")).alias("t"))
    got = keywords.found_words(df, "t", ["id"], words)
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert got.count() == 2 * 200 - 1 and keywords.word_counts(got).filter("word = 'w00000e'").first()["rows"] == 200
