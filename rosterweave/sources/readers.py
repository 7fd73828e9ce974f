"""Sources: line files with precedence, tables with discovered columns, histories, key files, landed pages.

Folders are listed on the driver through Hadoop's file system, so any store that Spark reads will do; the data itself is read by Spark.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterweave.functions import names
from rosterweave.functions.text import filled, middle_cut, text, trim
from rosterweave.operators.closure import reached
from rosterweave.operators.delta import union_in_order

#: The files of a site folder, the first that is there is read.
CANDIDATES = ("final_companies.jsonl", "companies_with_emails.jsonl")


class Folder:
    """A path and what lies in it, in any file system that Spark knows."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, folders: bool | None = None) -> list[str]:
        if not self._fs.exists(self._at):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at) if folders is None or s.isDirectory() == folders)

    def has(self, name: str) -> bool:
        return self._fs.exists(self._child(name))

    def _child(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path, name)

    def move(self, name: str, to: str) -> None:
        target = self._child(to)
        self._fs.mkdirs(target.getParent())
        self._fs.rename(self._child(name), target)

    def delete(self, name: str) -> None:
        self._fs.delete(self._child(name), True)

    def make(self) -> None:
        self._fs.mkdirs(self._at)

    def write_text(self, name: str, content: str) -> None:
        out = self._fs.create(self._child(name), True)
        out.write(bytearray(content.encode("utf-8")))
        out.close()

    def read_text(self, name: str) -> str:
        row = self.spark.read.text(f"{self.path}/{name}", wholetext=True).first()
        return row[0] if row else ""


def jsonl_sites(spark: SparkSession, root: str, schema: str, candidates: tuple[str, ...] = CANDIDATES, skip: tuple[str, ...] = ("delivery",)) -> DataFrame | None:
    """SC1: of each site folder in order the first candidate file; malformed lines are errors, blank lines are skipped. Adds source, site_ord and seq (order within a site)."""
    top, tables = Folder(spark, root), []
    for site in top.names(folders=True):
        if site in skip:
            continue
        inside = Folder(spark, f"{root}/{site}")
        if name := next((c for c in candidates if inside.has(c)), None):
            tables.append(json_lines(spark, f"{root}/{site}/{name}", schema).withColumn("source", F.lit(site)))
    return union_in_order(*tables) if tables else None


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """SC5: a file of JSON lines; seq follows the order of the file: splits in order of their start, then lines."""
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return df.select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias("seq"))


def discovered(df: DataFrame, wanted: list[str], order: tuple[str, ...] = ("id", "company_name")) -> DataFrame:
    """SC3: the wanted columns, blank where the table has none; `email` stands in for `emails`; ordered by the first order column there is."""
    have = set(df.columns)
    pick = lambda c: text(c) if c in have else text("email") if c == "emails" and "email" in have else F.lit("")
    by = next((c for c in order if c in have), None)
    return df.select(*[pick(c).alias(c) for c in wanted], *([F.col(by).alias("seq")] if by else [F.monotonically_increasing_id().alias("seq")]))


def table_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """SC2: a table of Parquet files, empty where there is none."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return spark.read.schema(schema).parquet(path) if Folder(spark, parent or ".").has(name) else spark.createDataFrame([], schema)


def site_tables(spark: SparkSession, paths: list[str], wanted: list[str]) -> DataFrame:
    """SC4: tables of several sites one after the other; their order decides who wins."""
    return union_in_order(*[discovered(spark.read.parquet(p), wanted) for p in paths])


def sqlite_files(spark: SparkSession, paths: str | list[str], table: str, wanted: list[str], order: tuple[str, ...] = ("id", "company_name"), mounted: bool = False) -> DataFrame:
    """SC2-SC4: a table of SQLite database files, wherever Spark can read them: file, seq (the order within a file) and the wanted columns as text.

    Columns that a file lacks are blank, `email` stands in for `emails`; rows come in order of the first order column there is. A file
    without the table has no rows. Each file is read by one task. Spark can't read a file of over 2 GB as bytes, and that ends the query with an error that names the file; such databases,
    on storage that every executor mounts, are read in place with `mounted` set: the task then opens the path itself and holds no copy."""
    import sqlite3

    names_, quoted = list(wanted), '"' + table.replace('"', '""') + '"'

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), [None] * batch.num_rows if mounted else batch.column(1), strict=True):
                db = sqlite3.connect(f"{path}?mode=ro" if mounted else ":memory:", uri=mounted)
                if not mounted:
                    db.deserialize(content.as_py())
                have = [r[1] for r in db.execute(f"PRAGMA table_info({quoted})")]
                if have:
                    pick = [c if c in have else "email" if c == "emails" and "email" in have else None for c in names_]
                    columns = ", ".join("''" if c is None else "CAST(\"" + c.replace('"', '""') + "\" AS TEXT)" for c in pick)
                    by = next((c for c in order if c in have), "rowid")
                    rows = db.execute(f"SELECT {columns} FROM {quoted} ORDER BY {by}")
                    seq = 0
                    while part := rows.fetchmany(10_000):
                        yield pa.RecordBatch.from_arrays([pa.array([path] * len(part)), pa.array(range(seq, seq + len(part)), pa.int64()), *(pa.array([v or "" for v in c], pa.string()) for c in zip(*part, strict=True))], names=["file", "seq", *names_])
                        seq += len(part)
                db.close()

    files = spark.read.format("binaryFile").load(paths)
    # the length is asked for so that rows come from the files' status alone
    files = files.select(F.regexp_replace("path", "^file:/+", "file:///").alias("path"), "length").repartition(F.col("path")).select("path") if mounted else files.select("path", "content")
    return files.mapInArrow(run, "file string, seq long, " + ", ".join(f"`{c}` string" for c in names_))


def sqlite_sites(spark: SparkSession, sites: dict[str, str], table: str, wanted: list[str]) -> DataFrame:
    """SC4: databases of several sites (name: path) one after the other; their order decides who wins."""
    return union_in_order(*[sqlite_files(spark, path, table, wanted).withColumn("source", F.lit(site)) for site, path in sites.items()])


def csv_history(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """SC6: delivered files; addresses are split at ;."""
    df = spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).csv(paths)
    return df.withColumn("emails", F.filter(F.transform(F.split(text("emails"), ";"), lambda e: F.trim(e)), lambda e: e != ""))


def key_file(spark: SparkSession, path: str, upgrade: bool = True) -> DataFrame:
    """SC7: keys by line; the older form name|domain gives a name key and a domain key."""
    line = spark.read.text(path).select(trim("value").alias("key")).filter("key <> ''")
    if not upgrade:
        return line.distinct()
    new = F.col("key").rlike(r"^(name|domain)\|")
    left, right = F.substring_index("key", "|", 1), F.regexp_extract("key", r"\|(.*)$", 1)
    old = F.filter(F.array(F.when(left != "", F.concat(F.lit("name|"), left)), F.when(right != "", F.concat(F.lit("domain|"), right))), lambda k: k.isNotNull())
    return line.select(F.explode(F.when(new | ~F.contains("key", F.lit("|")), F.array("key")).otherwise(old)).alias("key")).distinct()


def keys_of_csv(spark: SparkSession, path: str, name: str = "company_name") -> DataFrame:
    """SC7: where a day has no key file, the lower-cased names of its CSV."""
    return spark.read.option("header", True).option("escape", '"').csv(path).select(names.key_lower(name).alias("key")).filter("key <> ''").distinct()


def tidy_key(c: str) -> Column:
    """SC8: key text trimmed part by part."""
    return F.array_join(F.transform(F.split(F.lower(trim(c)), r"\|"), lambda p: F.trim(p)), "|")


def baseline_keys(spark: SparkSession, delivery: str, country: str, day: int, site: str | None = None, search_back: bool = True, tidy: bool = False) -> DataFrame:
    """SC7, SC8: the keys of the last day that has some, going back from `day`; site files before country files, keys before CSV. With search_back off, of that day alone; with tidy, key text is trimmed part by part."""
    from rosterweave.operators.queues import day_folder

    for n in range(day, 0, -1) if search_back else ([day] if day else []):
        folder = Folder(spark, f"{delivery}/{day_folder(country, n)}")
        for stem in [s for s in (site, None) if s or s is None]:
            keys, csv = (f"{stem}.keys.txt", f"{stem}.csv") if stem else ("keys.txt", "companies.csv")
            if folder.has(keys):
                found = key_file(spark, f"{folder.path}/{keys}", upgrade=False)
                return found.select(tidy_key("key").alias("key")).distinct() if tidy else found
            if folder.has(csv):
                return keys_of_csv(spark, f"{folder.path}/{csv}")
    return spark.createDataFrame([], "key string")


def website_list(spark: SparkSession, path: str) -> DataFrame:
    """SC9: websites by line, trimmed, each once, sorted."""
    return spark.read.text(path).select(trim("value").alias("website")).filter("website <> ''").distinct().orderBy("website")


def landed_pages(spark: SparkSession, path: str, content_type: str | None = None) -> DataFrame:
    """SC12, SC15: pages that were landed as a table: blank ones and other content types are left out."""
    df = spark.read.parquet(path)
    fine = filled("html") & filled("url")
    if content_type and content_type in df.columns:
        fine = fine & (F.col(content_type).isNull() | F.lower(content_type).rlike("html|xml|text"))
    return df.filter(fine)


#: The most letters of a page, and what stands where its middle was.
PAGE_CHARS, PAGE_CUT = 250_000, "\n<!-- 页面内容过长已截断 -->\n"


def page_bundle(pages: DataFrame, most: int | None = PAGE_CHARS, url: str = "url", html: str = "html") -> DataFrame:
    """UR15: pages for an extraction: addresses trimmed, pages without address or content and files that are no pages left out, the middle of what is longer than `most` cut out (None: nothing is cut)."""
    from rosterweave.functions import urls

    kept = pages.withColumn(url, trim(url)).filter((F.col(url) != "") & ~urls.is_asset(url) & filled(html))
    return kept.withColumn(html, text(html) if most is None else middle_cut(html, most, PAGE_CUT))


def sitemap_urls(files: DataFrame, start: str, limit: int = 200, depth: int = 3, url: str = "url", body: str = "body") -> DataFrame:
    """SC14: page addresses of a site from landed robots and sitemap files, following sitemaps of sitemaps `depth` levels down (a recursive table, so any depth is one plan; bodies that are gzip go through `decode.unpacked` first); own host only, no files, `limit` of them."""
    from rosterweave.functions import urls

    robots = F.regexp_extract_all(text(body), F.lit(r"(?im)^\s*sitemap:\s*(\S+)"), 1)
    named = files.filter(F.endswith(url, F.lit("/robots.txt")) & (urls.host(url) == urls.host(F.lit(start)))).select(F.explode(robots).alias("loc"))
    default = files.filter(F.col(url) == start.rstrip("/") + "/sitemap.xml").select(F.col(url).alias("loc"))
    locs = F.regexp_extract_all(text(body), F.lit(r"(?is)<loc>\s*(?:<!\[CDATA\[)?\s*(.*?)\s*(?:\]\]>)?\s*</loc>"), 1)
    index = F.lower(text(body)).rlike("<sitemapindex")
    links = files.filter(index).select(F.col(url).alias("src"), F.explode(locs).alias("dst"))
    read = reached(links, named.unionByName(default).select(F.col("loc").alias("node")), depth)
    pages = files.filter(~index).join(read, files[url] == read["node"], "left_semi").select(F.explode(locs).alias("page"))
    own = (urls.host("page") == urls.host(F.lit(start))) & ~urls.is_asset("page")
    return pages.filter(own).distinct().orderBy("page").limit(limit)


def embedded_json(html: str, marker: str = "__NEXT_DATA__") -> Column:
    """SC17: the JSON text of a page's script with that id, '' if there is none."""
    return F.regexp_extract(text(html), rf"(?is)<script[^>]*id=[\"']{re.escape(marker)}[\"'][^>]*>(.*?)</script>", 1)


def linked_data(html: str) -> Column:
    """SC17: the JSON texts of a page's linked-data scripts."""
    return F.regexp_extract_all(text(html), F.lit(r"(?is)<script[^>]*type=[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"), 1)


def guarded_json(body: str, prefix: str = ")]}'") -> Column:
    """SC17: JSON text without the guard that some services put before it; else the first braced block."""
    t = trim(body)
    bare = F.when(F.startswith(t, F.lit(prefix)), F.substr(t, F.lit(len(prefix) + 1))).otherwise(t)
    return F.when(bare.rlike(r"^\s*[\[{]"), trim(bare)).otherwise(F.regexp_extract(bare, r"(?s)(\{.*\})", 1))
