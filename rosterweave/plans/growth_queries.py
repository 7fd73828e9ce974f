"""Driver queries of what grows with a day and not with history, of names found by similarity, and of pages as they stand. See queries.py."""

from __future__ import annotations

from pyspark.sql import functions as F

from rosterweave.functions import emails, keywords, lists, names, urls, variants
from rosterweave.functions.text import squeeze, tokens_supported
from rosterweave.operators import ranking, similarity
from rosterweave.operators.snapshot import Snapshot
from rosterweave.plans.queries import _EMAILS, _HOST_SQL, DAY_TWO, query, table
from rosterweave.sources import readers
from rosterweave.sources.key_index import KeyIndex
from rosterweave.sources.readers import PAGE_CUT
from rosterweave.sources.scratch import shared_folder

_NAME = "regexp_replace(lower({0}), '[^0-9a-z]+', '', 'g')"
_GRAMS = "list_distinct(list_transform(range(1, length(n) - 1), lambda i: substr(n, i, 3)))"


@query(f"""
WITH s AS (SELECT s_suppkey, n, {_GRAMS} AS g FROM (SELECT s_suppkey, {_NAME.format("replace(s_name, 'Supplier', 'Customer')")} AS n FROM supplier)),
c AS (SELECT c_custkey, n, {_GRAMS} AS h FROM (SELECT c_custkey, {_NAME.format("c_name")} AS n FROM customer)),
p AS (SELECT s_suppkey, c_custkey, s.n AS a, c.n AS b, len(list_intersect(g, h)) AS shared, len(g) + len(h) - len(list_intersect(g, h)) AS grams FROM s, c)
SELECT s_suppkey, c_custkey, shared::INT AS shared, grams::INT AS grams, CASE WHEN a = b THEN 100 WHEN contains(b, a) OR contains(a, b) THEN 70 WHEN contains(b, substr(a, 1, 4)) THEN 45 ELSE 0 END AS name_score
FROM p WHERE 100 * shared >= 85 * grams
""")
def found_by_name(spark, d):
    """NA8, TK5: customers whose names are like a supplier's, by a join over grams."""
    s = table(spark, d, "supplier").select("s_suppkey", F.replace("s_name", F.lit("Supplier"), F.lit("Customer")).alias("asked"))
    return similarity.found_by_name(s, table(spark, d, "customer").select("c_custkey", "c_name"), "asked", "c_name", of=85).select("s_suppkey", "c_custkey", "shared", "grams", "name_score")


@query(f"""
WITH v AS (SELECT o_custkey AS k, CASE WHEN o_orderdate < TIMESTAMP '1995-01-01 00:00:00' THEN 0 WHEN o_orderdate < {DAY_TWO} THEN 1 ELSE 2 END AS batch, * FROM orders)
SELECT k, coalesce(arg_max(o_orderpriority, (batch, o_orderkey)) FILTER (WHERE o_orderstatus <> 'P'), '') AS priority, arg_max(o_orderstatus, (batch, o_orderkey)) AS status, max(o_totalprice) AS most FROM v GROUP BY k
""")
def bucketed_upsert(spark, d):
    """UP1-UP3, UP10: three batches folded into a snapshot of buckets."""
    o = table(spark, d, "orders")
    first, second = F.col("o_orderdate") < F.lit("1995-01-01").cast("timestamp_ntz"), F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")
    rows = o.select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("seq"), F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderpriority")).alias("priority"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("most"), F.when(first, 0).when(second, 1).otherwise(2).alias("batch"))
    shot = Snapshot(spark, f"{shared_folder(spark)}/snapshot", ["k"], {"priority": "non_blank", "status": "overwrite", "most": "greatest"}, n=16)
    for batch in range(3):
        shot.apply(rows.filter(F.col("batch") == batch).drop("batch"), batch)
    return shot.table()


@query(f"""
WITH day_one AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < {DAY_TWO}), later AS (SELECT * FROM orders WHERE o_orderdate >= {DAY_TWO})
SELECT o_orderkey, 'cust|' || o_custkey AS key FROM later WHERE o_custkey NOT IN (SELECT o_custkey FROM day_one)
""")
def indexed_delta(spark, d):
    """J4, SK2: what the second day brings, by the index of keys that the first day wrote."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate", F.concat(F.lit("cust|"), F.col("o_custkey").cast("string")).alias("key"))
    early = F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")
    index = KeyIndex(spark, f"{shared_folder(spark)}/keys", ranges=16, bits=20)
    index.add(o.filter(early), 1)
    return index.undelivered(o.filter(~early)).select("o_orderkey", "key")


@query(f"""
WITH o AS (SELECT DISTINCT 'cust|' || o_custkey AS key, o_orderdate < {DAY_TWO} AS early FROM orders)
SELECT key, CASE WHEN bool_or(early) THEN 1 ELSE 2 END AS day FROM o GROUP BY key
""")
def indexed_keys(spark, d):
    """SC7, SK2: each key with the day that delivered it first."""
    o = table(spark, d, "orders").select("o_orderdate", F.concat(F.lit("cust|"), F.col("o_custkey").cast("string")).alias("key"))
    index = KeyIndex(spark, f"{shared_folder(spark)}/keys", ranges=16, bits=20)
    index.add(o.filter(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")), 1)
    index.add(o, 2)
    return index.keys()


# slots: customers of a nation, some cooling, some disabled, some at their limit; tasks: orders of its customers
_SLOTS = """SELECT c_nationkey AS pool, c_custkey AS idx, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_custkey % 6 END AS in_flight, CASE WHEN c_custkey % 3 <> 0 THEN 1000 - c_custkey % 97 END AS last_used,
  CASE WHEN c_custkey % 7 = 0 THEN 9 END AS cooling_until, c_custkey % 13 = 0 AS disabled FROM customer"""
_FREE = f"SELECT pool, idx, coalesce(in_flight, 0) AS busy, coalesce(last_used, 0) AS used FROM ({_SLOTS}) WHERE NOT disabled AND (cooling_until IS NULL OR cooling_until <= 5) AND coalesce(in_flight, 0) < 4"


def _slots(spark, d):
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("pool"), k.alias("idx"), F.when(k % 11 != 0, k % 6).cast("int").alias("in_flight"), F.when(k % 3 != 0, 1000 - k % 97).alias("last_used"), F.when(k % 7 == 0, 9).alias("cooling_until"), (k % 13 == 0).alias("disabled"))


@query(f"""
WITH openings AS (SELECT pool, idx, busy, used, unnest(range(busy, 4)) AS load FROM ({_FREE})),
offered AS (SELECT pool, idx AS slot, load::INT AS load, row_number() OVER (PARTITION BY pool ORDER BY load, busy DESC, used, idx) AS place FROM openings),
tasks AS (SELECT c_nationkey AS pool, o_orderkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY o_orderkey) AS place FROM orders JOIN customer ON c_custkey = o_custkey)
SELECT pool, o_orderkey, slot, load FROM tasks JOIN offered USING (pool, place)
""")
def assigned_slots(spark, d):
    """TK10: many tasks at once to the slots of their pool."""
    tasks = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey")).select(F.col("c_nationkey").alias("pool"), "o_orderkey")
    return ranking.assigned(tasks, _slots(spark, d), "pool", F.lit(5), 4, [F.col("o_orderkey")])


@query(f"SELECT pool, arg_min(idx, (busy, used, idx)) AS idx FROM ({_FREE}) GROUP BY pool")
def slots_within_limits(spark, d):
    """TK10: the next slot of each pool, with limits and disabled slots; a slot that was never used counts as used at 0."""
    return ranking.least_loaded(_slots(spark, d).withColumn("in_flight", F.coalesce("in_flight", F.lit(0))), "pool", F.lit(5), disabled="disabled", limit=4).select("pool", "idx")


_ENDS = "|".join(e.replace(".", "\\.") for e in lists.SKIPPED_PAGE_ENDS)
_LINKS = f"""SELECT page_id, list_filter(list_transform(list_filter(regexp_extract_all(html, '(?i)\\bhref\\s*=\\s*["'']([^"''#]*)', 1), lambda u: u <> '' AND NOT regexp_matches(u, '(?i)^(#|javascript:|mailto:|tel:)')),
  lambda u: CASE WHEN regexp_matches(u, '^https?://') THEN u ELSE regexp_extract(url, '^https?://[^/?#]+') || u END), lambda u: NOT regexp_matches(lower(regexp_extract(u, '^[^?#]*')), '({_ENDS})$')) AS links FROM pages"""


@query(f"SELECT page_id, link, least(count(*), 1)::INT AS n FROM (SELECT page_id, unnest(links) AS link FROM ({_LINKS})) GROUP BY page_id, link")
def page_links(spark, d):
    """UR6, UR7 over pages as they stand: their own site's links as absolute URLs, each once."""
    p = table(spark, d, "pages")
    found = p.select("page_id", F.explode(urls.same_site_links("html", "url", limit=10_000)).alias("link"))
    return found.groupBy("page_id", "link").agg(F.count(F.lit(1)).cast("int").alias("n"))


_SEEN = r"regexp_replace(regexp_replace(html, '(?is)<!--.*?-->', ' ', 'g'), '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<template[^>]*>.*?</template>', ' ', 'g')"


@query(rf"""
SELECT DISTINCT page_id, lower(e) AS email FROM (
  SELECT page_id, unnest(regexp_extract_all({_SEEN}, '([A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{{2,}})', 1)) AS e FROM pages)
""")
def page_emails(spark, d):
    """EM9 over pages as they stand."""
    return table(spark, d, "pages").select("page_id", F.explode(emails.harvest("html")).alias("email"))


# --- rules over columns as they stand ---

_HOSTS = f"SELECT page_id, {_HOST_SQL} AS h FROM pages"
_FIRST_LABEL = "split_part(replace({0}, '-', ''), '.', 1)"


@query(f"""
SELECT a.page_id, a.h <> '' AND b.h <> '' AND (a.h = b.h OR ends_with(a.h, '.' || b.h) OR ends_with(b.h, '.' || a.h) OR replace(a.h, '-', '') = replace(b.h, '-', '')
  OR (length({_FIRST_LABEL.format("a.h")}) >= 3 AND length({_FIRST_LABEL.format("b.h")}) >= 3 AND (contains({_FIRST_LABEL.format("a.h")}, {_FIRST_LABEL.format("b.h")}) OR contains({_FIRST_LABEL.format("b.h")}, {_FIRST_LABEL.format("a.h")})))) AS related
FROM ({_HOSTS}) a JOIN ({_HOSTS}) b ON b.page_id = a.page_id + 1
""")
def related_hosts(spark, d):
    """EM7: whether the hosts of a page and of the next one belong together."""
    p = table(spark, d, "pages").select("page_id", urls.host("url").alias("h"))
    after = p.select((F.col("page_id") - 1).alias("page_id"), F.col("h").alias("other"))
    return p.join(after, "page_id").select("page_id", emails.related("h", "other").alias("related"))


_TITLE = "trim(regexp_extract(html, '<title>([^<]*)</title>', 1))"


@query(f"SELECT page_id, CASE WHEN regexp_matches({_TITLE}, '^[A-Za-z0-9]') THEN substr({_TITLE}, 1, 4) ELSE substr({_TITLE}, 1, 2) END AS seed FROM pages")
def title_seeds(spark, d):
    """NA17 over the titles of pages."""
    return table(spark, d, "pages").select("page_id", names.keyword_seed(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("seed"))


@query("""
WITH t AS (SELECT * FROM (SELECT conv_id, turn, trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')) AS text, lower(coalesce(text, '')) AS low FROM conversations)),
j AS (SELECT t.conv_id, t.turn, string_split(lower(t.text), ' ')[:6] AS name, n.low FROM t JOIN t AS n ON n.conv_id = t.conv_id AND n.turn = t.turn + 1)
SELECT conv_id, turn, len(list_filter(name, lambda w: w <> '')) > 0 AND 2 * len(list_filter(name, lambda w: w <> '' AND contains(low, w))) >= len(list_filter(name, lambda w: w <> '')) AS supported FROM j
""")
def supported_turns(spark, d):
    """NA14: whether a turn holds at least half of the first six words of the turn before it."""
    c = table(spark, d, "conversations").select("conv_id", "turn", "text")
    words = F.array_join(F.slice(F.split(squeeze("text"), " "), 1, 6), " ")
    after = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("quote"))
    return c.select("conv_id", "turn", words.alias("name")).join(after, ["conv_id", "turn"]).select("conv_id", "turn", tokens_supported("name", "quote").alias("supported"))


@query(f"""
WITH e AS (SELECT *, array_to_string(string_split(split_part(email, '@', 2), '.')[-2:], '.') AS domain FROM ({_EMAILS})), w AS (SELECT *, first_value(domain) OVER (PARTITION BY doc_id ORDER BY email) AS site FROM e)
SELECT doc_id, count(DISTINCT domain)::INT AS n_domains, count(DISTINCT email) FILTER (WHERE domain = site)::INT AS own, false AS directory_like FROM w GROUP BY doc_id
""")
def address_profiles(spark, d):
    """AG10: the addresses of a document, with the domain of the first as its site."""
    found = table(spark, d, "documents").select("doc_id", F.array_sort(emails.harvest_json("text")).alias("es")).filter(F.size("es") > 0)
    site = F.concat(F.lit("https://www."), F.regexp_extract(F.col("es")[0], "@(.*)$", 1), F.lit("/about"))
    return found.select("doc_id", emails.profile(emails.registrable(site), "es").alias("p")).select("doc_id", "p.n_domains", F.size("p.own").alias("own"), "p.directory_like")


# events' props as they come, with a renamed field, wrapped, and cut off
_PAYLOADS = """SELECT event_id, CASE event_id % 5 WHEN 1 THEN replace(props, '"k"', '"key"') WHEN 2 THEN '{"data": {"items": [' || props || ', {"k": null}]}, "n": ' || user_id || '}' WHEN 3 THEN substr(props, 1, length(props) - 1) WHEN 4 THEN '[' || props || ', [' || props || ']]' ELSE props END AS payload FROM events"""


def _payloads(spark, d):
    k, props = F.col("event_id") % 5, F.col("props")
    payload = F.when(k == 1, F.replace(props, F.lit('"k"'), F.lit('"key"'))).when(k == 2, F.concat(F.lit('{"data": {"items": ['), props, F.lit(', {"k": null}]}, "n": '), F.col("user_id").cast("string"), F.lit("}")))
    payload = payload.when(k == 3, F.substr(props, F.lit(1), F.length(props) - 1)).when(k == 4, F.concat(F.lit("["), props, F.lit(", ["), props, F.lit("]]"))).otherwise(props)
    return table(spark, d, "events").select("event_id", payload.alias("payload"))


@query(f"""
WITH p AS (SELECT event_id, CASE WHEN json_valid(payload) THEN payload END AS p FROM ({_PAYLOADS}))
SELECT event_id, coalesce(json_extract_string(p, '$.k'), json_extract_string(p, '$.key'), json_extract_string(p, '$.data.items[0].k'), json_extract_string(p, '$[0].k'))::BIGINT AS k FROM p
""")
def aliased_fields(spark, d):
    """PA1-PA4, PA11: a field by the names and places that it goes by, in payloads of five shapes, one of them malformed."""
    v = _payloads(spark, d).select("event_id", variants.parsed("payload").alias("v"))
    return v.select("event_id", variants.first_of("v", "$.k", "$.key", "$.data.items[0].k", "$[0].k", kind="bigint").alias("k"))


@query(f"""
WITH RECURSIVE p AS (SELECT event_id, payload::JSON AS v FROM ({_PAYLOADS}) WHERE json_valid(payload)),
w AS (
  SELECT event_id, '$' AS path, '' AS name, v FROM p
  UNION ALL
  SELECT event_id, c.path, c.name, c.v FROM (
    SELECT event_id, unnest(CASE json_type(v) WHEN 'OBJECT' THEN list_transform(json_keys(v), lambda k: {{path: path || '.' || k, name: k, v: json_extract(v, '$.' || k)}})
      WHEN 'ARRAY' THEN list_transform(range(json_array_length(v)::BIGINT), lambda i: {{path: path || '[' || i || ']', name: name, v: json_extract(v, '$[' || i || ']')}}) END) AS c FROM w WHERE json_type(v) IN ('OBJECT', 'ARRAY'))
)
SELECT event_id, path, json_extract_string(v, '$') AS value FROM w WHERE json_type(v) NOT IN ('OBJECT', 'ARRAY', 'NULL') AND name IN ('k', 'key')
""")
def named_values(spark, d):
    """PA10: a nested walk for the values of some names, wherever they stand."""
    return variants.named(_payloads(spark, d), "payload", ["event_id"], ("k", "key"))


@query("""
WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) AS word FROM benchmark), p AS (SELECT lower(html) AS t FROM pages)
SELECT word, count(*) AS rows FROM w JOIN p ON contains(t, word) GROUP BY word
""")
def page_keywords(spark, d):
    """UR9: all words of the benchmark texts, looked for in all pages at once."""
    words = table(spark, d, "benchmark").select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), 0))).alias("word"))
    pages = table(spark, d, "pages").select("page_id", F.lower("html").alias("t"))
    return keywords.word_counts(keywords.found_words(pages, "t", ["page_id"], words)).select("word", "rows")


@query(f"""
SELECT page_id, trim(url) AS url, CASE WHEN length(html) <= 4000 THEN html ELSE substr(html, 1, 2000) || '{PAGE_CUT}' || right(html, 2000) END AS html
FROM pages WHERE trim(url) <> '' AND trim(html) <> '' AND NOT regexp_matches(lower(regexp_extract(trim(url), '^[^?#]*')), '({_ENDS})$')
""")
def bundled_pages(spark, d):
    """UR15: pages with the middle of long ones cut out."""
    return readers.page_bundle(table(spark, d, "pages"), 4000).select("page_id", "url", "html")
