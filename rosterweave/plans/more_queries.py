"""More driver queries: rules over records that the driver tables stand in for. See queries.py."""

from __future__ import annotations

from pyspark.sql import functions as F

from rosterweave.functions import emails, lists, names, payloads, urls
from rosterweave.functions.text import alternation, middle_cut, number, pages_of, squeeze, tokens_supported
from rosterweave.operators import dedup, delta, gates, queues, ranking, upsert
from rosterweave.plans.queries import _EMAILS, _HOST_SQL, _SCORE, _SEARCHES, _TASKS, NOW, _harvested, _searches, _sql_list, _tasks, query, table

# customers as records: some without website, in different stages
_RECORDS = """SELECT c_custkey AS id, c_nationkey AS nation, c_name AS company_name, CASE WHEN c_acctbal < 0 THEN '' ELSE 'Rep ' || c_mktsegment END AS representative,
  CASE WHEN c_nationkey < 8 THEN '' WHEN c_nationkey < 12 THEN 'https://facebook.com/' || c_custkey ELSE 'https://www.c' || c_custkey || '.dk/' END AS website,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'pending' WHEN 'MACHINERY' THEN 'done' ELSE 'failed' END AS gmap_status,
  CASE WHEN c_nationkey > 20 THEN 'done' WHEN c_nationkey > 15 THEN 'rep_pending' ELSE 'pending' END AS email_status,
  CASE WHEN c_custkey > 500 THEN 'info@c' || c_custkey || '.dk' ELSE '' END AS emails FROM customer"""


def _records(spark, d):
    c = table(spark, d, "customer")
    k, nation, key = F.col("c_mktsegment"), F.col("c_nationkey"), F.col("c_custkey").cast("string")
    return c.select(
        F.col("c_custkey").alias("id"), nation.alias("nation"), F.col("c_name").alias("company_name"), F.when(F.col("c_acctbal") < 0, "").otherwise(F.concat(F.lit("Rep "), k)).alias("representative"),
        F.when(nation < 8, "").when(nation < 12, F.concat(F.lit("https://facebook.com/"), key)).otherwise(F.concat(F.lit("https://www.c"), key, F.lit(".dk/"))).alias("website"),
        F.when(k == "BUILDING", "pending").when(k == "MACHINERY", "done").otherwise("failed").alias("gmap_status"), F.when(nation > 20, "done").when(nation > 15, "rep_pending").otherwise("pending").alias("email_status"),
        F.when(F.col("c_custkey") > 500, F.concat(F.lit("info@c"), key, F.lit(".dk"))).otherwise("").alias("emails"),
    )


@query(f"SELECT id FROM ({_RECORDS}) WHERE representative <> '' AND emails <> ''")
def complete_records(spark, d):
    return _records(spark, d).filter(gates.three_fields()).select("id")


@query(f"SELECT id, website = '' AND gmap_status = 'pending' AS map_pending, website <> '' AND email_status IN ('pending', 'rep_pending') AS email_pending FROM ({_RECORDS})")
def pending_predicates(spark, d):
    return _records(spark, d).select("id", gates.map_pending().alias("map_pending"), gates.email_pending().alias("email_pending"))


@query(f"""
SELECT id, CASE WHEN website <> '' AND gmap_status = 'pending' THEN 'done' ELSE gmap_status END AS gmap_status,
  CASE WHEN website = '' AND gmap_status = 'done' THEN 'done' ELSE email_status END AS email_status FROM ({_RECORDS})
""")
def status_heal(spark, d):
    return gates.healed(_records(spark, d)).select("id", "gmap_status", "email_status")


@query(f"SELECT id, website <> '' AND gmap_status = 'done' AND email_status = 'done' AS ready FROM ({_RECORDS})")
def site_gate(spark, d):
    r = _records(spark, d).withColumns({"site": F.lit("hidubai"), "people_json": F.lit("")})
    return r.select("id", gates.site_done().alias("ready"))


@query(f"SELECT id, CASE WHEN website LIKE '%facebook%' THEN '' ELSE website END AS website, CASE WHEN website LIKE '%facebook%' THEN 'pending' ELSE gmap_status END AS gmap_status FROM ({_RECORDS})")
def purge_dirty_websites(spark, d):
    r = _records(spark, d)
    return gates.purge_dirty(r, r, "id")[0].select("id", "website", "gmap_status")


@query(f"SELECT id FROM ({_RECORDS}) WHERE email_status = 'done' AND representative = '' AND website = ''")
def empty_details(spark, d):
    return _records(spark, d).filter(gates.empty_detail("email_status")).select("id")


@query(f"SELECT id, nation IN (13, 14) AS in_country FROM ({_RECORDS})")
def country_plausibility(spark, d):
    phone = F.when(F.col("nation") == 13, "00971 50 123").when(F.col("nation") == 14, "x").otherwise("+45 12").alias("phone")
    r = _records(spark, d).select("id", "website", phone, F.when(F.col("nation") == 14, "Dubai Marina").otherwise("Road").alias("address"), F.lit("").alias("summary"))
    return r.select("id", gates.in_country("phone", "address", "summary", "website", "971", ("dubai", "sharjah"), ".ae").alias("in_country"))


@query("SELECT p_partkey FROM part WHERE p_name NOT IN ('small ring', 'red widget')")
def without_placeholder_names(spark, d):
    return table(spark, d, "part").filter(gates.not_placeholder_company(["small ring", "red widget"], "p_name")).select("p_partkey")


@query(f"SELECT id, CASE WHEN representative <> '' AND emails <> '' THEN 'done' WHEN website <> '' THEN 'email' ELSE 'map' END AS stage FROM ({_RECORDS})")
def stage_routing(spark, d):
    return _records(spark, d).select("id", queues.next_stage().alias("stage"))


@query(f"SELECT id, CASE WHEN email_status = 'done' AND representative = '' AND website <> '' THEN 'rep_pending' ELSE email_status END AS email_status FROM ({_RECORDS})")
def versioned_migration(spark, d):
    return upsert.migrated(_records(spark, d), 0)[0].select("id", "email_status")


@query(f"SELECT id, CASE WHEN website LIKE '%facebook%' THEN '' ELSE rtrim(replace(website, 'www.', ''), '/') END AS website FROM ({_RECORDS})")
def clean_websites(spark, d):
    return _records(spark, d).select("id", urls.clean_website("website").alias("website"))


@query(f"""
WITH r AS ({_RECORDS}), o AS (SELECT o_custkey AS id, arg_max(CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END, o_orderkey) AS p FROM orders GROUP BY 1)
SELECT r.id, CASE WHEN o.p <> '' THEN o.p ELSE representative END AS representative, CASE WHEN o.id IS NULL THEN gmap_status ELSE 'done' END AS gmap_status FROM r LEFT JOIN o ON r.id = o.id
""")
def stage_results_applied(spark, d):
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.max_by(F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderpriority")), "o_orderkey").alias("representative"))
    return upsert.stage_applied(_records(spark, d), o, "id", ["representative"], "gmap_status").select("id", "representative", "gmap_status")


@query(f"SELECT id, CASE WHEN nation % 2 = 0 THEN (CASE WHEN website <> '' THEN website WHEN representative <> '' THEN representative ELSE company_name END) ELSE (CASE WHEN representative <> '' THEN representative WHEN website <> '' THEN website ELSE company_name END) END AS name FROM ({_RECORDS})")
def name_precedence(spark, d):
    return _records(spark, d).select("id", upsert.by_precedence("representative", "website", "company_name", F.col("nation") % 2 == 0).alias("name"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'n|' || lpad(o_orderkey::VARCHAR, 13, '0') ELSE 'a|' || o_orderpriority || '|' || o_orderstatus END AS key FROM orders")
def dual_keys(spark, d):
    o = table(spark, d, "orders").withColumn("number", F.when(F.col("o_orderkey") % 3 == 0, F.lpad(F.col("o_orderkey").cast("string"), 13, "0")).otherwise("12-3"))
    return o.select("o_orderkey", upsert.dual_key("number", "o_orderpriority", "o_orderstatus").alias("key"))


@query("SELECT c_name AS name, c_mktsegment AS segment, '' AS city FROM customer UNION ALL SELECT s_name, '', 'town' FROM supplier")
def evolved_union(spark, d):
    return upsert.evolved(table(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")), table(spark, d, "supplier").select(F.col("s_name").alias("name"), F.lit("town").alias("city"))).select("name", "segment", "city")


@query(f"SELECT id, email FROM (SELECT id, representative, unnest([emails, 'b@x.dk']) AS email FROM ({_RECORDS}) WHERE emails <> '') WHERE representative <> ''")
def final_rows(spark, d):
    r = _records(spark, d).filter("emails <> ''").withColumn("emails", F.array("emails", F.lit("b@x.dk")))
    return upsert.final_rows(r).select("id", "email")


@query(f"""
WITH r AS ({_RECORDS}), o AS (SELECT o_custkey AS id, min(o_orderpriority) AS detail FROM orders GROUP BY 1)
SELECT r.id, coalesce(detail, representative) AS representative, o.id IS NOT NULL AS from_detail FROM r LEFT JOIN o ON r.id = o.id
""")
def fallback_records(spark, d):
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.min("o_orderpriority").alias("representative"))
    return queues.with_fallback(_records(spark, d), o, "id", ["representative"]).select("id", "representative", "from_detail")


@query("""
WITH r AS (SELECT o_orderkey, o_custkey::VARCHAR AS i, 'n' || (o_custkey % 97) AS n, CASE WHEN o_orderstatus = 'O' THEN '' ELSE o_orderstatus END AS s FROM orders),
a AS (SELECT i, arg_min(n, o_orderkey) AS n, coalesce(arg_min(s, o_orderkey) FILTER (WHERE s <> ''), '') AS s, min(o_orderkey) AS k FROM r GROUP BY i)
SELECT arg_min(n, k) AS company_name, coalesce(arg_min(s, k) FILTER (WHERE s <> ''), '') AS phone FROM a GROUP BY n
""")
def two_level_merge(spark, d):
    o = table(spark, d, "orders")
    r = o.select(F.col("o_custkey").cast("string").alias("orgnr"), F.concat(F.lit("n"), (F.col("o_custkey") % 97).cast("string")).alias("company_name"), F.when(F.col("o_orderstatus") == "O", "").otherwise(F.col("o_orderstatus")).alias("phone"), "o_orderkey", F.array().cast("array<string>").alias("emails"))
    return dedup.two_level(r, "orgnr", "company_name", ["o_orderkey"], ["company_name", "phone"]).select("company_name", "phone")


@query("""
SELECT coalesce(arg_min(c_phone, c_custkey) FILTER (WHERE c_phone <> ''), '') AS phone, count(*) AS n FROM (
  SELECT c_custkey, c_mktsegment, c_nationkey, CASE WHEN c_acctbal < 0 THEN '' ELSE c_acctbal::VARCHAR END AS c_phone FROM customer) GROUP BY lower(c_mktsegment), c_nationkey
""")
def composite_merge(spark, d):
    c = table(spark, d, "customer")
    r = c.select(F.col("c_mktsegment").alias("company_name"), F.concat(F.lit("ceo "), "c_mktsegment").alias("representative"), F.concat(F.lit("https://www.n"), F.col("c_nationkey").cast("string"), F.lit(".dk/"), F.col("c_custkey").cast("string")).alias("website"), F.lit("").alias("address"), F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_acctbal").cast("string")).alias("phone"), "c_custkey", F.array(F.col("c_custkey").cast("string")).alias("emails"))
    return dedup.composite(r, ["c_custkey"], ["company_name", "representative", "website", "phone"]).select("phone", F.size("emails").cast("long").alias("n"))


@query(f"""
SELECT e.id, count(*) AS n FROM ({_TASKS}) e JOIN customer ON user_id = c_custkey WHERE status IN ('pending', 'running') GROUP BY e.id
""")
def cache_lookup(spark, d):
    t = _tasks(spark, d).select("id", F.col("user_id").cast("string").alias("domain"), "status", F.array().cast("array<string>").alias("emails"))
    cache = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("domain"), F.array("c_name").alias("emails"))
    return delta.with_cache(t, cache).select("id", F.size("emails").cast("long").alias("n"))


@query(f"""
SELECT id, CASE WHEN status = 'done' AND value < 30 AND updated_at <= {NOW} THEN 'claimed' WHEN status = 'done' THEN 'done' WHEN status = 'running' AND updated_at > {NOW} - INTERVAL 900 SECOND THEN 'wait'
  WHEN status = 'pending' AND updated_at > {NOW} THEN 'wait' ELSE 'claimed' END AS decision FROM (SELECT id, value, updated_at, CASE status WHEN 'failed' THEN NULL ELSE status END AS status FROM ({_TASKS}))
""")
def cache_decisions(spark, d):
    t = _tasks(spark, d).withColumns({"domain": F.col("user_id").cast("string"), "status": F.when(F.col("status") != "failed", F.col("status")), "next_retry_at": F.col("updated_at"), "emails": F.when(F.col("value") < 30, F.array().cast("array<string>")).otherwise(F.array(F.lit("a")))})
    return t.select("id", queues.cache_decision(F.expr(NOW))["decision"].alias("decision"))


@query("SELECT event_id, CASE event_type WHEN 'error' THEN 'usage limit' WHEN 'view' THEN 'challenge' WHEN 'click' THEN 'transient' ELSE 'other' END AS kind, CASE event_type WHEN 'error' THEN 60 WHEN 'view' THEN 300 WHEN 'click' THEN 30 ELSE 0 END AS wait, event_type IN ('error', 'view', 'click') OR event_id % 9 < 6 AS again FROM events")
def retry_rules(spark, d):
    t = F.col("event_type")
    message = F.when(t == "error", "HTTP 429").when(t == "view", "captcha needed").when(t == "click", "read timed out").otherwise("boom")
    return table(spark, d, "events").select("event_id", queues.retry_rule(message, F.col("event_id") % 9).alias("r")).select("event_id", "r.kind", "r.wait", "r.again")


@query("SELECT user_id, CASE WHEN max(event_id) % 2 = 0 AND count(*) < 0.95 * 110 THEN 1 ELSE count(*) + 1 END AS page FROM events GROUP BY user_id")
def resume_pages(spark, d):
    e = table(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.when(F.max("event_id") % 2 == 0, "done").otherwise("running").alias("status"))
    return e.select("user_id", queues.start_page(F.col("n"), F.col("status"), F.col("n"), F.lit(110)).cast("long").alias("page"))


@query(f"SELECT id, CASE WHEN status = 'failed' THEN 'pending' ELSE status END AS status FROM ({_TASKS})")
def failed_requeued(spark, d):
    return queues.requeue_failed(_tasks(spark, d).withColumn("retries", F.lit(3))).select("id", "status")


@query(f"SELECT id, CASE WHEN id % 5 + 1 >= 3 THEN 'failed' ELSE 'pending' END AS status, CASE WHEN id % 5 + 1 >= 3 THEN NULL ELSE {NOW} + (pow(2, id % 5 + 1)::BIGINT * INTERVAL 1 SECOND) END AS next_run_at FROM ({_TASKS})")
def failure_transition(spark, d):
    return queues.failed_once_more(_tasks(spark, d).withColumn("retries", F.col("id") % 5), F.expr(NOW), 3, 300).select("id", "status", F.col("next_run_at").cast("timestamp_ntz").alias("next_run_at"))


@query(f"SELECT count(*) FILTER (WHERE status IN ('pending', 'running')) = 0 AS drained, user_id FROM ({_TASKS}) GROUP BY user_id")
def drained_queues(spark, d):
    return _tasks(spark, d).groupBy("user_id").agg(queues.drained().alias("drained"))


@query(f"SELECT s_suppkey, c_custkey, score FROM (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY score DESC, c_custkey) AS r FROM (SELECT s_suppkey, c_custkey, {_SCORE} AS score FROM {_SEARCHES}) WHERE score >= 45) WHERE r = 1")
def best_candidates(spark, d):
    c = _searches(spark, d).select("s_suppkey", "q", F.col("c_name").alias("name"), F.lit("").alias("website"), F.lit("").alias("phone"), F.col("c_custkey").alias("pos"), "c_custkey", "q_folded", "c_folded")
    return ranking.best_candidate(c, "s_suppkey", "q", folds=("q_folded", "c_folded")).select("s_suppkey", "c_custkey", "score")


_TITLES = {"BUILDING": ("Chief Executive Officer", 300), "MACHINERY": ("Finance Manager", 200), "AUTOMOBILE": ("Chief Accountant", 250), "HOUSEHOLD": ("Assistant to CEO", 0), "FURNITURE": ("Cook", 0)}
_TITLE_SQL = "CASE c_mktsegment " + " ".join(f"WHEN '{k}' THEN {n}" for k, (_, n) in _TITLES.items()) + " ELSE 0 END"


def _people(spark, d):
    title = F.lit("Cook")
    for k, (t, _) in _TITLES.items():
        title = F.when(F.col("c_mktsegment") == k, t).otherwise(title)
    return table(spark, d, "customer").select(F.col("c_nationkey").cast("string").alias("company"), F.col("c_name").alias("name"), title.alias("title"))


@query(f"SELECT company, name, score, rank FROM (SELECT c_nationkey::VARCHAR AS company, c_name AS name, {_TITLE_SQL} AS score, row_number() OVER (PARTITION BY c_nationkey ORDER BY {_TITLE_SQL} DESC, lower(c_name))::INT AS rank FROM customer WHERE {_TITLE_SQL} > 0) WHERE rank <= 10")
def contact_ranking(spark, d):
    return ranking.contacts(_people(spark, d), "company", limit=10).select("company", "name", "score", "rank")


@query(f"SELECT company, name FROM (SELECT c_nationkey::VARCHAR AS company, c_name AS name, c_mktsegment AS s, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY lower(c_name)) AS r FROM customer WHERE {_TITLE_SQL} > 0) WHERE r <= CASE s WHEN 'BUILDING' THEN 4 ELSE 1 END")
def contact_selection(spark, d):
    return ranking.selected_contacts(ranking.contacts(_people(spark, d), "company", limit=1_000_000), "company").select("company", "name")


@query(f"SELECT page_id, regexp_matches(h, '{alternation(lists.BLOCKED_HOST_PARTS)}') OR regexp_matches(h, '(?:{alternation(lists.BLOCKED_HOST_ENDS)})$') AS blocked FROM (SELECT page_id, {_HOST_SQL} AS h FROM pages)")
def blocked_hosts(spark, d):
    return table(spark, d, "pages").select("page_id", urls.is_blocked(urls.host("url")).alias("blocked"))


@query("SELECT page_id, url FROM pages")
def redirects_unwrapped(spark, d):
    return table(spark, d, "pages").select("page_id", urls.unwrap(F.concat(F.lit("https://www.google.com/url?sa=t&q="), F.url_encode("url"))).alias("url"))


@query("SELECT page_id, unnest(list_distinct(list_filter(list_transform(string_split(lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//[^/?#]*([^?#]*)', 1)), '/'), lambda s: regexp_replace(s, '[^a-z0-9]', '', 'g')), lambda s: length(s) >= 4))) AS keyword FROM pages")
def url_keywords(spark, d):
    return table(spark, d, "pages").select("page_id", F.explode(urls.keywords("url")).alias("keyword"))


@query(f"SELECT page_id, link, regexp_matches(regexp_extract(lower(link), '^([^?#]*)', 1), '(?:{alternation(lists.SKIPPED_PAGE_ENDS)})$') AS asset FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?i)<a\\b[^>]*?\\bhref\\s*=\\s*[\"'']?([^\"''\\s>]+)', 1)) AS link FROM pages)")
def asset_links(spark, d):
    return table(spark, d, "pages").select("page_id", F.explode(urls.raw_links("html")).alias("link")).select("page_id", "link", urls.is_asset("link").alias("asset"))


@query("SELECT p_partkey, p_name AS query, p_brand AS filter, CASE WHEN p_size > 25 THEN '' ELSE p_type END AS industry FROM part")
def task_key_codec(spark, d):
    key = urls.task_key("p_name", "p_brand", F.when(F.col("p_size") > 25, "").otherwise(F.col("p_type")))
    return table(spark, d, "part").select("p_partkey", urls.parse_task_key(key).alias("k")).select("p_partkey", "k.query", "k.filter", "k.industry")


@query(_EMAILS)
def cloudflare_decode(spark, d):
    e = _harvested(spark, d)
    coded = F.concat(F.lit("2a"), F.array_join(F.transform(F.sequence(F.lit(1), F.length("email")), lambda i: F.lower(F.lpad(F.hex(F.ascii(F.substr("email", i, F.lit(1))).cast("long").bitwiseXOR(F.lit(42).cast("long"))), 2, "0"))), ""))
    return e.select("doc_id", emails.decode_cloudflare(coded).alias("email"))


@query(f"SELECT doc_id, string_agg(email, '; ' ORDER BY email) AS joined, count(*) AS n FROM ({_EMAILS}) GROUP BY doc_id")
def email_lists(spark, d):
    g = _harvested(spark, d).groupBy("doc_id").agg(F.array_sort(F.collect_set("email")).alias("es"))
    back = emails.parse(emails.dump("es"))
    return g.select("doc_id", emails.join(back).alias("joined"), F.size(back).cast("long").alias("n"))


@query(f"SELECT source, count(DISTINCT array_to_string(string_split(split_part(email, '@', 2), '.')[-2:], '.'))::INT AS n_domains, 0 AS own FROM ({_EMAILS}) e JOIN documents USING (doc_id) GROUP BY source")
def email_set_profile(spark, d):
    e = _harvested(spark, d).join(table(spark, d, "documents").select("doc_id", "source"), "doc_id").groupBy("source").agg(F.collect_set("email").alias("es"))
    return e.select("source", emails.profile(F.lit("https://firm.dk"), "es").alias("p")).select("source", "p.n_domains", F.size("p.own").alias("own"))


@query(f"SELECT doc_id, email FROM ({_EMAILS}) WHERE regexp_replace(split_part(email, '@', 1), '[^a-z0-9]', '', 'g') NOT IN ({_sql_list(lists.OFFSITE_DROPPED)})")
def offsite_emails(spark, d):
    return _harvested(spark, d).select("doc_id", F.explode(emails.for_site(F.lit("https://firm.dk"), F.array("email"))).alias("email"))


@query("SELECT doc_id, trim(regexp_replace(replace(lower(text), '&', ' and '), '[^a-z0-9]+', ' ', 'g')) AS name FROM documents")
def uk_names(spark, d):
    return table(spark, d, "documents").select("doc_id", names.uk_name("text").alias("name"))


@query("SELECT s_suppkey, regexp_replace(trim(regexp_replace(lower(s_name) || ' uk limited', '[^a-z0-9]+', ' ', 'g')), '( (limited|ltd|plc|llp|lp|uk))+$', '') AS name FROM supplier")
def uk_suffixes(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", names.without_uk_suffix(F.concat("s_name", F.lit(" UK Limited"))).alias("name"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE '+45 ' || lpad(o_orderkey::VARCHAR, 8, '0') END AS phone, o_orderkey::BIGINT AS n, ceil(o_orderkey / 50.0)::BIGINT AS pages FROM orders")
def phones_and_numbers(spark, d):
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    raw = F.when(k % 2 == 0, F.concat(F.lit("45"), k.cast("string"))).otherwise(F.concat(F.lit(" +45  "), F.lpad(k.cast("string"), 8, "0")))
    return o.select("o_orderkey", names.phone(raw).alias("phone"), number(F.format_number(k, 0)).alias("n"), pages_of(k, 50).alias("pages"))


@query("SELECT p_partkey, CASE WHEN p_brand = p_type THEN p_brand ELSE p_brand || ', ' || p_type END AS address, p_name || ' ' || p_type || ' DK' AS first_query FROM part")
def addresses_and_queries(spark, d):
    return table(spark, d, "part").select("p_partkey", names.address("p_brand", "p_type", "p_brand").alias("address"), F.get(names.map_queries("p_name", "p_type", "DK"), F.lit(0)).alias("first_query"))


@query("SELECT conv_id, turn, trim(regexp_replace(text, '[\\s\\x{000b}\\x{0085}\\x{00a0}\\x{3000}]+', ' ', 'g')) AS squeezed FROM conversations")
def squeezed_text(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", squeeze("text").alias("squeezed"))


@query("SELECT p_partkey, contains('a small ring box', split_part(p_name, ' ', 1)) OR contains('a small ring box', split_part(p_name, ' ', 2)) AS supported FROM part")
def evidence_check(spark, d):
    return table(spark, d, "part").select("p_partkey", tokens_supported("p_name", F.lit("A small RING box")).alias("supported"))


def _page(key):
    """The page of a list that a row is on: pages hold few rows, however many the list has."""
    return F.floor(F.col(key) / 100).alias("page")


@query("SELECT o_custkey, o_orderkey::VARCHAR AS orgnr, o_orderpriority AS company_name FROM orders")
def search_payload(spark, d):
    one = F.struct(F.col("o_orderkey").cast("string").alias("orgnr"), F.col("o_orderpriority").alias("name"))
    pages = table(spark, d, "orders").groupBy("o_custkey", _page("o_orderkey")).agg(F.to_json(F.struct(F.collect_list(one).alias("companies"))).alias("payload"))
    return payloads.search_companies(pages, "payload", ["o_custkey"]).select("o_custkey", "orgnr", "company_name")


@query("SELECT c_nationkey AS industry, c_custkey::VARCHAR AS duns, c_name AS company_name, c_mktsegment AS postal_code FROM customer")
def listing_payload(spark, d):
    one = F.struct(F.col("c_custkey").cast("string").alias("duns"), F.col("c_name").alias("primaryName"), F.struct(F.col("c_mktsegment").alias("postalCode")).alias("primaryAddress"))
    pages = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("industry"), _page("c_custkey")).agg(F.to_json(F.struct(F.collect_list(one).alias("companyInformationCompany"))).alias("payload"))
    return payloads.listing_companies(pages, "payload", "industry").select("industry", "duns", "company_name", "postal_code")


@query("SELECT c_nationkey, c_name AS name, c_mktsegment AS title FROM customer")
def prospect_payload(spark, d):
    one = F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("job_title"))
    pages = table(spark, d, "customer").groupBy("c_nationkey", _page("c_custkey")).agg(F.to_json(F.struct(F.collect_list(one).alias("data"))).alias("payload"))
    return payloads.prospects(pages, "payload", ["c_nationkey"]).select("c_nationkey", "name", "title")


@query("SELECT n_nationkey, n_name AS title, 'Rep ' || n_regionkey AS representative FROM nation")
def job_payload(spark, d):
    j = F.to_json(F.struct(F.struct(F.create_map(F.lit("sv"), F.lit("x"), F.lit("fi"), F.col("n_name")).alias("values")).alias("title"), F.array(F.struct(F.lit("Rep").alias("firstName"), F.col("n_regionkey").cast("string").alias("lastName"))).alias("recruiting")))
    return table(spark, d, "nation").select("n_nationkey", payloads.job(j).alias("j")).select("n_nationkey", "j.title", "j.representative")
