"""A site's pages -> its addresses and representative, by rules: rank, shortlist, harvest, fall back, read labels.

pages: site, website, start, url, html. One row a site comes out. Pages meet by site; of a site's pages at most `limit` are kept before
their text moves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterweave.functions import emails, names, urls
from rosterweave.operators import dedup, ranking

NO_HOURS, FORM_HOURS = 12, 72  # how long a site without addresses, and one with a form alone, waits


def shortlist(pages: DataFrame, limit: int = 5, learned: str | None = None) -> DataFrame:
    """TK6: the pages of each site that are worth reading, with their rank."""
    best = ranking.ranked_urls(pages, "site", "start", "url", limit, learned).select("site", "url", "rank")
    return pages.join(best, ["site", "url"])


def found_emails(pages: DataFrame, **options) -> DataFrame:
    """AG11: a site's addresses over its pages by rank, filtered for the site (EM5)."""
    one = pages.select("site", "website", "rank", F.filter(F.transform(emails.harvest("html"), lambda e: emails.normalize(e, **options)), lambda e: (e != "") & ~emails.is_placeholder(e)).alias("found"))
    per_site = dedup.page_emails(one, "site", "website", "found", "rank")
    sites = one.select("site", "website").distinct()
    return per_site.join(sites, "site").select("site", emails.for_site("website", "emails").alias("emails"))


def with_secondary(found: DataFrame, lookup: DataFrame) -> DataFrame:
    """UX3: where rules find no address, those of a table made elsewhere (site, emails)."""
    other = lookup.select("site", F.col("emails").alias("_other"))
    none = F.array().cast("array<string>")
    return found.join(other, "site", "left").withColumn("emails", F.when(F.size("emails") > 0, F.col("emails")).otherwise(F.coalesce("_other", none))).drop("_other")


def representatives(pages: DataFrame) -> DataFrame:
    """NA13: a site's first representative: a label with a name behind it, or a line that is a label and a name in the next."""
    lines = pages.select("site", "url", "rank", F.posexplode(F.split(urls.to_lines("html"), "\n")).alias("pos", "line"))
    w = Window.partitionBy("site", "url").orderBy("pos")
    both = lines.withColumn("next", F.lead("line").over(w))
    from rosterweave.functions.lists import REPRESENTATIVE_LABELS

    bare = F.regexp_replace("line", r"[\s:：]+$", "").isin(*REPRESENTATIVE_LABELS)
    name = F.when(names.inline_representative("line") != "", names.inline_representative("line")).when(bare & names.can_be_representative("next"), F.trim("next"))
    named = both.withColumn("name", name).filter(F.col("name").isNotNull())
    return named.groupBy("site").agg(F.min_by(F.struct(F.col("name").alias("representative"), F.col("url").alias("evidence_url"), F.col("line").alias("evidence")), F.struct("rank", "pos")).alias("r")).select("site", "r.*")


def discover(pages: DataFrame, secondary: DataFrame | None = None, limit: int = 5, **options) -> DataFrame:
    """site, emails, representative, evidence_url, evidence, retry_hours (null when there are addresses)."""
    read = shortlist(pages.filter(F.trim("html") != ""), limit)
    found = found_emails(read, **options)
    found = with_secondary(found, secondary) if secondary is not None else found
    out = found.join(representatives(read), "site", "left")
    blank = [F.coalesce(c, F.lit("")).alias(c) for c in ("representative", "evidence_url", "evidence")]
    return out.select("site", "emails", *blank, F.when(F.size("emails") == 0, NO_HOURS).alias("retry_hours"))
