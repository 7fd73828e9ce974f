"""URL, host and page functions on columns."""

from __future__ import annotations

from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from rosterweave.functions import lists
from rosterweave.functions.emails import registrable
from rosterweave.functions.text import C, alternation, any_of, col, middle_cut, text, trim, unescape, unescape_common

__all__ = ["registrable", "middle_cut"]

HREF = r"(?i)<a\b[^>]*?\bhref\s*=\s*[\"']?([^\"'\s>]+)"


def host(url: C, strip_www: bool = True) -> Column:
    """UR1: the whole host in lower case, without port and, if asked, a leading www."""
    h = F.regexp_extract(F.lower(trim(url)), r"^(?:[a-z][a-z0-9+.\-]*:)?(?://)?([^/?#:\s]*)", 1)
    return F.regexp_replace(h, r"^www\.", "") if strip_www else h


def host_if_plain(url: C) -> Column:
    """UR1: the host if it is ASCII and has a dot, else ''."""
    h = host(url)
    return F.when(h.rlike(r"^[a-z0-9.\-]+\.[a-z0-9.\-]+$"), h).otherwise("")


def path(url: C) -> Column:
    return F.regexp_extract(text(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]*([^?#]*)", 1)


def normalize(value: C, keep_query: bool = True) -> Column:
    """UR3: https, no www., a host of letters and digits whose last label is letters, no fragment, no slash at the end; '' if it is none."""
    t = F.regexp_replace(text(value), r"(?U)\s+", "")
    t = F.when(t == "", t).when(F.startswith(t, F.lit("//")), F.concat(F.lit("https:"), t)).when(t.rlike("^https?://"), t).otherwise(F.concat(F.lit("https://"), t))
    h = F.regexp_replace(F.lower(F.regexp_extract(t, r"^https?://([^/?#]*)", 1)), r"^www\.", "")
    fine = h.rlike(r"^[a-z0-9\-]+(\.[a-z0-9\-]+)*\.[a-z]{2,}$")
    rest = F.regexp_extract(t, r"^https?://[^/?#]*([^#]*)" if keep_query else r"^https?://[^/?#]*([^?#]*)", 1)
    return F.when(fine, F.regexp_replace(F.concat(F.lit("https://"), h, rest), "/+$", "")).otherwise("")


def site_url(value: C, bad_hosts=("share.google", "maps.app.goo.gl", "facebook.com", "instagram.com", "twitter.com", "x.com", "linkedin.com")) -> Column:
    """UR3, the variant that keeps scheme, www. and query: the first http(s) URL in the text, '' on a bad host."""
    t = F.regexp_replace(F.regexp_extract(unescape(value), r"(?i)(https?://[^\s<>'\"]+)", 1), r"[.,;:)]+$", "")
    h = F.lower(F.regexp_extract(t, r"(?i)^https?://([^/?#]*)", 1))
    fine = h.rlike(r"^[^+]*\.[a-z]{2,24}$") & ~F.regexp_replace(h, r"^www\.", "").isin(*bad_hosts)
    rest = F.regexp_extract(t, r"(?i)^https?://[^/?#]*([^#]*)", 1)
    return F.when(fine, F.concat(F.lower(F.regexp_extract(t, r"(?i)^(https?)://", 1)), F.lit("://"), h, rest)).otherwise("")


def is_blocked(h: C, parts=lists.BLOCKED_HOST_PARTS, ends=lists.BLOCKED_HOST_ENDS) -> Column:
    """UR4: whether a host is a portal, a network, an encyclopedia, a file."""
    t = F.lower(text(h))
    return t.rlike(alternation(parts)) | t.rlike(f"(?:{alternation(ends)})$")


def clean_website(value: C) -> Column:
    """UR4: the URL normalised, '' where its host or path is no company's site."""
    u = normalize(value)
    bad = is_blocked(host(u)) | any_of(F.lower(path(u)), lists.BAD_PATH_PARTS) | F.lower(path(u)).rlike(f"(?:{alternation(lists.IMAGE_ENDS)})$")
    return F.when((u == "") | bad, F.lit("")).otherwise(u)


def unwrap(url: C) -> Column:
    """UR5: the target of a search engine's redirect, from its q or url parameter."""
    u = text(url)
    wrapped = F.contains(host(u, strip_www=False), F.lit("google.")) & path(u).isin("/url", "/search")
    target = F.coalesce(*[F.nullif(F.regexp_extract(u, f"[?&]{k}=([^&#]*)", 1), F.lit("")) for k in ("q", "url")], u)
    return F.when(wrapped, F.coalesce(F.try_url_decode(target), target)).otherwise(u)


@F.pandas_udf(ArrayType(StringType()))
def _absolute(links: pd.Series, base: pd.Series) -> pd.Series:
    def one(found, at):
        out = []
        for link in found if found is not None else []:
            try:
                out.append(urlsplit(urljoin(at or "", link))._replace(fragment="").geturl())
            except ValueError:
                continue
        return out

    return pd.Series([one(f, b) for f, b in zip(links, base, strict=True)])


def raw_links(html: C) -> Column:
    """Every href of a page as it stands, without fragments, scripts and addresses."""
    found = F.regexp_extract_all(text(html), F.lit(HREF), 1)
    return F.filter(found, lambda u: ~F.lower(u).rlike("^(#|javascript:|mailto:|tel:)"))


def is_asset(url: C) -> Column:
    """UR7: whether the path ends like a file that is no page."""
    return F.lower(F.regexp_extract(text(url), r"^([^?#]*)", 1)).rlike(f"(?:{alternation(lists.SKIPPED_PAGE_ENDS)})$")


def same_site_links(html: C, page_url: C, limit: int = 200, subdomains: bool = False) -> Column:
    """UR6: links of the page's own site as absolute URLs, each once, without files, at most `limit`."""
    links, own = _absolute(raw_links(html), text(page_url)), host(page_url)
    same = lambda u: (host(u) == own) | (F.endswith(host(u), F.concat(F.lit("."), own)) if subdomains else F.lit(False))
    return F.slice(F.array_distinct(F.filter(links, lambda u: u.rlike("^https?://") & same(u) & ~is_asset(u))), 1, limit)


def score(start: C, url: C, learned: C | None = None) -> Column:
    """UR8: 1000 for the start page; else the weights of the words it holds, 40 for each learned word, less a point for each slash, ten at most."""
    u = F.lower(text(url))
    total = F.lit(0)
    for word, weight in lists.URL_WEIGHTS.items():
        total = total + F.when(F.contains(u, F.lit(word)), weight).otherwise(0)
    if learned is not None:
        total = total + 40 * F.size(F.filter(col(learned), lambda k: F.contains(u, k)))
    total = total - F.least(F.regexp_count(u, F.lit("/")), F.lit(10))
    trimmed = lambda x: F.regexp_replace(text(x), "/+$", "")
    return F.when(trimmed(start) == trimmed(url), 1000).otherwise(total)


def keywords(url: C) -> Column:
    """UR9: path segments of four letters or digits or more, in lower case."""
    parts = F.transform(F.split(F.lower(path(url)), "/"), lambda s: F.regexp_replace(s, "[^a-z0-9]", ""))
    return F.array_distinct(F.filter(parts, lambda s: F.length(s) >= 4))


def to_lines(html: C, entities: dict[str, str] | None = None, space: str = r"(?U)\s+") -> Column:
    """UR10: a page's text by lines: blocks end a line, other tags are a space. Decodes every entity as HTML does, unclosed ones like &amp too; with entities, those alone."""
    t = unescape(html) if entities is None else unescape_common(html, entities)
    t = F.regexp_replace(t, r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<template\b.*?</template>", " ")
    t = F.regexp_replace(t, r"(?i)<br\s*/?>|</(?:p|div|li|tr|td|th|dt|dd|h[1-6]|section|article|table|ul|ol)>", "\n")
    t = F.regexp_replace(t, r"<[^>]*>", " ")
    lines = F.transform(F.split(t, "\n"), lambda x: F.trim(F.regexp_replace(x, space, " ")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def depth(url: C) -> Column:
    """UR13: the number of path segments."""
    return F.size(F.filter(F.split(path(url), "/"), lambda s: s != ""))


def task_key(query: C, filter_text: C, industry: C) -> Column:
    """UR14: the parts of a search task as one key; blank parts are left out."""
    part = lambda name, c: F.when(trim(c) != "", F.concat(F.lit(f"{name}="), trim(c)))
    return F.concat_ws("||", trim(query), part("filter", filter_text), part("industry", industry))


def parse_task_key(key: C) -> Column:
    t = text(key)
    return F.struct(
        F.regexp_extract(t, r"^(.*?)(?:\|\||$)", 1).alias("query"),
        F.regexp_extract(t, r"\|\|filter=(.*?)(?:\|\||$)", 1).alias("filter"),
        F.regexp_extract(t, r"\|\|industry=(.*?)(?:\|\||$)", 1).alias("industry"),
    )
