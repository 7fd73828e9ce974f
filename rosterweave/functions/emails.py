"""E-mail functions on columns: normalise, split, rank and filter by site."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterweave.functions import lists
from rosterweave.functions.text import C, alternation, any_of, ascii_key, col, fold_letters, text, trim, unescape, without_invisible

#: A run of local characters is tried from its start alone and without giving any back, so a long run without @ costs its length.
ADDRESS = r"(?i)(?:\G|(?<![A-Z0-9._%+\-]))([A-Z0-9._%+\-]++@[A-Z0-9.\-]+\.[A-Z]{2,})"
NONE = "array<string>"


def _local(email: Column) -> Column:
    return F.substring_index(email, "@", 1)


def _domain(email: Column) -> Column:
    return F.regexp_extract(email, "@(.*)$", 1)


def unquote(c: Column) -> Column:
    """Percent-decoding that keeps + and leaves text with a broken escape as it is."""
    return F.when(F.contains(c, F.lit("%")), F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)).otherwise(c)


def normalize(value: C, bad_hosts=lists.BAD_EMAIL_HOSTS, ignored=lists.IGNORED_LOCALS, bad_tlds=lists.ASSET_TLDS) -> Column:
    """EM1: one clean address, or ''."""
    t = F.lower(trim(without_invisible(unquote(text(value)))))
    t = F.regexp_replace(F.replace(t, F.lit("mailto:"), F.lit("")), "^(?:u003e|u003c|>|<)+", "")
    t = F.regexp_replace(t, r"(?U)\[at\]|\(at\)|\s+at\s+", "@")
    t = F.regexp_replace(t, r"(?U)\[dot\]|\(dot\)|\s+dot\s+", ".")
    email = F.regexp_replace(F.regexp_extract(t, ADDRESS, 1), r"[.,);:\]}>]+$", "")
    local, domain = _local(email), _domain(email)
    odd = lambda p: F.startswith(p, F.lit(".")) | F.endswith(p, F.lit(".")) | F.contains(p, F.lit(".."))
    in_url = F.exists(F.split(trim(t), r"(?U)\s+"), lambda w: F.contains(w, F.lit("://")) & F.contains(w, email))
    bad = (email == "") | odd(local) | odd(domain) | local.isin(*ignored) | F.substring_index(domain, ".", -1).isin(*bad_tlds) | in_url
    if bad_hosts:
        bad = bad | domain.rlike(alternation(bad_hosts))
    return F.when(bad, F.lit("")).otherwise(email)


def _stem(key: Column) -> Column:
    out = F.lit(False)
    for s in lists.PLACEHOLDER_STEMS:
        out = out | ((F.length(key) <= len(s) + 8) & (F.startswith(key, F.lit(s)) | F.endswith(key, F.lit(s))))
    return out


#: EM3's runs of a letter or of zeros that nobody's address holds.
RUNS = "x{4,}|0{4,}"


def is_placeholder(email: C, runs: str = RUNS) -> Column:
    """EM3: whether the local part or the domain is made up. runs: what speaks against a key wherever it stands in it; addresses that are numbered (sales10000@...) leave zeros out."""
    e = F.lower(trim(email))
    key = ascii_key(_local(e))
    local = (key == "") | key.isin(*lists.PLACEHOLDER_LOCALS) | _stem(key) | key.rlike(f"^a{{3,}}$|^0{{3,}}$|{runs}")
    part = lambda p: p.isin(*lists.PLACEHOLDER_LOCALS) | _stem(ascii_key(p)) | p.rlike("^x{2,}$|^a{3,}$")
    local = local | F.exists(F.filter(F.split(_local(e), r"[._%+\-]+"), lambda p: p != ""), part)
    labels = F.filter(F.split(_domain(e), r"\."), lambda x: x != "")
    suffix = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".").isin(*lists.PUBLIC_SUFFIXES)
    core = F.slice(labels, 1, F.greatest(F.size(labels) - F.when(suffix, 2).otherwise(1), F.lit(0)))

    def label(x: Column) -> Column:
        k = ascii_key(x)
        words = F.lit(False)
        for w in lists.PLACEHOLDER_DOMAINS:
            words = words | F.startswith(k, F.lit(w)) | F.endswith(k, F.lit(w))
        return (k == "") | words | k.rlike(f"{runs}|^x{{2,}}$|^a{{3,}}$|^0{{2,}}$")

    domain = (F.size(labels) < 2) | (F.size(core) == 0) | F.exists(core, label)
    return ~F.contains(e, F.lit("@")) | local | domain


def split(values: C, **options) -> Column:
    """EM2: the clean addresses of text with ; or , between, in order, each once, without placeholders (placeholders=False keeps them; runs: see `is_placeholder`)."""
    strict, runs = options.pop("placeholders", True), options.pop("runs", RUNS)
    found = F.transform(F.split(text(values), "[;,]"), lambda v: normalize(v, **options))
    found = F.array_distinct(F.filter(found, lambda e: (e != "") & ~is_placeholder(e, runs) if strict else e != ""))
    return without_prefixed(found)


def without_prefixed(found: Column) -> Column:
    """Without atinfo@... where info@... is there too."""
    return F.filter(found, lambda e: ~(F.startswith(e, F.lit("at")) & F.array_contains(found, F.substr(e, F.lit(3))) & ascii_key(_local(F.substr(e, F.lit(3)))).isin(*lists.PRIORITY_LOCALS)))


def priority(email: C) -> Column:
    """TK7: what an address is worth."""
    local = _local(F.lower(trim(email)))
    key = ascii_key(local)
    return (
        F.when(~F.contains(col(email), F.lit("@")), 0).when(local.isin(*lists.PRIORITY_LOCALS), 100).when(key.isin(*lists.PRIORITY_LOCALS), 90)
        .when(any_of(key, lists.PRIORITY_LOCALS), 70).when(key.rlike("^[a-z]+$"), 20).when(key.rlike("[0-9]"), 5).otherwise(10)
    )


def prioritized(emails: C) -> Column:
    """By priority, ties in the order that they had."""
    ranked = F.transform(col(emails), lambda e, i: F.struct((-priority(e)).alias("p"), i.alias("i"), e.alias("e")))
    return F.transform(F.array_sort(ranked), lambda s: s["e"])


def registrable(value: C, suffixes=lists.PUBLIC_SUFFIXES) -> Column:
    """UR2: the last two labels of a URL's or address's host, three where those two are a public suffix."""
    t = F.lower(trim(value))
    host = F.regexp_extract(t, r"^(?:[a-z][a-z0-9+.\-]*://)?([^/?#]*)", 1)
    host = F.substring_index(F.regexp_replace(host, r"^www\.", ""), ":", 1)
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    n = F.size(labels)
    last = F.array_join(F.slice(labels, F.greatest(n - 1, F.lit(1)), 2), ".")
    return F.when(n < 2, host).when(last.isin(*suffixes) & (n >= 3), F.array_join(F.slice(labels, F.greatest(n - 2, F.lit(1)), 3), ".")).otherwise(last)


def matches_site(website: C, email: C) -> Column:
    """EM4: whether the address is on the site's registrable domain."""
    site, domain = registrable(website), _domain(F.lower(trim(email)))
    return (site != "") & (domain != "") & ((domain == site) | F.endswith(domain, F.concat(F.lit("."), site)))


def for_site(website: C, emails: C) -> Column:
    """EM5: the site's own addresses, then others that are free mail or not of a dropped kind; by priority."""
    all_, site = col(emails), registrable(website)
    own = F.filter(all_, lambda e: matches_site(website, e))
    others = F.filter(all_, lambda e: ~matches_site(website, e) & (registrable(_domain(e)) != "") & (registrable(_domain(e)).isin(*lists.FREE_MAIL) | ~ascii_key(_local(e)).isin(*lists.OFFSITE_DROPPED)))
    return prioritized(F.when(site == "", all_).otherwise(F.concat(own, others)))


def profile(website: C, emails: C) -> Column:
    """AG10: the addresses by priority, the site's own, how many domains, and whether they look like a directory's."""
    e = prioritized(emails)
    own = F.filter(e, lambda x: matches_site(website, x))
    domains = F.size(F.array_distinct(F.transform(e, lambda x: registrable(_domain(x)))))
    return F.struct(e.alias("emails"), own.alias("own"), domains.alias("n_domains"), ((F.size(own) == 0) & (F.size(e) >= 8) & (domains >= 5)).alias("directory_like"))


def harvest(html: C) -> Column:
    """EM9: every address in a page, each once, without comments and scripts."""
    t = unescape(html)
    t = F.regexp_replace(t, r"(?is)<!--.*?-->", " ")
    t = F.regexp_replace(t, r"(?is)<(script|style|template)\b[^>]*>.*?</\1>", " ")
    t = F.regexp_replace(F.regexp_replace(t, "(?i)%40", "@"), "(?i)%2e", ".")
    t = F.regexp_replace(F.regexp_replace(t, r"(?i)\s*[\[(]at[\])]\s*", "@"), r"(?i)\s*[\[(]dot[\])]\s*", ".")
    return F.array_distinct(F.transform(F.regexp_extract_all(t, F.lit(ADDRESS), 1), lambda e: F.lower(e)))


def harvest_json(payload: C) -> Column:
    """EM10: every address in the strings of a JSON text, whatever its shape, each once."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text(payload), F.lit(ADDRESS), 1), lambda e: F.lower(e)))


def decode_cloudflare(encoded: C) -> Column:
    """EM11: hexadecimal with its first byte as key of an exclusive or; '' where it is not."""
    t = text(encoded)
    byte = lambda i: F.conv(F.substr(t, i, F.lit(2)), 16, 10).cast("int")
    chars = F.transform(F.sequence(F.lit(3), F.length(t) - 1, F.lit(2)), lambda i: F.char(byte(i).bitwiseXOR(byte(F.lit(1)))))
    return F.when(t.rlike("^(?:[0-9a-fA-F]{2}){2,}$"), F.array_join(chars, "")).otherwise(F.lit(""))


def join(emails: C) -> Column:
    return F.array_join(col(emails), "; ")


def dump(emails: C) -> Column:
    """EM12: a JSON list of distinct values."""
    return F.to_json(F.array_distinct(F.filter(col(emails), lambda e: trim(e) != "")))


def parse(c: C) -> Column:
    """EM12: a JSON list of strings; what is none gives none."""
    return F.coalesce(F.from_json(text(c), NONE), F.array().cast(NONE))


def strip_plus_digits(emails: C) -> Column:
    """EM8: addresses without a leading + or digits and +, normalised with a short list, each once."""
    short = ("example.com", "example.org", "example.net", "sentry.io")
    found = F.transform(col(emails), lambda e: F.regexp_replace(normalize(e, bad_hosts=short), r"^[0-9]*\++", ""))
    return F.array_distinct(F.filter(found, lambda e: e.rlike("^[^@]+@[^@]+$")))


def related(a: C, b: C, letters: dict[str, str] | None = None, fold: bool = True) -> Column:
    """EM7: whether two domains belong together: equal, one below the other, equal when folded, or first labels of three letters or more of which one holds the other."""
    x, y = F.lower(trim(a)), F.lower(trim(b))

    def folded(d: Column) -> Column:
        for k, v in (letters or {}).items():
            d = F.replace(d, F.lit(k), F.lit(v))
        return F.replace(fold_letters(d) if fold else d, F.lit("-"), F.lit(""))

    fx, fy = folded(x), folded(y)
    lx, ly = F.substring_index(fx, ".", 1), F.substring_index(fy, ".", 1)
    below = F.endswith(x, F.concat(F.lit("."), y)) | F.endswith(y, F.concat(F.lit("."), x))
    return (x != "") & (y != "") & ((x == y) | below | (fx == fy) | ((F.length(lx) >= 3) & (F.length(ly) >= 3) & (F.contains(lx, ly) | F.contains(ly, lx))))


def for_country(website: C, emails: C, **options) -> Column:
    """EM6: with a site, only related domains and no free mail; a first domain label of under three letters is always dropped."""
    host = F.replace(F.regexp_extract(F.lower(trim(website)), r"^(?:[a-z][a-z0-9+.\-]*://)?([^/?#]*)", 1), F.lit("www."), F.lit(""))

    def kept(e: Column) -> Column:
        d = _domain(e)
        long_enough = F.length(F.substring_index(d, ".", 1)) >= 3
        return long_enough & ((host == "") | (~d.isin(*lists.FREE_MAIL) & related(host, d, **options)))

    return F.filter(col(emails), kept)
