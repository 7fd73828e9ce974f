"""Company names, persons, phones and record keys on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterweave.functions import emails, lists, urls
from rosterweave.functions.text import C, alnum_key, any_of, ascii_key, bound, col, distinct_filled, filled, first_filled, squeeze, text, trim, unescape, unescape_common, without_invisible

_SIDES = r"^[ \t\r\n|/;,:：]+|[ \t\r\n|/;,:：]+$"
_MATCHED = "[^0-9a-z가-힣\\x{4e00}-\\x{9fff}\\x{3040}-\\x{309f}\\x{30a0}-\\x{30ff}]+"


# keys (NA1)
def key_engine(name: C, url: C) -> Column:
    """name| and a-z0-9 of the name; without those, domain| and the host."""
    k = ascii_key(name)
    return F.when(k != "", F.concat(F.lit("name|"), k)).otherwise(F.concat(F.lit("domain|"), urls.host(url)))


def key_domain(url: C) -> Column:
    h = urls.host(url)
    return F.when(h != "", F.concat(F.lit("domain|"), h)).otherwise("")


def key_lower(name: C) -> Column:
    return F.lower(trim(name))


def key_alnum(name: C) -> Column:
    return alnum_key(name)


def key_three(name: C, rep: C, site: C) -> Column:
    return F.concat_ws(" | ", *[F.lower(trim(c)) for c in (name, rep, site)])


def key_four(name: C, rep: C, site: C, address: C) -> Column:
    return F.concat_ws("|", *[F.lower(trim(c)) for c in (name, rep, site, address)])


def _compact(c: C) -> Column:
    return F.regexp_replace(F.lower(trim(c)), r"(?U)\s+", "")


def key_merge(name: C, rep: C, site: C, address: C, titles=lists.MERGE_TITLES) -> Column:
    """AG6: company, representative without titles, and registrable domain; else the address; else the four-part key."""
    who = _compact(rep)
    for t in titles:
        who = F.replace(who, F.lit(t), F.lit(""))
    company, domain, at = _compact(name), emails.registrable(site), _compact(address)
    return (
        F.when((company != "") & (who != "") & (domain != ""), F.concat_ws("|", company, who, domain))
        .when((company != "") & (who != "") & (at != ""), F.concat_ws("|", company, who, at))
        .otherwise(key_four(name, rep, site, address))
    )


def seed_id(name: C) -> Column:
    """UP4: sixteen hexadecimal digits of the MD5 of the lower-cased name."""
    return F.substring(F.md5(F.lower(trim(name)).cast("binary")), 1, 16)


# records (NA2, NA3)
def has_corporate_suffix(name: C) -> Column:
    return text(name).rlike(lists.CORPORATE_SUFFIX)


def clean_phone_text(phone: C) -> Column:
    """Digits, white space, + - ( ) alone."""
    return trim(F.regexp_replace(without_invisible(phone), r"(?U)[^\d\s+\-()]", ""))


def sanitized(name: C, rep: C, email_values: C, phone: C, **options) -> Column:
    """NA2: a struct of the clean fields, null where name, representative or e-mails are missing."""
    n = trim(unescape(name))
    cut = F.substring(n, 1, 150)
    n = F.when(F.char_length(n) <= 150, n).otherwise(F.when(F.contains(cut, F.lit(" ")), F.regexp_replace(cut, " [^ ]*$", "")).otherwise(cut))
    r = trim(unescape(rep))
    r = F.when(has_corporate_suffix(r), F.lit("")).otherwise(r)
    joined = emails.join(emails.split(F.array_join(F.filter(col(email_values), lambda e: trim(e) != ""), "; "), **options))
    fine = (F.char_length(n) >= 2) & filled(r) & filled(joined)
    return F.when(fine, F.struct(n.alias("company_name"), r.alias("representative"), joined.alias("emails"), clean_phone_text(phone).alias("phone")))


# persons (NA4-NA6)
def person(value: C, company: C = None, decode: bool = True) -> Column:
    """NA4: a person's name without titles and roles, in title case; '' if it is none."""
    t = squeeze(F.regexp_replace(unescape(value) if decode else text(value), _SIDES, ""))
    strip = lambda x: F.regexp_replace(x, _SIDES, "")
    t = strip(F.regexp_replace(t, lists.PERSON_PREFIX, ""))
    t = strip(F.regexp_replace(t, rf"(?i)\b(?:{lists.PERSON_ROLES})$", ""))
    t = strip(F.regexp_replace(t, rf"(?i)\s+\b(?:{lists.PERSON_INLINE_ROLES})\b.*$", ""))
    return bound(t, lambda t: bound(F.lower(t), lambda low: _checked_person(t, low, company)))


def _checked_person(t: Column, low: Column, company: C | None) -> Column:
    rep_key = lambda c: F.regexp_replace(F.lower(text(c)), "[^a-z0-9\\x{0600}-\\x{06FF}]+", "")
    latin = lambda x: F.regexp_replace(x, "[^A-Za-z]", "")
    gibberish = F.exists(F.split(t, r"\s+"), lambda w: (F.length(latin(w)) >= 5) & ~latin(w).rlike("[aeiouAEIOU]"))
    bad = (
        low.isin(*lists.PERSON_EMPTY) | low.rlike(r"http|www\.|@") | (F.regexp_count(t, F.lit("[0-9]")) >= 3) | (F.char_length(t) < 2) | (F.char_length(t) > 80)
        | F.exists(F.split(low, " "), lambda w: w.isin(*lists.PERSON_NON_NAMES)) | any_of(low, lists.PERSON_COMPANY_HINTS)
        | (F.regexp_count(t, F.lit("[A-Za-z\\x{0600}-\\x{06FF}]")) < 2) | gibberish
    )
    if company is not None:
        bad = bad | (filled(company) & (rep_key(t) == rep_key(company)))
    return F.when(bad, F.lit("")).when(t.rlike(r"^[A-Za-z .'\-]+$"), title_case(t)).otherwise(t)


def title_case(name: C) -> Column:
    """Each part between spaces, hyphens and apostrophes with one capital."""
    out = F.initcap(F.lower(text(name)))
    for sep in ("-", "'"):
        parts = F.transform(F.split(out, sep), lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.upper(F.substring(p, 1, 1)), F.substr(p, F.lit(2)))))
        out = F.array_join(parts, sep)
    return out


def merge_persons(first: C, second: C, company: C = None) -> Column:
    """NA5: names of both, split at ;, each once by letters, joined by ;."""
    parts = F.concat(F.split(unescape_common(first), ";"), F.split(unescape_common(second), ";"))
    named = F.filter(F.transform(parts, lambda p: person(p, company, decode=False)), lambda p: p != "")
    first_of = lambda named, keys: F.filter(named, lambda p, i: F.array_position(keys, F.get(keys, i)) == i + 1)
    return F.array_join(bound(named, lambda named: bound(F.transform(named, ascii_key), lambda keys: first_of(named, keys))), ";")


def looks_like_person(value: C, hints=lists.COMPANY_HINTS) -> Column:
    """NA6: two to five words of letters, none of which is a company's."""
    low = F.lower(trim(value))
    parts = F.filter(F.transform(F.split(low, r"(?U)\s+"), lambda w: F.regexp_replace(w, "^[ .,'`´\\-]+|[ .,'`´\\-]+$", "")), lambda w: w != "")
    return ~any_of(low, hints) & F.size(parts).between(2, 5) & (F.size(F.filter(parts, lambda w: F.char_length(w) >= 2)) >= 2) & F.forall(parts, lambda w: w.rlike(r"^[\p{L}.'`´\-]+$"))


def is_human_officer(value: C) -> Column:
    """NA6: an officer's name that is a person's: 'Surname, given names', or two to six words."""
    n = uk_name(value)
    words = F.filter(F.split(n, " "), lambda w: w != "")
    comma = F.contains(text(value), F.lit(","))
    halves = (uk_name(F.substring_index(text(value), ",", 1)) != "") & (uk_name(F.regexp_replace(text(value), "^[^,]*,", "")) != "")
    return (n != "") & ~F.exists(words, lambda w: w.isin(*lists.ENTITY_HINTS)) & ~n.rlike("[0-9]") & F.when(comma, halves).otherwise(F.size(words).between(2, 6))


# company names (NA7-NA9)
def uk_name(value: C) -> Column:
    return trim(F.regexp_replace(F.replace(F.lower(text(value)), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " "))


def without_uk_suffix(value: C) -> Column:
    """NA7: the name without the legal forms at its end, however many."""
    return F.regexp_replace(uk_name(value), f"( (?:{'|'.join(lists.UK_SUFFIXES)}))+$", "")


def clear_containment(a: C, b: C, least: int = 8) -> Column:
    x, y = col(a), col(b)
    return (F.least(F.length(x), F.length(y)) >= least) & (F.contains(x, y) | F.contains(y, x))


def _without_forms(value: C, by: str) -> Column:
    t = F.lower(squeeze(value))
    for form in lists.NAME_FORMS:
        t = F.replace(t, F.lit(form), F.lit(by))
    return t


def match_name(value: C) -> Column:
    return F.regexp_replace(_without_forms(value, ""), _MATCHED, "")


def match_tokens(value: C) -> Column:
    return F.array_distinct(F.filter(F.split(_without_forms(value, " "), _MATCHED), lambda p: F.char_length(p) >= 2))


def name_score(query: C, candidate: C) -> Column:
    """NA8: 100 equal, 70 one in the other, 45 the first four letters in it, else 0."""
    return folded_score(match_name(query), match_name(candidate))


def folded_score(query: C, candidate: C) -> Column:
    """NA8 of names that `match_name` has folded."""
    q, c = col(query), col(candidate)
    return F.when((q == "") | (c == ""), 0).when(q == c, 100).when(F.contains(c, q) | F.contains(q, c), 70).when(F.contains(c, F.substring(q, 1, 4)), 45).otherwise(0)


def folded(value: C) -> Column:
    """match_name and match_tokens of a name, to be made once where the name stands in many pairs."""
    return F.struct(match_name(value).alias("name"), match_tokens(value).alias("tokens"))


def domain_score(query: C, website: C, fold: C | None = None) -> Column:
    """NA9: 100 the host's first label is the name, 80 one begins with the other, else the best of the name's tokens: 95 label, 80 in the host."""
    h = urls.host(website)
    query_name, query_tokens = (match_name(query), match_tokens(query)) if fold is None else (col(fold)["name"], col(fold)["tokens"])
    label, q = F.substring_index(h, ".", 1), query_name
    tokens = F.filter(query_tokens, lambda t: F.char_length(t) >= 4)
    best = F.when(F.array_contains(tokens, label), 95).when(F.exists(tokens, lambda t: F.contains(h, t)), 80).otherwise(0)
    return F.when(h == "", 0).when((q != "") & (q == label), 100).when((q != "") & (F.startswith(q, label) | F.startswith(label, q)), 80).otherwise(best)


def candidate_score(query: C, name: C, website: C, phone: C, folds: tuple[C, C] | None = None) -> Column:
    """NA10: the better of name and domain, less what speaks for another country or for an echo of the query. folds: `folded` of query and name, if made before."""
    domain = domain_score(query, website, folds and folds[0])
    h, low = urls.host(website), F.lower(text(website))
    foreign_tld = any_of(h, lists.FOREIGN_TLDS, F.endswith)
    foreign_url = any_of(low, lists.FOREIGN_URL_PARTS)
    foreign_phone = any_of(text(phone), lists.FOREIGN_PHONES, F.startswith)
    q, c = (match_tokens(query), match_tokens(name)) if folds is None else (col(f)["tokens"] for f in folds)
    by_name = name_score(query, name) if folds is None else folded_score(*(col(f)["name"] for f in folds))
    echo = (F.size(q) > 0) & (F.size(c) > F.size(q) + 1) & (F.slice(c, 1, F.greatest(F.size(q), F.lit(1))) == q) & (domain < 80)
    return (
        F.greatest(by_name, domain) - F.when(foreign_tld, 60).otherwise(0) - F.when(foreign_url, 40).otherwise(0)
        - F.when(foreign_phone, F.when(domain < 80, 60).otherwise(40)).otherwise(0) - F.when(echo, 45).otherwise(0)
    )


# Words of Korean company names, of addresses, and names that say nothing.
KOREAN_COMPANY = ("주식회사", "(주)", "㈜", "유한회사", "합자회사", "건설", "산업", "엔지니어링", "전기", "개발", "테크", "기업")
KOREAN_GENERIC = ("건설회사", "회사", "공사업체", "사업체", "건설", "산업", "엔지니어링")


def local_name_score(value: C) -> Column:
    """NA11: how much a text looks like a company's Korean name; -10000 if it cannot be one."""
    t = squeeze(value)
    compact = F.regexp_replace(t, "[^가-힣]+", "")
    bad = ~t.rlike("[가-힣]") | ~F.char_length(t).between(2, 120) | F.lower(t).rlike(r"http|www\.") | t.rlike("(?:입니다|해주세요|공유해\\s*주세요)[.!?]?$") | compact.isin(*KOREAN_GENERIC) | compact.rlike("(?:시는|군은|구는)$") | (F.contains(t, F.lit("대한민국")) & (F.char_length(t) >= 25))
    s = trim(F.regexp_replace(t, "\\((?:소유자|사업주)\\)", ""))
    points = F.lit(40) + F.when(any_of(s, KOREAN_COMPANY), 50).otherwise(0) - F.when(s.rlike("[시군구]$") & (F.char_length(s) <= 4), 80).otherwise(0) - F.when(s.rlike("[A-Za-z]{4,}"), 20).otherwise(0) + F.floor(F.least(F.char_length(s), F.lit(50)) / 5).cast("int")
    return F.when(bad, F.lit(-10000)).otherwise(points)


# phones, addresses, queries (NA12, NA16-NA19)
def phone(value: C) -> Column:
    """NA12: the text squeezed if it is a phone number of 9 to 13 digits, else ''."""
    t = squeeze(value)
    return F.when(t.rlike(r"^(?:\+\d{1,3}|0)[0-9\s\-]{7,}$") & F.length(F.regexp_replace(t, r"\D", "")).between(9, 13), t).otherwise("")


def national_phone(value: C, country: str) -> Column:
    """NA12: without the country's code and white space."""
    return F.regexp_replace(F.regexp_replace(text(value), r"(?U)\s+", ""), rf"^(?:\+|00){country}", "")


def inline_representative(line: C, labels=lists.REPRESENTATIVE_LABELS) -> Column:
    """NA13: what follows a label and a separator in a line, if it can be a name."""
    found = trim(F.regexp_extract(text(line), f"^\\s*(?:{'|'.join(labels)})[\\s:：/・\\-]+(.+)$", 1))
    return F.when(can_be_representative(found), found).otherwise("")


def can_be_representative(value: C) -> Column:
    t = trim(value)
    return F.char_length(t).between(2, 40) & ~any_of(F.lower(t), lists.REPRESENTATIVE_BLOCKERS) & ~t.isin(*lists.REPRESENTATIVE_NON_NAMES) & ~t.isin(*lists.REPRESENTATIVE_LABELS)


def address(*parts: C) -> Column:
    """NA16: the distinct parts that are filled, joined."""
    return F.array_join(distinct_filled(*parts), ", ")


def jp_prefix(value: C) -> Column:
    """NA16: prefecture and city at the beginning of a Japanese address."""
    return F.regexp_extract(text(value), "^((?:東京都|北海道|(?:京都|大阪)府|.{2,3}県)(?:[^市区町村]{1,10}?[市区町村])?)", 1)


def keyword_seed(name: C) -> Column:
    """NA17: four letters of a Latin name, else two; after a legal form one more."""
    t = trim(name)
    rest = F.regexp_replace(t, "^(?:株式会社|有限会社|合同会社)", "")
    form = F.regexp_extract(t, "^(株式会社|有限会社|合同会社)", 1)
    return F.when(form != "", F.concat(form, F.substring(rest, 1, 1))).when(t.rlike("^[A-Za-z0-9]"), F.substring(t, 1, 4)).otherwise(F.substring(t, 1, 2))


def map_queries(name: C, city: C, country: str) -> Column:
    """NA19: search texts from exact to broad, each once."""
    return distinct_filled(F.concat_ws(" ", trim(name), trim(city), F.lit(country)), F.concat_ws(" ", trim(name), F.lit(country)), trim(name))


def first_present(*columns: C) -> Column:
    """TK11: the first filled by a list of labels."""
    return first_filled(*columns)
