"""Parsers of landed JSON payloads, as columns: from_json with a declared schema, then paths. A payload that is no JSON gives no rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterweave.functions import emails, names
from rosterweave.functions.text import C, col, filled, first_filled, number, squeeze, text, trim, unescape, unescape_common

_S = "string"


def unmasked(c: C, decode=unescape) -> Column:
    """Text squeezed; blank where only question marks and no letter or digit are left."""
    t = squeeze(decode(c))
    return F.when(F.replace(t, F.lit("?"), F.lit("")).rlike(r"[\p{L}\p{N}]"), t).otherwise("")


def with_scheme(c: C) -> Column:
    t = unmasked(c)
    return F.when((t == "") | t.rlike("^https?://"), t).otherwise(F.concat(F.lit("https://"), F.regexp_replace(t, "^/+", "")))


# PA1: directory listings and profiles
LISTING = (
    "currentPageNumber string, totalPages string, pageSize string, candidatesMatchedQuantityInt string, candidatesMatchedQuantity string, industryName string, countryMapValue string,"
    "companyInformationGeos array<struct<name:string,href:string,quantity:string>>,"
    "companyInformationCompany array<struct<duns:string,primaryName:string,companyNameUrl:string,addressCountryIsoAlphaTwoCode:string,addressCountryName:string,addressRegionNameFormatted:string,"
    "addressLocalityNameFormatted:string,salesRevenue:string,primaryAddress:struct<postalCode:string,streetAddress:struct<line1:string>>>>"
)
PROFILE = (
    "overview struct<primaryName:string,keyPrincipal:string,website:string,phone:string>, contacts struct<contacts:array<struct<name:string>>>,"
    "header struct<companyName:string,companyWebsiteUrl:string,companyNewHeaderParameter:struct<companyInformationForCookie:struct<companyName:string,companyAddress:string,companyCity:string,companyState:string,companyZip:string>>>"
)


def listing_pages(df: DataFrame, payload: str, industry: str) -> DataFrame:
    """PA1: one row a page: current_page, total_pages, page_size, matched, geos."""
    p = df.withColumn("_p", F.from_json(payload, LISTING))
    geos = F.transform(F.coalesce("_p.companyInformationGeos", F.array().cast("array<struct<name:string,href:string,quantity:string>>")), lambda g: F.struct(trim(g["name"]).alias("name"), trim(g["href"]).alias("href"), number(g["quantity"]).alias("quantity")))
    matched = number(first_filled("_p.candidatesMatchedQuantityInt", "_p.candidatesMatchedQuantity"))
    return p.select(industry, number("_p.currentPageNumber").alias("current_page"), number("_p.totalPages").alias("total_pages"), number("_p.pageSize").alias("page_size"), matched.alias("matched"), geos.alias("geos"))


def listing_companies(df: DataFrame, payload: str, industry: str, detail_url: str = "https://example.invalid/profiles/{}.html") -> DataFrame:
    """PA1: one row a company, with its position in the page."""
    c = df.select(industry, F.posexplode(F.from_json(payload, LISTING)["companyInformationCompany"]).alias("pos", "c"))
    slug, (before, after) = trim("c.companyNameUrl"), detail_url.split("{}")
    return c.select(
        industry, "pos", trim("c.duns").alias("duns"), trim(unescape("c.primaryName")).alias("company_name"), slug.alias("slug"), F.when(slug != "", F.concat(F.lit(before), slug, F.lit(after))).otherwise("").alias("detail_url"),
        trim("c.addressCountryIsoAlphaTwoCode").alias("country_code"), trim("c.addressRegionNameFormatted").alias("region"), trim("c.addressLocalityNameFormatted").alias("city"),
        trim("c.primaryAddress.postalCode").alias("postal_code"), trim(unescape("c.primaryAddress.streetAddress.line1")).alias("address"), trim("c.salesRevenue").alias("sales_revenue"),
    )


def profile(payload: C) -> Column:
    """PA1: a profile as a struct. The representative is the key principal, else the first contact with a real name."""
    p = F.from_json(col(payload), PROFILE)
    cookie = p["header"]["companyNewHeaderParameter"]["companyInformationForCookie"]
    real = F.filter(F.transform(F.coalesce(p["contacts"]["contacts"], F.array().cast("array<struct<name:string>>")), lambda x: unmasked(x["name"], unescape_common)), lambda n: (n != "") & ~F.startswith(F.lower(n), F.lit("contact ")))
    return F.struct(
        unmasked(first_filled(p["overview"]["primaryName"], p["header"]["companyName"], cookie["companyName"])).alias("company_name"),
        first_filled(unmasked(p["overview"]["keyPrincipal"]), F.get(real, F.lit(0))).alias("representative"),
        with_scheme(first_filled(p["overview"]["website"], p["header"]["companyWebsiteUrl"])).alias("website"), unmasked(p["overview"]["phone"]).alias("phone"),
        unmasked(cookie["companyAddress"]).alias("address"), unmasked(cookie["companyCity"]).alias("city"), unmasked(cookie["companyState"]).alias("region"), unmasked(cookie["companyZip"]).alias("postal_code"),
    )


# PA2: search results with facets
SEARCH = (
    "hits string, pages string, companies array<struct<orgnr:string,name:string,legalName:string,email:string,homePage:string,phone:string,"
    "address:struct<addressLine:string,zipCode:string,postPlace:string>,contactPerson:struct<name:string,role:string>>>,"
    "filters array<struct<filterType:string,filters:array<struct<displayName:string,hits:string>>>>"
)


def search_companies(df: DataFrame, payload: str, keys: list[str]) -> DataFrame:
    """PA2: one row a company that has a number and a name."""
    c = df.select(*keys, F.posexplode(F.from_json(payload, SEARCH)["companies"]).alias("pos", "c"))
    out = c.select(
        *keys, "pos", squeeze("c.orgnr").alias("orgnr"), squeeze(unescape(first_filled("c.name", "c.legalName"))).alias("company_name"), squeeze(unescape("c.contactPerson.name")).alias("representative"),
        squeeze("c.contactPerson.role").alias("representative_role"), names.address("c.address.addressLine", "c.address.zipCode", "c.address.postPlace").alias("address"), squeeze("c.homePage").alias("homepage"),
        emails.normalize("c.email").alias("email"), squeeze("c.phone").alias("phone"),
    )
    return out.filter(filled("orgnr") & filled("company_name"))


def search_facets(df: DataFrame, payload: str, keys: list[str], kind: str) -> DataFrame:
    """PA2: name and hits of each value of a facet, the first of each name."""
    groups = df.select(*keys, F.explode(F.from_json(payload, SEARCH)["filters"]).alias("g")).filter(F.lower(trim("g.filterType")) == kind.lower())
    values = groups.select(*keys, F.posexplode("g.filters").alias("pos", "f")).select(*keys, "pos", squeeze("f.displayName").alias("name"), number("f.hits").alias("hits")).filter("name <> ''")
    return values.groupBy(*keys, "name").agg(F.min_by("hits", "pos").alias("hits"), F.min("pos").alias("pos"))


# PA3: register entries
REGISTER = "cvr string, senesteNavn string, beliggenhedsadresse string, postnummer string, by string, telefonnummer string, email string, hovedbranche string, virksomhedsform string, status string, startDato string"
REGISTER_DETAIL = (
    "udvidedeOplysninger struct<email:string,telefon:string,kommune:string,formaal:string,registreretKapital:string,hovedbranche:struct<branchekode:string,titel:string>>,"
    "ejerforhold struct<aktiveLegaleEjere:array<struct<senesteNavn:string,navn:string,adresse:string,enhedstype:string>>>,"
    "personkreds struct<personkredser:array<struct<rolle:struct<name:string,funktionsVaerdi:array<string>>,personRoller:array<struct<senesteNavn:string,navn:string>>>>>"
)
#: Roles that lead a company.
DIRECTOR_ROLES = ("DIREKTOERER", "DIREKTION", "ADM_DIREKTION")


def register_entry(payload: C) -> Column:
    """PA3: an entry of a register's result list."""
    p = F.from_json(col(payload), REGISTER)
    branch = text(p["hovedbranche"])
    return F.struct(
        text(p["cvr"]).alias("cvr"), text(p["senesteNavn"]).alias("company_name"), F.replace(text(p["beliggenhedsadresse"]), F.lit("\n"), F.lit(", ")).alias("address"), text(p["postnummer"]).alias("postcode"),
        text(p["by"]).alias("city"), text(p["telefonnummer"]).alias("phone"), text(p["email"]).alias("email"), F.substring_index(branch, " ", 1).alias("industry_code"),
        F.when(F.contains(branch, F.lit(" ")), F.regexp_extract(branch, "^[^ ]* (.*)$", 1)).otherwise(branch).alias("industry_name"), text(p["virksomhedsform"]).alias("company_type"), text(p["status"]).alias("status"), text(p["startDato"]).alias("start_date"),
    )


def register_detail(payload: C) -> Column:
    """PA3: owners, and the representative: the first person in a directing role, else the first owner that is no company."""
    p = F.from_json(col(payload), REGISTER_DETAIL)
    owner = "struct<name:string,address:string,type:string>"
    owners = F.transform(F.coalesce(p["ejerforhold"]["aktiveLegaleEjere"], F.array().cast("array<struct<senesteNavn:string,navn:string,adresse:string,enhedstype:string>>")), lambda o: F.struct(first_filled(o["senesteNavn"], o["navn"]).alias("name"), text(o["adresse"]).alias("address"), text(o["enhedstype"]).alias("type")))
    groups = F.filter(F.coalesce(p["personkreds"]["personkredser"], F.array().cast("array<struct<rolle:struct<name:string,funktionsVaerdi:array<string>>,personRoller:array<struct<senesteNavn:string,navn:string>>>>")), lambda g: F.upper(text(g["rolle"]["name"])).isin(*DIRECTOR_ROLES))
    persons = F.flatten(F.transform(groups, lambda g: F.transform(F.coalesce(g["personRoller"], F.array().cast("array<struct<senesteNavn:string,navn:string>>")), lambda r: F.struct(first_filled(r["senesteNavn"], r["navn"]).alias("name"), first_filled(F.get(g["rolle"]["funktionsVaerdi"], F.lit(0)), F.upper(text(g["rolle"]["name"]))).alias("role")))))
    director = F.get(F.filter(persons, lambda x: x["name"] != ""), F.lit(0))
    first = F.get(owners, F.lit(0))
    natural = F.when(F.upper(text(first["type"])) != "VIRKSOMHED", F.struct(first["name"].alias("name"), F.lit("Ejer").alias("role")))
    who = F.coalesce(director, natural)
    ext = p["udvidedeOplysninger"]
    return F.struct(
        text(ext["email"]).alias("email"), text(ext["telefon"]).alias("phone"), text(ext["kommune"]).alias("municipality"), text(ext["formaal"]).alias("purpose"), text(ext["registreretKapital"]).alias("capital"),
        text(ext["hovedbranche"]["branchekode"]).alias("industry_code"), text(ext["hovedbranche"]["titel"]).alias("industry_name"), F.to_json(owners.cast(f"array<{owner}>")).alias("owners_json"),
        text(who["name"]).alias("representative"), text(who["role"]).alias("representative_role"),
    )


# PA4: job postings in several languages
JOB = (
    "id string, businessId string, postOffice string, title struct<values:map<string,string>>, businessName struct<values:map<string,string>>, location struct<municipality:string>,"
    "employer struct<name:string,businessId:string,businessName:struct<values:map<string,string>>>, recruiting array<struct<firstName:string,lastName:string,email:string,telephone:string>>,"
    "externalLinks array<struct<url:string>>, postalAddress string, postalNumber string, industryCode string, regions array<string>, wagePrincipleInfo struct<values:map<string,string>>, jobDescription struct<values:map<string,string>>"
)


def local_text(values: Column, languages: tuple[str, ...] = ("fi", "en")) -> Column:
    """The text of the first language that has one, else the first there is."""
    return first_filled(*[F.try_element_at(values, F.lit(lang)) for lang in languages], F.get(F.map_values(values), F.lit(0)))


def job(payload: C) -> Column:
    """PA4: a posting as a struct; the first recruiter is the contact."""
    p = F.from_json(col(payload), JOB)
    who = F.get(p["recruiting"], F.lit(0))
    links = F.filter(F.coalesce(p["externalLinks"], F.array().cast("array<struct<url:string>>")), lambda x: trim(x["url"]) != "")
    return F.struct(
        text(p["id"]).alias("job_id"), local_text(p["title"]["values"]).alias("title"), first_filled(local_text(p["employer"]["businessName"]["values"], ("fi",)), local_text(p["businessName"]["values"], ("fi",)), p["employer"]["name"]).alias("company_name"),
        first_filled(p["businessId"], p["employer"]["businessId"]).alias("business_id"), first_filled(p["location"]["municipality"], p["postOffice"]).alias("city"), trim(F.concat_ws(" ", trim(who["firstName"]), trim(who["lastName"]))).alias("representative"),
        F.lower(trim(who["email"])).alias("email"), trim(who["telephone"]).alias("phone"), trim(F.get(links, F.lit(0))["url"]).alias("homepage"), trim(p["postalAddress"]).alias("address"), trim(p["postalNumber"]).alias("postcode"),
        trim(p["industryCode"]).alias("industry_code"), F.array_join(p["regions"], ",").alias("region"), local_text(p["wagePrincipleInfo"]["values"], ("fi",)).alias("salary"), F.substring(local_text(p["jobDescription"]["values"], ("fi",)), 1, 2000).alias("description"),
    )


# PA11-PA13, PA15: contacts
PROSPECTS = "data array<struct<name:string,first_name:string,last_name:string,position:string,job_title:string,title:string,prospect_hash:string,hash:string,id:string,search_emails_start:string,links:struct<search_emails:string,searchEmails:string>,source_page:string,source:string>>"


def prospects(df: DataFrame, payload: str, keys: list[str]) -> DataFrame:
    """PA11: one row a contact that has a name and a title, each once, in order."""
    p = df.select(*keys, F.posexplode(F.from_json(payload, PROSPECTS)["data"]).alias("pos", "x"))
    out = p.select(
        *keys, "pos", first_filled("x.name", F.concat_ws(" ", trim("x.first_name"), trim("x.last_name"))).alias("name"), trim(first_filled("x.position", "x.job_title", "x.title")).alias("title"), trim(first_filled("x.prospect_hash", "x.hash", "x.id")).alias("prospect_hash"),
        trim(first_filled("x.search_emails_start", "x.links.search_emails", "x.links.searchEmails")).alias("email_lookup_path"), trim(first_filled("x.source_page", "x.source")).alias("source_page"),
    ).filter(filled("name") & filled("title"))
    return out.groupBy(*keys, F.lower("name").alias("_n"), F.lower("title").alias("_t")).agg(F.min_by(F.struct("pos", "name", "title", "prospect_hash", "email_lookup_path", "source_page"), "pos").alias("r")).select(*keys, "r.*")


def people_json(people: C) -> Column:
    """PA12: an array of {name, title_zh, emails} as JSON."""
    return F.to_json(F.transform(col(people), lambda p: F.struct(p["name"].alias("name"), p["title"].alias("title_zh"), p["emails"].alias("emails"))))


def representative_names(people: C) -> Column:
    return F.array_join(F.filter(F.transform(col(people), lambda p: p["name"]), lambda n: filled(n)), ";")


def name_and_site(df: DataFrame, payload: str, keys: list[str]) -> DataFrame:
    """PA13: rows of name and website."""
    return df.select(*keys, F.inline(F.from_json(payload, "array<struct<name:string,website:string>>"))).select(*keys, trim("name").alias("company_name"), trim("website").alias("website")).filter("company_name <> ''")


def extracted_emails(payload: C) -> Column:
    """PA15: addresses in an extraction's answer, wherever it is wrapped (data, extract, result, or bare); lower-cased, those with an @, each once."""
    inner = "emails array<string>, email string"
    shape = f"{inner}, data struct<{_typed(inner)},extract:struct<{_typed(inner)}>,result:struct<{_typed(inner)}>>, extract struct<{_typed(inner)}>, result struct<{_typed(inner)}>"
    p = F.from_json(col(payload), shape)
    none = F.array().cast("array<string>")
    spots = [p, p["data"], p["extract"], p["result"], p["data"]["extract"], p["data"]["result"]]
    all_ = F.flatten(F.array(*[F.concat(F.coalesce(s["emails"], none), F.coalesce(F.array(s["email"]), none)) for s in spots]))
    return F.array_distinct(F.filter(F.transform(all_, lambda e: F.lower(trim(e))), lambda e: F.contains(e, F.lit("@"))))


def _typed(fields: str) -> str:
    return ",".join(f"{n}:{t}" for n, t in (f.strip().split(" ") for f in fields.split(", ")))


def supported(name: C, quote: C) -> Column:
    """NA14: a name only if its words are in the quote."""
    from rosterweave.functions.text import tokens_supported

    return F.when(tokens_supported(name, quote), text(name)).otherwise("")
