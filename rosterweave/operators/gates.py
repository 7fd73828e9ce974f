"""Predicates that decide which records go on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterweave.functions import urls
from rosterweave.functions.text import any_of, filled, is_blank, text, trim


def three_fields(name: str = "company_name", rep: str = "representative", emails: str = "emails", dash_is_blank: bool = False) -> Column:
    """FP1: company, representative and at least one address are there."""
    out = filled(name) & filled(rep) & filled(emails)
    return out & (trim(rep) != "-") if dash_is_blank else out


def qualified(df: DataFrame, gate: Column, suspicious: Callable[[], Column] | None = None, exempt: Column | None = None) -> DataFrame:
    """FP1, FP2: rows that pass the gate and that the country's own predicate does not suspect; exempt rows are never suspected."""
    bad = suspicious() if suspicious else F.lit(False)
    return df.filter(gate & ~(bad & ~(exempt if exempt is not None else F.lit(False))))


def gate_counts(df: DataFrame, gate: Column, suspicious: Column) -> DataFrame:
    """FP1: rows kept, without a field, suspected; in one pass."""
    return df.agg(F.count_if(gate & ~suspicious).alias("kept"), F.count_if(~gate).alias("incomplete"), F.count_if(gate & suspicious).alias("suspicious"))


def site_done(site: str = "site", people_site: str = "wizasnov") -> Column:
    """FP3: a people site needs name, addresses, a named person and a finished e-mail stage; others name, website and both stages finished."""
    named = F.exists(F.from_json(text("people_json"), "array<struct<name:string>>"), lambda p: filled(p["name"]))
    people = filled("company_name") & filled("emails") & F.coalesce(named, F.lit(False)) & (F.col("email_status") == "done")
    others = filled("company_name") & filled("website") & (F.col("gmap_status") == "done") & (F.col("email_status") == "done")
    return F.when(F.col(site) == people_site, people).otherwise(others)


def site_filter(spec: str | None, site: str = "site") -> Column:
    """FP4: sites named in a list with , or ; between; no list is every site."""
    wanted = [s.strip().lower() for s in (spec or "").replace(";", ",").split(",") if s.strip()]
    return F.lower(F.col(site)).isin(*wanted) if wanted else F.lit(True)


def map_pending() -> Column:
    """FP5: no website yet, and the map stage is open."""
    return is_blank("website") & (F.col("gmap_status") == "pending")


def email_pending() -> Column:
    """FP5: a website, and the e-mail stage is open."""
    return filled("website") & (F.col("email_status").isNull() | F.col("email_status").isin("pending", "rep_pending"))


def dirty_website(website: str = "website") -> Column:
    """FP6: a website that cleaning takes away."""
    return filled(website) & (urls.clean_website(website) == "")


def purge_dirty(records: DataFrame, dependants: DataFrame, key: str, website: str = "website") -> tuple[DataFrame, DataFrame]:
    """FP6: records with dirty websites reset to the map stage, and dependants without their rows."""
    dirty = records.filter(dirty_website(website)).select(key)
    bad = dirty_website(website)
    reset = records.withColumn("gmap_status", F.when(bad, "pending").otherwise(F.col("gmap_status"))).withColumn(website, F.when(bad, "").otherwise(F.col(website)))
    return reset, dependants.join(dirty, key, "left_anti")


def not_placeholder_company(names: list[str], name: str = "company_name") -> Column:
    """FP7."""
    return ~F.col(name).isin(*names)


def in_country(phone: str, address: str, summary: str, website: str, code: str, hints: tuple[str, ...], tld: str, local: str = r"^0[2-9]\d{7,8}$") -> Column:
    """FP8: whether phone, text or website place a record in a country."""
    digits = F.regexp_replace(text(phone), r"[^0-9+]", "")
    words = F.lower(F.concat_ws(" ", text(address), text(summary)))
    return digits.rlike(rf"^(?:\+|00)?{code}") | digits.rlike(local) | any_of(words, hints) | F.endswith(urls.host(website), F.lit(tld))


def empty_detail(status: str = "detail_status", rep: str = "representative", website: str = "website") -> Column:
    """FP9: a detail stage that ended with nothing."""
    return (F.col(status) == "done") & is_blank(rep) & is_blank(website)


def healed(df: DataFrame) -> DataFrame:
    """FP11: states that contradict the data: without a website after the map stage there is no e-mail stage; with one there is no map stage."""
    email = F.when(is_blank("website") & (F.col("gmap_status") == "done"), "done").otherwise(F.col("email_status"))
    gmap = F.when(filled("website") & (F.col("gmap_status") == "pending"), "done").otherwise(F.col("gmap_status"))
    return df.withColumns({"email_status": email, "gmap_status": gmap})


#: Marks of a listing that has ended.
ENDED = ("掲載終了", "募集終了", "受付終了")


def has_ended(name: str) -> Column:
    """FP12."""
    return any_of(text(name), ENDED)


def without_ended(name: str) -> Column:
    return trim(F.regexp_replace(text(name), f"[(（【\\[]?(?:{'|'.join(ENDED)})[)）】\\]]?", ""))
