"""Daily delivery: scan, merge, gate, delta against the days before, sinks. One operator; what differs between countries is a parameter set.

Everything up to the sinks is one lazy plan. On the driver are only folder names, the day check and the summary's counts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterweave.functions import emails, names
from rosterweave.functions.text import trim
from rosterweave.operators import dedup, delta, gates, queues
from rosterweave.sources import readers, sinks

FIELDS = ["company_name", "representative", "website", "phone", "address"]
COLUMNS = ["company_name", "representative", "emails", "website", "phone", "address"]


@dataclass(frozen=True)
class Delivery:
    """How a country's records become a delivery."""

    country: str
    #: the record key, from the columns of FIELDS
    key: Callable[[], Column]
    #: "none", "two_level" (registry id, then name), "fields" (by key), "best" (best row by key, addresses united), "composite"
    merge: str = "none"
    #: records kept after cleaning
    gate: Callable[[], Column] = gates.three_fields
    #: e-mail rule by site, None: addresses as they are
    email_filter: Callable[[str, str], Column] | None = None
    #: NA2: entities, lengths, corporate suffixes, phone
    sanitize: bool = True
    key_policy: str = "union"
    #: look further back when the day before left no keys
    search_back: bool = True
    #: write keys though nothing is new
    keys_without_delta: bool = False
    #: keys of earlier days may have spaces around their parts
    tidy_keys: bool = False
    email_options: dict = field(default_factory=dict)


_lower = lambda: names.key_lower("company_name")
_alnum = lambda: names.key_alnum("company_name")
_three = lambda: names.key_three("company_name", "representative", "website")
_four = lambda: names.key_four("company_name", "representative", "website", "address")

#: UX2: the registry. A new country is a new row.
COUNTRIES: dict[str, Delivery] = {
    d.country.lower(): d
    for d in (
        Delivery("England", _lower, "two_level", email_filter=emails.for_country, key_policy="current", keys_without_delta=True),
        Delivery("Denmark", _lower, "two_level", email_filter=lambda w, e: emails.for_country(w, e, letters={"æ": "ae", "ø": "oe", "å": "aa"}), key_policy="current", keys_without_delta=True),
        Delivery("Finland", _lower, "fields", email_filter=lambda w, e: emails.for_country(w, e, fold=False), key_policy="current", keys_without_delta=True),
        Delivery("Taiwan", _lower, key_policy="current", keys_without_delta=True),
        Delivery("Brazil", _three, "best", sanitize=False),
        Delivery("UnitedStates", _three, "best", sanitize=False),
        Delivery("Germany", _alnum),
        Delivery("UnitedArabEmirates", _alnum, gate=lambda: trim("company_name") != "", sanitize=False),
        Delivery("Japan", _four, "composite", gate=lambda: gates.three_fields(dash_is_blank=True), tidy_keys=True),
    )
}


def merged(records: DataFrame, spec: Delivery) -> DataFrame:
    """records: FIELDS, emails (array), site_ord, seq, and orgnr where the merge is by id."""
    order = ["site_ord", "seq"]
    if spec.merge == "two_level":
        out = dedup.two_level(records, "orgnr", "company_name", order, FIELDS)
    elif spec.merge == "fields":
        out = dedup.first_non_blank(records.withColumn("_key", spec.key()), ["_key"], order, FIELDS, ("emails",)).drop("_at")
    elif spec.merge == "best":
        score = [sum((F.when(trim(c) != "", 1).otherwise(0) for c in ("website", "phone", "address")), F.size("emails"))]
        out = dedup.best_with_union(records, spec.key(), score, order)
    elif spec.merge == "composite":
        out = dedup.composite(records, order, FIELDS)
    else:
        out = records
    return out.select(*FIELDS, "emails")


def cleaned(records: DataFrame, spec: Delivery) -> DataFrame:
    """Addresses filtered by site, fields sanitised, the gate applied; with `key`."""
    df = records
    if spec.email_filter:
        df = df.withColumn("emails", spec.email_filter("website", "emails"))
    if spec.sanitize:
        df = df.withColumn("_clean", names.sanitized("company_name", "representative", "emails", "phone", **spec.email_options)).filter(F.col("_clean").isNotNull())
        df = df.select("_clean.company_name", "_clean.representative", F.split("_clean.emails", "; ").alias("emails"), "website", "_clean.phone", "address")
    joined = df.withColumn("emails", emails.join("emails"))
    return joined.filter(spec.gate()).withColumn("key", spec.key()).select("key", *COLUMNS)


def day(records: DataFrame, baseline: DataFrame, spec: Delivery) -> tuple[DataFrame, DataFrame]:
    """(current, delta): all records of today with their keys, and those whose key the baseline lacks."""
    current = cleaned(merged(records, spec), spec)
    if spec.merge == "none":  # a key may still repeat: its first row by content goes
        current = dedup.first_wins(current, F.col("key"), ["key", *COLUMNS])
    return current, delta.new_by_key(current, baseline, "key")


def deliver(spark: SparkSession, records: DataFrame, delivery: str, label: str, spec: Delivery) -> dict:
    """One day: checked, computed, written. Returns the summary."""
    number, before = queues.check_day(label, spec.country, [n for n in readers.Folder(spark, delivery).names(folders=True)])
    baseline = readers.baseline_keys(spark, delivery, spec.country, before, search_back=spec.search_back, tidy=spec.tidy_keys).cache()
    current, new = day(records, baseline, spec)
    current, new = current.cache(), new.cache()
    folder = sinks.prepared(spark, delivery, queues.day_folder(spec.country, number))
    total, n = _write(folder, "companies", "keys.txt", baseline, current, new, spec)
    out = sinks.summary(folder, country=spec.country, day=number, baseline_day=before, delta_companies=n, total_current_companies=total)
    for df in (baseline, current, new):
        df.unpersist()
    return out


def _write(folder: readers.Folder, stem: str, keys: str, baseline: DataFrame, current: DataFrame, new: DataFrame, spec: Delivery) -> tuple[int, int]:
    """SK8: without a delta there is no CSV, and keys only where the country always writes them. Returns (records, new ones)."""
    total, n = current.count(), new.count()
    if n:
        sinks.delta_csv(new, folder, f"{stem}.csv", COLUMNS, bom=True)
    if n or spec.keys_without_delta:
        sinks.key_file(baseline, current, folder, keys, policy=spec.key_policy)
    if not n:
        sinks.cleared(folder, f"{stem}.csv", *([] if spec.keys_without_delta else [keys]))
    return total, n


def deliver_sites(spark: SparkSession, sites: dict[str, DataFrame], delivery: str, label: str, spec: Delivery, only: str | None = None, keep: bool = False, summary_only: bool = False) -> dict:
    """One day, site by site: each with its own CSV, keys and baseline; sites are a few dozen, their records are not.

    only: FP4, a list of sites. keep: files of other sites of the day stay (else the folder is new). summary_only: nothing is computed, the
    summary is made from the files there are (SK3)."""
    number, before = queues.check_day(label, spec.country, readers.Folder(spark, delivery).names(folders=True))
    folder = sinks.prepared(spark, delivery, queues.day_folder(spec.country, number), keep=keep or summary_only)
    wanted = {x.strip().lower() for x in (only or "").replace(";", ",").split(",") if x.strip()}
    stats, skipped = {}, []
    for site in sorted(sites) if not summary_only else []:
        if wanted and site.lower() not in wanted:
            continue
        baseline = readers.baseline_keys(spark, delivery, spec.country, before, site, spec.search_back, spec.tidy_keys).cache()
        current, new = (df.cache() for df in day(sites[site], baseline, spec))
        total, n = _write(folder, site, f"{site}.keys.txt", baseline, current, new, spec)
        stats[site] = {"qualified_current": total, "delta": n}
        if not n:
            skipped.append(site)
        for df in (baseline, current, new):
            df.unpersist()
    for site in sorted({n.removesuffix(".keys.txt").removesuffix(".csv") for n in folder.names(folders=False) if n.endswith((".csv", ".keys.txt")) and not n.startswith(".")} - stats.keys()):
        csv, keys = (f"{folder.path}/{site}{end}" for end in (".csv", ".keys.txt"))
        stats[site] = {
            "qualified_current": spark.read.text(keys).filter(trim("value") != "").count() if folder.has(f"{site}.keys.txt") else 0,
            "delta": spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(csv).count() if folder.has(f"{site}.csv") else 0,
        }
    sums = {f"{k}_companies": sum(s[v] for s in stats.values()) for k, v in (("delta", "delta"), ("total_current", "qualified_current"))}
    return sinks.summary(folder, country=spec.country, day=number, baseline_day=before, **sums, sites=stats, skipped_sites_no_delta=sorted(skipped))


def deliver_country(spark: SparkSession, country: str, records: DataFrame, delivery: str, label: str) -> dict:
    """UX2."""
    if country.lower() not in COUNTRIES:
        raise ValueError(f"no such country: {country}")
    return deliver(spark, records, delivery, label, COUNTRIES[country.lower()])


def deliver_websites(spark: SparkSession, sites: dict[str, DataFrame], delivery: str, label: str, country: str) -> dict:
    """J7: websites alone, in a series of days of its own: each site's set of today without that of the day before; keys are written always."""
    series = f"{country}_websites"
    number, before = queues.check_day(label, series, readers.Folder(spark, delivery).names(folders=True))
    folder = sinks.prepared(spark, delivery, queues.day_folder(series, number))
    stats, skipped = {}, []
    for site in sorted(sites):
        today = sites[site].select(trim("website").alias("website")).filter("website <> ''").distinct().cache()
        old = readers.baseline_keys(spark, delivery, series, before, site, search_back=False).select(F.col("key").alias("website"))
        new = delta.website_difference(today, old).cache()
        if n := new.count():
            sinks.delta_csv(new, folder, f"{site}.csv", ["website"])
        else:
            skipped.append(site)
        keys = today.select(F.col("website").alias("key"))
        sinks.key_file(keys, keys, folder, f"{site}.keys.txt", policy="current")
        stats[site] = {"qualified_current": today.count(), "delta": n}
        today.unpersist()
        new.unpersist()
    sums = {f"{k}_websites": sum(s[v] for s in stats.values()) for k, v in (("delta", "delta"), ("total_current", "qualified_current"))}
    return sinks.summary(folder, country=country, day=number, baseline_day=before, **sums, sites=stats, skipped_sites_no_delta=skipped)


def engine_delivery(current: DataFrame, history: DataFrame | None, baseline: DataFrame, suspicious: Callable[[], Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """The shared form: records of today and of earlier days (sites in order, history last), gated, first wins by name key else domain key; the delta by both keys.

    current, history: FIELDS, emails (array), site_ord, seq. Returns (records with key and domain_key, delta)."""
    today = current.withColumn("_old", F.lit(False))
    rows = today
    if history is not None:
        old = history.withColumns({"_old": F.lit(True), "key": names.key_engine("company_name", "website"), "domain_key": names.key_domain("website"), "_row": F.monotonically_increasing_id()})
        old = delta.seen_by_two_keys(old, baseline, "key", "domain_key", "_row").drop("key", "domain_key", "_row")
        rows = today.unionByName(old, allowMissingColumns=True)
    gate = gates.three_fields(emails="_joined")
    rows = gates.qualified(rows.withColumn("_joined", emails.join("emails")), gate, suspicious, exempt=F.col("_old")).drop("_joined")
    kept = dedup.first_wins(rows, names.key_engine("company_name", "website"), ["_old", "site_ord", "seq"])
    kept = kept.withColumns({"key": names.key_engine("company_name", "website"), "domain_key": names.key_domain("website")})
    return kept, delta.new_by_two_keys(kept, baseline, "key", "domain_key")
