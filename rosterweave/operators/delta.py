"""Joins and set operations between days: what is new, what was delivered before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterweave.functions.text import trim


def new_by_key(current: DataFrame, baseline: DataFrame, key: str) -> DataFrame:
    """J4: rows whose key the baseline lacks."""
    return current.join(baseline.select(key).distinct(), key, "left_anti")


def new_by_two_keys(current: DataFrame, baseline: DataFrame, name_key: str, domain_key: str, key: str = "key") -> DataFrame:
    """J5: rows of which the baseline holds neither key. A blank domain key is no key. Two equi-joins, where an OR would compare all pairs."""
    keys = baseline.select(F.col(key).alias("_k")).distinct()
    rest = current.join(keys, current[name_key] == keys["_k"], "left_anti")
    return rest.join(keys.filter("_k <> ''"), rest[domain_key] == F.col("_k"), "left_anti")


def seen_by_two_keys(history: DataFrame, baseline: DataFrame, name_key: str, domain_key: str, row_id: str, key: str = "key") -> DataFrame:
    """J6: rows of which the baseline holds a key."""
    keys = baseline.select(F.col(key).alias("_k")).filter("_k <> ''").distinct()
    hits = history.select(row_id, F.explode(F.array(name_key, domain_key)).alias("_k")).join(keys, "_k", "left_semi").select(row_id).distinct()
    return history.join(hits, row_id, "left_semi")


def cumulative_keys(baseline: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """ST1: the keys of both, each once."""
    return baseline.select(key).unionByName(current.select(key)).distinct()


def website_difference(current: DataFrame, baseline: DataFrame, site: str = "website") -> DataFrame:
    """J7: sites of today that the baseline lacks, trimmed, each once."""
    tidy = lambda df: df.select(trim(site).alias(site)).filter(F.col(site) != "")
    return tidy(current).subtract(tidy(baseline))


def union_in_order(*sites: DataFrame, ordinal: str = "site_ord") -> DataFrame:
    """ST3: tables one after the other; the position is kept, since the first row of a key wins later."""
    out = None
    for i, df in enumerate(sites):
        one = df.withColumn(ordinal, F.lit(i))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def skip_planned(catalogue: DataFrame, planned: DataFrame, key: str) -> DataFrame:
    """ST5: what is not planned yet."""
    return catalogue.join(planned.select(key).distinct(), key, "left_anti")


def keep_allowed(picked: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    """ST6, J9: picks that the allowed set holds; the order column of the picks stays."""
    return picked.join(allowed.select(key).distinct(), key, "left_semi")


def queue_with_records(queue: DataFrame, records: DataFrame, key: str) -> DataFrame:
    """J1: tasks with their records."""
    return queue.join(records, key, "inner")


def final_with_profile(final: DataFrame, records: DataFrame, key: str, phone: str = "phone", other_phone: str = "map_phone") -> DataFrame:
    """J2, FP10: final rows with what the record adds; the phone is the first that is filled."""
    joined = final.join(records, key, "left")
    return joined.withColumn(phone, F.coalesce(F.nullif(F.col(phone), F.lit("")), F.nullif(F.col(other_phone), F.lit("")), F.lit("")))


def with_exists(rows: DataFrame, others: DataFrame, norm: Column, other_norm: Column, flag: str = "exists") -> DataFrame:
    """J3: a column that says whether others hold a row of the same normalised name."""
    found = others.select(other_norm.alias("_norm")).filter("_norm <> ''").distinct().withColumn(flag, F.lit(True))
    return rows.withColumn("_norm", norm).join(found, "_norm", "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False))).drop("_norm")


def with_cache(tasks: DataFrame, cache: DataFrame, domain: str = "domain", emails: str = "emails") -> DataFrame:
    """J8: open tasks whose domain was looked up before, with the addresses of both, the task's first."""
    known = cache.select(domain, F.col(emails).alias("_cached"))
    merged = F.array_union(F.coalesce(F.col(emails), F.array().cast("array<string>")), F.col("_cached"))
    return tasks.filter(F.col("status").isin("pending", "running")).join(known, domain, "inner").withColumn(emails, merged).withColumn("status", F.lit("done")).drop("_cached")


def scopes_to_do(scopes: DataFrame, checkpoints: DataFrame, key: str, by_status: bool = True) -> DataFrame:
    """J11: scopes that are not done, with a rank: failed, running, the rest, then by key."""
    left = scopes.join(checkpoints.select(key, "status"), key, "left").withColumn("status", F.coalesce("status", F.lit("pending"))).filter("status <> 'done'")
    first = F.when(F.col("status") == "error", 0).when(F.col("status") == "running", 1).otherwise(2) if by_status else F.lit(0)
    return left.withColumn("priority", first)


def prospect_by_key(wanted: DataFrame, prospects: DataFrame, key: str, order: list[str]) -> DataFrame:
    """J10: for each wanted key the first prospect that has it; keys that none has go."""
    rest = [c for c in prospects.columns if c != key]
    first = prospects.filter(F.col(key) != "").groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_p"))
    return wanted.join(first, key).select(*wanted.columns, *[F.col(f"_p.{c}").alias(c) for c in rest if c not in wanted.columns])


def contact_sources(companies: DataFrame, by_domain: DataFrame, by_name: DataFrame) -> DataFrame:
    """J12: a company's domain, looked up by name where it has none, and the addresses of all sources united."""
    named = by_name.select("company_name", F.col("domain").alias("_found"))
    at = companies.join(named, "company_name", "left").withColumn("domain", F.coalesce(F.nullif(F.col("domain"), F.lit("")), F.col("_found"), F.lit(""))).drop("_found")
    none = F.array().cast("array<string>")
    joined = at.join(by_domain, "domain", "left")
    return joined.withColumn("emails", F.array_union(F.array_union(F.coalesce("domain_emails", none), F.coalesce("generic_emails", none)), F.coalesce("person_emails", none)))
