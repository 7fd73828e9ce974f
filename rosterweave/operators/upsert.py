"""Upserts as folds: a snapshot and a batch of changes give the next snapshot.

Plain Parquet tables have no MERGE, and a fold needs none: rows of old and new are grouped by primary key, and each column takes its
value by a policy. All policies combine before the shuffle. `seq` orders changes; the snapshot comes before them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterweave.functions import emails, names
from rosterweave.functions.text import filled, text, trim
from rosterweave.operators.dedup import Pick, grouped

BLANKS = ("", "-")


def _non_blank(blanks: tuple[str, ...]) -> Callable[[str, Column], Pick]:
    def pick(f: str, at: Column) -> Pick:
        fine = ~trim(f).isin(*blanks)
        return F.max_by, F.when(fine, F.col(f)), F.when(fine, at)

    return pick


#: How a column of several versions gets its value. `at` is (0, 0) for the snapshot and (1, seq) for changes.
POLICIES: dict[str, Callable[[str, Column], Pick]] = {
    "non_blank": _non_blank(("",)),  # UP1, UP2: the last that is not blank
    "non_blank_or_dash": _non_blank(BLANKS),  # UP1: where - is blank too
    "overwrite": lambda f, at: (F.max_by, F.col(f), at),  # UP3: the last, blank or not
    "keep_old": lambda f, at: (F.min_by, F.col(f), at),  # UP3, UP4: the first
    "greatest": lambda f, at: (F.max_by, F.col(f), F.col(f)),  # AG14
}
#: UP6: the distinct values that are not blank, in order, joined by ;. A union, not a pick.
JOIN = "join"


def _listed(f: str) -> Column:
    return F.filter(F.transform(F.split(text(f), ";"), lambda x: F.trim(x)), lambda x: x != "")


def fold(snapshot: DataFrame | None, changes: DataFrame, keys: list[str], policy: dict[str, str], seq: str = "seq") -> DataFrame:
    """UP1-UP3, UP10, UP15: the next snapshot. `policy` names a rule for each column; columns that one side lacks are blank there."""
    both = changes.withColumn("_new", F.lit(1))
    if snapshot is not None:
        both = snapshot.withColumns({"_new": F.lit(0), seq: F.lit(0).cast("long")}).unionByName(both, allowMissingColumns=True)
    at = F.struct("_new", F.col(seq))
    missing = {c: F.lit(None).cast("string") for c in policy if c not in both.columns}
    picks = {c: POLICIES[rule](c, at) for c, rule in policy.items() if rule != JOIN}
    got = grouped(both.withColumns(missing), keys, picks, {c: (_listed(c), at) for c, rule in policy.items() if rule == JOIN})
    shown = {JOIN: lambda c: F.array_join(c, ";"), **{r: lambda c: F.coalesce(c, F.lit("")) for r in ("non_blank", "non_blank_or_dash")}}
    return got.select(*keys, *[shown.get(rule, F.col)(c).alias(c) for c, rule in policy.items()])


def true_inserts(snapshot: DataFrame, changes: DataFrame, keys: list[str]) -> int:
    """Rows of the batch that are new, each key once; updates do not count."""
    return changes.select(*keys).distinct().join(snapshot.select(*keys), keys, "left_anti").count()


def insert_ignore(existing: DataFrame, rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """UP4: existing rows, and of each new key its first row."""
    first = rows.groupBy(key).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("r")).select("r.*")
    return existing.unionByName(first.join(existing.select(key), key, "left_anti"), allowMissingColumns=True)


def seeded(rows: DataFrame, name: str = "company_name", key: str = "id") -> DataFrame:
    """UP4: rows with an id made from the name."""
    return rows.withColumn(key, names.seed_id(name))


def final_rows(records: DataFrame, key: str = "orgnr", emails_col: str = "emails") -> DataFrame:
    """UP5: one row a record, representative and address, for records that have all three and a person as representative. A view: nothing is mutated."""
    fine = filled("company_name") & filled("representative") & ~names.has_corporate_suffix("representative") & (F.size(emails_col) > 0)
    return records.filter(fine).withColumn("email", F.explode(emails_col)).drop(emails_col)


def final_merge(old: DataFrame, results: DataFrame, key: str, previous: DataFrame | None = None, bad_hosts=None) -> DataFrame:
    """UP7: records with a site stage's results. The old representative stays only if the names match or one is blank; addresses are united; a record without all three leaves the final table as it was."""
    options = {} if bad_hosts is None else {"bad_hosts": bad_hosts}
    new = results.select(key, *[F.col(c).alias(f"_{c}") for c in ("company_name", "representative", "emails", "website")])
    j = old.join(new, key, "inner")
    a, b = names.key_alnum("company_name"), names.key_alnum("_company_name")
    same = (a == b) | (a == "") | (b == "")
    first = lambda *cs: F.coalesce(*[F.when(filled(c), text(c)) for c in cs], F.lit(""))
    merged = j.select(
        key, first("_company_name", "company_name").alias("company_name"),
        F.when(same, first("_representative", "representative")).otherwise(text("_representative")).alias("representative"),
        emails.split(F.array_join(F.array_union(F.col("emails"), F.col("_emails")), ";"), **options).alias("emails"),
        first("_website", "website").alias("website"),
    )
    fine = merged.filter(filled("company_name") & filled("representative") & (F.size("emails") > 0))
    return fine if previous is None else fine.unionByName(previous.join(fine.select(key), key, "left_anti"))


def by_precedence(site: str, mapped: str, registry: str, override: Column | None = None) -> Column:
    """UP8: site before map before registry; with an override the map's goes first."""
    normal = F.coalesce(*[F.when(filled(c), text(c)) for c in (site, mapped, registry)], F.lit(""))
    if override is None:
        return normal
    return F.when(override, F.coalesce(*[F.when(filled(c), text(c)) for c in (mapped, site, registry)], F.lit(""))).otherwise(normal)


def dual_key(corporate_number: str, name: str, address: str) -> Column:
    """UP9: a 13-digit corporate number, else name and address."""
    number = F.regexp_replace(text(corporate_number), "[^0-9]", "")
    return F.when(F.length(number) == 13, F.concat(F.lit("n|"), number)).otherwise(F.concat_ws("|", F.lit("a"), trim(name), trim(address)))


def dual_key_rejects(rows: DataFrame, existing: DataFrame, key: str, other: list[str]) -> DataFrame:
    """UP9: rows whose other unique columns belong to an existing row of another key."""
    taken = existing.select(F.col(key).alias("_other"), *other)
    return rows.join(taken, other, "inner").filter(F.col(key) != F.col("_other")).drop("_other")


def evolved(*tables: DataFrame, blank: str = "") -> DataFrame:
    """UP12: tables of different columns as one; what a table lacks is blank."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return out.na.fill(blank)


def migrated(df: DataFrame, version: int) -> tuple[DataFrame, int]:
    """UP13: records finished without a representative, though with a website, go back to that stage; once."""
    if version >= 1:
        return df, version
    again = (F.col("email_status") == "done") & ~filled("representative") & filled("website")
    return df.withColumn("email_status", F.when(again, "rep_pending").otherwise(F.col("email_status"))), 1


def stage_applied(records: DataFrame, results: DataFrame, key: str, fields: list[str], status: str, overwrite: tuple[str, ...] = ()) -> DataFrame:
    """UP14: records with a stage's results by the non-blank rule (or overwritten), and its status done."""
    new = results.select(key, *[F.col(f).alias(f"_{f}") for f in fields], F.lit(True).alias("_hit"))
    j = records.join(new, key, "left")
    pick = lambda f: F.when(F.col("_hit") & (F.lit(f in overwrite) | filled(f"_{f}")), text(f"_{f}")).otherwise(F.col(f))
    return j.withColumns({**{f: pick(f) for f in fields}, status: F.when(F.col("_hit"), F.lit("done")).otherwise(F.col(status))}).drop("_hit", *[f"_{f}" for f in fields])


def replaced(df: DataFrame, path: str) -> None:
    """UP11: the table at path is df alone."""
    df.write.mode("overwrite").parquet(path)
