"""Dedup and merge by key. Order is part of the meaning: every input names the columns that give it (`order`, e.g. site_ord and seq).

Where one row wins, max_by over a struct keeps to partial aggregation, so a key with very many rows is combined before the shuffle;
no window over all rows of a key is needed.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterweave.functions import emails, names, urls
from rosterweave.functions.text import filled, text, trim


def _place(order: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def first_wins(df: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """AG1: the first row of each key, whole."""
    rows = df.select(key.alias("_key"), F.struct(*df.columns).alias("_row"), _place(order).alias("_at"))
    return rows.groupBy("_key").agg(F.min_by("_row", "_at").alias("_row")).select("_row.*")


def best_wins(df: DataFrame, key: Column, score: list[Column], order: list[str]) -> DataFrame:
    """AG2: the row with the highest score (compared in turn); of equals the first."""
    at = F.struct(*[(-s).alias(f"s{i}") for i, s in enumerate(score)], *[F.col(c) for c in order])
    rows = df.select(key.alias("_key"), F.struct(*df.columns).alias("_row"), at.alias("_at"))
    return rows.groupBy("_key").agg(F.min_by("_row", "_at").alias("_row")).select("_row.*")


def record_score(website: str = "website", emails_col: str = "emails", rep: str = "representative", phone: str = "phone") -> list[Column]:
    """AG2: has a site, number of addresses, has a representative, has a phone."""
    flag = lambda c: filled(c).cast("int")
    return [flag(website), F.size(emails_col), flag(rep), flag(phone)]


#: How a value is chosen over the rows of a key: min_by or max_by, the value, its order (rows with a null order do not count).
Pick = tuple[Callable[[Column, Column], Column], Column, Column]


def _tagged(values: Column, tag: int, kind: str) -> Column:
    return F.coalesce(F.transform(values, lambda v, i: F.struct(F.lit(tag).alias("tag"), v.cast("string").alias("v"), i.alias("pos"))).cast(kind), F.array().cast(kind))


def _with_position(df: DataFrame, place: str) -> Column:
    """A row's place and an element's position in it, in their order: one number where the place is a whole number, so that its minimum is kept in a hash table; else a struct. A null place comes first."""
    kind, pos = dict(df.dtypes)[place], F.col("_e.pos")
    if kind in ("tinyint", "smallint", "int"):
        return F.coalesce(F.col(place).cast("long") + 1, F.lit(-(2**31)).cast("long")) * F.lit(2**31).cast("long") + pos
    if kind == "bigint":
        wide = "decimal(38,0)"
        return ((F.coalesce(F.col(place).cast("decimal(20,0)"), F.lit(Decimal(-(2**63) - 1)).cast("decimal(20,0)")) * F.lit(Decimal(2**32)).cast("decimal(11,0)")).cast(wide) + pos.cast("decimal(11,0)")).cast(wide)
    return F.struct(F.col(place).alias("at"), pos.alias("pos"))


def grouped(df: DataFrame, keys: list[str], picks: dict[str, Pick], unions: dict[str, tuple[Column, Column]]) -> DataFrame:
    """AG3, AG15: a row a key with the picks and, for each union (an array of strings, the place of its row), the distinct elements, the first of each.

    Elements are made distinct before they are collected, and both steps combine rows before their shuffle: what one task holds of a
    key is no longer than the list that comes out, however many rows the key has. Without unions there is one step. Null arrays count
    as empty, null keys are a key, and elements of equal places follow their positions.
    """
    df = df.select("*", *[place.alias(f"_place_{name}") for name, (_, place) in unions.items()])
    unions = {name: (values, _with_position(df, f"_place_{name}")) for name, (values, _) in unions.items()}
    if not unions:
        return df.groupBy(*keys).agg(*[by(value, order).alias(name) for name, (by, value, order) in picks.items()])
    # element 0 stands for the row itself, so that the picks are taken once a row; without picks only a row without elements needs one
    kind, tags = "array<struct<tag:int,v:string,pos:int>>", {name: tag for tag, name in enumerate(unions, 1)}
    own = [F.array(F.struct(F.lit(0).alias("tag"), F.lit(None).cast("string").alias("v"), F.lit(0).alias("pos"))).cast(kind)] if picks else []
    lists = [_tagged(values, tags[name], kind) for name, (values, _) in unions.items()]
    found = [c for name, (_, value, order) in picks.items() for c in (value.alias(f"_v_{name}"), order.alias(f"_o_{name}"))]
    if len(unions) == 1 and not picks:  # one list of elements, which the engine numbers itself
        rows = df.select(*keys, *[f"_place_{name}" for name in unions], F.posexplode_outer(*[values for values, _ in unions.values()]).alias("_pos", "_value"))
        rows = rows.withColumn("_e", F.struct(F.when(F.col("_pos").isNotNull(), F.lit(1)).alias("tag"), F.col("_value").cast("string").alias("v"), F.col("_pos").alias("pos"))).drop("_pos", "_value")
    else:
        rows = df.select(*keys, *found, *[f"_place_{name}" for name in unions], F.explode_outer(F.concat(*own, *lists)).alias("_e"))

    def once(name: str, by: Callable[[Column, Column], Column]) -> list[Column]:
        order = F.when(F.col("_e.tag") == 0, F.col(f"_o_{name}"))
        return [by(F.col(f"_v_{name}"), order).alias(f"_v_{name}"), (F.min if by is F.min_by else F.max)(order).alias(f"_o_{name}")]

    first = [F.min(F.when(F.col("_e.tag") == tag, unions[name][1])).alias(f"_p_{name}") for name, tag in tags.items()]
    distinct = rows.groupBy(*keys, F.col("_e.tag").alias("_tag"), F.col("_e.v").alias("_v")).agg(*[c for name, (by, _, _) in picks.items() for c in once(name, by)], *first)
    lists = [F.sort_array(F.collect_list(F.when(F.col("_tag") == tag, F.struct(f"_p_{name}", "_v")))).getField("_v").alias(name) for name, tag in tags.items()]
    return distinct.groupBy(*keys).agg(*[by(f"_v_{name}", f"_o_{name}").alias(name) for name, (by, _, _) in picks.items()], *lists)


def best_with_union(df: DataFrame, key: Column, score: list[Column], order: list[str], emails_col: str = "emails") -> DataFrame:
    """AG3: the best row of each key, with the addresses of all its rows, lower-cased, in the order of score."""
    at = F.struct(*[(-s).alias(f"s{i}") for i, s in enumerate(score)], *[F.col(c) for c in order])
    rows = df.withColumn(emails_col, F.transform(emails_col, lambda e: F.lower(e))).select(key.alias("_key"), F.struct(*df.columns).alias("_row"), at.alias("_at"), F.col(emails_col).alias("_emails"))
    merged = grouped(rows, ["_key"], {"_row": (F.min_by, F.col("_row"), F.col("_at"))}, {"_union": (F.col("_emails"), F.col("_at"))})
    return merged.select("_row.*", "_union").withColumn(emails_col, F.col("_union")).drop("_union")


def first_non_blank(df: DataFrame, keys: list[str], order: list[str], fields: list[str], arrays: tuple[str, ...] = (), blanks: tuple[str, ...] = ("",)) -> DataFrame:
    """AG5: for each key and field the first value that is not blank; arrays are united in order."""
    at = _place(order)
    picks = {f: (F.min_by, text(f), F.when(~trim(f).isin(*blanks), at)) for f in fields}
    got = grouped(df, keys, {**picks, "_at": (F.min_by, at, at)}, {a: (F.col(a), at) for a in arrays})
    return got.select(*keys, *[F.coalesce(f, F.lit("")).alias(f) for f in fields], *arrays, "_at")


def two_level(df: DataFrame, id_col: str, name_col: str, order: list[str], fields: list[str], arrays: tuple[str, ...] = ("emails",)) -> DataFrame:
    """AG4: rows merged by registry id, the results by lower-cased name. Rows without an id go by name alone."""
    keyed = df.withColumn("_id", F.when(filled(id_col), F.concat(F.lit("id:"), trim(id_col))).otherwise(F.concat(F.lit("name:"), names.key_lower(name_col))))
    once = first_non_blank(keyed, ["_id"], order, fields, arrays)
    again = once.withColumn("_name", names.key_lower(name_col)).withColumnRenamed("_at", "_order")
    return first_non_blank(again, ["_name"], ["_order"], fields, arrays).drop("_name", "_at")


def composite(df: DataFrame, order: list[str], fields: list[str], name="company_name", rep="representative", site="website", address="address") -> DataFrame:
    """AG6: rows merged by company, representative and domain, else address, else all four."""
    return first_non_blank(df.withColumn("_key", names.key_merge(name, rep, site, address)), ["_key"], order, fields, ("emails",)).drop("_at")


def regroup(df: DataFrame, canonical: Column, fields: dict[str, str], order: list[str]) -> DataFrame:
    """AG7: rows of one canonical id as one row, each column by its own rule: longest, shallowest (URL), latest, joined (addresses)."""
    at = _place(order)
    rules = {
        "longest": lambda f: (F.min_by, F.col(f), F.struct(-F.char_length(text(f)), at)),
        "shallowest": lambda f: (F.min_by, F.col(f), F.when(filled(f), F.struct(urls.depth(f), F.char_length(f), at))),
        "latest": lambda f: (F.max_by, F.col(f), F.col(f)),
    }
    picks = {f: rules[r](f) for f, r in fields.items() if r != "joined"}
    got = grouped(df.withColumn("_canonical", canonical), ["_canonical"], picks, {f: (emails.split(f), at) for f, r in fields.items() if r == "joined"})
    shown = {"joined": lambda f: F.array_join(f, "; "), "latest": F.col}
    return got.select(F.col("_canonical").alias("id"), *[shown.get(r, lambda f: F.coalesce(f, F.lit("")))(f).alias(f) for f, r in fields.items()])


def unique_best(df: DataFrame, key: str, score: list[Column]) -> DataFrame:
    """AG12: the best row of each key, if no other has its score."""
    w = Window.partitionBy(key).orderBy(*[s.desc() for s in score])
    ranked = df.withColumn("_rank", F.rank().over(w)).filter("_rank = 1")
    return ranked.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(key))).filter("_n = 1").drop("_rank", "_n")


def register_score(query: str, name: str, is_active: str) -> list[Column]:
    """AG12: 300 equal, 250 equal without legal forms, 200 one clearly in the other; active first; then the nearest length."""
    q, n, qs, ns = names.uk_name(query), names.uk_name(name), names.without_uk_suffix(query), names.without_uk_suffix(name)
    points = F.when(q == n, 300).when((qs == ns) & (qs != ""), 250).when(names.clear_containment(qs, ns), 200).otherwise(0)
    return [points, F.col(is_active).cast("int"), -F.abs(F.length(q) - F.length(n))]


def accumulate_set(existing: Column, new: Column) -> Column:
    """AG13: two comma lists as one sorted set."""
    parts = lambda c: F.filter(F.split(text(c), ","), lambda x: trim(x) != "")
    return F.array_join(F.array_sort(F.array_union(parts(existing), parts(new))), ",")


def progress(df: DataFrame, group: list[str], status: str = "status", states: tuple[str, ...] = ("pending", "running", "done", "failed")) -> DataFrame:
    """AG8: rows of each state, in one pass."""
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(status) == s).alias(s) for s in states])


def completion(df: DataFrame, group: list[str], status: str, pages: str, updated: str) -> DataFrame:
    """AG9: how far a collection is: rows, rows done, pages, last change, complete."""
    out = df.groupBy(*group).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col(status) == "done").alias("done"), F.sum(pages).alias("pages"), F.max(updated).alias("updated_at"))
    return out.withColumn("complete", (F.col("total") > 0) & (F.col("total") == F.col("done")))


def page_emails(pages: DataFrame, site: str, website: str, found: str, order: str) -> DataFrame:
    """AG11: a site's addresses over its pages in order; a page that looks like a directory gives the site's own addresses alone."""
    p = pages.withColumn("_profile", emails.profile(website, found))
    kept = p.withColumn("_kept", F.when(F.col("_profile.directory_like"), F.col("_profile.own")).otherwise(F.col("_profile.emails")))
    return grouped(kept, [site], {}, {"emails": (F.col("_kept"), F.col(order))})
