"""Top-k, claims and rankings. A global top-k is orderBy + limit, which Spark plans as TakeOrderedAndProject; per group it is row_number, whose
limit Spark pushes below the shuffle (WindowGroupLimit)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterweave.functions import lists, names, urls
from rosterweave.functions.text import filled, is_blank, text
from rosterweave.operators.dedup import grouped
from rosterweave.sources.scratch import landed, shared_folder


def _top(df: DataFrame, group: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col(rank) <= k)


def ready(now: Column, status: str = "status", next_run: str = "next_run_at") -> Column:
    return (F.col(status) == "pending") & (F.col(next_run).isNull() | (F.col(next_run) <= now))


def claim(queue: DataFrame, now: Column, k: int = 1, group: list[str] | None = None, order: tuple[str, ...] = ("updated_at", "id")) -> DataFrame:
    """TK1: the k tasks that are ready and wait longest, in each group or overall."""
    open_, by = queue.filter(ready(now)), [F.col(c) for c in order]
    return _top(open_, group, by, k) if group else open_.orderBy(*by).limit(k)


def claim_with_site_first(queue: DataFrame, k: int = 1, website: str = "website") -> DataFrame:
    """TK2: tasks with a website before others."""
    return queue.filter("status = 'pending'").orderBy(is_blank(website), "updated_at", "id").limit(k)


def claim_reranked(queue: DataFrame, k: int = 1, first: int = 200, rep: str = "representative", name: str = "company_name") -> DataFrame:
    """TK3: of the `first` tasks that wait longest, those with a representative, then those with a company's name. The first limit is part of the result."""
    oldest = queue.filter("status = 'pending'").orderBy("updated_at", "id").limit(first)
    return oldest.orderBy(is_blank(rep), names.looks_like_person(name), "updated_at", "id").limit(k)


def claim_with_flag(queue: DataFrame, k: int = 1, exists: str = "exists", rep: str = "representative") -> DataFrame:
    """TK4: tasks without a final row of their name first (J3), then those with a representative, then by time."""
    return queue.filter("status = 'pending'").orderBy(exists, is_blank(rep), "updated_at", "id").limit(k)


def best_candidate(candidates: DataFrame, key: str, query: str, name: str = "name", website: str = "website", phone: str = "phone", pos: str = "pos", least: int = 45, folds: tuple[str, str] | None = None) -> DataFrame:
    """TK5: each query's best candidate, of equals the earlier, if it scores enough. folds: columns with `names.folded` of query and name, where these were made once for each name before names met; they are dropped."""
    scored = candidates.withColumn("score", names.candidate_score(query, name, website, phone, folds)).filter(F.col("score") >= least).drop(*folds or ())
    return scored.groupBy(key).agg(F.min_by(F.struct(*[c for c in scored.columns if c != key]), F.struct(-F.col("score"), F.col(pos))).alias("r")).select(key, "r.*")


def ranked_urls(df: DataFrame, site: str, start: str, url: str, limit: int, learned: str | None = None, strong: int = 60) -> DataFrame:
    """TK6: a site's pages by score, then by URL: the start page, strong ones, weak ones; `limit` of them."""
    scored = df.select(site, start, url, *([learned] if learned else [])).distinct().withColumn("score", urls.score(start, url, learned))
    w = Window.partitionBy(site).orderBy(F.col("score").desc(), F.col(url))
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit).withColumn("is_strong", F.col("score") >= strong)


def title_score(title: str, table) -> Column:
    low = F.lower(text(title))
    return F.greatest(F.lit(0), *[F.when(low.rlike(rf"\b(?:{pattern})\b"), points).otherwise(0) for pattern, points in table])


def contacts(people: DataFrame, company: str, name: str = "name", title: str = "title", limit: int = 200) -> DataFrame:
    """TK8: people with a title of one of three families and none that is blocked, each name and title once, best first."""
    low = F.lower(text(title))
    blocked = low.rlike(rf"\b(?:{'|'.join(lists.BLOCKED_TITLES)})\b")
    scored = people.filter(filled(name) & ~blocked).withColumns({"leader": title_score(title, lists.LEADER_TITLES), "finance": title_score(title, lists.FINANCE_TITLES), "accounting": title_score(title, lists.ACCOUNTING_TITLES)})
    scored = scored.withColumn("score", F.greatest("leader", "finance", "accounting")).filter("score > 0").dropDuplicates([company, name, title])
    return _top(scored, [company], [F.col("score").desc(), F.lower(name), F.lower(title)], limit)


def selected_contacts(candidates: DataFrame, company: str, name: str = "name", title: str = "title", quota: tuple[tuple[str, int], ...] = (("leader", 4), ("finance", 1), ("accounting", 1))) -> DataFrame:
    """TK9: four leaders, then one of finance and one of accounting that were not chosen yet."""
    left, out = candidates, None
    for place, (family, n) in enumerate(quota):
        chosen = _top(left.filter(F.col(family) > 0), [company], [F.col(family).desc(), F.lower(name), F.lower(title)], n, "place").withColumns({"family": F.lit(family), "family_order": F.lit(place)})
        out = chosen if out is None else out.unionByName(chosen)
        left = left.join(chosen.select(company, name, title), [company, name, title], "left_anti")
    return out


def slot_of(host: Column, slots: int) -> Column:
    """TK10: the shard of a host."""
    return F.pmod(F.xxhash64(F.lower(host)), F.lit(slots)).cast("int")


def least_loaded(slots: DataFrame, pool: str, now: Column, in_flight: str = "in_flight", last_used: str = "last_used", idx: str = "idx", cooling: str = "cooling_until", disabled: str | None = None, limit: int | None = None) -> DataFrame:
    """TK10: of each pool's slots that are not cooling (nor disabled, nor at their limit, where these are named), the one with the fewest tasks, the longest unused (never comes first), then the first."""
    free = slots.filter(F.col(cooling).isNull() | (F.col(cooling) <= now))
    free = free if disabled is None else free.filter(~F.coalesce(F.col(disabled), F.lit(False)))
    free = free if limit is None else free.filter(F.coalesce(F.col(in_flight), F.lit(0)) < max(limit, 1))
    at = F.struct(F.col(in_flight), F.col(last_used).isNotNull(), F.col(last_used), F.col(idx))
    return free.groupBy(pool).agg(F.min_by(F.struct(*[c for c in slots.columns if c != pool]), at).alias("s")).select(pool, "s.*")


def ranked_by_range(df: DataFrame, group: list[str], order: list[Column], rank: str, folder: str) -> DataFrame:
    """df with the rank of each row in its group, from 0. Rows are sorted by range and numbered within their partition, so a group of any size is spread over tasks; each partition's and each group's start is an aggregate. folder: for the sorted rows, which must not be sorted anew in between."""
    ids = F.monotonically_increasing_id()
    rows = landed(df.orderBy(*group, *order).withColumn("_id", ids).withColumn("_part", F.shiftrightunsigned("_id", 33).cast("int")).withColumn("_at", F.col("_id").bitwiseAND(F.lit(2**33 - 1).cast("long"))), folder)
    parts = rows.groupBy("_part").agg((F.max("_at") + 1).alias("_n"))  # a row a partition
    before = parts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    placed = rows.join(F.broadcast(before), "_part").withColumn("_place", F.col("_before") + F.col("_at"))
    first = placed.groupBy(*[F.col(g).alias(f"_first_{g}") for g in group]).agg(F.min("_place").alias("_first"))
    same = [F.col(g).eqNullSafe(F.col(f"_first_{g}")) for g in group]
    return placed.join(first, same).select(*df.columns, (F.col("_place") - F.col("_first")).alias(rank))


def assigned(tasks: DataFrame, slots: DataFrame, pool: str, now: Column, limit: int, order: list[Column], in_flight: str = "in_flight", last_used: str = "last_used", idx: str = "idx", cooling: str = "cooling_until", disabled: str = "disabled") -> DataFrame:
    """TK10 for many tasks at once: each task of a pool, in order, goes to the slot that picking one by one would give it (fewest in flight, longest unused, first), until the pool has no opening left.

    A slot with f in flight offers openings at load f, f + 1 ... limit - 1. Picking one by one takes openings by load; at one load, slots that were not
    yet picked come before those picked on the way up, which is: more in flight at first, then longest unused, then first. So openings and tasks
    are both ranked, and meet by rank. Slots that are disabled, that still cool down or are at their limit offer none; a null in_flight counts as 0.
    Pools without openings or tasks have no rows. Columns: those of the task, then the slot's idx and load (in flight before this task)."""
    folder, busy = shared_folder(tasks.sparkSession), F.coalesce(F.col(in_flight), F.lit(0)).cast("int")
    free = slots.filter(~F.coalesce(F.col(disabled), F.lit(False)) & (F.col(cooling).isNull() | (F.col(cooling) <= now)) & (busy < max(limit, 1)))
    openings = free.select(pool, F.col(idx).alias("slot"), busy.alias("busy"), F.coalesce(F.col(last_used).cast("double"), F.lit(0.0)).alias("used"), F.explode(F.sequence(busy, F.lit(max(limit, 1) - 1))).alias("load"))
    offered = ranked_by_range(openings, [pool], [F.col("load"), F.desc("busy"), F.col("used"), F.col("slot")], "_rank", f"{folder}/openings").select(pool, "_rank", "slot", "load")
    wanted = ranked_by_range(tasks, [pool], order, "_rank", f"{folder}/tasks")
    return wanted.join(offered, [pool, "_rank"]).drop("_rank").select(*tasks.columns, "slot", "load")


def representatives(officers: DataFrame, key: str, name: str = "name", active: str = "is_active", pos: str = "pos") -> DataFrame:
    """TK11: names of current officers that are persons, in order, joined; all current ones where none is."""
    current = officers.filter(F.col(active)).withColumn("human", names.is_human_officer(name))
    got = grouped(current, [key], {}, {"all": (F.array(name), F.col(pos)), "humans": (F.when(F.col("human"), F.array(name)), F.col(pos))})
    return got.select(key, F.array_join(F.when(F.size("humans") > 0, F.col("humans")).otherwise(F.col("all")), "; ").alias("representative"))


def back_of_queue(queue: DataFrame, ids: DataFrame, now: Column, key: str = "id") -> DataFrame:
    """TK12: tasks to try again later: their time moves to now, so they come last."""
    hit = ids.select(key, F.lit(True).alias("_hit"))
    return queue.join(hit, key, "left").withColumn("updated_at", F.when(F.col("_hit"), now).otherwise(F.col("updated_at"))).drop("_hit")
