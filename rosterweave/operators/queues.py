"""Work queues as tables: state by events, leases, retries, stages, segments. Time is always a column or literal `now`, never the clock."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterweave.functions.text import filled, is_blank

ERROR_CHARS = 500


def latest_state(events: DataFrame, task: str, status: str, order: list[str], fields: tuple[str, ...] = ()) -> DataFrame:
    """QS1: each task's last status, and how often it failed."""
    at = F.struct(*order)
    return events.groupBy(task).agg(F.max_by(status, at).alias(status), F.count_if(F.col(status) == "failed").alias("failures"), *[F.max_by(f, at).alias(f) for f in fields])


def backoff(retries: Column, cap: int) -> Column:
    """QS7: 2 ** retries seconds, `cap` at most."""
    return F.least(F.pow(F.lit(2.0), F.least(retries, F.lit(62))), F.lit(float(cap)))


def failed_once_more(queue: DataFrame, now: Column, most: int, cap: int | None, error: Column | None = None) -> DataFrame:
    """QS1: a failure: retries grow; failed at `most`, else pending, at once (no cap) or after the back-off."""
    n = F.col("retries") + 1
    out = queue.withColumns({"retries": n, "status": F.when(n >= most, "failed").otherwise("pending"), "updated_at": now})
    if cap is not None:
        out = out.withColumn("next_run_at", F.when(F.col("status") == "failed", F.col("next_run_at")).otherwise(now + F.make_dt_interval(secs=backoff(F.col("retries"), cap).cast("decimal(18,6)"))))
    return out.withColumn("last_error", F.substring(error, 1, ERROR_CHARS)) if error is not None else out


def next_stage(name: str = "company_name", rep: str = "representative", emails: str = "emails", site: str = "website") -> Column:
    """QS2: all three there: done; a website: e-mail stage; a name alone: map stage; else none."""
    return F.when(filled(name) & filled(rep) & filled(emails), "done").when(filled(site), "email").when(filled(name), "map").otherwise("none")


def requeue_stale(queue: DataFrame, cutoff: Column, inclusive: bool = True) -> DataFrame:
    """QS3: running tasks whose lease has run out are pending again. Stores differ in whether the cutoff itself is stale."""
    late = F.col("updated_at") <= cutoff if inclusive else F.col("updated_at") < cutoff
    return queue.withColumn("status", F.when((F.col("status") == "running") & late, "pending").otherwise(F.col("status")))


def requeue_failed(queue: DataFrame) -> DataFrame:
    """QS4: failed tasks start anew."""
    bad = F.col("status") == "failed"
    return queue.withColumns({"status": F.when(bad, "pending").otherwise(F.col("status")), "retries": F.when(bad, 0).otherwise(F.col("retries"))})


def revive_empty(queue: DataFrame, now: Column) -> DataFrame:
    """QS5: tasks that ended with nothing are pending again when their time has come."""
    due = (F.col("status") == "done") & (F.size("emails") == 0) & (F.col("retry_at") <= now)
    return queue.withColumn("status", F.when(due, "pending").otherwise(F.col("status")))


def cache_decision(now: Column, stale: int = 900) -> Column:
    """QS6: what to do about a domain by its cache row (status null: there is none): claimed, done or wait, and how long."""
    blank, status, retry = is_blank("domain"), F.col("status"), F.col("next_retry_at")
    seconds = lambda t: F.greatest(t.cast("timestamp").cast("double") - now.cast("timestamp").cast("double"), F.lit(1.0))
    later = retry.isNotNull() & (retry > now)
    fresh = (status == "running") & (F.col("updated_at") > now - F.make_dt_interval(secs=F.lit(stale)))
    answer = lambda what, wait: F.struct(F.lit(what).alias("decision"), wait.cast("double").alias("wait"))
    none = F.lit(None).cast("double")
    return (
        F.when(blank, answer("wait", F.lit(60.0))).when(status.isNull(), answer("claimed", none))
        .when((status == "done") & (F.size("emails") > 0), answer("done", none))
        .when((status == "done") & retry.isNotNull() & ~later, answer("claimed", none)).when(status == "done", answer("done", F.when(later, seconds(retry))))
        .when((status == "pending") & later, answer("wait", seconds(retry))).when(fresh, answer("wait", F.lit(15.0))).otherwise(answer("claimed", none))
    )


def start_page(last_page: Column, status: Column, stored: Column, total: Column, coverage: float = 0.95) -> Column:
    """QS8: where a scope goes on: after its last page, or at the first when a finished one holds too little."""
    thin = (status == "done") & (stored < total * coverage)
    return F.when(thin, 1).otherwise(F.coalesce(last_page, F.lit(0)) + 1)


def pages(df: DataFrame, total: str, most: int = 400, limit: str | None = None) -> DataFrame:
    """QS9: a row for each page of each query."""
    n = F.least(F.col(total), F.lit(most), *([F.col(limit)] if limit else []))
    return df.withColumn("page", F.explode(F.when(n >= 1, F.sequence(F.lit(1), n.cast("int"))).otherwise(F.array().cast("array<int>"))))


def segments(facets: DataFrame, capacity: int, levels: int, key: str = "scope", parent: str = "parent", hits: str = "hits", keep_cut: bool = False) -> DataFrame:
    """QS10: scopes to collect: a scope over capacity is split into its children, level by level; one without children stays.

    facets: one row a scope with its parent ('' at the top). The loop has one join a level; nothing but the plan is on the driver."""
    at, out = facets.filter(F.col(parent) == ""), None
    parents = facets.select(F.col(parent).alias("_p")).distinct()
    for level in range(levels):
        over = F.col(hits) > capacity
        split = at.filter(over).join(parents, at[key] == parents["_p"], "left_semi") if level < levels - 1 else at.filter(F.lit(False))
        stay = at if keep_cut else at.join(split.select(key), key, "left_anti")
        done = stay.withColumns({"level": F.lit(level), "truncated": over})
        out = done if out is None else out.unionByName(done)
        if level < levels - 1:
            at = facets.join(split.select(F.col(key).alias("_p")), facets[parent] == F.col("_p"), "left_semi")
    return out


def drained(status: str = "status") -> Column:
    """QS11: an aggregate: nothing is pending or running."""
    return F.count_if(F.col(status).isin("pending", "running")) == 0


_DAY = re.compile(r"day([1-9][0-9]*)", re.IGNORECASE)


def day_number(label: str) -> int:
    """QS13: N of dayN."""
    if not (m := _DAY.fullmatch(label.strip())):
        raise ValueError(f"not a day label: {label!r}")
    return int(m[1])


def check_day(label: str, country: str, folders: list[str]) -> tuple[int, int]:
    """QS13: (day, baseline day). Only the latest day again, or the one after it; the first is day1."""
    day = day_number(label)
    days = [int(m[1]) for f in folders if (m := re.fullmatch(rf"{re.escape(country)}_day(\d+)", f, re.IGNORECASE))]
    latest = max(days, default=0)
    if day > latest + 1 or day < latest or (not days and day != 1):
        raise ValueError(f"{label} does not follow day {latest}")
    return day, day - 1


def day_folder(country: str, day: int) -> str:
    return f"{country}_day{day:03d}"


def with_fallback(listed: DataFrame, details: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """QS15: listed records with their details; where those are missing, what the list says."""
    d = details.select(key, *[F.col(f).alias(f"_{f}") for f in fields], F.lit(True).alias("_hit"))
    j = listed.join(d, key, "left")
    return j.withColumns({**{f: F.coalesce(F.when(filled(f"_{f}"), F.col(f"_{f}")), F.col(f)) for f in fields}, "from_detail": F.coalesce("_hit", F.lit(False))}).drop("_hit", *[f"_{f}" for f in fields])


def next_seed(board: DataFrame) -> DataFrame:
    """QS16: the first seed that is neither done nor worked on."""
    return board.filter(~F.col("status").isin("done", "working")).orderBy("pos").limit(1)


#: How long errors of a class wait, in seconds; these do not use up retries.
WAITS = {"usage limit": 60, "challenge": 300, "transient": 30}


def retry_rule(message: Column, retries: Column, most: int = 6) -> Column:
    """QS17: what an error message leads to: its class, how long to wait, whether a retry is left."""
    low = F.lower(message)
    kind = F.when(low.rlike("usage limit|quota|too many requests|429"), "usage limit").when(low.rlike("challenge|captcha|verify"), "challenge").when(low.rlike("timeout|timed out|connection|reset|temporar|50[234]"), "transient").otherwise("other")
    wait = F.lit(0)
    for k, s in WAITS.items():
        wait = F.when(kind == k, s).otherwise(wait)
    return F.struct(kind.alias("kind"), wait.alias("wait"), (kind != "other").alias("free"), ((kind != "other") | (retries < most)).alias("again"))


def chunked(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """QS18: rows numbered in chunks of `size`, without moving them to one task: each partition of the range-sorted rows is numbered on its own and starts after those before it."""
    from pyspark.sql import Window

    dealt = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return dealt.withColumn("chunk", F.struct(F.col("_part").alias("part"), F.floor(own / size).cast("int").alias("number"))).drop("_part")
