"""Queues as streams: task events in, task states out. State lives in Spark's state store by task, so a restarted query goes on from its checkpoint.

The reference time is the stream's: processing-time timers requeue a task whose lease runs out and revive one whose empty result has aged.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from rosterweave.operators.dedup import first_wins
from rosterweave.operators.queues import backoff

OUT = "task string, status string, retries int, wait double"
_STATE = "status string, retries int"


class TaskStates(StatefulProcessor):
    """QS1, QS3, QS5: events (task, kind: added, claimed, done, empty, failed; seq) drive a task's state.

    added -> pending; claimed -> running with a lease; done ends; empty ends until `ttl_ms`; failed -> pending again after a back-off, or
    failed for good at `most`. A claim on what is not pending, and an addition of what is there, change nothing."""

    def __init__(self, most: int = 3, cap: int = 300, lease_ms: int = 300_000, ttl_ms: int = 43_200_000):
        self.most, self.cap, self.lease_ms, self.ttl_ms = most, cap, lease_ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("state", _STATE)

    def _at(self) -> tuple[str, int]:
        return tuple(self.state.get()) if self.state.exists() else ("", 0)

    def _timer(self, ms: int | None, now: int) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if ms is not None:
            self.handle.registerTimer(now + ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        (status, retries), wait, moved = self._at(), 0.0, False
        events = pd.concat(list(rows)).sort_values("seq")
        for kind in events["kind"]:
            before = status
            if kind == "added" and not status:
                status = "pending"
            elif kind == "claimed" and status == "pending":
                status = "running"
                self._timer(self.lease_ms, now)
            elif kind in ("done", "empty") and status == "running":
                status = kind
                self._timer(self.ttl_ms if kind == "empty" else None, now)
            elif kind == "failed" and status == "running":
                retries += 1
                status, wait = ("failed", 0.0) if retries >= self.most else ("pending", float(min(2**retries, self.cap)))
                self._timer(None, now)
            moved = moved or status != before
        if moved:
            self.state.update((status, retries))
            yield pd.DataFrame({"task": [key[0]], "status": [status], "retries": [retries], "wait": [wait]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        status, retries = self._at()
        if status in ("running", "empty"):
            self.state.update(("pending", retries))
            yield pd.DataFrame({"task": [key[0]], "status": ["pending"], "retries": [retries], "wait": [0.0]})

    def close(self) -> None:
        pass


def task_states(events: DataFrame, **options) -> DataFrame:
    """events: task, kind, seq. A row each time a task's state changes. Needs the RocksDB state store."""
    return events.groupBy("task").transformWithStateInPandas(TaskStates(**options), outputStructType=OUT, outputMode="Update", timeMode="ProcessingTime")


FLIGHT_OUT = "domain string, request string, decision string, emails array<string>, wait double"
_FLIGHT = "status string, claimant string, until long"


class SingleFlight(StatefulProcessor):
    """QS6: of a domain's requests one is looked up, and its answer goes to all that wait.

    Events: domain, request, kind (ask, answer, failed), emails, seconds, seq. An ask of a new domain is `claimed`; while that lookup runs, further
    asks `wait` and are kept. An answer ends it: the claimant and all who wait get `done` with the addresses. An answer without addresses holds for
    `seconds` (0: for good), after which the next ask claims anew; one with addresses holds for good. `failed` puts the domain off for `seconds`; asks
    wait meanwhile. A claim that neither answers nor fails for `stale_ms`, and a domain whose time of putting off is over, go to the one that has
    waited longest, which is then `claimed`; with none waiting, the next ask claims. A late answer of a claimant that was taken over counts too. An
    event without a domain gets `wait` and leaves no state."""

    def __init__(self, stale_ms: int = 900_000, recheck_s: float = 2.0):
        self.stale_ms, self.recheck_s = stale_ms, recheck_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("flight", _FLIGHT)
        self.waiting, self.found = handle.getListState("waiting", "request string"), handle.getValueState("found", "emails array<string>")

    def _timer(self, at: int | None) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if at is not None:
            self.handle.registerTimer(at)

    def _claim(self, request: str, now: int) -> tuple:
        self.state.update(("running", request, now + self.stale_ms))
        self._timer(now + self.stale_ms)
        return request, "claimed", [], 0.0

    def _event(self, kind: str, request: str, emails: list[str], seconds: float, now: int) -> list[tuple]:
        status, claimant, until = tuple(self.state.get()) if self.state.exists() else ("", "", 0)
        if kind == "ask":
            if status == "done" and not (until and until <= now):
                held = list(self.found.get()[0] or []) if self.found.exists() else []
                return [(request, "done", held, max(0.0, (until - now) / 1000) if until else 0.0)]
            if status == "running" or (status == "pending" and until > now):
                self.waiting.appendValue((request,))
                return [(request, "wait", [], self.recheck_s if status == "running" else (until - now) / 1000)]
            return [self._claim(request, now)]
        if kind == "answer":
            after = now + int(1000 * seconds) if not emails and seconds > 0 else 0
            told = [r for r in dict.fromkeys([claimant, request, *(w[0] for w in self.waiting.get())]) if r]
            self.state.update(("done", "", after))
            self.found.update((emails,))
            self.waiting.clear()
            self._timer(None)
            return [(r, "done", emails, float(seconds) if after else 0.0) for r in told]
        if kind == "failed" and status == "running" and request == claimant:
            self.state.update(("pending", "", now + int(1000 * seconds)))
            self._timer(now + int(1000 * seconds))
        return []

    def _rows(self, domain: str, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if rows:
            request, decision, emails, wait = zip(*rows, strict=True)
            yield pd.DataFrame({"domain": [domain] * len(rows), "request": request, "decision": decision, "emails": emails, "wait": wait})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now, events = timerValues.getCurrentProcessingTimeInMs(), pd.concat(list(rows)).sort_values("seq", kind="stable")
        if not key[0]:
            yield from self._rows(key[0], [(r, "wait", [], 60.0) for r in events["request"]])
            return
        out = []
        for e in events.itertuples(index=False):
            emails = [] if e.emails is None or not hasattr(e.emails, "__len__") else list(e.emails)
            out += self._event(e.kind, e.request, emails, 0.0 if pd.isna(e.seconds) else float(e.seconds), now)
        yield from self._rows(key[0], out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, waiting = timerValues.getCurrentProcessingTimeInMs(), [w[0] for w in self.waiting.get()]
        if not waiting:
            self.state.update(("pending", "", 0))
            return
        self.waiting.clear()
        for other in waiting[1:]:
            self.waiting.appendValue((other,))
        yield from self._rows(key[0], [self._claim(waiting[0], now)])

    def close(self) -> None:
        pass


def shared_lookups(events: DataFrame, **options) -> DataFrame:
    """QS6: events: domain, request, kind, emails, seconds, seq (see SingleFlight). A row for each decision. Needs the RocksDB state store."""
    clean = events.withColumn("domain", F.lower(F.trim(F.coalesce("domain", F.lit("")))))
    return clean.groupBy("domain").transformWithStateInPandas(SingleFlight(**options), outputStructType=FLIGHT_OUT, outputMode="Update", timeMode="ProcessingTime")


def single_flight(requests: DataFrame, domain: str = "domain", time: str = "ts", delay: str = "1 hour") -> DataFrame:
    """QS6: each domain's first request within the watermark; others of it wait for the same answer."""
    return requests.withWatermark(time, delay).dropDuplicatesWithinWatermark([domain])


def deltas(stream: DataFrame, keys_path: str, out_path: str, checkpoint: str, key: str = "key", order: tuple[str, ...] = ("seq",)) -> StreamingQuery:
    """Incremental delivery: of each micro-batch what no batch before had. Keys and rows carry the batch's number, so a batch that runs again replaces its own."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        first = first_wins(batch, F.col(key), list(order))
        try:
            seen = spark.read.parquet(keys_path).filter(F.col("batch") < number).select(key).distinct()
            first = first.join(seen, key, "left_anti")
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER" not in str(e):
                raise
        first = first.persist()
        first.select(key).write.mode("overwrite").parquet(f"{keys_path}/batch={number}")
        first.write.mode("overwrite").parquet(f"{out_path}/batch={number}")
        first.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def with_backoff(failures: DataFrame, retries: str = "retries", cap: int = 300) -> DataFrame:
    """QS7 on a stream of failures: when each may run again."""
    return failures.withColumn("next_run_at", F.col("ts") + F.make_dt_interval(secs=backoff(F.col(retries), cap).cast("decimal(18,6)")))


def progress(events: DataFrame, window: str = "30 seconds", time: str = "ts", status: str = "status") -> DataFrame:
    """AG8 as a stream: how many tasks reached each state in each window."""
    return events.withWatermark(time, window).groupBy(F.window(time, window), status).count()
