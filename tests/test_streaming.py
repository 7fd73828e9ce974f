"""Streams over files: states, single flight, incremental delivery; a restart goes on from the checkpoint."""

import json
import time

from rosterweave.shipping import ship
from rosterweave.streaming import queues


def feed(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(json.dumps(r) for r in rows))


def drain(query):
    query.awaitTermination(90)
    if query.exception():
        raise query.exception()


def test_task_states_and_restart(spark, tmp_path):
    ship(spark)
    events = lambda *kinds: [{"task": "t", "kind": k, "seq": i} for i, k in enumerate(kinds)]

    def run():
        got = []
        s = spark.readStream.schema("task string, kind string, seq long").json(str(tmp_path / "in"))
        q = queues.task_states(s, most=2).writeStream.outputMode("update").foreachBatch(lambda df, n: got.extend(tuple(r) for r in df.collect())).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        drain(q)
        return got

    feed(tmp_path / "in", "a", events("added", "claimed", "failed"))
    assert run() == [("t", "pending", 1, 2.0)]
    feed(tmp_path / "in", "b", events("claimed", "failed"))
    assert run() == [("t", "failed", 2, 0.0)]


def test_lease_runs_out(spark, tmp_path):
    ship(spark)
    feed(tmp_path / "in", "a", [{"task": "t", "kind": "added", "seq": 0}, {"task": "t", "kind": "claimed", "seq": 1}])
    got = []
    s = spark.readStream.schema("task string, kind string, seq long").json(str(tmp_path / "in"))
    q = queues.task_states(s, lease_ms=1500).writeStream.outputMode("update").foreachBatch(lambda df, n: got.extend(tuple(r) for r in df.collect())).option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="500 milliseconds").start()
    end = time.time() + 60
    while len(got) < 2 and time.time() < end:
        time.sleep(0.3)
    q.stop()
    assert [g[1] for g in got[:2]] == ["running", "pending"]


def test_single_flight(spark, tmp_path):
    feed(tmp_path / "in", "a", [{"domain": "a.dk", "ts": "2024-01-01T00:00:00"}, {"domain": "a.dk", "ts": "2024-01-01T00:01:00"}, {"domain": "b.dk", "ts": "2024-01-01T00:01:00"}])
    s = spark.readStream.schema("domain string, ts timestamp").json(str(tmp_path / "in"))
    got = []
    drain(queues.single_flight(s).writeStream.foreachBatch(lambda df, n: got.extend(r["domain"] for r in df.collect())).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    assert sorted(got) == ["a.dk", "b.dk"]


def test_incremental_delivery(spark, tmp_path):
    def run():
        s = spark.readStream.schema("key string, seq long, v string").json(str(tmp_path / "in"))
        drain(queues.deltas(s, str(tmp_path / "keys"), str(tmp_path / "out"), str(tmp_path / "cp")))
        return sorted((r["key"], r["v"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    feed(tmp_path / "in", "a", [{"key": "a", "seq": 2, "v": "late"}, {"key": "a", "seq": 1, "v": "first"}])
    assert run() == [("a", "first")]
    feed(tmp_path / "in", "b", [{"key": "a", "seq": 3, "v": "again"}, {"key": "b", "seq": 4, "v": "new"}])
    assert run() == [("a", "first"), ("b", "new")]


FLIGHT = "domain string, request string, kind string, emails array<string>, seconds double, seq long"


def flights(spark, tmp_path, steps, until, **options):
    """Feed a file of events at each step, when the rows so far satisfy its condition; what came out until `until` holds."""
    ship(spark)
    (tmp_path / "in").mkdir()
    got, seq = [], 0
    out = queues.shared_lookups(spark.readStream.schema(FLIGHT).json(str(tmp_path / "in")), **options)
    q = out.writeStream.outputMode("update").foreachBatch(lambda df, n: got.extend(tuple(r) for r in df.collect())).option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="300 milliseconds").start()
    end = time.time() + 90
    try:
        for n, (ready, events) in enumerate(steps):
            while not ready(got) and time.time() < end:
                time.sleep(0.1)
            rows = []
            for domain, request, kind, *more in events:
                seq += 1
                rows.append({"domain": domain, "request": request, "kind": kind, "emails": more[0] if more else None, "seconds": more[1] if len(more) > 1 else None, "seq": seq})
            (tmp_path / f"{n}.json").write_text("\n".join(json.dumps(r) for r in rows))
            (tmp_path / f"{n}.json").rename(tmp_path / "in" / f"{n}.json")
        while not until(got) and time.time() < end:
            time.sleep(0.1)
    finally:
        q.stop()
    if q.exception():
        raise q.exception()
    return got


def decisions(got, domain):
    return [(r, d, list(e)) for x, r, d, e, _ in got if x == domain]


def test_a_dead_claim_goes_to_the_one_that_waits_longest(spark, tmp_path):
    """The first claim dies; of two waiters the first takes over, and both get the second answer."""
    steps = [
        (lambda g: True, [("a.dk", "r1", "ask"), (" A.dk ", "r2", "ask"), ("a.dk", "r3", "ask"), ("b.dk", "s1", "ask"), ("", "nothing", "ask")]),
        (lambda g: ("r2", "claimed") in [x[1:3] for x in g], [("a.dk", "r2", "answer", ["post@a.dk"])]),
        (lambda g: ("r3", "done") in [x[1:3] for x in g], [("a.dk", "r4", "ask")]),
    ]
    got = flights(spark, tmp_path, steps, lambda g: ("r4", "done") in [x[1:3] for x in g], stale_ms=4000)
    assert decisions(got, "a.dk") == [("r1", "claimed", []), ("r2", "wait", []), ("r3", "wait", []), ("r2", "claimed", []), ("r2", "done", ["post@a.dk"]), ("r3", "done", ["post@a.dk"]), ("r4", "done", ["post@a.dk"])]
    assert decisions(got, "b.dk")[:1] == [("s1", "claimed", [])] and decisions(got, "") == [("nothing", "wait", [])]


def test_empty_answers_age_and_failures_put_off(spark, tmp_path):
    steps = [
        (lambda g: True, [("a.dk", "r1", "ask"), ("a.dk", "r1", "answer", [], 3.0), ("a.dk", "r2", "ask"), ("b.dk", "s1", "ask"), ("b.dk", "s1", "failed", None, 3.0), ("b.dk", "s2", "ask"), ("c.dk", "t1", "ask"), ("c.dk", "t1", "answer", [], 0.0)]),
        (lambda g: ("s2", "claimed") in [x[1:3] for x in g], [("a.dk", "r3", "ask"), ("b.dk", "s2", "answer", ["x@b.dk"]), ("c.dk", "t2", "ask")]),
    ]
    got = flights(spark, tmp_path, steps, lambda g: {("r3", "claimed"), ("s2", "done"), ("t2", "done")} <= {x[1:3] for x in g})
    assert decisions(got, "a.dk") == [("r1", "claimed", []), ("r1", "done", []), ("r2", "done", []), ("r3", "claimed", [])]
    assert decisions(got, "b.dk") == [("s1", "claimed", []), ("s2", "wait", []), ("s2", "claimed", []), ("s2", "done", ["x@b.dk"])]
    assert decisions(got, "c.dk") == [("t1", "claimed", []), ("t1", "done", []), ("t2", "done", [])]
    assert 0 < next(w for x, r, d, _, w in got if r == "r2") <= 3.0
