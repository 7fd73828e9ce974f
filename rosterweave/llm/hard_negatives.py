"""Hard negatives by a Voronoi-partitioned nearest-neighbour join.

An inner product becomes a distance: each candidate gets one more coordinate, sqrt(M^2 - |x|^2) with M the largest norm, and each anchor
a zero; then |a - x|^2 = |a|^2 + M^2 - 2 a.x, so that the highest products are the nearest rows. Pivots cut the space into Voronoi cells,
and every row is in the cell of its nearest pivot. Anchors are put into groups of near cells. A bounded sample of rows gives each anchor
a score that its k-th best can't be below, and so a distance beyond which it needs nothing; by the triangle inequality and by the plane
between two pivots, this gives for each group and cell the distances from the pivot at which a row may serve one of the group's anchors.
A row is copied to those groups alone. A group's rows are dealt in chunks, each with all anchors of the group; a task joins a chunk
exactly, batch by batch, and the chunks' best are ranked once more. No result depends on pivots or sample: they only spare work.

Two such joins: of each anchor with its own label (positives), and with other labels, where each positive asks for the best
scores within its band (30 to 90 per cent of its own score by default).

A row without label or vector, or with a component that is null or not finite, takes no part. Components count as floor(256 x), held
within +-2^24; a vector is read as zeros beyond its end, and may have 2^14 components. A null vec_id is no anchor and comes last among
equals. Rows that repeat are rows each: two of one vec_id are anchors each, and each other's candidates. Anchors without positives and
positives without negatives have no rows. Columns beyond those named are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterweave.llm.common import shared_dir, written
from rosterweave.shipping import ship

SCALE, LIMIT = 256, 2**24
POSITIVES, NEGATIVES, BAND = 5, 10, (30, 90)
#: Rows of the sample, and pivots, which are some of them.
SAMPLE, PIVOTS = 2_048, 128
#: Labels are told apart in routing by so many remainders.
BUCKETS = 16
#: Anchors a group at most; a chunk of candidates has CHUNK times a group's anchors.
GROUP_MOST, CHUNK = 65_536, 16
#: Group-and-cell bounds that are broadcast at once; more groups are joined in further blocks.
ROUTES_SENT = 500_000
_CELLS = 4_000_000  # of a matrix of scores
_LOW, _HIGH = -(2**62), 2**62


def quantised(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, label, q of the rows that take part."""
    v = F.col("_v")
    fine = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("_v"))
    rows = rows.filter(v.isNotNull() & F.col("label").isNotNull()).filter(fine)
    whole = F.transform("_v", lambda x: F.floor(F.greatest(F.least(x * F.lit(float(SCALE)), F.lit(float(LIMIT))), F.lit(-float(LIMIT)))).cast("int"))
    return rows.select("vec_id", "label", whole.alias("q"))


class Space:
    """Pivots and sample in the space of distances. Bounded: SAMPLE rows."""

    def __init__(self, sample: list, norm2: int, dims: int, pivots: int):
        self.dims, self.norm2 = dims, float(norm2)
        self.labels, self.rows = np.array([r["label"] for r in sample], dtype=np.int64), np.array([r["row"] for r in sample], dtype=np.int64)
        self.sample = self.matrix([r["q"] for r in sample])
        apart = np.full(len(sample), np.inf)
        chosen: list[int] = []
        while len(chosen) < min(pivots, len(sample)):  # each pivot is the sampled row farthest from those before it
            at = int(np.argmax(apart)) if chosen else 0
            if apart[at] == 0:
                break
            chosen.append(at)
            apart = np.minimum(apart, self._between(self.sample, self.sample[at : at + 1])[:, 0])
            apart[at] = 0
        self.pivots = self.sample[chosen]
        self.slack = 1e-6 * (1 + math.sqrt(self.norm2))
        self.between = self._between(self.pivots, self.pivots) if chosen else np.zeros((0, 0))

    def matrix(self, vectors: list) -> np.ndarray:
        out = np.zeros((len(vectors), self.dims))
        for i, v in enumerate(vectors):
            out[i, : len(v)] = v
        return out

    def _more(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, self.norm2 - (x * x).sum(axis=1)))

    def _between(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Distances of candidates from candidates."""
        return np.sqrt(np.maximum(0.0, 2 * self.norm2 - 2 * (x @ y.T + np.outer(self._more(x), self._more(y)))))

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest pivot of each candidate, and how far it is."""
        d = self._between(x, self.pivots)
        cell = d.argmin(axis=1)
        return cell, d[np.arange(len(x)), cell]

    def needed(self, x: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For anchors that need scores from low to high, the distances from each pivot (least, most) at which a row of its cell may have such a score; least > most where none may."""
        base = (x * x).sum(axis=1) + self.norm2
        far, near = (np.sqrt(np.maximum(0.0, base - 2 * s)) for s in (low, high))
        d = np.sqrt(np.maximum(0.0, base[:, None] - 2 * x @ self.pivots.T))
        own = d.argmin(axis=1)
        least, most = np.maximum(d - far[:, None], near[:, None] - d) - self.slack, d + far[:, None] + self.slack
        gap = self.between[own]
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = np.where(gap > 0, (d * d - (d[np.arange(len(x)), own] ** 2)[:, None]) / (2 * gap), 0.0)
        most[(plane > far[:, None] + self.slack) | (low > high)[:, None]] = -1.0
        return least, most


def _grouped(counts: dict[int, int], between: np.ndarray, size: int) -> dict[int, tuple[int, int]]:
    """Of each cell with anchors, its first group and number of groups: cells one after the other, each the nearest of those left, fill groups of about `size` anchors; a larger cell has several of its own."""
    out, left, group, filled = {}, set(counts), 0, 0
    at = min(left, default=0)
    while left:
        at = min(left, key=lambda c: (between[at][c], c))
        left.remove(at)
        parts = -(-counts[at] // size)
        if filled and filled + counts[at] > size:
            group, filled = group + 1, 0
        out[at] = (group, parts)
        group, filled = (group + parts, 0) if parts > 1 else (group, filled + counts[at])
    return out


class Best:
    """The k best candidates of each slot (an anchor and a range of scores), fed by batches. Memory: k rows a slot and _CELLS scores."""

    def __init__(self, space: Space, rows: np.ndarray, labels: np.ndarray, x: np.ndarray, slots: list[list[dict]], k: int, same: bool):
        self.rows, self.labels, self.k, self.same = rows, labels, k, same
        self.exact = space.norm2 < 2**53  # sums of products are whole numbers that a double holds
        self.x = x if self.exact else x.astype(np.int64)
        self.of = np.repeat(np.arange(len(rows)), list(map(len, slots)))
        self.slot, self.low, self.high = (np.array([s[f] for ss in slots for s in ss], dtype=np.int64) for f in ("slot", "low", "high"))
        self.first = np.concatenate([[0], np.cumsum(list(map(len, slots)))]).astype(np.int64)
        self.kept = [np.empty(0, np.int64) for _ in range(5)]  # slot's place, score, whether the id is null, id, row

    def feed(self, rows: np.ndarray, labels: np.ndarray, null: np.ndarray, ids: np.ndarray, y: np.ndarray) -> None:
        step = max(1, _CELLS // max(1, len(self.rows)))
        for s in range(0, len(rows), step):
            self._feed(*(v[s : s + step] for v in (rows, labels, null, ids, y)))

    def _feed(self, rows, labels, null, ids, y) -> None:
        if not len(self.of):
            return
        scores = self.x @ (y if self.exact else y.astype(np.int64)).T
        full = np.flatnonzero(np.diff(self.first))
        low, high = np.full(len(self.rows), _HIGH), np.full(len(self.rows), _LOW)
        low[full], high[full] = np.minimum.reduceat(self.low, self.first[full]), np.maximum.reduceat(self.high, self.first[full])
        fit = (scores >= low[:, None]) & (scores <= high[:, None])
        fit &= (self.labels[:, None] == labels) if self.same else (self.labels[:, None] != labels)
        a, c = np.nonzero(fit)
        apart = self.rows[a] != rows[c]
        a, c = a[apart], c[apart]
        s, n = scores[a, c].astype(np.int64), np.diff(self.first)[a]
        place = np.repeat(self.first[a], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        s, c = np.repeat(s, n), np.repeat(c, n)
        ok = (s >= self.low[place]) & (s <= self.high[place])
        place, s, c = place[ok], s[ok], c[ok]
        if not len(place):
            return
        kept = [np.concatenate(x) for x in zip(self.kept, (place, s, null[c].astype(np.int64), ids[c], rows[c]), strict=True)]
        order = np.lexsort((kept[4], kept[3], kept[2], -kept[1], kept[0]))
        kept = [x[order] for x in kept]
        edge = np.concatenate([[0], np.flatnonzero(np.diff(kept[0])) + 1])
        rank = np.arange(len(order)) - np.repeat(edge, np.diff(np.concatenate([edge, [len(order)]])))
        last = rank == self.k - 1
        self.low[kept[0][last]] = kept[1][last]  # what is below the k-th best can't be among them
        self.kept = [x[rank < self.k] for x in kept]

    def out(self) -> pa.RecordBatch:
        place, score, null, ids, rows = self.kept
        columns = [pa.array(self.rows[self.of[place]]), pa.array(self.slot[place].astype(np.int32)), pa.array(ids, mask=null.astype(bool)), pa.array(rows), pa.array(score)]
        return pa.RecordBatch.from_arrays(columns, names=["anchor", "slot", "vec_id", "row", "score"])


class Join:
    """Vectors in cells (a written table), and exact joins of anchors with them."""

    def __init__(self, rows: DataFrame, id_col: str, vector_col: str, label_col: str, anchors: Column, sample: int, pivots: int):
        spark = rows.sparkSession
        ship(spark)
        self.folder = shared_dir(spark)
        self.vectors = written(quantised(rows, id_col, vector_col, label_col).withColumn("row", F.monotonically_increasing_id()), self.folder, "vectors")
        norm2 = F.aggregate("q", F.lit(0).cast("long"), lambda s, x: s + x.cast("long") * x)
        known = self.vectors.agg(F.max(norm2).alias("norm2"), F.max(F.size("q")).alias("dims"), F.count(F.lit(1)).alias("n"), F.count(F.when(anchors, 1)).alias("anchors")).first()
        chosen = self.vectors.orderBy(F.xxhash64("vec_id", "q"), "row").limit(sample).collect()
        self.space = spark.sparkContext.broadcast(Space(chosen, known["norm2"] or 0, known["dims"] or 0, pivots))
        self.size = int(min(GROUP_MOST, max(64, 8 * math.isqrt(known["anchors"]))))
        self.chunks = max(1, -(-known["n"] // (CHUNK * self.size)))
        space = self.space

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in filter(len, batches):
                cell, far = space.value.cells(space.value.matrix(batch.column(3).to_pylist()))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(far)], names=["row", "vec_id", "label", "q", "cell", "far"])

        celled = self.vectors.select("row", "vec_id", "label", "q").mapInArrow(placed, "row long, vec_id long, label long, q array<int>, cell int, far double")
        self.celled = written(celled, self.folder, "cells")
        self.anchors = self.celled.filter(anchors)

    def best(self, asked: DataFrame, k: int, same: bool, name: str) -> DataFrame:
        """asked: row, vec_id, label, q, cell of anchors, and their slots (array of slot, low, high). anchor, slot, vec_id, row, score and rank of each slot's k best: of the anchor's own label, or of the others."""
        space, bucket = self.space, F.pmod("label", F.lit(BUCKETS)).cast("int") if same else F.lit(0)
        # groups of anchors: at most PIVOTS (times BUCKETS) counts reach the driver
        asked = written(asked.withColumn("bucket", bucket), self.folder, f"{name}_asked")
        counts: dict[int, dict[int, int]] = {}
        for r in asked.groupBy("bucket", "cell").count().collect():
            counts.setdefault(r["bucket"], {})[r["cell"]] = r["count"]
        table, groups = [], 0
        for b in sorted(counts):
            of = _grouped(counts[b], space.value.between, self.size)
            table += [(b, c, groups + first, parts) for c, (first, parts) in of.items()]
            groups += max(first + parts for first, parts in of.values())
        cells = asked.sparkSession.createDataFrame(table, "bucket int, cell int, first int, parts int")
        asked = asked.join(F.broadcast(cells), ["bucket", "cell"]).withColumn("group", (F.col("first") + F.pmod(F.xxhash64("row"), F.col("parts"))).cast("int"))
        asked = asked.select("group", "bucket", "row", "vec_id", "label", "q", "slots")

        def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in filter(len, batches):
                at = space.value
                group, buckets, rows, labels = (batch.column(i).to_numpy() for i in range(4))
                x, slots = at.matrix(batch.column(4).to_pylist()), batch.column(5).to_pylist()
                low, high = _needed_scores(at, rows, labels, x, slots, k, same)
                least, most = at.needed(x, low.astype(float), high.astype(float))
                keys, inverse = np.unique(np.stack([group, buckets]), axis=1, return_inverse=True)
                lo, hi = np.full((keys.shape[1], least.shape[1]), np.inf), np.full((keys.shape[1], least.shape[1]), -1.0)
                some = most >= np.maximum(least, 0.0)
                inverse = inverse.ravel()
                np.minimum.at(lo, inverse, np.where(some, least, np.inf))
                np.maximum.at(hi, inverse, np.where(some, most, -1.0))
                g, c = np.nonzero(hi >= 0)
                yield pa.RecordBatch.from_arrays([pa.array(keys[0][g].astype(np.int32)), pa.array(keys[1][g].astype(np.int32)), pa.array(c.astype(np.int32)), pa.array(lo[g, c]), pa.array(hi[g, c])], names=["group", "bucket", "cell", "lo", "hi"])

        routes = asked.select("group", "bucket", "row", "label", "q", "slots").mapInArrow(bounds, "group int, bucket int, cell int, lo double, hi double")
        routes = written(routes.groupBy("group", "bucket", "cell").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")), self.folder, f"{name}_routes")
        a_block = max(1, ROUTES_SENT // max(1, len(space.value.pivots)))
        blocks = [routes.filter((F.col("group") >= g) & (F.col("group") < g + a_block)) for g in range(0, max(1, groups), a_block)]
        there = self.celled.withColumn("bucket", bucket)
        served = reduce(DataFrame.unionByName, [there.join(F.broadcast(b), ["bucket", "cell"]).filter("far >= lo and far <= hi") for b in blocks])

        # a group's anchors go to each of its chunks, and come first there
        nothing = F.array().cast("array<struct<slot:int,low:bigint,high:bigint>>")
        served = served.select("group", F.pmod(F.xxhash64("row"), F.lit(self.chunks)).cast("int").alias("chunk"), F.lit(1).alias("part"), "row", "vec_id", "label", "q", nothing.alias("slots"))
        first = asked.select("group", F.explode(F.sequence(F.lit(0), F.lit(self.chunks - 1))).alias("chunk"), F.lit(0).alias("part"), "row", "vec_id", "label", "q", "slots")
        dealt = first.unionByName(served).repartition("group", "chunk").sortWithinPartitions("group", "chunk", "part")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, now, waiting, best = space.value, None, [], None
            for batch in batches:
                group, chunk, part = (batch.column(i).to_numpy().astype(np.int64) for i in range(3))
                key = (group << 32 | chunk) * 2 + part
                edges = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
                for s, e in zip(edges, edges[1:], strict=False):
                    if s == e:
                        continue
                    if key[s] >> 1 != now:
                        if best is not None:
                            yield best.out()
                        now, waiting, best = key[s] >> 1, [], None
                    piece = batch.slice(s, e - s)
                    if part[s] == 0:
                        waiting.append(piece)
                        continue
                    if best is None and waiting:
                        rows, labels = (np.concatenate([p.column(i).to_numpy() for p in waiting]) for i in (3, 5))
                        x, slots = at.matrix([v for p in waiting for v in p.column(6).to_pylist()]), [v for p in waiting for v in p.column(7).to_pylist()]
                        best, waiting = Best(at, rows, labels, x, slots, k, same), []
                    if best is not None:
                        ids = piece.column(4)
                        best.feed(piece.column(3).to_numpy(), piece.column(5).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(), at.matrix(piece.column(6).to_pylist()))
            if best is not None:
                yield best.out()

        found = dealt.mapInArrow(run, "anchor long, slot int, vec_id long, row long, score long")
        rank = F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row"))  # k rows a chunk at most
        return written(found.withColumn("rank", rank).filter(F.col("rank") <= k), self.folder, name)


def _needed_scores(space: Space, rows: np.ndarray, labels: np.ndarray, x: np.ndarray, slots: list[list[dict]], k: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """From which score to which an anchor needs rows: its slots' ranges, cut below by the k-th best of the sample in them."""
    low, high = np.full(len(rows), _HIGH), np.full(len(rows), _LOW)
    best = Best(space, rows, labels, x, slots, k, same)
    best.feed(space.rows, space.labels, np.zeros(len(space.rows), bool), space.rows, space.sample)  # of equal scores any will do
    np.minimum.at(low, best.of, best.low)
    np.maximum.at(high, best.of, best.high)
    return low, high


def hard_negatives(
    rows: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES,
    band: tuple[int, int] = BAND, sample: int = SAMPLE, pivots: int = PIVOTS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. anchors: a condition on vec_id and label. band: per cent of the positive's score, least and most, both included."""
    join = Join(rows, id_col, vector_col, label_col, anchors, sample, pivots)
    slot = lambda n, low, high: F.struct(n.cast("int").alias("slot"), low.cast("long").alias("low"), high.cast("long").alias("high"))
    asked = join.anchors.select("row", "vec_id", "label", "q", "cell")
    own = join.best(asked.withColumn("slots", F.array(slot(F.lit(0), F.lit(_LOW), F.lit(_HIGH)))), positives, True, "positives")
    least, most = (F.expr(f"(score * {p} - pmod(score * {p}, 100)) div 100") for p in (-band[0], band[1]))  # floors
    banded = own.withColumn("low", -least).withColumn("high", most).filter("low <= high")
    slots = banded.groupBy("anchor").agg(F.collect_list(slot(F.col("rank"), F.col("low"), F.col("high"))).alias("slots")).withColumnRenamed("anchor", "row")
    others = join.best(asked.join(slots, "row"), negatives, False, "negatives")
    pairs = own.select("anchor", F.col("rank").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    pairs = pairs.join(asked.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
    found = others.select("anchor", "slot", F.col("rank").cast("int"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")).join(pairs, ["anchor", "slot"])
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(moved, F.col("vec_id") % 100 == 0)


ORACLE = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same, list_inner_product(a.q, r.q)::BIGINT AS score
  FROM r AS a JOIN r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
