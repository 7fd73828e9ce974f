"""Jaccard join of documents' word n-grams by T-occurrence search.

Two sets link when they share at least `of` hundredths of their union. For a query set of m tokens this asks for T common tokens, so the
search counts, over the inverted lists of the query's tokens, which documents occur T times. DivideSkip puts the L longest lists aside:
the short ones are merged by a heap that skips what cannot reach T - L, and what does is looked up in the long lists by binary search
until it reaches the overlap that its own size asks for. No pair of documents is compared any other way.

The inverted index of a corpus does not fit a task, so it is cut into shards that lose no link. Two sets that link differ in at most
(|x| + |y|) (1 - t) / (1 + t) tokens. Sizes fall into intervals whose ends have ratio t; two linked sets are in one interval or in neighbours,
and meet in the larger one's, where at most D tokens may differ. The range of token hashes is cut into D + c parts: at least c parts hold
the same tokens in both. The hash of a part's tokens names a shard; sets that share no shard can't link. A set with fewer than c parts of
under WEAK tokens leaves these out, since one of the c equal parts then has more; so few sets meet for some common tokens alone.

Equal sets are one class. Shards that one class alone has are dropped by an aggregate. The classes that hang together by the others are a
cluster, which no link leaves: a task gets a cluster's sets and searches their inverted lists. A search looks from each set reached for
those not reached, so n sets that hang together give n - 1 links. A cluster of over TASK_TOKENS tokens is searched shard by shard instead, in
two rounds. In the first, each class joins the PICKS largest of its shards, which ties copies together; then a shard whose classes all
hang together, or met in one task, needs no search, and the second searches all others whole. A shard of over TASK_TOKENS tokens is dealt in
tiles, in the second round so that every two tiles meet in a task. The links give components, named by their smallest doc_id.

Words: A-Z in lower case, what stands between white space; a text of fewer words than n is one shingle; a text that is null or has no word
has an empty set, linked with nothing, not even its like. Tokens are 64-bit hashes of shingles, classes 128-bit hashes of sets. A null doc_id
is never a component's smallest unless all are null. Rows that repeat are rows each, of one class. A text is read whole, however long.
Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterweave.llm.common import possible, salted_join, shared_dir, written
from rosterweave.llm.components import components
from rosterweave.shipping import ship

SHINGLE, OF = 3, 90
WEAK, PICKS, TASK_TOKENS = 3, 2, 1_000_000
TEXTS = 1000  # texts whose sets are made at once
#: Weight of a long list's probe against a merge step, in DivideSkip's L = T / (MU * log2(longest) + 1): probes are made many at once and cost little beside a step of the heap.
MU = 0.0005
_PROBED_AT_ONCE = 8  # long lists, after which candidates that can no longer reach their overlap go


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that leaves no pattern."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, n: int = SHINGLE) -> np.ndarray:
    """The sorted hashes of a text's distinct shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes, n = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words)), min(n, len(words))
    out = np.full(len(words) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(hashes) - n + 1 + k])
    return np.unique(out)


class Shards:
    """Names of the shards of a set. of: hundredths of the union that links share."""

    def __init__(self, of: int = OF):
        self.of, self.ends = of, [0]  # the last size of each interval

    def interval(self, size: int) -> int:
        while self.ends[-1] < size:
            self.ends.append(100 * (self.ends[-1] + 1) // self.of)
        return bisect_left(self.ends, size)

    def names(self, tokens: np.ndarray) -> np.ndarray:
        """Those of the set's own interval and of the next."""
        own, out = self.interval(len(tokens)), []
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tokens)])
        for place in (own, own + 1):
            while len(self.ends) <= place:
                self.interval(self.ends[-1] + 1)
            differ = 2 * self.ends[place] * (100 - self.of) // (100 + self.of)
            spare = 1 + differ // 8
            parts = differ + spare
            edges = np.searchsorted(tokens, np.array([(k << 64) // parts for k in range(1, parts)], dtype=np.uint64))
            edges = np.concatenate([[0], edges, [len(tokens)]])
            named = _mixed(_mixed(sums[edges[1:]] - sums[edges[:-1]]) + _mixed(np.arange(parts, dtype=np.uint64) + np.uint64(place << 32)))
            weak = np.diff(edges) < WEAK
            out.append(named[~weak] if weak.sum() < spare else named)
        return np.concatenate(out)


class Lists:
    """Inverted lists over sets; ids are places in `sets`, which stand in order of size."""

    def __init__(self, sets: list[np.ndarray], of: int = OF):
        self.sets, self.of = sets, of
        self.sizes = np.array(list(map(len, sets)), dtype=np.int64)
        token, doc = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(token, kind="stable")
        self._index(token[order], doc[order])

    def _index(self, token: np.ndarray, doc: np.ndarray) -> None:
        self.token, self.doc = token, doc
        self.place = np.cumsum(np.concatenate([[0], token[1:] != token[:-1]])) * len(self.sets) + doc if len(token) else doc

    def keep(self, alive: np.ndarray) -> None:
        """Leave the others out of the lists."""
        there = alive[self.doc]
        self._index(self.token[there], self.doc[there])

    def search(self, query: int, alive: np.ndarray) -> np.ndarray:
        """The ids alive that share enough with the query."""
        tokens = self.sets[query]
        m, enough = len(tokens), -(-self.of * len(tokens) // 100)
        start, end = np.searchsorted(self.token, tokens, side="left"), np.searchsorted(self.token, tokens, side="right")
        lengths = end - start
        some = np.flatnonzero(lengths)
        if len(some) < enough:
            return np.empty(0, dtype=np.int64)
        some = some[np.argsort(lengths[some], kind="stable")]
        long = min(enough - 1, int(enough / (MU * math.log2(int(lengths[some[-1]]) + 1) + 1)))
        short, far = some[: len(some) - long], some[len(some) - long :]
        low, high = np.searchsorted(self.sizes, [enough, 100 * m // self.of + 1])
        ids, counts = _merged([self.doc[start[i] : end[i]].tolist() for i in short], enough - long)
        ids, counts = np.array(ids, dtype=np.int64), np.array(counts, dtype=np.int64)
        fit = alive[ids] & (ids >= low) & (ids < high)
        ids, counts = ids[fit], counts[fit]
        needed = -(-self.of * (m + self.sizes[ids]) // (100 + self.of))
        step = _PROBED_AT_ONCE
        for s in range(0, len(far), step):
            if not len(ids):
                break
            base = self.place[start[far[s : s + step]]] - self.doc[start[far[s : s + step]]]
            asked = base[:, None] + ids
            at = np.minimum(np.searchsorted(self.place, asked), len(self.place) - 1)
            counts = counts + (self.place[at] == asked).sum(axis=0)
            fit = counts + max(0, len(far) - s - step) >= needed  # what can still get there
            ids, counts, needed = ids[fit], counts[fit], needed[fit]
        return ids[counts >= needed]


def _merged(lists: list[list[int]], least: int) -> tuple[list[int], list[int]]:
    """Ids that occur in at least `least` sorted lists, with their counts: a heap of the lists' heads, which skips ids that too few lists can hold."""
    heap = [(x[0], i, 0) for i, x in enumerate(lists)]
    heapq.heapify(heap)
    ids, counts = [], []
    while len(heap) >= least:
        top, popped = heap[0][0], []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap))
        if len(popped) >= least:
            ids.append(top)
            counts.append(len(popped))
            for _, i, at in popped:
                if at + 1 < len(lists[i]):
                    heapq.heappush(heap, (lists[i][at + 1], i, at + 1))
            continue
        # an id below the one that comes after least - 1 popped lists can't occur often enough
        while heap and len(popped) < least - 1:
            popped.append(heapq.heappop(heap))
        if not heap:
            break
        to = heap[0][0]
        for _, i, at in popped:
            at = bisect_left(lists[i], to, at)
            if at < len(lists[i]):
                heapq.heappush(heap, (lists[i][at], i, at))
    return ids, counts


def spanning(sets: list[np.ndarray], roots: list, of: int = OF) -> list[tuple[int, int]]:
    """Links (places in sets) that join whatever hangs together; sets of one root hang together already."""
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    mates: dict = {}
    for at, i in enumerate(order):
        mates.setdefault(roots[i], []).append(at)
    lists, alive, held, out = Lists([sets[i] for i in order], of), np.ones(len(sets), dtype=bool), len(sets), []
    for group in sorted(mates.values(), key=len):
        if not alive[group[0]]:
            continue
        reach = list(group)
        alive[reach] = False
        while reach:
            left = int(alive.sum())
            if not left:
                return out
            if 2 * left <= held:
                lists.keep(alive)
                held = left
            at = reach.pop()
            for found in lists.search(at, alive).tolist():
                if alive[found]:
                    out.append((order[at], order[found]))
                    new = mates[roots[order[found]]]
                    alive[new] = False
                    reach.extend(new)
    return out


def sets_of(docs: DataFrame, n: int = SHINGLE, of: int = OF, with_sets: bool = False) -> DataFrame:
    """docs: doc_id, text, mark. doc_id, mark, n_shingles, set_key (null if empty), shards; or, with_sets, the set (its tokens' bytes) in place of its shards."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = Shards(of)
        for batch in (whole.slice(start, TEXTS) for whole in batches for start in range(0, whole.num_rows, TEXTS)):
            found = [shingle_set(batch.column(1)[i].as_py(), n) for i in range(batch.num_rows)]
            keys = pa.array([xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None for s in found], pa.string())
            sizes = pa.array([len(s) for s in found], pa.int64())
            if with_sets:
                last = pa.array([s.tobytes() for s in found], pa.binary())
            else:
                names = [shards.names(s) if len(s) else s for s in found]
                ends = pa.array(np.cumsum([0, *map(len, names)]).astype(np.int32))
                last = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.empty(0, np.uint64), *names]).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), sizes, keys, last], names=["doc_id", "mark", "n_shingles", "set_key", "last"])

    out = docs.select("doc_id", "text", "mark").mapInArrow(run, "doc_id long, mark long, n_shingles long, set_key string, last " + ("binary" if with_sets else "array<long>"))
    return out.withColumnRenamed("last", "tokens" if with_sets else "shards")


def _searched(rows: DataFrame, of: int) -> DataFrame:
    """rows: shard, tile, set_key, root, tokens. a, b: links found within each shard and tile."""

    def links(keys: list[str], roots: list[str], tokens: list[bytes]) -> Iterator[pa.RecordBatch]:
        if len(set(roots)) > 1 and (found := spanning([np.frombuffer(t, dtype=np.uint64) for t in tokens], roots, of)):
            yield pa.RecordBatch.from_arrays([pa.array([keys[i] for i, _ in found]), pa.array([keys[j] for _, j in found])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kept = None, ([], [], [])
        for batch in filter(len, batches):
            shard, tile = (batch.column(i).to_numpy() for i in range(2))
            edges = [0, *(np.flatnonzero((np.diff(shard) != 0) | (np.diff(tile) != 0)) + 1).tolist(), batch.num_rows]
            for s, e in zip(edges, edges[1:], strict=False):
                if (shard[s], tile[s]) != now:
                    yield from links(*kept)
                    now, kept = (shard[s], tile[s]), ([], [], [])
                for column, values in zip(kept, batch.columns[2:], strict=True):
                    column.extend(values.slice(s, e - s).to_pylist())
        yield from links(*kept)

    dealt = rows.select("shard", "tile", "set_key", "root", "tokens").repartition("shard", "tile").sortWithinPartitions("shard", "tile", "set_key")
    return dealt.mapInArrow(run, "a string, b string")


def _tile(tiles: Column) -> Column:
    return F.pmod(F.xxhash64("set_key", "shard"), tiles).cast("long")


def _in_shards(members: DataFrame, sets: DataFrame, folder: str, of: int, picks: int, tile_tokens: int) -> DataFrame:
    """members: shard, set_key, n_shingles. Links of clusters too large for a task, shard by shard."""
    # shards of the same classes are one; first round: a class joins its largest shards
    same = [F.bit_xor(F.xxhash64("set_key", F.lit(k))).alias(f"same{k}") for k in range(2)]
    sizes = members.groupBy("shard").agg(*same, F.count(F.lit(1)).alias("classes"), F.ceil(F.sum("n_shingles") / tile_tokens).alias("tiles"))
    sizes = sizes.groupBy("same0", "same1", "classes", "tiles").agg(F.min("shard").alias("shard")).select("shard", "classes", "tiles")
    members = written(salted_join(members, sizes, ["shard"], "classes", max(1, members.count()), F.xxhash64("set_key"), how="inner"), folder, "different")
    rank = F.row_number().over(Window.partitionBy("set_key").orderBy(F.desc("classes"), "shard"))  # a class has as many shards as its set is long
    first = members.withColumn("rank", rank).filter(F.col("rank") <= picks).withColumn("tile", _tile(F.col("tiles"))).withColumn("root", F.col("set_key"))
    first = written(first.select("shard", "tile", "set_key", "root"), folder, "first")
    found = written(_searched(first.join(sets, "set_key"), of), folder, "links1")
    roots = components(found, folder, "first").withColumnRenamed("node", "set_key")

    # second round: every shard that still has several roots, unless all its classes met in one task of the first
    rooted = members.select("shard", "set_key", "classes", "tiles").join(roots, "set_key", "left").withColumn("root", F.coalesce("root", "set_key"))
    rooted = written(rooted, folder, "rooted")
    several = rooted.groupBy("shard", "classes").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least <> most")
    several = written(several.select("shard", "classes"), folder, "several")
    open_ = salted_join(rooted.drop("classes"), several, ["shard"], "classes", max(1, rooted.count()), F.xxhash64("set_key"), how="inner")
    met = first.select("set_key", F.col("shard").alias("met"), F.col("tile").alias("met_tile"))
    done = open_.join(met, "set_key").groupBy("shard", "classes", "met", "met_tile").agg(F.count(F.lit(1)).alias("n")).filter("n = classes").select("shard").distinct()
    done = written(done.withColumn("done", F.lit(True)), folder, "done")
    open_ = salted_join(open_, several.join(done, "shard", "left_anti"), ["shard"], "classes", max(1, rooted.count()), F.xxhash64("set_key"), how="left_semi")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    open_ = open_.withColumn("own", _tile(F.col("tiles"))).withColumn("other", other).withColumn("tile", F.least("own", "other") * 2**31 + F.greatest("own", "other"))
    return found.unionByName(written(_searched(open_.join(sets, "set_key"), of), folder, "links2"))


def similar(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", n: int = SHINGLE, of: int = OF, picks: int = PICKS, task_tokens: int = TASK_TOKENS) -> DataFrame:
    """One row a row of docs: doc_id, n_shingles, component_id."""
    folder = shared_dir(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("mark", F.xxhash64("text", "doc_id"))
    marks = written(sets_of(rows, n, of), folder, "marks")
    total = marks.count()

    # shards that several classes have, and their classes
    named = marks.select(F.explode("shards").alias("shard"), "set_key", "n_shingles").withColumn("class", F.xxhash64("set_key"))
    shared = named.groupBy("shard").agg(F.min("class").alias("least"), F.max("class").alias("most"), F.count(F.lit(1)).alias("rows")).filter("least <> most")
    shared = written(shared.select("shard", "least", "rows"), folder, "shared")
    sums = shared.agg(F.count(F.lit(1)), F.sum("rows")).first()
    members = salted_join(possible(named, shared, "shard", sums[0]), shared, ["shard"], "rows", max(total, sums[1] or 0), F.col("class"), how="inner")
    members = written(members.groupBy("shard", "set_key", "class", "least", "n_shingles").agg(F.count(F.lit(1)).alias("rows")), folder, "members")

    # the sets of these classes, each from one row
    classes = members.select("set_key", "class", "n_shingles").distinct()
    of_class = marks.filter("n_shingles > 0").groupBy("set_key").agg(F.min("mark").alias("mark")).join(classes, "set_key", "left_semi")
    of_class = written(of_class, folder, "representatives")
    texts = possible(rows, of_class.select("mark"), "mark", of_class.count()).join(of_class.select("mark").distinct(), "mark", "left_semi")
    sets = sets_of(texts, n, of, with_sets=True).filter(F.col("set_key").isNotNull()).select("set_key", "tokens").dropDuplicates(["set_key"])
    sets = written(sets, folder, "sets")

    # clusters: what hangs together by shards; no link leaves one
    clusters = components(members.select(F.col("class").alias("a"), F.col("least").alias("b")).distinct(), folder, "clusters")
    placed = classes.join(clusters.select(F.col("node").alias("class"), F.col("root").alias("cluster")), "class", "left").withColumn("cluster", F.coalesce("cluster", "class"))
    placed = written(placed, folder, "placed")
    sizes = placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("classes"), (F.sum("n_shingles") > task_tokens).alias("large"))
    sized = salted_join(placed, sizes, ["cluster"], "classes", max(1, placed.count()), F.col("class"), how="inner")
    sized = written(sized.select("set_key", "cluster", "large"), folder, "sized")
    whole = sized.filter(~F.col("large")).select(F.col("cluster").alias("shard"), F.lit(0).cast("long").alias("tile"), "set_key", F.col("set_key").alias("root"))
    found = written(_searched(whole.join(sets, "set_key"), of), folder, "links0")
    if sized.filter("large").limit(1).count():
        large = members.select("shard", "set_key", "n_shingles").join(sized.filter("large"), "set_key", "left_semi")
        found = found.unionByName(_in_shards(large, sets, folder, of, picks, task_tokens))
    roots = components(found, folder, "roots").withColumnRenamed("node", "set_key")

    # the smallest doc_id of each component
    classes = marks.filter("n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows"))
    classes = written(classes.join(roots, "set_key", "left").withColumn("root", F.coalesce("root", "set_key")), folder, "classes")
    smallest = classes.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("classes"))
    of_class = salted_join(classes, smallest, ["root"], "classes", classes.count(), F.xxhash64("set_key")).select("set_key", "rows", "component_id")
    out = salted_join(marks.select("doc_id", "n_shingles", "set_key"), of_class, ["set_key"], "rows", total, F.xxhash64("doc_id"))
    return out.select("doc_id", "n_shingles", F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar(spark.read.parquet(f"{sf_dir}/documents.parquet"))
