"""SimHash near-dedup with deletion-variant signatures.

A fingerprint has 64 bits; two link when at most MAX_BITS = 4 differ. It is cut into three segments, fewer than the five that would
leave one segment equal: among three, one differs in at most one bit. So each segment is indexed once for each of its bits, with
that bit as a wildcard: 64 variants a fingerprint. Two segments that differ in one bit or none share a variant, which is an
equality; the 64 bits are then compared.

Rows of one fingerprint are one entry of the index, however many they are. Within a group of entries that share a variant, a small
group is compared pair by pair and each link comes out in the first variant that the two share. In a group of over SMALL entries
each entry reached is compared with those not reached yet, so a group of n that hang together gives n - 1 links, not all pairs.
In a group of over WIDE entries, which a larger corpus has everywhere, a further equality is asked: the bits outside the segment are
cut into MAX_BITS + 1 blocks, one of which is equal in two entries that link, and the group falls apart by block and its bits. What
still has over TILE entries is dealt in tiles, every two of which meet in one task. No link is lost by either. The links then give
components, whose smallest doc_id names them.

Texts: A-Z in lower case, words between white space, shingles of four words with repeats; a text of fewer words is one shingle; one
without words (null, empty) has fingerprint 0, linked like any other. A bit is set when it is set in over half of the hashes
(XXH64, seed 42). A null doc_id is never the smallest unless all are null. Rows that repeat a doc_id are rows each. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterweave.llm.common import packed, salted_join, shared_dir, without_rows, written
from rosterweave.llm.components import components
from rosterweave.shipping import ship

SHINGLE, SEED, MAX_BITS = 4, 42, 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, bits
SMALL, WIDE, TILE = 64, 4_096, 50_000
_BLOCK = 32_768  # hashes whose bits are spread out at once


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined, ends = b" ".join(words), [e - 1 for e in accumulate(len(w) + 1 for w in words)]
        starts, of = [0, *(e + 1 for e in ends)], xxhash.xxh64_intdigest
        hashes = [of(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :], strict=False)]
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), _BLOCK):
        block = np.array(hashes[k : k + _BLOCK], dtype="<u8")
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = SHINGLE, hash_texts: bool = False) -> DataFrame:
    """doc_id, fp: the fingerprint as a signed long; with hash_texts also the text's SHA-256 (null as empty)."""

    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            found = np.array([fingerprint(texts[i].as_py(), shingle) for i in range(batch.num_rows)], dtype="<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found), *batch.columns[2:]], names=["doc_id", "fp", *batch.schema.names[2:]])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if hash_texts:
        return rows.withColumn("sha", text_sha(F.col("text"))).mapInArrow(run, "doc_id long, fp long, sha string")
    return rows.mapInArrow(run, "doc_id long, fp long")


def text_sha(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _first_shared(x: np.ndarray) -> np.ndarray:
    """From fingerprints' differences, the first variant that the two share; 64 if none."""
    out = np.full(len(x), 64, dtype=np.int64)
    for first, bits in reversed(SEGMENTS):
        part = (x >> np.uint64(first)) & np.uint64((1 << bits) - 1)
        n = np.bitwise_count(part)
        one = n == 1
        out[one] = first + np.bitwise_count(part[one] - np.uint64(1)).astype(np.int64)
        out[n == 0] = first
    return out


def _spanning(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what hangs together among distinct fps: each entry reached is compared with those not reached."""
    a, b, left = [], [], fps
    while len(left) > 1:
        reach, left = [left[0]], left[1:]
        while reach and len(left):
            at = reach.pop()
            near = np.bitwise_count(left ^ at) <= max_bits
            if near.any():
                new = left[near]
                a.append(np.full(len(new), at, dtype=np.uint64))
                b.append(new)
                reach.extend(new)
                left = left[~near]
    none = np.empty(0, dtype=np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _linked(keys: np.ndarray, variant: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of whole groups; rows are sorted by key."""
    edge = np.flatnonzero(np.diff(keys)) + 1
    starts, ends = np.concatenate([[0], edge]), np.concatenate([edge, [len(keys)]])
    sizes = ends - starts
    a, b = [], []
    for s, e in zip(starts[sizes > SMALL], ends[sizes > SMALL], strict=True):
        x, y = _spanning(fps[s:e], max_bits)
        a.append(x)
        b.append(y)
    size_of = np.repeat(sizes, sizes)
    most = int(sizes[sizes <= SMALL].max(initial=1))
    for d in range(1, most):
        i = np.flatnonzero((keys[:-d] == keys[d:]) & (size_of[:-d] <= SMALL))
        x = fps[i] ^ fps[i + d]
        i = i[np.bitwise_count(x) <= max_bits]
        i = i[_first_shared(fps[i] ^ fps[i + d]) == variant[i]]
        a.append(fps[i])
        b.append(fps[i + d])
    none = np.empty(0, dtype=np.uint64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _blocks(n: int) -> Column:
    """Of rows with fp and key (a variant), the n blocks of the bits outside the variant's segment: each block's place and bits in one number above 0."""
    of_segment = None
    for first, bits in SEGMENTS:
        width = 64 - bits
        turned = F.col("fp") if first + bits == 64 else F.shiftrightunsigned("fp", first + bits).bitwiseOR(F.shiftleft("fp", 64 - first - bits))
        cuts = [width * k // n for k in range(n + 1)]
        values = [F.shiftrightunsigned(turned, a).bitwiseAND(F.lit(2 ** (b - a) - 1).cast("long")) for a, b in zip(cuts, cuts[1:], strict=False)]
        blocks = F.array(*[(v + F.lit((k + 1) << 44).cast("long")) for k, v in enumerate(values)])
        inside = F.shiftrightunsigned("key", 22) >= first
        of_segment = blocks if of_segment is None else F.when(inside, blocks).otherwise(of_segment)
    return of_segment


def links(distinct: DataFrame, folder: str, max_bits: int = MAX_BITS) -> DataFrame:
    """distinct: fp, each once. a, b: pairs of fingerprints that link, enough of them to join all that hang together."""
    variants = []
    for first, bits in SEGMENTS:
        part = F.col("fp").bitwiseAND(F.lit(_signed(((1 << bits) - 1) << first)))
        variants += [(F.shiftrightunsigned(part.bitwiseAND(F.lit(_signed(~(1 << bit) & (2**64 - 1)))), first) + F.lit(bit << 22)).cast("int") for bit in range(first, first + bits)]
    index = distinct.select("fp", F.explode(F.array(*variants)).alias("key"))
    index = index.withColumn("block", F.lit(0).cast("long")).withColumn("tile", F.lit(0).cast("long"))
    wide = written(index.groupBy("key").count().filter(F.col("count") > WIDE).select("key", F.lit(True).alias("wide")), folder, "wide")
    if wide.limit(1).count():
        block = F.explode(F.when(F.col("wide"), _blocks(max_bits + 1)).otherwise(F.array(F.lit(0).cast("long"))))
        index = index.join(wide, "key", "left").select("fp", "key", block.alias("block"), "tile")
        over = index.groupBy("key", "block").count().filter(F.col("count") > TILE)
        over = written(over.select("key", "block", F.ceil(F.col("count") / TILE).cast("int").alias("tiles")), folder, "over")
        if over.limit(1).count():
            # entry of tile t meets every tile: (0, t) .. (t, t) .. (t, last)
            own = F.coalesce(F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"), F.lit(0))
            other = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("tiles"), F.lit(1)) - 1))
            index = index.drop("tile").join(over, ["key", "block"], "left").withColumn("own", own).withColumn("other", other)
            index = index.select("fp", "key", "block", (F.least("own", "other").cast("long") * 2**31 + F.greatest("own", "other")).alias("tile"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [*(np.empty(0, np.int64) for _ in range(3)), np.empty(0, np.uint64)]  # the last group may go on in the next batch
        for batch in _and_end(batches):
            if batch is not None:
                new = [c.to_numpy(zero_copy_only=False).astype(np.int64, copy=False) for c in batch.columns]
                new[3] = new[3].view(np.uint64)
                kept = [np.concatenate(x) for x in zip(kept, new, strict=True)]
            key, block, tile, fp = kept
            if not len(key):
                continue
            last = len(key) if batch is None else int(np.flatnonzero((key == key[-1]) & (block == block[-1]) & (tile == tile[-1]))[0])
            # key, block and tile in one number for the comparison of neighbours
            changes = [np.diff(x[:last]) != 0 for x in (key, block, tile)]
            change = np.concatenate([[0], np.cumsum(np.logical_or.reduce(changes))]) if last else np.empty(0, np.int64)
            kept = [x[last:] for x in kept]
            if last:
                a, b = _linked(change, key[:last] >> 22, fp[:last], max_bits)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    group = ["key", "block", "tile"]
    dealt = index.select(*group, "fp").repartition(*group).sortWithinPartitions(*group, "fp")
    return dealt.mapInArrow(run, "a long, b long")


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _classes(marks: DataFrame, folder: str, max_bits: int) -> DataFrame:
    """A row a fingerprint of marks: fp, n (its rows), least (doc_id), root of its component."""
    classes = written(marks.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), folder, "classes")
    roots = components(links(classes.select("fp"), folder, max_bits), folder)
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return written(rooted, folder, "rooted")


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", max_bits: int = MAX_BITS, shingle: int = SHINGLE) -> DataFrame:
    """One row a row of docs: doc_id, fp, component_id (the smallest doc_id of its component)."""
    folder = shared_dir(docs.sparkSession)
    marks = written(fingerprints(docs, text_col, id_col, shingle), folder, "fingerprints")
    rooted = _classes(marks, folder, max_bits)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("fps"))
    n_classes = rooted.count()
    of_class = salted_join(rooted, named, ["root"], "fps", n_classes, F.col("fp")).select("fp", "n", "component_id")
    total = marks.count()
    return salted_join(marks, of_class, ["fp"], "n", total, F.xxhash64("doc_id")).select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", max_bits: int = MAX_BITS, shingle: int = SHINGLE) -> DataFrame:
    """The rows of docs that stay, one of each component, with all their columns: that with the smallest doc_id; of rows that repeat it, one.

    Where doc_ids repeat (nulls too), a row is told by doc_id and text, since its doc_id may stand in several components."""
    folder = shared_dir(docs.sparkSession)
    rows = packed(docs, id=docs[id_col].cast("long"), text=docs[text_col].cast("string"))
    if rows.groupBy("id").count().filter("count > 1").limit(1).count() == 0:
        marks = written(near_duplicates(docs, text_col, id_col, max_bits, shingle), folder, "marks")
        drop = marks.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_id"))
        return without_rows(rows, drop, {"_id": F.col("id")}).select("_row.*")
    marks = written(fingerprints(docs, text_col, id_col, shingle, hash_texts=True), folder, "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "sha")).alias("first")
    # one row a fingerprint, then one a component: both are plain aggregates, combined before their shuffles
    chosen = marks.groupBy("fp").agg(first).join(_classes(marks, folder, max_bits).select("fp", "root"), "fp").groupBy("root").agg(F.min("first").alias("first"))
    drop = marks.select("doc_id", "sha").subtract(chosen.select("first.doc_id", "first.sha")).toDF("_id", "_sha")
    rows = rows.withColumn("sha", text_sha(F.col("text")))
    out = without_rows(rows, written(drop, folder, "drop"), {"_id": F.col("id"), "_sha": F.col("sha")})
    return out.dropDuplicates(["id", "sha"]).select("_row.*")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
