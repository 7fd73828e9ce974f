"""Exact dedup: an extendible-hash index on shared files.

Texts are equal when they are identical after white space is deleted. A 64-bit hash of the normalised text addresses a directory by its
leading bits. The directory doubles until no bucket holds over `bucket_rows` entries (or MAX_DEPTH is reached: copies of one text share
a hash, so no split parts them; they are a chain). Each owner has a contiguous range of buckets, hence of hashes; owners have about
equal numbers of entries. A chain longer than a bucket counts as one entry when buckets are split. The index is files in the shared folder, a folder an owner: pages of entries (sorted by bucket and hash), and
the chains of hashes that occur twice or more.

Chains are resolved by comparing bytes: the texts of a chain go to their owner's task, which groups what is identical, so a collision
of hashes never joins two texts. A chain with over a thousandth of all rows is dealt over salts first, and what the salts found is
compared again. A bitmap of bounded size keeps texts whose hash occurs once where they are; when more chains than it has bits make it
useless, each text moves once, and nothing else changes. `Index.probe` looks up other documents in the files.

Null and empty texts are equal to each other. Rows of the same text and length are told apart by doc_id, the smallest stays; a
null doc_id ranks last. A repeated row counts as a row each time and every copy of the row that stays is marked kept. A very long text
is compared whole, like any other. An empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterweave.llm.common import HOT_SALTS, HOT_SHARE, SPACE_CLASS, packed, possible, salted_join, shared_dir, without_rows, written

#: The directory has at most 2 ** MAX_DEPTH entries, which bounds what reaches the driver and what is broadcast.
MAX_DEPTH = 16
BUCKET_ROWS = 50_000
_TOP = 2**63 - 1


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE_CLASS}+", "")


def directory(counts: dict[int, int], bucket_rows: int = BUCKET_ROWS, max_depth: int = MAX_DEPTH) -> list[int]:
    """Entries by leading bits, from counts of rows by `max_depth` leading bits: the bucket's number for each slot. len() is 2 ** global depth."""
    buckets, depth = {(0, 0): sum(counts.values())}, 0  # (local depth, leading bits): rows
    while over := [b for b, n in buckets.items() if n > bucket_rows and b[0] < max_depth]:
        for local, bits in over:
            del buckets[local, bits]
            half = max_depth - local - 1
            for child in (2 * bits, 2 * bits + 1):
                buckets[local + 1, child] = 0
            for slot in range(bits << (half + 1), (bits + 1) << (half + 1)):
                buckets[local + 1, slot >> half] += counts.get(slot, 0)
            depth = max(depth, local + 1)  # a bucket as deep as the directory doubles it
    slots = [0] * 2**depth
    for number, (local, bits) in enumerate(sorted(buckets, key=lambda b: b[1] << (max_depth - b[0]))):
        for slot in range(bits << (depth - local), (bits + 1) << (depth - local)):
            slots[slot] = number
    return slots


def owners(slots: list[int], counts: dict[int, int], n: int, max_depth: int = MAX_DEPTH) -> list[int]:
    """The owner of each bucket: rising with the buckets, about equal in entries."""
    depth = len(slots).bit_length() - 1
    load = [0] * (slots[-1] + 1)
    for slot, rows in counts.items():
        load[slots[slot >> (max_depth - depth)]] += rows
    out, before, total = [], 0, max(1, sum(load))
    for rows in load:
        out.append(min(n - 1, before * n // total))
        before += rows
    return out


def _leading(bits: int) -> Column:
    return F.shiftrightunsigned("h64", 64 - bits).cast("int") if bits else F.lit(0)


def _hashed(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """doc_id, n_code_points, norm, h64."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("_text"))
    return rows.select("doc_id", F.length(F.coalesce("_text", F.lit(""))).cast("long").alias("n_code_points"), normalised(F.col("_text")).alias("norm")).withColumn("h64", F.xxhash64("norm"))


def _sha() -> Column:
    return F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256")


@dataclass
class Index:
    """Files in the shared folder. directory: slot, bucket, owner. pages: an entry a row of the documents. chains: an entry a text that occurs twice or more, with the doc_id that stays (keep; the largest long if that is null)."""

    depth: int
    total: int
    directory: DataFrame
    pages: DataFrame
    chains: DataFrame

    def routed(self, rows: DataFrame) -> DataFrame:
        """rows (with h64) with bucket and owner. The directory is broadcast: 2 ** MAX_DEPTH rows at most."""
        return rows.withColumn("slot", _leading(self.depth)).join(F.broadcast(self.directory), "slot").drop("slot")

    def marked(self) -> DataFrame:
        """A row a page entry: doc_id, keep_id, group_size, kept, text_sha256, n_code_points, bucket."""
        found = salted_join(self.pages, self.chains, ["owner", "bucket", "h64", "text_sha256"], "group_size", self.total, F.xxhash64("doc_id"))
        keep = F.when(F.col("keep") != _TOP, F.col("keep")).otherwise(F.when(F.col("group_size").isNull(), F.col("doc_id")))
        return found.select(
            "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
            F.coalesce(F.col("doc_id").eqNullSafe(keep), F.lit(True)).alias("kept"), "text_sha256", "n_code_points", "bucket",
        )

    def probe(self, docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
        """doc_id, found for each row of docs (other documents): whether the index has its text."""
        asked = self.routed(_hashed(docs, text_col, id_col).select("doc_id", "h64", _sha()))
        keys = ["owner", "bucket", "h64", "text_sha256"]
        return asked.join(self.pages.select(*keys).distinct().withColumn("found", F.lit(True)), keys, "left").select("doc_id", F.coalesce("found", F.lit(False)).alias("found"))


def build(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", bucket_rows: int = BUCKET_ROWS) -> Index:
    spark, folder = docs.sparkSession, shared_dir(docs.sparkSession)
    n_owners, hashed = int(spark.conf.get("spark.sql.shuffle.partitions")), _hashed(docs, text_col, id_col)
    entries = written(hashed.select("doc_id", "n_code_points", "h64", _sha()), folder, "entries")

    # the directory, from at most 2 ** MAX_DEPTH counts; a chain longer than a bucket counts as one entry, for no split parts it
    chains = written(entries.groupBy("h64").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), folder, "hashes")
    by_slot = lambda rows, n: {int(r["slot"]): int(r["n"]) for r in rows.groupBy(_leading(MAX_DEPTH).alias("slot")).agg(n.alias("n")).collect()}
    counts, long = by_slot(entries, F.count(F.lit(1))), by_slot(chains.filter(F.col("n") > bucket_rows), F.sum(F.col("n") - 1))
    slots, total = directory({slot: n - long.get(slot, 0) for slot, n in counts.items()}, bucket_rows, MAX_DEPTH), sum(counts.values())
    slots = slots * 2 if len(slots) == 1 else slots  # one bucket, two slots: the join with the directory has a key
    of = owners(slots, counts, n_owners, MAX_DEPTH)
    pairs = spark.range(1).select(F.posexplode(F.from_json(F.lit(json.dumps([[b, of[b]] for b in slots])), "array<array<int>>")).alias("slot", "pair"))
    table = written(pairs.select("slot", F.col("pair")[0].alias("bucket"), F.col("pair")[1].alias("owner")).coalesce(1), folder, "directory")
    index = Index(len(slots).bit_length() - 1, total, table, entries, entries)

    def filed(rows: DataFrame, name: str, task: Column) -> DataFrame:
        """A folder an owner, sorted by bucket and hash within each of its files."""
        rows.repartitionById(n_owners, task).sortWithinPartitions("owner", "bucket", "h64").write.partitionBy("owner").parquet(f"{folder}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{folder}/{name}")

    hot = chains.filter(F.col("n") > max(total // HOT_SHARE, HOT_SALTS)).select("h64", F.lit(True).alias("hot"))  # HOT_SHARE rows at most
    # an owner's pages are written by the task of its number; rows of hot hashes are dealt over all tasks, each with a file in the owner's folder
    dealt_pages = F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id", "n_code_points"), F.lit(n_owners)).cast("int")).otherwise(F.col("owner"))
    pages = index.routed(entries).join(F.broadcast(hot), "h64", "left").withColumn("task", dealt_pages)
    index.pages = filed(pages.drop("hot"), "pages", F.col("task")).drop("task")
    texts = index.routed(possible(hashed, chains.select("h64"), "h64", chains.count())).join(F.broadcast(hot), "h64", "left")
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.lit(HOT_SALTS)).cast("int")).otherwise(F.lit(0))
    # Of a group the longest stays, then the smallest doc_id: one number holds both, so that the aggregate stays a hash aggregate.
    rank = F.col("n_code_points").cast("decimal(20,0)") * F.lit(Decimal(2**64)).cast("decimal(20,0)") - F.coalesce(F.col("doc_id"), F.lit(_TOP)).cast("decimal(20,0)")
    dealt = texts.select("owner", salt.alias("salt"), "hot", "bucket", "h64", "norm", rank.cast("decimal(38,0)").alias("rank")).repartition("owner", "salt")
    # no shuffle between: an owner's task groups identical texts
    own = dealt.groupBy("owner", "salt", "hot", "bucket", "h64", "norm").agg(F.max("rank").alias("best"), F.count(F.lit(1)).alias("n"))
    own = own.select("owner", "bucket", "h64", _sha(), F.when(F.col("hot"), F.col("norm")).alias("spelled"), "best", "n")
    groups = own.groupBy("owner", "bucket", "h64", "text_sha256", "spelled").agg(F.max("best").alias("best"), F.sum("n").alias("n")).filter("n > 1")
    modulus = F.lit(Decimal(2**64)).cast("decimal(38,0)")
    back = F.pmod(-F.col("best"), modulus)
    keep = F.when(back > F.lit(_TOP), back - modulus).otherwise(back).cast("long").alias("keep")
    index.chains = filed(groups.select("owner", "bucket", "h64", "text_sha256", F.col("n").alias("group_size"), keep), "chains", F.col("owner"))
    return index


def exact_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256, n_code_points, bucket."""
    return build(docs, text_col, id_col, bucket_rows).marked()


def deduplicated(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of docs that stay, with all their columns: one of each group of equal texts. Of a group's rows that share the doc_id that stays, the longest stays; of equally long ones any."""
    marks = exact_duplicates(docs, text_col, id_col).select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"), F.col("n_code_points").alias("_n"), "kept")
    marks = written(marks, shared_dir(docs.sparkSession), "marks")
    text = F.coalesce(F.col("text"), F.lit(""))
    made = {"_id": F.col("id"), "_sha": F.sha2(normalised(text).cast("binary"), 256)}
    rows = packed(docs, id=docs[id_col].cast("long"), text=docs[text_col].cast("string"))
    groups = marks.filter("kept").groupBy("_id", "_sha").agg(F.max("_n").alias("_most"), F.count(F.lit(1)).alias("n"), F.min("_n").alias("_least")).filter("n > 1")
    groups = written(groups, shared_dir(docs.sparkSession), "groups")
    out = without_rows(rows, marks.filter("not kept").select("_id", "_sha").distinct(), made)
    if groups.limit(1).count():
        same = marks["_id"].eqNullSafe(groups["_id"]) & (marks["_sha"] == groups["_sha"])
        short = marks.join(groups.filter("_least < _most"), same).filter(F.col("_n") < F.col("_most")).select(marks["_id"], marks["_sha"], "_n").distinct()
        out = without_rows(out, written(short, shared_dir(docs.sparkSession), "short"), {**made, "_n": F.length(text).cast("long")})
        out = out.withColumn("_sha", made["_sha"]).dropDuplicates(["id", "_sha"])
    return out.select("_row.*")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("bucket")


ORACLE = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_code_points, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g') AS norm
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256, n_code_points
FROM d WINDOW w AS (PARTITION BY norm ORDER BY n_code_points DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""
