"""Line dedup: levelled sorted runs of line hashes.

The lines of documents come in batches, by falling doc_id. A batch's distinct lines are merged against the runs there are: a line
that no run holds (the anti-join) enters with its holder, the largest doc_id in the batch, and a line that a run holds adds to its count
alone. So exactly one run names the holder of a line. The batch's own lines then form a sorted run of level 0. When a level has
`fanout` runs, they are compacted to one run of the next. Runs are tables in the shared folder, bucketed and sorted by hash, so that
merging with a run moves no row of it. A batch has about BATCH_LINES lines, and there are MIN_BATCHES at least.

Runs can be kept: with `runs` given, the lines of earlier calls are held by the earlier documents, whatever their doc_id, and the new
documents lose them once they are frequent enough. `SortedRuns.open` finds kept runs in their folder.

A line's key is the line without white space at both ends and with A-Z in lower case. Lines are compared by the MD5 of the key,
128 bits. Keys of `min_chars` code points or more found in `min_docs` documents or more lose all their lines but those of the
largest doc_id. Where doc_ids repeat, a hash of the text ranks the rows after doc_id; a null doc_id ranks below all others. Rows that
repeat both doc_id and text are the same document: they count once and get the same result. Null and empty texts are one empty line;
very long texts and lines are read whole; other columns of the input are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import math
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterweave.llm.common import SPACE_CHARS, ascii_lower, joined_where_found, salted_join, shared_dir, written

MIN_CHARS, MIN_DOCS, FANOUT = 20, 3, 2
MIN_BATCHES, BATCH_LINES = 4, 2**32
_LEAST = -(2**63)
_ROW = "key binary, n long, holder struct<doc_id: long, text_hash: long>"


class SortedRuns:
    """Levelled runs of (key, n, holder): how many documents hold a line, and the one that keeps it (null where another run names it)."""

    def __init__(self, spark: SparkSession, folder: str, fanout: int = FANOUT):
        self.spark, self.folder, self.fanout, self.levels = spark, folder, fanout, [[]]
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> SortedRuns:
        """Runs that `save` left in the folder, maybe in another session."""
        runs = cls(spark, folder)
        for r in spark.read.json(f"{folder}/manifest").collect():  # a row a run
            runs.buckets, runs.fanout = r["buckets"], r["fanout"]
            while len(runs.levels) <= r["level"]:
                runs.levels.append([])
            if r["name"]:
                spark.sql(f"CREATE TABLE IF NOT EXISTS {r['name']} ({_ROW}) USING parquet CLUSTERED BY (key) SORTED BY (key) INTO {r['buckets']} BUCKETS LOCATION '{folder}/{r['name']}'")
                runs.levels[r["level"]].append(r["name"])
        return runs

    def save(self) -> None:
        """Name the runs in the folder's manifest."""
        rows = [{"level": k, "name": name, "buckets": self.buckets, "fanout": self.fanout} for k, level in enumerate(self.levels) for name in level or [""]]
        entries = F.from_json(F.lit(json.dumps(rows)), "array<struct<level: int, name: string, buckets: int, fanout: int>>")
        self.spark.range(1).select(F.inline(entries)).coalesce(1).write.mode("overwrite").json(f"{self.folder}/manifest")

    def close(self) -> None:
        """Forget the tables; their files stay."""
        for name in (n for level in self.levels for n in level):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _write(self, rows: DataFrame, level: int) -> None:
        name = f"rosterweave_run_{uuid.uuid4().hex}"
        rows.write.bucketBy(self.buckets, "key").sortBy("key").option("path", f"{self.folder}/{name}").saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def tables(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    @staticmethod
    def merged(runs: list[DataFrame]) -> DataFrame:
        """One row a key, by merging sorted runs two by two. Of a key's rows one alone has a holder."""

        def merge(a: DataFrame, b: DataFrame) -> DataFrame:
            b = b.withColumnsRenamed({"n": "_n", "holder": "_holder"})
            return a.join(b, "key", "full").select("key", (F.coalesce("n", F.lit(0)) + F.coalesce("_n", F.lit(0))).cast("long").alias("n"), F.least("holder", "_holder").alias("holder"))

        return reduce(merge, runs)

    def add(self, batch: DataFrame) -> None:
        """batch: one row a line, (key, n, holder), of documents that no earlier batch had and that rank below all of these."""
        for number, run in enumerate(self.tables()):
            held = run.filter(F.col("holder").isNotNull()).select("key", F.lit(True).alias(f"held{number}"))
            batch = batch.join(held, "key", "left").withColumn("holder", F.when(F.col(f"held{number}").isNull(), F.col("holder"))).select("key", "n", "holder")
        self._write(batch, 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._write(self.merged([self.spark.table(name) for name in full]), level + 1)
            for name in full:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            level += 1


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def repeated_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int | None = None, runs: SortedRuns | None = None) -> DataFrame:
    """doc_id, text_hash, drops: for each document that loses lines, their positions from 0 in order."""
    spark, folder, kept = docs.sparkSession, shared_dir(docs.sparkSession), runs is not None
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LEAST)).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    exploded = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split(ascii_lower(F.col("text")), "\n", -1)).alias("pos", "line"))
    key = F.trim("line", F.lit(SPACE_CHARS))
    lines = exploded.select("doc_id", "text_hash", "pos", key.alias("k")).filter(F.char_length("k") >= min_chars)
    lines = written(lines.select("doc_id", "text_hash", "pos", F.unhex(F.md5(F.col("k").cast("binary"))).alias("key")), folder, "lines")
    total = lines.count()
    batches = batches or max(MIN_BATCHES, math.ceil(total / BATCH_LINES))
    cuts = lines.agg(F.percentile_approx("doc_id", [(i + 1) / batches for i in range(batches - 1)], 1000).alias("cuts")).first()["cuts"] if batches > 1 else []
    cuts = sorted(set(cuts or []), reverse=True)

    runs = runs or SortedRuns(spark, folder)
    for b in range(len(cuts) + 1):  # falling doc_id
        own = lines if b == len(cuts) else lines.filter(F.col("doc_id") > cuts[b])
        own = own.filter(F.col("doc_id") <= cuts[b - 1]) if b else own
        once = own.groupBy("key", "doc_id", "text_hash").agg(F.lit(1).cast("long").alias("n"))
        runs.add(once.groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("doc_id", "text_hash")).alias("holder")))
    drop = written(runs.merged(runs.tables()).filter(F.col("n") >= min_docs), folder, "drop")
    runs.save() if kept else runs.close()
    found = salted_join(lines, drop, ["key"], "n", total, F.xxhash64("doc_id"))
    lost = (F.col("holder.doc_id") != F.col("doc_id")) | (F.col("holder.text_hash") != F.col("text_hash"))
    return found.filter(lost).groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("drops"))


def without_repeated_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text for each row."""
    drops = written(repeated_lines(docs, text_col, id_col, **options).withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"}), shared_dir(docs.sparkSession), "drops")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = joined_where_found(rows.withColumns({"_id": F.coalesce("doc_id", F.lit(_LEAST)), "_hash": F.xxhash64("text")}), drops, ["_id", "_hash"])
    text, lines, none = F.col("text"), lines_of(F.col("text")), F.array().cast("array<int>")
    gone = F.coalesce("drops", none)
    starts = F.concat(F.array(F.lit(0)), F.transform(gone, lambda p: p + 1))
    ends = F.concat(gone, F.array(F.size(lines)))
    runs = F.transform(F.arrays_zip(starts.alias("s"), ends.alias("e")), lambda z: F.slice(lines, z["s"] + 1, z["e"] - z["s"]))
    return found.withColumns({
        "n_lines": F.size(lines).cast("long"), "n_dropped": F.size(gone).cast("long"),
        "kept_text": F.when(F.col("drops").isNull(), text).otherwise(F.array_join(F.flatten(runs), "\n")),
    }).select("doc_id", "n_lines", "n_dropped", "kept_text")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return without_repeated_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


_KEY = "translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT doc_id, pos, line, {_KEY} AS key FROM l),
g AS (SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE g.holder <> k.doc_id) AS n_dropped,
  sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.pos) FILTER (WHERE g.holder IS NULL OR g.holder = k.doc_id), '')) AS kept_sha256
FROM k LEFT JOIN g ON k.key = g.key GROUP BY k.doc_id
"""
