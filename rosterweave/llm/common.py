"""What several corpus operators share: scratch tables, skew-proof joins, text patterns."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The white space that every contract names: [\x20\x09-\x0D].
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A key holding over one row in HOT_SHARE is hot. There are at most HOT_SHARE such keys, so their list may be broadcast.
HOT_SHARE = 1000
HOT_SALTS = 64

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """A new folder that the driver and every executor reach: below spark.checkpoint.dir. Where that is unset, it is below the temp folder in local mode, in which all share it, and an error on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and every executor reach")
        base = f"{tempfile.gettempdir()}/rosterweave-checkpoints"
    path = f"{base.rstrip('/')}/rosterweave-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def forget(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _forget_all() -> None:
    for spark, path in _made:
        try:
            forget(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone
            return


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder. It cuts the lineage and outlives a lost executor."""
    df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone. Where all characters are ASCII, lower() does just that and is much faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def salted_join(facts: DataFrame, dims: DataFrame, keys: list[str], weight: str, total: int, salt_by: Column, how: str = "left") -> DataFrame:
    """facts joined with dims on keys, where dims has one row a key and `weight` is the number of rows of facts with that key.

    Keys with over total / HOT_SHARE rows are dealt over HOT_SALTS partitions: their dims rows are copied once a salt, and the
    facts of those keys take the salt of `salt_by`. At most HOT_SHARE keys can be hot, which bounds the broadcast list.
    """
    hot_from = max(total // HOT_SHARE, HOT_SALTS)
    hot = dims.filter(F.col(weight) > hot_from).select(*keys, F.lit(True).alias("_hot"))
    facts = facts.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.when(F.col("_hot"), F.pmod(salt_by, F.lit(HOT_SALTS)).cast("int")).otherwise(F.lit(0))).drop("_hot")
    salts = F.when(F.col(weight) > hot_from, F.sequence(F.lit(0), F.lit(HOT_SALTS - 1))).otherwise(F.array(F.lit(0)))
    return facts.join(dims.withColumn("_salt", F.explode(salts)), [*keys, "_salt"], how).drop("_salt")


def packed(docs: DataFrame, **named: Column | str) -> DataFrame:
    """docs as one column `_row`, so that no name of its columns clashes with an operator's, beside the named columns."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), *[(docs[c] if isinstance(c, str) else c).alias(n) for n, c in named.items()])


def smallest(rows: DataFrame, of: str, by: str, most: int) -> DataFrame:
    """Of distinct rows (of, by: a hash), those with the `most` smallest hashes for each value of `of`, and no more. Counts come first, so that about twice as many rows as stay are ranked."""
    sizes = rows.groupBy(of).agg(F.count(F.lit(1)).alias("_n"))
    unit = F.pmod(F.col(by), F.lit(1_000_003)) / F.lit(1_000_003.0)
    few = rows.join(sizes, rows[of].eqNullSafe(sizes[of]), "left").filter(unit * F.col("_n") <= F.lit(2.0 * most + 10)).select(rows["*"])
    rank = F.row_number().over(Window.partitionBy(of).orderBy(F.pmod(by, F.lit(1_000_003)), by))
    return few.withColumn("_rank", rank).filter(F.col("_rank") <= most).drop("_rank")


#: Keys of rows to drop are broadcast up to this many; beyond it they are shuffled.
KEYS_BROADCAST = 1_000_000


def without_rows(df: DataFrame, keys: DataFrame, made: dict[str, Column]) -> DataFrame:
    """df without the rows whose columns `made` equal a row of `keys` (a written table, distinct). Nulls equal nulls."""
    names = [f"_without_{k}" for k in made]
    left = df.withColumns(dict(zip(names, made.values(), strict=True)))
    same = [left[n].eqNullSafe(keys[k]) for n, k in zip(names, made, strict=True)]
    right = F.broadcast(keys) if keys.count() <= KEYS_BROADCAST else keys
    return left.join(right, same, "left_anti").drop(*names)


#: A bitmap has at most 2 ** BITMAP_BITS bits, sent as 2 ** (BITMAP_BITS - 6) words of 64 at most.
BITMAP_BITS = 26


def flagged(rows: DataFrame, keys: DataFrame, key: str, n: int) -> DataFrame:
    """rows with `_likely`: whether their key may be among the n keys (longs). It is true for all that are, and few others while the bitmap is sparse; when it is full, for all. For use before an exact join."""
    bits = min(BITMAP_BITS, max(10, (16 * max(n, 1)).bit_length()))
    at = F.col(key).bitwiseAND(F.lit(2**bits - 1).cast("long"))
    word, bit = F.shiftrightunsigned(at, 6), at.bitwiseAND(F.lit(63).cast("long")).cast("int")
    words = keys.select(word.alias("_word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    hit = F.call_function("shiftrightunsigned", F.col("_bits"), bit).bitwiseAND(F.lit(1).cast("long")) == 1
    return rows.withColumn("_word", word).join(F.broadcast(words), "_word", "left").withColumn("_likely", F.coalesce(hit, F.lit(False))).drop("_word", "_bits")


def possible(rows: DataFrame, keys: DataFrame, key: str, n: int) -> DataFrame:
    """The rows that `flagged` holds for likely."""
    return flagged(rows, keys, key, n).filter("_likely").drop("_likely")


def joined_where_found(rows: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """rows (texts) left-joined with found, a written table that has a row a key at most and no nulls in keys. Rows that no key of found can match stay where they are."""
    mark = F.xxhash64(*keys)
    marked = flagged(rows.withColumn("_mark", mark), found.select(mark.alias("_mark")), "_mark", found.count()).drop("_mark")
    others = [c for c in found.columns if c not in keys]
    moved = marked.filter("_likely").drop("_likely").join(found, keys, "left")
    stay = marked.filter("not _likely").drop("_likely").withColumns({c: F.lit(None).cast(found.schema[c].dataType) for c in others})
    return moved.unionByName(stay)
