"""J4, J5, SC7, SC8, SK2: delivered keys as an index that a day adds to, in place of a key file that each day reads and writes whole.

Keys lie in folders by range of their hash and by day; a day writes its new keys alone, in as many tasks as there are ranges. Beside them
stands one Bloom filter for all days: words of 64 bits by the leading bits of the hash, kept by version, of bounded size (2 ** BITS bits). A row
whose bits are not all set is new without a look at any key; the others are looked up in the folders of their ranges. So a day's join holds its
repeats (and about one new row in a thousand while the filter is sparse), reads only ranges that they hit, and moves no row that is new.

Days are numbers. A day that is written again replaces its own keys; `rebuilt` makes the filter anew from the keys (after days were taken back,
or to widen it). A null key is never delivered and so always new. The key file for people is `sinks.key_file` over `keys()`, a separate step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterweave.sources.readers import Folder

BITS, HASHES = 26, 3


class KeyIndex:
    def __init__(self, spark: SparkSession, path: str, ranges: int = 64, bits: int = BITS):
        self.spark, self.path, self.ranges, self.bits = spark, path.rstrip("/"), ranges, bits
        self.folder = Folder(spark, self.path)

    def days(self) -> list[int]:
        return sorted(int(n.removeprefix("day=")) for n in Folder(self.spark, f"{self.path}/keys").names(folders=True) if n.startswith("day="))

    def _range(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.ranges)).cast("int")

    def keys(self, until: int | None = None, ranges: list[int] | None = None) -> DataFrame:
        """Delivered keys (key, day), of days up to `until`, of some ranges or of all; each folder that is read is named."""
        out = []
        for day in self.days():
            if until is not None and day > until:
                continue
            there = Folder(self.spark, f"{self.path}/keys/day={day}").names(folders=True)
            out += [f"{self.path}/keys/day={day}/{n}" for n in there if n.startswith("range=") and (ranges is None or int(n.removeprefix("range=")) in set(ranges))]
        if not out:
            return self.spark.createDataFrame([], "key string, day int")
        return self.spark.read.schema("key string, day int").parquet(*out)

    def _bits(self, key: Column) -> Column:
        """word, bit: HASHES places of the filter for a key."""
        places = [F.shiftrightunsigned(F.xxhash64(key, F.lit(k)), 64 - self.bits) for k in range(HASHES)]
        return F.array(*[F.struct(F.shiftrightunsigned(p, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(F.lit(63).cast("long")).cast("int")).alias("bit")) for p in places])

    def _filter(self) -> DataFrame | None:
        versions = sorted(int(n.removeprefix("bloom-")) for n in self.folder.names(folders=True) if n.startswith("bloom-") and Folder(self.spark, f"{self.path}/{n}").has("_SUCCESS"))
        return self.spark.read.schema("word long, bits long").parquet(f"{self.path}/bloom-{versions[-1]}") if versions else None

    def _set(self, keys: DataFrame, before: DataFrame | None, version: int) -> None:
        words = keys.select(F.explode(self._bits(F.col("key"))).alias("b")).select("b.word", F.col("b.bit").alias("bits"))
        both = words if before is None else words.unionByName(before)
        both.groupBy("word").agg(F.bit_or("bits").alias("bits")).write.mode("overwrite").parquet(f"{self.path}/bloom-{version}")
        for n in self.folder.names(folders=True):
            if n.startswith("bloom-") and int(n.removeprefix("bloom-")) < version - 1:  # the last but one stays for readers
                self.folder.delete(n)

    def split(self, rows: DataFrame, key: str = "key") -> DataFrame:
        """rows with `_maybe`: whether their key may have been delivered. False is certain."""
        bloom = self._filter()
        if bloom is None:
            return rows.withColumn("_maybe", F.lit(False))
        # at most 2 ** (bits - 6) words: their size is bounded, so they go to the rows
        words, out, held = F.broadcast(bloom), rows.withColumn("_at", self._bits(F.col(key))), F.lit(True)
        for k in range(HASHES):
            out = out.withColumn("word", F.col("_at")[k]["word"]).join(words.withColumnRenamed("bits", f"_w{k}"), "word", "left").drop("word")
            held = held & (F.coalesce(F.col(f"_w{k}"), F.lit(0).cast("long")).bitwiseAND(F.col("_at")[k]["bit"]) != 0)
        return out.withColumn("_maybe", F.col(key).isNotNull() & held).drop("_at", *[f"_w{k}" for k in range(HASHES)])

    def undelivered(self, rows: DataFrame, key: str = "key", until: int | None = None) -> DataFrame:
        """J4: rows whose key no day (up to `until`) delivered."""
        marked = self.split(rows, key)
        hit = sorted(r[0] for r in marked.filter("_maybe").select(self._range(F.col(key))).distinct().collect())  # `ranges` numbers at most
        seen = self.keys(until, hit).select(F.col("key").alias(key)).distinct()
        return marked.filter("not _maybe").unionByName(marked.filter("_maybe").join(seen, key, "left_anti").select(*marked.columns)).drop("_maybe")

    def undelivered_by_two(self, rows: DataFrame, name_key: str, domain_key: str, until: int | None = None) -> DataFrame:
        """J5: rows of which neither key was delivered; a null key decides nothing."""
        return self.undelivered(self.undelivered(rows, name_key, until), domain_key, until)

    def add(self, keys: DataFrame, day: int, key: str = "key") -> None:
        """SK2: the day's keys that no earlier day has, each once; a day given again replaces its own."""
        wanted = keys.select(F.col(key).alias("key")).filter(F.col("key").isNotNull()).distinct()
        new = self.undelivered(wanted, "key", day - 1).select("key", F.lit(day).cast("int").alias("day"), self._range(F.col("key")).alias("range"))
        path = f"{self.path}/keys/day={day}"
        new.repartition("range").sortWithinPartitions("range", "key").write.mode("overwrite").partitionBy("range").parquet(path)
        versions = [int(n.removeprefix("bloom-")) for n in self.folder.names(folders=True) if n.startswith("bloom-")]
        self._set(self.keys_of(day), self._filter(), 1 + max(versions, default=-1))

    def keys_of(self, day: int) -> DataFrame:
        return self.spark.read.schema("key string, day int, range int").parquet(f"{self.path}/keys/day={day}").select("key", "day")

    def rebuilt(self) -> None:
        """The filter from the keys of all days."""
        versions = [int(n.removeprefix("bloom-")) for n in self.folder.names(folders=True) if n.startswith("bloom-")]
        self._set(self.keys(), None, 1 + max(versions, default=-1))
