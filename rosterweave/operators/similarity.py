"""Candidates for a name among many names: a set-similarity join over letter q-grams.

A name's set holds its q-grams (the whole name if it is shorter). Two names are similar when they share at least `of` hundredths of their union.
In any order of all grams, the first gram that two similar sets share is among each other's first m - ceil(of m / 100) + 1 grams, and the second
that they share one place further. The order puts frequent grams last: those with over 1 / HOT of all grams (so HOT at most) are counted and
broadcast, the rest follow by their hash. So if the first shared gram is rare, both names are indexed under it, and if not, both are indexed under
the pair of frequent grams that they share first; names that can be similar by one gram alone are indexed under each. An equality join finds all
pairs, and nothing compares all names with all. There are few grams but many pairs of them, so the names met under a key stay few as names grow.
A key under which many names stand all the same is dealt over salts. Each name carries 128 bits that its grams set: a bit that one name has and the
other lacks is a gram that they do not share. Sizes and bits that can't be similar are left out by the join; the rest is checked gram by gram.

Names that are spelled alike after folding are one entry, so repeated names do not multiply in the join; `expanded` gives their rows back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterweave.functions import names
from rosterweave.sources.scratch import landed, shared_folder

HOT, SALTS = 100_000, 16
CROWDED = 10_000  # a key with more names, and over 1 / CROWDED of all entries, is dealt over salts


def grams(name: Column | str, q: int = 3) -> Column:
    """The distinct q-grams of a name; a shorter one is a gram itself, an empty one has none."""
    n = F.col(name) if isinstance(name, str) else name
    cut = F.array_distinct(F.transform(F.sequence(F.lit(1), F.char_length(n) - (q - 1)), lambda i: F.substring(n, i, F.lit(q))))
    return F.when(n == "", F.array().cast("array<string>")).when(F.char_length(n) <= q, F.array(n)).otherwise(cut)


def _bits(by: int) -> Column:
    """A bit of 64 for each gram, by six bits of its hash."""
    return F.expr(f"aggregate(grams, 0L, (bits, g) -> bits | shiftleft(1L, cast(shiftright(xxhash64(g), {by}) & 63 as int)))")


def _keys(entries: DataFrame, hot: DataFrame, of: int) -> DataFrame:
    """entries: name, grams, m, low, high. name, m, low, high, key: hashes of the rare grams and of the pairs of frequent grams that the name is indexed under."""
    own = ["name", "m", "low", "high"]
    spread = entries.select(*own, F.explode("grams").alias("gram")).join(F.broadcast(hot), "gram", "left")
    rank = F.row_number().over(Window.partitionBy(*own).orderBy(F.coalesce("n", F.lit(0)), F.xxhash64("gram"), "gram"))  # a name's grams: as many as it has letters
    least = F.expr(f"({of} * m + 99) div 100")
    first = spread.withColumn("rank", rank).filter(F.col("rank") <= F.col("m") - least + 2)
    first = first.groupBy(*own).agg(F.sort_array(F.collect_list(F.struct("rank", "gram", F.col("n").isNotNull().alias("frequent")))).alias("first"))
    single = F.filter("first", lambda g: (g["rank"] <= F.col("m") - least + 1) & (~g["frequent"] | (least <= 1)))
    frequent = F.filter("first", lambda g: g["frequent"])
    pairs = F.flatten(F.transform("often", lambda g, i: F.transform(F.slice("often", i + 2, F.size("often")), lambda h: F.xxhash64(g["gram"], h["gram"]))))
    keys = F.concat(F.transform(single, lambda g: F.xxhash64(g["gram"])), pairs)
    return first.withColumn("often", frequent).select(*own, F.explode(F.array_distinct(keys)).alias("key"))


def similar_names(left: DataFrame, right: DataFrame, left_name: str, right_name: str, of: int = 60, q: int = 3, fold=names.match_name) -> DataFrame:
    """left_key, right_key (folded names), shared (grams in both), grams (in either): each pair of similar names once. Null and empty names are similar to none."""
    folder = shared_folder(left.sparkSession)
    entries = [landed(df.select(F.coalesce(fold(c), F.lit("")).alias("name")).filter("name <> ''").distinct().withColumn("grams", grams("name", q)).withColumns({"m": F.size("grams"), "low": _bits(0), "high": _bits(6)}), f"{folder}/{side}") for side, df, c in (("left", left, left_name), ("right", right, right_name))]
    every = entries[0].unionByName(entries[1])
    total = every.agg(F.sum("m")).first()[0] or 0
    hot = landed(every.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max(1, total // HOT)), f"{folder}/hot")
    a, b = (landed(_keys(e, hot, of), f"{folder}/{side}-keys") for e, side in zip(entries, ("left", "right"), strict=True))
    counts = a.select("key").unionByName(b.select("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    crowded = landed(counts.filter(F.col("n") > max(CROWDED, total // CROWDED)), f"{folder}/crowded").select("key", F.lit(True).alias("crowded"))
    own = F.when(F.col("crowded"), F.pmod(F.xxhash64("name"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    every_salt = F.explode(F.when(F.col("crowded"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    a = a.join(F.broadcast(crowded), "key", "left").select(*[F.col(c).alias(f"left_{c}") for c in ("m", "low", "high")], F.col("name").alias("left_key"), "key", own.alias("salt"))
    b = b.join(F.broadcast(crowded), "key", "left").select(*[F.col(c).alias(f"right_{c}") for c in ("m", "low", "high")], F.col("name").alias("right_key"), "key", every_salt.alias("salt"))
    most = F.least(*[F.col(f"{x}_m") - F.bit_count(F.col(f"{x}_{c}").bitwiseAND(F.bitwise_not(f"{y}_{c}"))) for x, y in (("left", "right"), ("right", "left")) for c in ("low", "high")])
    fits = (100 * most >= of * (F.col("left_m") + F.col("right_m") - most)) & (100 * F.col("left_m") >= of * F.col("right_m")) & (100 * F.col("right_m") >= of * F.col("left_m"))
    met = a.join(b, ["key", "salt"]).filter(fits).select("left_key", "right_key", "left_m", "right_m").distinct()
    shared = F.size(F.array_intersect(grams("left_key", q), grams("right_key", q)))
    checked = met.select("*", F.explode(F.array(shared)).alias("shared"))  # counted once; a plain column would be counted in the filter again
    checked = checked.withColumn("grams", F.col("left_m") + F.col("right_m") - F.col("shared"))
    return checked.filter(100 * F.col("shared") >= of * F.col("grams")).select("left_key", "right_key", "shared", "grams")


def expanded(pairs: DataFrame, left: DataFrame, right: DataFrame, left_name: str, right_name: str, fold=names.match_name) -> DataFrame:
    """The rows of left and right that the pairs of names stand for, with the other columns of pairs."""
    a = left.withColumn("left_key", fold(left_name)).join(pairs, "left_key")
    return a.join(right.withColumn("right_key", fold(right_name)), "right_key").drop("left_key", "right_key")


def found_by_name(searches: DataFrame, known: DataFrame, query: str, name: str, of: int = 60) -> DataFrame:
    """NA8, NA10, TK5: each search with the known rows whose names are similar, and NA8's score of the two names. Feeds `ranking.best_candidate`."""
    pairs = similar_names(searches, known, query, name, of)
    scored = pairs.withColumn("name_score", names.folded_score("left_key", "right_key"))  # once for each pair of names, however many rows have them
    return expanded(scored, searches, known, query, name)
