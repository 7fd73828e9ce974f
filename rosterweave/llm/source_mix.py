"""Mixing sources to target weights.

The words of each source are summed, and targets derived by filling: a source's target is weight * level, at most `most` times its
size, where the level makes all targets add up to all words. The level is found by a loop that moves two sums to the driver each
time, however many sources there are. A document of a source with rate r = target / size is taken floor(r) times, and once more
with probability f = r - floor(r).

That copy hangs on a coin, the MD5 of seed and doc_id, so reruns agree on any number of partitions. Independent coins would leave the
words of a source far from its target where few documents have most of the words. So the coins of a source are used together: its
documents in order of coins lie side by side on a circle, each as long as it has words, and those whose middle is in an arc of f of the
circle are taken once more. The arc begins where the MD5 of seed and source says, so each document's probability is f, and the words
taken miss the target by no more than the words of the source's longest document. Where the arc begins and ends is found from sums of words
by leading bits of coins, LEVELS times refined; the result is two coins a source, and each document is decided by its own coin.

Sources weigh 1, 2, 3, 1, ... in order of code points, null last. A null or empty text has no words and takes none. A source without
words has target 0. Rows of a source that repeat a doc_id share its coin and its place on the circle. Very long texts are counted whole;
clashing names of other columns do no harm. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterweave.llm.common import WORD_PATTERN, packed, salted_join, shared_dir, written

WEIGHTS, MOST, SEED = (1, 2, 3), 3, "mix"
_COIN_DIGITS = 13  # hexadecimal, 52 bits: exact in a double
LEVELS, _LEVEL_BITS = 4, 13  # a level's sums are at most 2 ** 13 a source and end of its arc


def coin(what: Column, seed: str = SEED) -> Column:
    """A number from 0 to 2 ** 52 - 1 made from the seed and a text."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(what.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, _COIN_DIGITS), 16, 10).cast("long")


def _ranked(sources: DataFrame, folder: str) -> DataFrame:
    """sources with rank, from 0 by code points and null last, without moving them to one task."""
    dealt = written(sources.withColumn("last", F.col("source").isNull()).repartitionByRange("last", "source").withColumn("part", F.spark_partition_id()), folder, "dealt")
    counts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row a partition
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    own = F.row_number().over(Window.partitionBy("part").orderBy("last", "source")) - 1
    return dealt.join(F.broadcast(before), "part").withColumn("rank", own + F.col("before")).drop("part", "before")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> tuple[DataFrame, int]:
    """sized: source, size. One row a source: source, last (it is null), n_docs, source_size, weight, target; and the number of documents."""
    folder = shared_dir(sized.sparkSession)
    sources = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = written(_ranked(sources, folder).withColumn("weight", weight.cast("long")).drop("rank"), folder, "sources")
    sums = sources.agg(F.sum("source_size").alias("words"), F.sum("n_docs").alias("docs")).first()
    words, full = sums["words"] or 0, F.lit(False)
    above, rest = 0, -1
    while True:  # the level only rises, so each turn adds sources to the full ones, or ends
        at = sources.agg(
            F.coalesce(F.sum(F.when(full, F.col("source_size") * most)), F.lit(0)).alias("above"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("rest"),
        ).first()
        if (at["above"], at["rest"]) == (above, rest) or not at["rest"]:
            break
        above, rest = at["above"], at["rest"]
        full = F.col("source_size") * most * rest <= F.lit(words - above) * F.col("weight")
    level = F.lit(float(words - above)) * F.col("weight") / F.lit(float(max(rest, 1)))
    target = F.when(full, (F.col("source_size") * most).cast("double")).otherwise(level)
    return sources.withColumn("target", target), sums["docs"] or 0


#: Targets are broadcast up to this many sources; beyond it they are joined by a shuffle that salts the hot ones.
SOURCES_BROADCAST = 50_000


def _with_source(rows: DataFrame, table: DataFrame, few: bool, total: int, how: str) -> DataFrame:
    """rows joined with a table of a row a source; both have _source and _last, the table n_docs."""
    if few:
        return rows.join(F.broadcast(table), ["_source", "_last"], how)
    return salted_join(rows, table, ["_source", "_last"], "n_docs", total, F.col("coin"), how=how)


def _arcs(sizes: DataFrame, targets: DataFrame, few: bool, total: int, seed: str, folder: str) -> DataFrame:
    """targets with `from` and `to`: the first coins of documents with their middle at or after the arc's two ends, 2 ** 52 for none.

    sizes: _source, _last, coin, size. A source's documents by coins begin at the sums of the words before them. An end's place on the
    line of words is followed down the coins' bits: at each level the words of each next piece of bits say which piece it falls in."""
    s, fraction = F.col("source_size"), F.col("target") / F.greatest("source_size", F.lit(1)) - F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))
    begin = F.floor(coin(F.when(~F.col("_last"), F.concat(F.lit("source "), F.col("_source"))), seed) / F.lit(float(2**52)) * s).cast("long")
    stop = (begin + F.round(fraction * s)).cast("long")
    # an end at or beyond the line's end wraps to its start
    ends = targets.filter(s > 0).select("_source", "_last", "n_docs", F.posexplode(F.array(begin, F.when(stop >= s, stop - s).otherwise(stop))).alias("end", "rest"), F.lit(0).cast("long").alias("lead"))
    at = written(ends, folder, "level0")
    for level in range(LEVELS):
        shift = _LEVEL_BITS * (LEVELS - 1 - level)
        both = at.groupBy("_source", "_last").agg(F.max("n_docs").alias("n_docs"), F.collect_list(F.struct("end", "rest", "lead")).alias("ends"))  # two
        own = _with_source(sizes, both, few, total, "inner").select("_source", "_last", "coin", "size", F.explode("ends").alias("e")).select("_source", "_last", "coin", "size", "e.*")
        own = own.filter(F.shiftright("coin", shift + _LEVEL_BITS) == F.col("lead"))
        sums = own.groupBy("_source", "_last", "end", "rest", F.shiftright("coin", shift).alias("piece")).agg(F.sum("size").alias("words"))
        line = Window.partitionBy("_source", "_last", "end").orderBy("piece")  # 2 ** _LEVEL_BITS rows at most
        sums = sums.withColumn("before", F.sum("words").over(line) - F.col("words"))
        # the piece that the place falls in; it has words
        found = sums.filter((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words")))
        found = found.select("_source", "_last", "end", (F.col("rest") - F.col("before")).alias("rest"), F.col("piece").alias("lead"), "words")
        at = written(found.join(targets.select("_source", "_last", "n_docs"), ["_source", "_last"]), folder, f"level{level + 1}")
    # the last piece is one coin
    edge = F.when(2 * F.col("rest") > F.col("words"), F.col("lead") + 1).otherwise(F.col("lead"))
    found = at.groupBy("_source", "_last").agg(F.max(F.when(F.col("end") == 0, edge)).alias("from"), F.max(F.when(F.col("end") == 1, edge)).alias("to"))
    return targets.join(found, ["_source", "_last"], "left").withColumn("wraps", stop >= s)


def _mixed(rows: DataFrame, weights: tuple[int, ...], most: int, seed: str) -> DataFrame:
    """rows: doc_id, text, source and others. Adds size, source_size, target, copies; text and source go."""
    folder = shared_dir(rows.sparkSession)
    size = F.coalesce(F.regexp_count("text", F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    keys = {"_source": F.coalesce("source", F.lit("")), "_last": F.col("source").isNull(), "coin": coin(F.col("doc_id"), seed)}
    # words are counted once: what else the rows have comes back with them only if there is more than ids
    keyed = rows.withColumns({"size": size, **keys}).drop("text")
    others = [c for c in keyed.columns if c not in ("doc_id", "source", "size", *keys)]
    if not others:
        keyed = written(keyed, folder, "sizes")
        sizes = keyed
    else:
        sizes = written(keyed.select("source", "size", *keys), folder, "sizes")
    targets, total = source_targets(sizes.select("source", "size"), weights, most)
    targets = targets.select(F.coalesce("source", F.lit("")).alias("_source"), F.col("last").alias("_last"), "n_docs", "source_size", "target")
    few = targets.count() <= SOURCES_BROADCAST
    arcs = written(_arcs(sizes, targets, few, total, seed, folder), folder, "arcs")
    found = _with_source(keyed.drop("source"), arcs, few, total, "left")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    after, before = F.col("coin") >= F.col("from"), F.col("coin") < F.col("to")
    more = F.when(F.col("wraps"), after | before).otherwise(after & before)
    copies = F.floor(rate) + F.when(more & (rate > F.floor(rate)), 1).otherwise(0)
    return found.withColumn("copies", copies.cast("long")).drop("_source", "_last", "n_docs", "coin", "from", "to", "wraps")


def _named(docs: DataFrame, text_col: str, source_col: str, id_col: str) -> dict[str, Column]:
    return {"doc_id": docs[id_col].cast("long"), "text": docs[text_col].cast("string"), "source": docs[source_col].cast("string")}


def mixed(docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, copies (how many times the mix takes the document) for each row."""
    return _mixed(docs.select(*[c.alias(n) for n, c in _named(docs, text_col, source_col, id_col).items()]), weights, most, seed)


def emitted(docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The rows of the mix: each document as often as it is taken, with the columns of docs."""
    found = _mixed(packed(docs, **_named(docs, text_col, source_col, id_col)), weights, most, seed)
    return found.filter("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("_row.*")


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mixed(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


ORACLE = """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM d GROUP BY source),
t AS (SELECT sum(source_size)::BIGINT AS words, sum(weight)::BIGINT AS weights FROM s),
c AS (
  SELECT s.*, words,
    coalesce(sum(3 * source_size) OVER w, 0)::BIGINT AS above, weights - coalesce(sum(weight) OVER w, 0)::BIGINT AS rest
  FROM s, t WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
f AS (SELECT above, rest FROM c WHERE 3 * source_size * rest > (words - above) * weight ORDER BY above LIMIT 1),
x AS (
  SELECT c.source, c.source_size,
    CASE WHEN f.rest IS NULL OR 3 * c.source_size * f.rest <= (words - f.above) * weight THEN (3 * c.source_size)::DOUBLE
    ELSE (words - f.above)::DOUBLE * weight / f.rest::DOUBLE END AS target
  FROM c LEFT JOIN f ON true
),
k AS (
  SELECT d.doc_id, d.size, x.source_size, x.target, CASE WHEN x.source_size > 0 THEN x.target / x.source_size ELSE 0.0::DOUBLE END AS rate,
    ('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::UBIGINT::BIGINT AS coin, x.source AS src,
    floor(('0x' || substr(md5('mix:' || coalesce('source ' || x.source, '')), 1, 13))::UBIGINT::DOUBLE / 4503599627370496.0::DOUBLE * x.source_size)::BIGINT AS arc
  FROM d JOIN x ON d.source IS NOT DISTINCT FROM x.source
),
p AS (
  SELECT *, rate - floor(rate) AS f, (arc + round((rate - floor(rate)) * source_size))::BIGINT AS stop,
    coalesce(sum(size) OVER (PARTITION BY src ORDER BY coin RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start, sum(size) OVER (PARTITION BY src, coin)::BIGINT AS own
  FROM k
)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + CASE
  WHEN f = 0 THEN 0 WHEN stop >= source_size THEN (2 * start + own >= 2 * arc OR 2 * start + own < 2 * (stop - source_size))::INT ELSE (2 * start + own >= 2 * arc AND 2 * start + own < 2 * stop)::INT END))::BIGINT AS taken
FROM p
"""
