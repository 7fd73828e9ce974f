"""UR8, UR9, UR4: many words looked for at once. One Aho-Corasick automaton over all words goes to the tasks; a text is read once, however many words there are.

Words are sent in blocks of at most BLOCK, which bounds a broadcast; more words are further passes. Empty and null words are never found, a null text has none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterweave.functions.text import filled
from rosterweave.shipping import ship

BLOCK = 200_000
_built: dict[int, object] = {}


def _automaton(words: Broadcast):
    """One for each worker process and block of words."""
    import ahocorasick

    if id(words.value) not in _built:
        _built.clear()
        made = ahocorasick.Automaton()
        for w in words.value:
            made.add_word(w, w)
        made.make_automaton()
        _built[id(words.value)] = (made, words)
    return _built[id(words.value)][0]


def found_words(df: DataFrame, text: str, keys: list[str], words: DataFrame, word: str = "word", block: int = BLOCK) -> DataFrame:
    """keys, word, n: each word that a row's text holds, and how often, overlaps included."""
    spark = df.sparkSession
    ship(spark)
    wanted = words.select(F.col(word).cast("string").alias("word")).filter("word <> ''").distinct()
    blocks = max(1, -(-wanted.count() // block))
    types, out = dict(df.dtypes), []
    rows = df.select(*keys, F.col(text).cast("string").alias("_text"))
    for b in range(blocks):
        of_block = wanted.filter(F.pmod(F.xxhash64("word"), F.lit(blocks)) == b) if blocks > 1 else wanted
        sent = spark.sparkContext.broadcast([r["word"] for r in of_block.collect()])
        if not sent.value:
            continue

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            find = _automaton(sent)
            for batch in batches:
                at, found, times = [], [], []
                for i, t in enumerate(batch.column(len(keys)).to_pylist()):
                    counts: dict[str, int] = {}
                    for _, w in find.iter(t or ""):
                        counts[w] = counts.get(w, 0) + 1
                    at += [i] * len(counts)
                    found += counts.keys()
                    times += counts.values()
                take = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays([*(batch.column(k).take(take) for k in range(len(keys))), pa.array(found, pa.string()), pa.array(times, pa.int64())], names=[*keys, "word", "n"])

        out.append(rows.mapInArrow(run, ", ".join([*(f"`{k}` {types[k]}" for k in keys), "word string", "n long"])))
    return reduce(DataFrame.unionByName, out) if out else rows.select(*keys, F.lit("").alias("word"), F.lit(0).cast("long").alias("n")).limit(0)


def word_counts(found: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """UR9: word, rows (how many hold it), n (how often): of what was found, added to counts kept from earlier runs."""
    new = found.groupBy("word").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"))
    both = new if before is None else new.unionByName(before.select("word", "rows", "n"))
    return both.groupBy("word").agg(F.sum("rows").alias("rows"), F.sum("n").alias("n"))


def holding_none(df: DataFrame, text: str, keys: list[str], blocked: DataFrame, word: str = "word") -> DataFrame:
    """UR4: the rows whose text holds none of many blocked words; keys tell rows apart, a blank text passes."""
    hit = found_words(df.filter(filled(text)), text, keys, blocked, word).select(*keys).distinct()
    same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(hit[k]) for k in keys])
    return df.join(hit, same, "left_anti")
