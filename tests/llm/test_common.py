"""Joins that stand skew, and filters before them."""

import random

import pytest
from pyspark.sql import functions as F

from rosterweave.llm import common


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_a_plain_join(spark, how, monkeypatch):
    monkeypatch.setattr(common, "HOT_SHARE", 10)  # keys with over a tenth of the rows are hot
    rnd = random.Random(1)
    rows = [(0 if rnd.random() < 0.4 else rnd.randrange(1, 400), "x" if rnd.random() < 0.5 else "y", i) for i in range(3000)]
    facts = spark.createDataFrame(rows, "k long, s string, id long")
    dims = facts.groupBy("k", "s").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top")).filter("k % 7 <> 3")
    mine = common.salted_join(facts, dims, ["k", "s"], "n", 3000, F.xxhash64("id"), how=how).select("id", "k", "s", "n", "top")
    plain = facts.join(dims, ["k", "s"], how).select("id", "k", "s", "n", "top")
    assert sorted(map(repr, map(tuple, mine.collect()))) == sorted(map(repr, map(tuple, plain.collect())))


def test_possible_loses_no_row_of_a_key(spark):
    rnd = random.Random(2)
    keys = [rnd.getrandbits(64) - 2**63 for _ in range(500)] + [0, -1, 2**63 - 1, -(2**63)]
    others = [rnd.getrandbits(64) - 2**63 for _ in range(5000)]
    got = {r["key"] for r in common.possible(spark.createDataFrame([(k,) for k in keys + others], "key long"), spark.createDataFrame([(k,) for k in keys], "key long"), "key", len(keys)).collect()}
    assert set(keys) <= got and len(got) < len(keys) + 0.2 * len(others)


@pytest.mark.parametrize("bits", [6, 26])
def test_joined_where_found_equals_a_left_join(spark, monkeypatch, bits):
    monkeypatch.setattr(common, "BITMAP_BITS", bits)
    rows = spark.range(1000).select((F.col("id") % 700).alias("k"), F.lit(3).cast("long").alias("l"), "id")
    found = spark.range(0, 2000, 50).select(F.col("id").alias("k"), F.lit(3).cast("long").alias("l"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"))
    mine, plain = common.joined_where_found(rows, found, ["k", "l"]), rows.join(found, ["k", "l"], "left")
    assert sorted(map(repr, mine.select("id", "k", "v").collect())) == sorted(map(repr, plain.select("id", "k", "v").collect()))


def test_smallest_keeps_so_many_of_each(spark):
    rows = spark.range(5000).select(F.concat(F.lit("g"), (F.col("id") % 3).cast("string")).alias("g"), F.xxhash64("id").alias("h")).unionByName(spark.createDataFrame([("few", 1), (None, 2)], "g string, h long"))
    got = {r["g"]: r["n"] for r in common.smallest(rows, "g", "h", 20).groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {"g0": 20, "g1": 20, "g2": 20, "few": 1, None: 1}


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    class Cluster:
        conf = type("conf", (), {"get": staticmethod(lambda *_: None)})
        sparkContext = type("context", (), {"master": "local-cluster[3,2,1024]"})

    with pytest.raises(ValueError, match="checkpoint"):
        common.shared_dir(Cluster())


@pytest.mark.parametrize("most", [0, 10])
def test_without_rows_by_broadcast_and_by_shuffle(spark, monkeypatch, most):
    monkeypatch.setattr(common, "KEYS_BROADCAST", most)
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, None)], "id long, t string")
    keys = spark.createDataFrame([(1, "a"), (None, "c"), (2, None)], "i long, u string")
    assert [tuple(r) for r in common.without_rows(df, keys, {"i": F.col("id"), "u": F.col("t")}).collect()] == [(1, "b")]


def test_ascii_lower_leaves_other_letters(spark):
    got = spark.createDataFrame([("AZ É İ ß",), ("ABC",), (None,)], "t string").select(common.ascii_lower(F.col("t")).alias("t")).collect()
    assert [r["t"] for r in got] == ["az É İ ß", "abc", None]


def test_scratch_is_below_the_checkpoint_folder(spark):
    path = common.shared_dir(spark)
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    common.written(spark.range(3).toDF("x"), path, "t")
    common.forget(spark, path)
    import os

    assert not os.path.exists(path)
