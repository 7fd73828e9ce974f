"""Payloads of unknown or changing shape, as VARIANT: parsed once in the JVM, without a schema. A text that is no JSON is null and has no leaves."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterweave.functions.text import C, col


def parsed(payload: C) -> Column:
    """The payload as a variant; null where it is no JSON."""
    return F.try_parse_json(col(payload))


def first_of(variant: C, *paths: str, kind: str = "string") -> Column:
    """PA1-PA4, PA11: the value at the first of several paths that has one of the kind: the names that a field goes by. Wrong kinds and missing parents count as no value."""
    return F.coalesce(*[F.try_variant_get(col(variant), p, kind) for p in paths])


def leaves(df: DataFrame, payload: str, keys: list[str], depth: int = 8) -> DataFrame:
    """PA10: keys, path, name, value of every value (text, number, truth value) in the payload, down to `depth` levels of nesting; null values, empty objects and what lies deeper have no row.

    path: $.a[0].b, name: the last name in it. Each level is one lateral explode of the rows before, so the payload is read and parsed once."""
    spark, nested = df.sparkSession, "schema_of_variant(v) RLIKE '^(OBJECT|ARRAY)'"
    at = df.select(*keys, F.lit("$").alias("path"), F.lit("").alias("name"), parsed(payload).alias("v")).filter("v IS NOT NULL")
    names = ", ".join(f"s.`{k}`" for k in keys)
    for _ in range(depth):
        view = f"variants_{uuid.uuid4().hex}"
        at.selectExpr("*", f"CASE WHEN {nested} THEN v END AS n").createOrReplaceTempView(view)
        at = spark.sql(f"""
            SELECT {names}, CASE WHEN t.value IS NULL THEN s.path WHEN t.key IS NULL THEN concat(s.path, '[', t.pos, ']') ELSE concat(s.path, '.', t.key) END AS path,
              CASE WHEN t.key IS NULL THEN s.name ELSE t.key END AS name, CASE WHEN t.value IS NULL THEN s.v ELSE t.value END AS v
            FROM {view} AS s, LATERAL variant_explode_outer(s.n) AS t WHERE s.n IS NULL OR t.value IS NOT NULL
        """)
    return at.filter(f"NOT {nested} AND NOT is_variant_null(v)").select(*keys, "path", "name", F.expr("try_variant_get(v, '$', 'string')").alias("value"))


def named(df: DataFrame, payload: str, keys: list[str], names: tuple[str, ...], depth: int = 8) -> DataFrame:
    """PA10: keys, path, value of the values that go by one of the names, wherever they stand."""
    return leaves(df, payload, keys, depth).filter(F.col("name").isin(*names)).select(*keys, "path", "value")
