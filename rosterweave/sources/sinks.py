"""Sinks of a delivery: CSV, keys, summary, snapshots. Deltas and keys are small beside the tables that they come from; large outputs stay in part files."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterweave.functions.text import filled, trim
from rosterweave.sources.readers import Folder

BOM = "﻿"


def _single_file(df: DataFrame, folder: Folder, name: str, kind: str, bom: bool = False, **options) -> None:
    """One file of the given name: written by Spark beside it, then renamed. The rename is what makes it appear."""
    tmp = f".{name}.{uuid.uuid4().hex}"
    out = df.coalesce(1).write.mode("overwrite").options(**options)
    getattr(out, kind)(f"{folder.path}/{tmp}")
    part = next(n for n in Folder(df.sparkSession, f"{folder.path}/{tmp}").names(folders=False) if n.startswith("part-"))
    if folder.has(name):
        folder.delete(name)
    folder.move(f"{tmp}/{part}", name)
    folder.delete(tmp)
    if bom:  # Spark writes no byte order mark; this is for files that people open
        folder.write_text(name, BOM + folder.read_text(name))


def delta_csv(df: DataFrame, folder: Folder, name: str, columns: list[str], order: list[str] | None = None, bom: bool = False) -> None:
    """SK1, SK4: a CSV with the columns in that order; addresses joined; other columns are left out."""
    types = dict(df.dtypes)
    rows = df.select(*[F.array_join(c, "; ").alias(c) if types[c].startswith("array") else F.col(c) for c in columns])
    _single_file(rows.orderBy(*(order or columns)), folder, name, "csv", bom, header=True, escape='"')


#: SK2: which keys a day writes.
KEY_POLICIES = {
    "current": lambda baseline, current: current,
    "union": lambda baseline, current: baseline.unionByName(current),
}


def key_file(baseline: DataFrame, current: DataFrame, folder: Folder, name: str = "keys.txt", policy: str = "union") -> None:
    keys = KEY_POLICIES[policy](baseline.select("key"), current.select("key")).distinct().orderBy("key")
    _single_file(keys.select(F.col("key").alias("value")), folder, name, "text")


def summary(folder: Folder, name: str = "summary.json", **values) -> dict:
    """SK3."""
    folder.write_text(name, json.dumps(values, ensure_ascii=False, indent=2))
    return values


def jsonl_snapshot(df: DataFrame, path: str, per_email: str | None = None) -> None:
    """SK5: JSON lines in part files; Spark's commit makes them appear at once. With per_email, a row for each address."""
    rows = df.withColumn("email", F.explode(per_email)).drop(per_email) if per_email else df
    rows.write.mode("overwrite").json(path)


def websites_txt(df: DataFrame, folder: Folder, name: str = "websites.txt", website: str = "website") -> None:
    """SK6: websites that are filled, each once, sorted."""
    _single_file(df.filter(filled(website)).select(trim(website).alias("value")).distinct().orderBy("value"), folder, name, "text")


def prepared(spark, delivery: str, name: str, keep: bool = False) -> Folder:
    """SK7: the day's folder, new: what an earlier run left goes to .trash, unless it is to be kept."""
    top = Folder(spark, delivery)
    if top.has(name) and not keep:
        top.move(name, f".trash/{name}-{uuid.uuid4().hex}")
    folder = Folder(spark, f"{delivery}/{name}")
    folder.make()
    return folder


def cleared(folder: Folder, *files: str) -> None:
    """SK8: no delta, no files: those of an earlier run go."""
    for f in files:
        if folder.has(f):
            folder.delete(f)


def full_export(df: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """SK9."""
    return df.select(*columns).orderBy(*order)
