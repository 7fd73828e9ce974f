"""Scratch tables of the record operators, in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir. Where that is unset: below the temp folder in local mode, in which all share it; an error on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and every executor reach")
        base = f"{tempfile.gettempdir()}/rosterweave-scratch"
    return f"{base.rstrip('/')}/records-{uuid.uuid4().hex}"


def landed(df: DataFrame, path: str) -> DataFrame:
    """df as a Parquet table at path: computed once, and read again by whoever loses an executor."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
