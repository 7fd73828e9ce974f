"""Snapshots that a batch of changes rewrites only where it hits.

A snapshot is a folder of buckets by the hash of its key. A manifest file names the folder of each bucket's present version; a batch reads
and folds the buckets that its keys fall into, writes their next version beside the old, and then writes the next manifest. Readers see the
manifest that they opened, a batch that dies leaves the last one valid, and a batch given again under its number changes nothing. Work follows the
batch and the buckets that it hits, so choose so many buckets that a batch's keys fall into few of them (keys a bucket, not buckets, should stay
constant as the table grows).
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rosterweave.operators.upsert import fold
from rosterweave.sources.readers import Folder


@dataclass
class Manifest:
    """version: of the last batch applied. buckets: bucket number -> folder below the snapshot's path."""

    version: int
    n: int
    schema: str
    buckets: dict[int, str]


class Snapshot:
    """UP1-UP3, UP10: an upserted table. n buckets are fixed when it is made."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], policy: dict[str, str], n: int = 256):
        self.spark, self.path, self.keys, self.policy = spark, path.rstrip("/"), keys, policy
        self.at = self._open(n)

    def _open(self, n: int) -> Manifest:
        folder = Folder(self.spark, self.path)
        versions = sorted(int(x.removeprefix("manifest-").removesuffix(".json")) for x in folder.names(folders=False) if x.startswith("manifest-"))
        if not versions:
            return Manifest(-1, n, "", {})
        raw = json.loads(folder.read_text(f"manifest-{versions[-1]}.json"))
        return Manifest(raw["version"], raw["n"], raw["schema"], {int(k): v for k, v in raw["buckets"].items()})

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.at.n)).cast("int")

    def table(self, only: list[int] | None = None) -> DataFrame | None:
        """The present rows, of some buckets or of all; None before the first batch."""
        paths = [f"{self.path}/{f}" for b, f in sorted(self.at.buckets.items()) if only is None or b in set(only)]
        if not self.at.schema:
            return None
        schema = StructType.fromJson(json.loads(self.at.schema))
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def apply(self, changes: DataFrame, number: int, seq: str = "seq") -> list[int]:
        """Fold a batch into the buckets that it hits, which are returned. A number that was applied before is skipped."""
        if number <= self.at.version:
            return []
        changes = changes.withColumn("_bucket", self._bucket())
        hit = sorted(r[0] for r in changes.select("_bucket").distinct().collect())  # n numbers at most
        after = fold(self.table(hit), changes.drop("_bucket"), self.keys, self.policy, seq)
        name = f"v{number}"
        # one writer a bucket; rows of a bucket come together by the same hash that names it
        rows = after.withColumn("bucket", self._bucket()).repartition("bucket").sortWithinPartitions("bucket", *self.keys)
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{name}")
        buckets = self.at.buckets | {b: f"{name}/bucket={b}" for b in hit}
        made = Manifest(number, self.at.n, after.schema.json(), buckets)
        Folder(self.spark, self.path).write_text(f"manifest-{number}.json", json.dumps(made.__dict__))
        self.at = made
        return hit

    def vacuum(self) -> list[str]:
        """Delete versions of buckets and manifests that the present manifest does not name; their names."""
        folder, gone = Folder(self.spark, self.path), []
        for version in [v for v in folder.names(folders=True) if v.startswith("v")]:
            inside = Folder(self.spark, f"{self.path}/{version}")
            for b in inside.names(folders=True):
                if f"{version}/{b}" not in self.at.buckets.values():
                    inside.delete(b)
                    gone.append(f"{version}/{b}")
        for m in folder.names(folders=False):
            if m.startswith("manifest-") and m != f"manifest-{self.at.version}.json":
                folder.delete(m)
        return gone
