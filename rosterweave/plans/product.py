"""Command line: python -m rosterweave.plans.product COUNTRY [websites] dayN DATA DELIVERY

DATA has a folder a site: a line file (see sources.readers), a Parquet table companies.parquet, or, for websites, websites.txt.
"""

from __future__ import annotations

import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterweave.functions import emails
from rosterweave.functions.text import text
from rosterweave.operators.delta import union_in_order
from rosterweave.plans import delivery
from rosterweave.sources import readers

SCHEMA = "orgnr string, company_name string, representative string, website string, homepage string, phone string, address string, email string, emails string"
#: Countries whose sites have files of their own.
BY_SITE = ("japan", "brazil", "unitedstates", "germany", "unitedarabemirates")


def records_of(df: DataFrame) -> DataFrame:
    """A site's rows in the form that delivery takes; columns that a site lacks are blank."""
    have = set(df.columns)
    pick = lambda *names: F.coalesce(*[F.nullif(text(n), F.lit("")) for n in names if n in have], F.lit(""))
    found = emails.split(pick("emails", "email"), placeholders=False)
    ordered = "seq" if "seq" in have else F.monotonically_increasing_id().alias("seq")
    return df.select(pick("orgnr", "cvr", "member_id").alias("orgnr"), pick("company_name").alias("company_name"), pick("representative", "ceo").alias("representative"), pick("website", "homepage").alias("website"), pick("phone").alias("phone"), pick("address").alias("address"), found.alias("emails"), ordered)


def load_sites(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """SC1-SC5: a site's table, else the first of its line files; sites without either are left out."""
    out = {}
    for site in readers.Folder(spark, root).names(folders=True):
        folder = readers.Folder(spark, f"{root}/{site}")
        if folder.has("companies.parquet"):
            df = spark.read.parquet(f"{folder.path}/companies.parquet")
        elif name := next((c for c in readers.CANDIDATES if folder.has(c)), None):
            df = readers.json_lines(spark, f"{folder.path}/{name}", SCHEMA)
        else:
            continue
        out[site] = records_of(df).withColumn("site_ord", F.lit(len(out)))
    return out


def run(spark: SparkSession, country: str, kind: str, label: str, data: str, target: str) -> dict:
    if kind == "websites":
        folder = readers.Folder(spark, data)
        sites = {s: readers.website_list(spark, f"{data}/{s}/websites.txt") for s in folder.names(folders=True) if readers.Folder(spark, f"{data}/{s}").has("websites.txt")}
        return delivery.deliver_websites(spark, sites, target, label, country)
    if country.lower() not in delivery.COUNTRIES:
        raise ValueError(f"no such country: {country}")
    spec, sites = delivery.COUNTRIES[country.lower()], load_sites(spark, data)
    if country.lower() in BY_SITE:
        return delivery.deliver_sites(spark, {s: df.withColumn("site_ord", F.lit(0)) for s, df in sites.items()}, target, label, spec)
    # the order within a site comes as numbers or as places in files; as (block, line) or (0, number) both are structs of longs
    plain = []
    for df in sites.values():
        place = ("seq.block", "seq.line") if df.schema["seq"].dataType.typeName() == "struct" else (F.lit(0), "seq")
        one, two = (F.col(c) if isinstance(c, str) else c for c in place)
        plain.append(df.withColumn("seq", F.struct(one.cast("long").alias("block"), two.cast("long").alias("line"))).drop("site_ord"))
    if not plain:
        raise ValueError(f"no sites in {data}")
    return delivery.deliver(spark, union_in_order(*plain), target, label, spec)


def main(args: list[str]) -> int:
    if len(args) not in (4, 5) or (len(args) == 5 and args[1] != "websites"):
        print(__doc__, file=sys.stderr)
        return 2
    country, kind, (label, data, target) = args[0], "websites" if len(args) == 5 else "companies", args[-3:]
    spark = SparkSession.builder.appName("delivery").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        print(json.dumps(run(spark, country, kind, label, data, target), ensure_ascii=False, indent=2))
    except ValueError as e:
        print(e, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
