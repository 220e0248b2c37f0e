"""The training-data pipeline: five stages, each one operator of tessera.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs.  Toxic documents go, one
document of each near-duplicate group stays, documents that leak a benchmark
item go, secrets are replaced in the texts, and the rest is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate as dec
from tessera.llm import packing, secrets, simhash, toxicity
from tessera.llm.common import cut
from tessera.sources.tables import load


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, load(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, out="__toxicity")
    return scored.where("__toxicity.predicted = 0").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dec.decontaminate(docs, load(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack(docs)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [("toxicity", toxic), ("near_duplicates", near_duplicates), ("decontamination", decontaminate),
          ("secrets", secret_scan), ("packing", pack)]

#: Learnt weights, SimHash and byte-pair ids are no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        df = cut(stage(spark, df, sf_dir), f"stage-{name}")
    return df
