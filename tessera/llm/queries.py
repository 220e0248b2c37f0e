"""One query for each operator, over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import load

from . import (align, chat, decontaminate, graph, license_scan, packing, pii, quality, repair, secrets, sharding, simhash,
               toxicity)
from .common import documents

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return deco


@query("op1_simhash")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(documents(spark, sf_dir))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op2_pii")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.scan(documents(spark, sf_dir)))


@query("op3_secrets")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(documents(spark, sf_dir)))


@query("op4_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir))


@query("op5_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packing.pack(documents(spark, sf_dir))
    return rows.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, load(spark, sf_dir, "labels"))
    t = F.col("toxicity")
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), t["score"].alias("score"),
        t["predicted"].alias("predicted"), t["passages"].alias("passages"))


@query("op7_decontamination")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaking(documents(spark, sf_dir), load(spark, sf_dir, "benchmark"))


@query("op8_license", license_scan.sql())
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


@query("op9_chat", chat.SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.with_trap(load(spark, sf_dir, "conversations"), spark)
    return chat.digest(chat.read_back(chat.render(rows)))


@query("op10_sharding")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot", "version")


@query("op12_align")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignments(documents(spark, sf_dir)).drop("a", "b")


@query("op11_graph")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.near_duplicates(load(spark, sf_dir, "embeddings"))


@query("op13_repair")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.summaries(repair.damaged(load(spark, sf_dir, "conversations")))
