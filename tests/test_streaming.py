"""Structured Streaming corpus path equals the batch parse."""

from tessera.operators.html import parse_article
from tessera.session import scratch_path
from tessera.streaming.corpus_stream import (article_stream, token_count_stream, write_counts_stream,
                                             write_jsonl_stream)

SF = "/root/testdata/sf0.001"


def test_article_stream_matches_batch(spark):
    src = scratch_path(spark, "landed")
    spark.read.parquet(f"{SF}/pages.parquet").repartition(3).write.parquet(src)
    out, ck = scratch_path(spark, "stream_out"), scratch_path(spark, "stream_ck")
    q = write_jsonl_stream(article_stream(spark, src, max_files_per_trigger=1), out, ck)
    q.awaitTermination(120)
    got = spark.read.schema("page_id long, content array<string>, ok boolean").json(out)
    batch = parse_article(spark.read.parquet(f"{SF}/pages.parquet"), "page_id", "html")
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_token_counts_stream(spark):
    src = scratch_path(spark, "docs_landed")
    spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").repartition(2).write.parquet(src)
    seen = {}

    def sink(batch, _epoch):
        for r in batch.collect():
            seen[r.tok] = r.cnt

    stream = spark.readStream.schema("doc_id long, text string").option("maxFilesPerTrigger", 1).parquet(src)
    q = write_counts_stream(token_count_stream(stream), sink, scratch_path(spark, "cnt_ck"))
    q.awaitTermination(120)
    from pyspark.sql import functions as F
    from tessera.functions.text import tokenize
    want = {r.tok: r["count"] for r in spark.read.parquet(src).select(F.explode(tokenize("text")).alias("tok"))
            .groupBy("tok").count().collect()}
    assert seen == want
