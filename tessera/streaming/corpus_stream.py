"""Structured Streaming versions of the parts of the corpus path that carry no
cross-row state.

The reference has no streaming.  Article parsing (T15) is a per-row map, so
landed page files can be parsed as they arrive; token counts (the unigram
model, L1) are a plain streaming aggregation whose state is one row per
token.  The index parse (J1), the token stream (K6) and the seeded split (R2)
need all rows and stay batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import explode_nonempty, tokenize
from ..operators.html import parse_article

PAGE_SCHEMA = "page_id bigint, url string, html string"


def article_stream(spark: SparkSession, source_dir: str, schema: str = PAGE_SCHEMA,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed page files (Parquet) -> ``(page_id, content, ok)`` as a stream."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_article(r.parquet(source_dir), "page_id", "html")


def token_count_stream(docs: DataFrame, text: str = "text") -> DataFrame:
    """Running token counts of a document stream (state: one row per token)."""
    toks = docs.select(explode_nonempty(tokenize(text)).alias("tok")).where(F.col("tok").isNotNull())
    return toks.groupBy("tok").agg(F.count(F.lit(1)).alias("cnt"))


def write_jsonl_stream(df: DataFrame, out_dir: str, checkpoint_location: str,
                       available_now: bool = True) -> StreamingQuery:
    """Append parsed articles to a JSON-lines sink with exactly-once file
    commits (the checkpoint location must be on shared storage)."""
    w = (df.writeStream.format("json").option("path", out_dir)
         .option("checkpointLocation", checkpoint_location).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def write_parquet_stream(df: DataFrame, out_dir: str, checkpoint_location: str,
                         available_now: bool = True) -> StreamingQuery:
    """Append to a Parquet sink (exactly-once file commits)."""
    w = (df.writeStream.format("parquet").option("path", out_dir)
         .option("checkpointLocation", checkpoint_location).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def write_counts_stream(df: DataFrame, sink, checkpoint_location: str,
                        available_now: bool = True, mode: str = "update") -> StreamingQuery:
    """Hand each micro-batch of counts to ``sink(batch_df, epoch_id)`` (e.g. a
    MERGE into a table); ``update`` mode emits only changed tokens,
    ``complete`` the whole state."""
    w = (df.writeStream.outputMode(mode).foreachBatch(sink)
         .option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
