"""Streams with state by key (J2 and U4 as data arrive).

``latest`` keeps for each key the row of the largest order (a later fetch
replaces an earlier one, as repeated assignment does), ``earliest`` the one of
the smallest (the first listing of a ref stays).  Both are streaming aggregates,
so Spark keeps one row of state for each key, checkpoints it, and merges late
and repeated events without regard to their order of arrival.

The sink writes each micro-batch's changed keys under its epoch and overwrites
that epoch when it is replayed after a failure; a key's newest epoch is its
value.  So a restart from the checkpoint neither loses nor doubles anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def _by_key(events: DataFrame, key: str, order: list[str], pick) -> DataFrame:
    cols = [c for c in events.columns if c != key]
    best = events.groupBy(key).agg(pick(F.struct(*cols), F.struct(*order)).alias("_r"))
    return best.select(key, *(F.col("_r")[c].alias(c) for c in cols))


def latest(events: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Last write wins: the row of the largest ``order`` for each key; batch or stream."""
    return _by_key(events, key, order, F.max_by)


def earliest(events: DataFrame, key: str, order: list[str]) -> DataFrame:
    """First seen stays: the row of the smallest ``order`` for each key; batch or stream."""
    return _by_key(events, key, order, F.min_by)


def write_keyed(state: DataFrame, table: str, checkpoint_location: str, available_now: bool = True) -> StreamingQuery:
    """Start writing the changed keys of every micro-batch to ``table``."""
    def sink(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/epoch={epoch}")

    w = state.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint_location)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")).start()


def finish(query: StreamingQuery) -> None:
    """Wait for an available-now query and raise what ended it."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def read_keyed(spark: SparkSession, table: str, key: str, schema: str) -> DataFrame:
    """The current row of every key."""
    rows = spark.read.schema(f"{schema}, epoch long").parquet(table)
    return latest(rows, key, ["epoch"]).drop("epoch")
