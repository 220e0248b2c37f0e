"""Landed payloads packed into archives, read in batch or as a stream.

An archive is a gzip file of JSON lines, one member a line: ``ref``, ``crc``
(CRC-32 of the payload's UTF-8 bytes) and ``payload``.  A crawl of millions of
pages is thousands of files instead of millions; a file is read by one task and
Spark's own text source does the reading, so archives may lie in any store that
Spark reads.  A member that cannot be used is a row with ``ok = false`` and a
reason, never an error and never dropped (D5).  A file cut off in the middle of
its gzip stream fails the read: its members are unknown.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

MEMBER = "ref string, crc long, payload string, _broken string"


def checksum(payload: Column) -> Column:
    return F.crc32(payload.cast("binary"))


def member(ref: Column, payload: Column, crc: Column | None = None) -> Column:
    """One line of an archive."""
    return F.to_json(F.struct(ref.cast("string").alias("ref"), (checksum(payload) if crc is None else crc).alias("crc"),
                              payload.alias("payload")))


def write_archives(lines: DataFrame, path: str, per_file: int = 10_000) -> str:
    """Write member lines (one string column), at most ``per_file`` to an archive."""
    col = lines.columns[0]
    lines.select(F.col(col).alias("value")).write.mode("overwrite").option("compression", "gzip").option(
        "maxRecordsPerFile", per_file).text(path)
    return path


def read_archives(reader: DataFrameReader | DataStreamReader, path: str) -> DataFrame:
    """``(ref, payload, ok, reason)`` of every member below ``path``; ``reader`` is ``spark.read`` or
    ``spark.readStream``.  Reasons: ``not a member`` (no JSON object; its ref is unknown), ``no ref``, ``no payload``, ``checksum``; the payload of a member
    that is not ok is null."""
    m = F.from_json("value", MEMBER, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    rows = reader.text(path).select(m.alias("m")).select(F.col("m").isNull().alias("_blank"), "m.*")
    reason = (F.when(F.col("_blank") | F.col("_broken").isNotNull(), "not a member").when(F.col("ref").isNull(), "no ref")
              .when(F.col("payload").isNull(), "no payload")
              .when(~F.col("crc").eqNullSafe(checksum(F.col("payload"))), "checksum"))
    rows = rows.select("ref", "payload", reason.alias("reason"))
    return rows.select("ref", F.when(F.col("reason").isNull(), F.col("payload")).alias("payload"),
                       F.col("reason").isNull().alias("ok"), "reason")
