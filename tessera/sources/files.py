"""File sources and sinks.

Every written intermediate goes to the shared folder of the session
(``spark.checkpoint.dir``), never to a machine-local temporary folder.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from itertools import groupby

from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import normalize_split
from ..session import default_blocks, scratch_path

TSV_WRITE = {"sep": "\t", "quote": "", "escape": "", "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false", "nullValue": ""}


def read_tsv(spark: SparkSession, path: str, schema: StructType | str, header: bool = False,
             quoting: bool = False) -> DataFrame:
    """Tab-separated file with declared columns; ``header=True`` skips
    one line.  By default quotes are plain characters (no glued fields, D8);
    ``quoting=True`` reproduces the glued read that :func:`repair_pair` undoes
    (a doubled quote inside a quoted field is one quote, a backslash is text)."""
    r = spark.read.schema(schema).option("sep", "\t").option("header", header)
    if quoting:
        r = r.option("quote", '"').option("escape", '"')
    else:
        r = r.option("quote", "").option("escape", "")
    return r.csv(path)


def write_tsv(df: DataFrame, path: str, header: bool = False, partition_by: str | None = None) -> str:
    """TSV sink (no quoting, white space kept); with ``partition_by`` one
    directory per value, written in a single pass."""
    w = df.write.mode("overwrite").option("header", header)
    if partition_by:
        w = w.partitionBy(partition_by)
    for k, v in TSV_WRITE.items():
        w = w.option(k, v)
    w.csv(path)
    return path


def write_lines(lines: DataFrame, path: str, header_line: str | None = None) -> str:
    """Write one string column verbatim, one value per line; with
    ``header_line`` every part file starts with that line (so a reader that
    skips one header line per file sees only data).  Values must not hold
    newlines."""
    col = lines.columns[0]
    out = lines.select(F.col(col).alias(header_line or "value"))
    w = (out.write.mode("overwrite").option("sep", "\u0001").option("quote", "")
         .option("escape", "").option("escapeQuotes", "false").option("header", header_line is not None)
         .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false"))
    w.csv(path)
    return path


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Generic scan chosen by extension (csv, tsv, json, jsonl).  Give the
    schema where it is known: inferring it reads the file once more."""
    p = path.rstrip("/").lower()
    if p.endswith(".csv"):
        r = spark.read.option("header", True).option("escape", '"')
        return (r.schema(schema) if schema else r.option("inferSchema", True)).csv(path)
    if p.endswith(".tsv"):
        return read_tsv(spark, path, schema, header=True)
    if p.endswith(".json") or p.endswith(".jsonl"):
        r = spark.read
        return (r.schema(schema) if schema else r).json(path)
    raise ValueError(f"unsupported file type: {path} (csv, tsv, json or jsonl)")


FILE_STEM = r"([^/]+?)(?:\.[^./]*)?$"

#: Name of the payloads without a key, as Spark's partition folders have it.
NO_KEY = "__HIVE_DEFAULT_PARTITION__"

#: Tasks that land payload files, folders they land in and tasks that read files back, at least.
PAYLOAD_BLOCKS = 64


def _payload_blocks(spark: SparkSession) -> int:
    return max(default_blocks(spark), PAYLOAD_BLOCKS)


def _mounted(spark: SparkSession, path: str) -> str | None:
    """The folder behind ``path`` if it is one of a mounted file system, else ``None``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def _land(path: str, key: str) -> Callable[[Iterable[Row]], None]:
    def land(rows: Iterable[Row]) -> None:
        for (folder, name), same in groupby(rows, key=lambda r: (r.folder, r.name)):
            os.makedirs(to := f"{path}/{folder}", exist_ok=True)
            # whole under its name or not there; a task that is run again puts the same files in place
            with open(part := f"{to}/.{TaskContext.get().taskAttemptId()}", "wb") as f:
                for r in same:
                    f.write(r.payload)
                    f.write(b"\n")
            os.replace(part, f"{to}/{key}={name}.txt")
    return land


def write_payload_files(df: DataFrame, key: str, payload: str, path: str) -> str:
    """Land each payload below the new folder ``path`` as a file of its own,
    ended by a newline and named by its URL-encoded key (:func:`payload_name`
    finds it); payloads of one key follow each other in one file.

    On a mounted file system the tasks write the files themselves, side by side
    in a bounded number of folders: Hadoop's local file system starts two
    ``chmod`` processes a file, and Spark's writer makes, moves and lists a
    folder for each key.  Any other store gets Spark's folder for each key."""
    spark = df.sparkSession
    folder = _mounted(spark, path)
    if folder is None:
        df.select(key, payload).repartition(key).write.partitionBy(key).text(path)
        return path
    os.makedirs(folder)
    n = _payload_blocks(spark)
    name = F.url_encode(F.col(key).cast("string"))
    rows = df.select(F.when(F.length(name) > 0, name).otherwise(NO_KEY).alias("name"),
                     F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("payload"))
    rows = rows.repartition(n, "name").sortWithinPartitions("name")
    rows.select(F.pmod(F.hash("name"), F.lit(n)).alias("folder"), "name", "payload").foreachPartition(_land(folder, key))
    return path


def payload_name(key: str) -> str:
    """Pattern of the names that :func:`write_payload_files` gives, in both its layouts."""
    return rf"/{key}=([^/]+?)(?:\.txt|/[^/]*)$"


def read_payload_files(spark: SparkSession, path: str, key: str = "ref", name: str = FILE_STEM,
                       nested: bool = False) -> DataFrame:
    """Landed payload files, one document per file: ``(ref, payload)``
    with ``ref`` = the file name without its extension, or group 1 of another
    ``name`` pattern (``wholetext`` keeps each file in one row); ``nested`` reads
    the folders below ``path`` too.  Spark plans a scan of small files in tasks of
    a few files each; they are put together, so the tasks do not grow with the
    files.  For payloads by the million, see :mod:`tessera.sources.archives`."""
    raw = spark.read.text(path, wholetext=True, recursiveFileLookup=nested)
    name = F.regexp_extract(F.input_file_name(), name, 1)
    found = raw.select(F.coalesce(F.try_url_decode(name), name).alias(key), F.col("value").alias("payload"))
    return found.coalesce(_payload_blocks(spark))


def read_splits(spark: SparkSession, paths: dict[str, str], reader) -> DataFrame:
    """One path per split -> one dataset with a ``split`` column."""
    parts = [reader(spark, p).withColumn("split", F.lit(name)) for name, p in paths.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def with_file_split(df: DataFrame, out: str = "split") -> DataFrame:
    """Split taken from each row's file name."""
    return df.withColumn(out, normalize_split(F.input_file_name()))


def write_split_dataset(df: DataFrame, name: str, split_col: str = "split") -> str:
    """Parquet directory partitioned by split (for partition pruning)."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)
    return path


def read_split(spark: SparkSession, path: str, split: str, split_col: str = "split") -> DataFrame:
    """Named split of a split-partitioned dataset (partition pruning)."""
    return spark.read.parquet(path).where(F.col(split_col) == split)


def write_jsonl(df: DataFrame, path: str, split_col: str | None = "split") -> str:
    """One JSON object per line, one file set per split; nulls are kept."""
    w = df.write.mode("overwrite").option("ignoreNullFields", "false")
    if split_col:
        w = w.partitionBy(split_col)
    w.json(path)
    return path


def write_titles(df: DataFrame, path: str, col: str = "title") -> str:
    """One title per line."""
    df.select(F.col(col).cast("string")).write.mode("overwrite").text(path)
    return path


def materialize(df: DataFrame, path: str, overwrite: bool = False) -> DataFrame:
    """Write once and reuse; rewrite when asked, or when the last write
    did not end."""
    spark = df.sparkSession
    done = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    fs = done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if overwrite or not fs.exists(done):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def materialize_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None,
                         overwrite: bool = False) -> DataFrame:
    """S12 for tables that are joined or grouped by ``keys`` again and again:
    written once as table ``table`` in ``buckets`` buckets of ``keys``, one file
    each and sorted, below ``path`` (default: the shared scratch folder).  Joins
    of tables with as many buckets of the join keys, and groups by them, need no
    exchange.  A table that is there is reused unless overwrite is asked."""
    spark = df.sparkSession
    if overwrite or not spark.catalog.tableExists(table):
        df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option(
            "path", path or scratch_path(spark, table)).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return spark.table(table)
