"""Session helpers: building a session for tests and benches, and the shared
folder used for lineage cuts and scratch tables.

On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared file
system path).  We only set our own when the session has none, as in tests.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StructField, StructType

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # whole documents cross into the pandas UDFs: small Arrow batches keep a
    # Python worker's batch to ~1,000 texts instead of the default 10,000
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Broadcast only below this size; every explicit broadcast in the
    # library is additionally behind a bounded row count (a parameter).
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app: str = "tessera", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a private one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, wherever the driver was started
    from: a zip of its modules, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-ship-"), f"{os.path.basename(here)}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera-scratch/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's written intermediates; call it when its
    results have been read."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(
        f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-scratch/{spark.sparkContext.applicationId}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` once as a Parquet table in the shared checkpoint
    folder and continue from it.  One pass (a reliable ``checkpoint()``
    computes the plan twice unless cached), survives executor loss, and the
    plan after it starts from a file scan with pushdown and pruning."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    # the schema is known: no footer-reading job to infer it again
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """The session with ``conf`` set, and as it was afterwards."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def freed_shuffles(spark: SparkSession):
    """Shuffle files of the queries run within go when their query ends, not when the driver collects its garbage."""
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def deal(df: DataFrame, slot: Column, slots: int, name: str = "dealt") -> tuple[str, DataFrame]:
    """Write ``df`` once, without a shuffle or sort, to a folder for each value of ``slot`` (0 .. ``slots`` - 1): each task
    has a file open for every slot.  Returns the path and the table with its column ``slot``, which prunes folders."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(slots)}):
        df.withColumn("slot", slot.cast("int")).write.option("compression", "zstd").partitionBy("slot").parquet(path)
    return path, spark.read.schema(StructType([*df.schema.fields, StructField("slot", IntegerType())])).parquet(path)


def drop_folders(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete written intermediates of the shared folder when they have been read."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def default_blocks(spark: SparkSession) -> int:
    """Blocks of the distributed prefix sums: one per shuffle partition."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
