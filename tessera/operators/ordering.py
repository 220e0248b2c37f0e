"""Global order without a one-task window.

``Window.orderBy(...)`` with no partition key moves every row into one task.
Corpus-wide offsets (the token stream), ordinals of a seeded shuffle and
average ranks all need a running sum over the *global* order, so they go
through :func:`global_offsets` instead:

1. the rows are dealt by ranges of the whole order key (``repartitionByRange``,
   so a hot value of a leading column is split) and written once to the shared
   folder with the number of their range, the block.  Spark samples the bounds
   on the executors and sends a bounded number of keys to the driver;
2. running sum inside each block: a window partitioned by ``block``, which holds
   about ``rows / blocks`` rows;
3. block totals (``blocks`` rows) get an exclusive prefix sum and are joined
   back with a broadcast whose size is bounded by ``blocks``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, default_blocks

_BLK = "_tsr_blk"


def global_offsets(df: DataFrame, order_cols: Sequence[str], size_col: str | None = None,
                   out: str = "offset", blocks: int | None = None, carry: str | None = None) -> DataFrame:
    """Add ``out`` = exclusive running sum of ``size_col`` (1 per row when None)
    over the global ascending order of ``order_cols`` (which must be unique and
    not null).  With ``carry``, that column becomes its last value that is not
    null among the rows before.  All columns of ``df`` go through the range
    exchange and are written once when this is called: hand over keys and sizes
    and join what is heavy (see :func:`offset_index`)."""
    blocks = blocks or default_blocks(df.sparkSession)
    ranges = df.repartitionByRange(blocks, *order_cols)
    keyed = cut_lineage(ranges.withColumn(_BLK, F.spark_partition_id()), "offsets")
    size = F.col(size_col).cast("long") if size_col else F.lit(1).cast("long")
    w = Window.partitionBy(_BLK).orderBy(*order_cols)
    upto, before = (w.rowsBetween(Window.unboundedPreceding, at) for at in (Window.currentRow, -1))
    running = keyed.withColumn("_tsr_incl", F.sum(size).over(upto))
    ends = [F.sum(size).alias("_tsr_tot")]
    # <= blocks rows: a one-partition window here is bounded by construction.
    blocks_before = Window.orderBy(_BLK).rowsBetween(Window.unboundedPreceding, -1)
    starts = [F.coalesce(F.sum("_tsr_tot").over(blocks_before), F.lit(0).cast("long")).alias("_tsr_base")]
    if carry:
        ends.append(F.max_by(carry, F.when(F.col(carry).isNotNull(), F.struct(*order_cols))).alias("_tsr_last"))
        starts.append(F.last("_tsr_last", ignorenulls=True).over(blocks_before).alias("_tsr_carry"))
        running = running.withColumn("_tsr_seen", F.last(carry, ignorenulls=True).over(before))
    prefix = keyed.groupBy(_BLK).agg(*ends).select(_BLK, *starts)
    joined = running.join(F.broadcast(prefix), _BLK, "inner").withColumn(out, F.col("_tsr_base") + F.col("_tsr_incl") - size)
    if carry:
        joined = joined.withColumn(carry, F.coalesce("_tsr_seen", "_tsr_carry"))
    return joined.drop(_BLK, "_tsr_incl", "_tsr_base", "_tsr_seen", "_tsr_carry")


def offset_index(df: DataFrame, order_cols: Sequence[str], size_col: str | None = None, out: str = "offset",
                 blocks: int | None = None, carry: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """``(order_cols, out[, carry][, keep])``, written: what :func:`global_offsets` adds,
    from the keys and sizes of a written table alone, to be joined back by key."""
    narrow = df.select(*order_cols, *dict.fromkeys([c for c in (size_col, carry, *keep) if c]))
    found = global_offsets(narrow, order_cols, size_col, out, blocks, carry)
    return cut_lineage(found.select(*order_cols, out, *([carry] if carry else []), *keep), "offset-index")


def global_row_number(df: DataFrame, order_cols: Sequence[str], out: str = "rn",
                      blocks: int | None = None) -> DataFrame:
    """1-based row number in the global order, distributed (see module doc)."""
    r = global_offsets(df, order_cols, None, "_tsr_off", blocks)
    return r.withColumn(out, F.col("_tsr_off") + 1).drop("_tsr_off")
