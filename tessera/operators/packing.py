"""K9 across rows: greedy packing of all sentences of a group, in order, as a parallel scan.

Greedy packing is a chain: whether a sentence opens a pack depends on how full
the pack before it is.  But all a run of sentences needs to know of what lies
before it is that fill, a number from 0 to the limit (or ``closed``, one above
it: nothing open, or a sentence longer than the limit).  So each block of
consecutive rows becomes a table from the fill on entry to the fill on exit and
the packs opened in between; tables compose, and every task works on one block
or on ``FAN`` tables:

1. the order keys, the group and the token counts (no text) are dealt by ranges
   of (group, keys) and written; each block of a group makes its table;
2. tables are composed ``FAN`` at a time, level by level, up to one per group;
3. going down again, every table learns its entry fill and the packs before it;
4. blocks replay their sentences from their entry and give each row its runs
   ``(first sentence, sentences, tokens, pack)``;
5. runs go back to the rows by key, sentences of a run are joined in place, and
   the pieces of a pack (at most ``limit`` tokens, or one longer sentence) meet
   in one group.

A group may hold any share of the table: no task sees more than its block.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import TOKEN_PATTERN, explode_nonempty
from ..session import cut_lineage, default_blocks

#: Tables that one task composes.
FAN = 64


def next_breaks(ns: np.ndarray, limit: int) -> np.ndarray:
    """For each sentence, the sentence that opens the next pack when this one opens a pack (``len(ns)``: none here)."""
    ends = np.cumsum(ns)
    return np.maximum(np.searchsorted(ends, ends - ns + limit, "right"), np.arange(1, len(ns) + 1))


def block_table(ns: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(exit, opened): fill on exit and packs opened for each fill 0 .. limit + 1 on entry."""
    m, ends = len(ns), np.cumsum(ns)
    after, opened, exits = next_breaks(ns, limit).tolist(), [0] * (m + 1), [0] * (m + 1)
    total, fills = int(ends[-1]) if m else 0, (ends - ns).tolist()
    for j in range(m - 1, -1, -1):
        opened[j] = opened[after[j]] + 1
        exits[j] = exits[after[j]] if after[j] < m else min(total - fills[j], limit + 1)
    entry = np.arange(limit + 2)
    first = np.searchsorted(ends, limit - entry, "right")
    return np.where(first < m, np.array(exits)[first], np.minimum(entry + total, limit + 1)), np.array(opened)[first]


def replay(ns: np.ndarray, limit: int, entry: int) -> np.ndarray:
    """Of each sentence: packs opened in this block up to and with it."""
    after, opens = next_breaks(ns, limit), np.zeros(len(ns), dtype=np.int64)
    j = int(np.searchsorted(np.cumsum(ns), limit - entry, "right"))
    while j < len(ns):
        opens[j] = 1
        j = int(after[j])
    return np.cumsum(opens)


def _sizes(pdf: pd.DataFrame, keys: Sequence[str]) -> tuple[pd.DataFrame, np.ndarray]:
    pdf = pdf.sort_values(list(keys), kind="stable")
    parts = [np.asarray(x, dtype=np.int64) for x in pdf["ns"]]
    return pdf, np.concatenate(parts) if parts else np.empty(0, np.int64)


def _tables(keys: Sequence[str], limit: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, ns = _sizes(pdf, keys)
        exits, opened = block_table(ns, limit)
        return pd.DataFrame({"grp": pdf["grp"].iloc[:1].to_numpy(), "blk": pdf["blk"].iloc[:1].to_numpy(),
                             "exit": [exits], "opened": [opened]})

    return run


def _composed(pdf: pd.DataFrame) -> pd.DataFrame:
    """One table of several that follow each other."""
    pdf = pdf.sort_values("blk")
    exits, opened = np.asarray(pdf["exit"].iloc[0]), np.asarray(pdf["opened"].iloc[0])
    for e, o in zip(pdf["exit"].iloc[1:], pdf["opened"].iloc[1:]):
        exits, opened = np.asarray(e)[exits], opened + np.asarray(o)[exits]
    return pd.DataFrame({"grp": pdf["grp"].iloc[:1].to_numpy(), "blk": pdf["up"].iloc[:1].to_numpy(), "exit": [exits], "opened": [opened]})


def _entered(pdf: pd.DataFrame) -> pd.DataFrame:
    """Entry fill and packs before each of the tables under one parent."""
    pdf = pdf.sort_values("blk")
    fill, base, out = int(pdf["entry"].iloc[0]), int(pdf["base"].iloc[0]), []
    for blk, e, o in zip(pdf["blk"], pdf["exit"], pdf["opened"]):
        out.append((blk, fill, base))
        fill, base = int(e[fill]), base + int(o[fill])
    made = pd.DataFrame(out, columns=["blk", "entry", "base"])
    made.insert(0, "grp", pdf["grp"].iloc[0])
    return made


def _runs(keys: Sequence[str], limit: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """For each row: where its packs begin, and their numbers."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, ns = _sizes(pdf, keys)
        pack = int(pdf["base"].iloc[0]) - 1 + replay(ns, limit, int(pdf["entry"].iloc[0]))
        out, at = [], 0
        for size in pdf["ns"].map(len):
            own, n = pack[at:at + size], ns[at:at + size]
            first = np.flatnonzero(np.diff(own, prepend=-1))
            out.append([{"first": int(a), "n": int(b - a), "tokens": int(n[a:b].sum()), "pack": int(own[a])}
                        for a, b in zip(first, [*first[1:], size])])
            at += size
        return pdf[list(keys)].assign(grp=pdf["grp"], runs=out)

    return run


def pack_runs(df: DataFrame, group: str, keys: Sequence[str], ns: str, limit: int = 1024,
              blocks: int | None = None) -> DataFrame:
    """``(keys, grp, runs)``: for each row, the packs its sentences fall into.
    ``ns`` holds the token counts of the row's sentences; ``keys`` order the rows
    of a group and must be unique and not null, the group may be null."""
    keys = list(keys)
    spark = df.sparkSession
    blocks = blocks or default_blocks(spark)
    own = df.where(F.size(ns) > 0).select(F.col(group).alias("grp"), *keys, F.col(ns).alias("ns"))
    own = cut_lineage(own.repartitionByRange(blocks, F.col("grp"), *keys).withColumn("blk", F.spark_partition_id().cast("long")), "pack-sizes")
    kinds = dict((f.name, f.dataType.simpleString()) for f in own.schema.fields)
    table = f"grp {kinds['grp']}, blk long, exit array<int>, opened array<long>"
    levels = [cut_lineage(own.groupBy("grp", "blk").applyInPandas(_tables(keys, limit), table), "pack-tables")]
    n = blocks  # block numbers are below this
    while n > 1:
        up = levels[-1].withColumn("up", F.floor(F.col("blk") / FAN))
        levels.append(cut_lineage(up.groupBy("grp", "up").applyInPandas(_composed, table), "pack-tables"))
        n = -(-n // FAN)
    at = levels[-1].select("grp", "blk", F.lit(limit + 1).alias("entry"), F.lit(0).cast("long").alias("base"))
    for tables in reversed(levels[:-1]):
        above = at.select(F.col("grp").alias("g"), F.col("blk").alias("u"), "entry", "base")
        below = tables.withColumn("up", F.floor(F.col("blk") / FAN))
        both = below.join(above, F.col("grp").eqNullSafe(F.col("g")) & (F.col("up") == F.col("u")))
        at = cut_lineage(both.select("grp", "up", "blk", "exit", "opened", "entry", "base").groupBy("grp", "up").applyInPandas(
            _entered, f"grp {kinds['grp']}, blk long, entry int, base long"), "pack-entries")
    entries = at.select(F.col("grp").alias("g"), F.col("blk").alias("b"), "entry", "base")
    rows = own.join(entries, F.col("grp").eqNullSafe(F.col("g")) & (F.col("blk") == F.col("b"))).drop("g", "b")
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keys), f"grp {kinds['grp']}",
                        "runs array<struct<first:int,n:int,tokens:long,pack:long>>"])
    return rows.groupBy("grp", "blk").applyInPandas(_runs(keys, limit), schema)


def pack_groups(df: DataFrame, group: str, keys: Sequence[str], sentences: str, limit: int = 1024,
                blocks: int | None = None) -> DataFrame:
    """K9 over groups of any size: ``(group, pack, n_sentences, n_tokens, text)``.
    Successive sentences of a group, in the order of ``keys`` and of their array,
    join a pack while its tokens stay within ``limit``; a longer sentence is a
    pack of its own.  Packs cross rows, never groups."""
    keys = list(keys)
    sizes = F.transform(sentences, lambda s: F.regexp_count(s, F.lit(TOKEN_PATTERN)))
    runs = pack_runs(df.select(group, *keys, sizes.alias("_n")), group, keys, "_n", limit, blocks).drop("grp")
    pieces = df.select(group, *keys, sentences).join(runs, keys).select(
        group, *keys, sentences, explode_nonempty("runs").alias("r")).where("r is not null")
    pieces = pieces.select(group, F.col("r.pack").alias("pack"), F.col("r.n").alias("n"), F.col("r.tokens").alias("tokens"), F.struct(
        *keys, F.array_join(F.slice(sentences, F.col("r.first") + 1, F.col("r.n")), " ").alias("t")).alias("piece"))
    return pieces.groupBy(group, "pack").agg(
        F.sum("n").cast("long").alias("n_sentences"), F.sum("tokens").alias("n_tokens"),
        F.array_join(F.transform(F.array_sort(F.collect_list("piece")), lambda p: p["t"]), " ").alias("text"))
