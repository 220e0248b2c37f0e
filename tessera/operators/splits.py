"""Seeded splits, shuffles and samples.

Order keys are ``md5('<seed>:<key>')`` so the same split comes out of any
engine and out of every recompute (the reference's split was unseeded, D6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import md5_order_key, md5_unit
from .ordering import global_row_number


def split_fixed(df: DataFrame, key: str, n_test: int = 60, n_valid: int = 60,
                seed: int = 42, out: str = "split") -> DataFrame:
    """The first ``n_test`` keys in seeded order are ``test``, the next
    ``n_valid`` are ``valid``, all others ``train``.

    The held-out keys are a top-k (``TakeOrderedAndProject``, no full sort) of
    ``n_test + n_valid`` rows - bounded by the parameters, not by the data.  The
    last key of each part is its bound, and a row's part follows from comparing
    its own order key with the two bounds: no join, and no repeated top-k when
    the split feeds several jobs.  ``key`` must be unique; a null key is ``train``.
    """
    n = n_test + n_valid
    h = md5_order_key(seed, F.col(key))
    held = (df.where(F.col(key).isNotNull()).select(key, h.alias("_tsr_h"))
            .orderBy("_tsr_h", key).limit(n).collect())

    def among_first(m: int):
        if not held or m <= 0:
            return F.lit(False)
        last = held[min(m, len(held)) - 1]
        return (h < last["_tsr_h"]) | ((h == last["_tsr_h"]) & (F.col(key) <= F.lit(last[key])))

    return df.withColumn(out, F.when(among_first(n_test), F.lit("test"))
                         .when(among_first(n), F.lit("valid")).otherwise(F.lit("train")))


def split_fraction(df: DataFrame, key: str, test: float = 0.2, valid: float = 0.2,
                   seed: int = 42, out: str = "split") -> DataFrame:
    """Seeded fractional split: a row-local md5 draw, no shuffle and no
    global order (for training sets whose held-out part grows with them)."""
    u = md5_unit(F.lit(seed), F.col(key))
    return df.withColumn(out, F.when(u < test, F.lit("test"))
                         .when(u < test + valid, F.lit("valid")).otherwise(F.lit("train")))


def shuffle(df: DataFrame, key: str, seed: int = 42, ordinal: str | None = "ord") -> DataFrame:
    """Seeded full shuffle.  With ``ordinal`` the position is a column
    (computed by distributed offsets, no one-task window) and carries the
    order; without it the rows are sorted for a sink."""
    keyed = df.withColumn("_tsr_h", md5_order_key(seed, F.col(key)))
    if ordinal:
        if df.columns == [key]:
            return global_row_number(keyed, ["_tsr_h", key], ordinal).drop("_tsr_h")
        # the order is found from the keys alone; the rows are only joined with their places
        return df.join(global_row_number(keyed.select("_tsr_h", key), ["_tsr_h", key], ordinal).drop("_tsr_h"), key)
    return keyed.orderBy("_tsr_h", key).drop("_tsr_h")


def sample_n(df: DataFrame, key: str, n: int = 3, seed: int = 42) -> DataFrame:
    """``n`` rows for inspection, seeded; a top-k, never a full sort."""
    return (df.withColumn("_tsr_h", md5_order_key(seed, F.col(key)))
            .orderBy("_tsr_h", key).limit(n).drop("_tsr_h"))
