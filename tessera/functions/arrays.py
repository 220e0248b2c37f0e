"""Array helpers of built-in higher-order functions, for arrays of any length in a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LONGS = "array<long>"


def _scan(xs: Column, base: Column) -> Column:
    zero = F.struct(F.array().cast(LONGS).alias("a"), base.cast("long").alias("s"))
    return F.aggregate(xs, zero, lambda acc, x: F.struct(
        F.concat(acc["a"], F.array(acc["s"])).cast(LONGS).alias("a"), (acc["s"] + x).cast("long").alias("s")), lambda acc: acc["a"])


def running_starts(lengths: Column, step: int = 128) -> Column:
    """Sum of the entries before each entry.  Growing an array costs its length each time, so runs of ``step``
    entries are summed first and scanned on their own.  ``lengths`` should be a column: a lambda evaluates an
    expression again for each entry."""
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / step).cast("int")),
                       lambda c: F.slice(lengths, c * step + 1, step))
    sums = F.transform(runs, lambda run: F.aggregate(run, F.lit(0).cast("long"), lambda a, x: (a + x).cast("long")))
    return F.when(F.size(lengths) == 0, F.array().cast(LONGS)).otherwise(F.flatten(F.zip_with(runs, _scan(sums, F.lit(0)), _scan)))


def last_before(starts: Column, values: Column, at: Column, step: int = 64) -> Column:
    """For each entry of ``at`` the value whose start is the last one before it (null: none); ``starts`` ascend.
    Two levels: the run of ``step`` starts first, by the first start of each, then the place in it."""
    firsts = F.filter(starts, lambda s, i: i % step == 0)

    def place(x: Column) -> Column:
        run = F.size(F.filter(firsts, lambda s: s < x)) - 1
        return run * step + F.size(F.filter(F.slice(starts, F.greatest(run, F.lit(0)) * step + 1, step), lambda s: s < x))

    return F.transform(at, lambda x: F.get(values, place(x) - 1))
