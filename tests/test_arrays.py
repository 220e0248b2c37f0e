"""Array scans against plain Python."""

import random
from itertools import accumulate

from pyspark.sql import functions as F

from tessera.functions.arrays import last_before, running_starts


def test_running_starts(spark):
    rng = random.Random(1)
    rows = [(i, [rng.randint(0, 9) for _ in range(n)]) for i, n in enumerate([0, 1, 2, 127, 128, 129, 256, 1000])]
    got = spark.createDataFrame(rows, "i int, x array<int>").select("i", running_starts(F.col("x")).alias("s")).collect()
    assert {r.i: r.s for r in got} == {i: [0, *accumulate(x)][:len(x)] for i, x in rows}


def test_last_before(spark):
    rng = random.Random(2)
    rows = []
    for i, n in enumerate([0, 1, 5, 63, 64, 65, 300]):
        starts = sorted(rng.sample(range(2000), n))
        rows.append((i, starts, [None if rng.random() < 0.1 else s * 10 for s in starts], [rng.randrange(2000) for _ in range(50)] + starts[:5]))
    df = spark.createDataFrame(rows, "i int, s array<long>, v array<long>, at array<long>")
    got = {r.i: r.d for r in df.select("i", last_before(F.col("s"), F.col("v"), F.col("at")).alias("d")).collect()}
    for i, s, v, at in rows:
        assert got[i] == [next((b for a, b in reversed(list(zip(s, v))) if a < x), None) for x in at]
