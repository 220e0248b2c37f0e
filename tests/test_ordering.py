"""Distributed global offsets (W3) with skewed keys."""

import random

from pyspark.sql import functions as F

from tessera.operators.ordering import global_offsets, global_row_number


def test_offsets_with_hot_leading_key(spark):
    rnd = random.Random(6)
    rows = [(0 if rnd.random() < 0.4 else rnd.randint(1, 50), i, rnd.randint(0, 9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "a long, b long, n long")
    got = {(r.a, r.b): r.offset for r in global_offsets(df, ["a", "b"], "n", blocks=7).collect()}
    acc = 0
    for a, b, n in sorted(rows):
        assert got[(a, b)] == acc
        acc += n


def test_row_number_strings(spark):
    keys = [f"k{i:05d}" for i in random.Random(1).sample(range(100000), 500)]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r.k: r.rn for r in global_row_number(df, ["k"], blocks=4).collect()}
    assert [got[k] for k in sorted(keys)] == list(range(1, 501))


def test_many_more_blocks_than_rows(spark):
    rows = [(d, p, (d * 3 + p) % 4) for d in range(40) for p in range(5)]
    df = spark.createDataFrame(rows, "d long, p long, n long")
    out = global_offsets(df, ["d", "p"], "n", blocks=500)
    assert "TakeOrderedAndProject" not in out._jdf.queryExecution().executedPlan().toString()
    got = {(r.d, r.p): r.offset for r in out.collect()}
    acc = 0
    for d, p, n in rows:
        assert got[(d, p)] == acc
        acc += n


def test_offsets_of_no_rows(spark):
    df = spark.range(0).withColumn("n", F.lit(2))
    assert global_offsets(df, ["id"], "n", blocks=4).count() == 0
