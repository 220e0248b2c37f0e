"""Article paragraphs are cleaned in slices: few strings are Python objects at a time, and all come back in place."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from tessera.functions import udfs


def test_elements_in_slices(monkeypatch):
    monkeypatch.setattr(udfs, "SLICE", 5)
    rng = random.Random(1)
    lists = [rng.choice([None, [], [None], [f"t{rng.random()}" for _ in range(rng.randint(1, 13))]]) for _ in range(200)]
    whole = pa.array(lists, pa.list_(pa.string()))
    for s in (whole, whole.slice(7, 90), whole.slice(0, 0), pa.array([None, []], pa.list_(pa.string()))):
        got = udfs._map_arrays(s, str.upper)
        assert got.to_pylist() == [x and [v and v.upper() for v in x] for x in s.to_pylist()]


def test_no_batch_of_articles_is_python_objects(spark):
    """The cleaning gets Arrow arrays, not a pandas column with an object for each text of the batch."""
    rows = [(1, ["<b>x</b>", None, "é&#233;"]), (2, []), (3, None)]
    df = spark.createDataFrame(rows, "k long, a array<string>").select("k", udfs.clean_markup_udf("a").alias("m"), udfs.clean_array_udf("a").alias("c"))
    assert [tuple(r) for r in df.orderBy("k").collect()] == [(1, ["x", None, "éé"], ["x", None, "é&#233;"]), (2, [], []), (3, None, None)]
    plan = df.select(F.col("m"), F.col("c"))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan
    seen = []
    udfs._map_arrays(pa.array([["x"] * 2000], pa.list_(pa.string())), lambda v: seen.append(v) or v)
    assert len(seen) == 2000
