"""The stored slot map: edited from run to run, and the byte law with records that repeat."""

import numpy as np
import pytest
from tessera.llm import sharding
from tessera.session import scratch_path

FIELDS = "doc_id long, text string"


def docs(spark, lo, hi, size=40):
    return spark.createDataFrame([(i, f"text {i} " + "x" * (i * 7919 % size)) for i in range(lo, hi)], FIELDS)


def maps(spark, store):
    out = {}
    for r in sharding.stored_map(spark, store).collect():
        out.setdefault(r.version, {})[r.virtual_slot] = r.shard
    return out


def loads(df):
    total = {}
    for r in df.collect():
        total[r.shard] = total.get(r.shard, 0) + r.size
    return total


def test_a_second_run_edits_the_stored_map(spark):
    store = scratch_path(spark, "map")
    one = sharding.shard(docs(spark, 0, 3000), 4, 256, store=store)
    first = maps(spark, store)
    assert set(first) == {0, 1} and {r.version for r in one.select("version").distinct().collect()} == {1}
    again = sharding.shard(docs(spark, 0, 3000), 4, 256, store=store)
    assert maps(spark, store) == first and sorted(again.collect()) == sorted(one.collect())  # nothing had to move
    more = sharding.shard(docs(spark, 0, 3600), 4, 256, store=store)
    after = maps(spark, store)
    assert set(after) == {0, 1, 2} and {k: after[k] for k in first} == first  # older versions stay
    moved = sum(after[2][s] != first[1][s] for s in first[1])
    assert 0 < moved < 60  # few of 256 slots
    total = loads(more)
    assert max(total.values()) - min(total.values()) <= 0.01 * sum(total.values())


def test_more_and_fewer_shards(spark):
    store = scratch_path(spark, "map")
    sharding.shard(docs(spark, 0, 2000), 3, 128, store=store)
    grown = loads(sharding.shard(docs(spark, 0, 2000), 5, 128, store=store))
    assert set(grown) == set(range(5)) and max(grown.values()) < 1.1 * min(grown.values())
    less = loads(sharding.shard(docs(spark, 0, 2000), 2, 128, store=store))
    assert set(less) == {0, 1} and max(less.values()) < 1.05 * min(less.values())


def test_empty_table_leaves_the_map(spark):
    store = scratch_path(spark, "map")
    assert sharding.shard(docs(spark, 0, 5).limit(0), 4, 64, store=store).count() == 0
    assert set(maps(spark, store)) == {0}


@pytest.mark.parametrize("rows", [
    [(7, f"another text {i % 997}" + "y" * (i % 50)) for i in range(4000)],      # one id, many texts
    [(7, "the same record")] * 6000 + [(i, f"t{i}") for i in range(2000)],       # one record
    [(None, "no id, same text")] * 5000 + [(None, f"n{i}") for i in range(500)]])
def test_bytes_stay_near_equal_with_repeats(spark, monkeypatch, rows):
    monkeypatch.setattr(sharding, "COPIES", 50)
    out = sharding.shard(spark.createDataFrame(rows, FIELDS), 8)
    got = out.collect()
    total = loads(out)
    assert len(got) == len(rows) and max(total.values()) - min(total.values()) <= 0.05 * sum(total.values()) / 8 + 2000
    for s in total:
        own = sorted(r.slot for r in got if r.shard == s)
        assert own == list(range(len(own)))


def test_shrink_moves_only_the_slots_of_removed_shards():
    load = np.random.default_rng(1).integers(1, 100, 64).astype(float)
    owner = sharding.rebalance(sharding.initial_map(6, 64), load, 6)
    less = sharding.shrink(owner, load, 4)
    assert less.max() == 3 and (less[owner < 4] == owner[owner < 4]).all()
