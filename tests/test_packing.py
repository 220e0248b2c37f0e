"""K9 across rows: the scan against one pass over all sentences."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.operators import packing

LIMIT = 10


def one_pass(ns, limit=LIMIT):
    packs, fill = [], None
    for n in ns:
        if fill is not None and fill + n <= limit:
            fill += n
            packs.append(packs[-1])
        else:
            fill = n
            packs.append(packs[-1] + 1 if packs else 0)
    return packs


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 14), max_size=9), max_size=6))
def test_tables_compose_and_replay(blocks):
    fill, base, got = LIMIT + 1, 0, []
    for block in blocks:
        ns = np.array(block, dtype=np.int64)
        exits, opened = packing.block_table(ns, LIMIT)
        got += (base - 1 + packing.replay(ns, LIMIT, fill)).tolist()
        fill, base = int(exits[fill]), base + int(opened[fill])
    flat = [n for b in blocks for n in b]
    assert got == one_pass(flat) and base == (max(got) + 1 if got else 0)


@pytest.mark.parametrize("blocks,fan", [(1, 64), (3, 2), (16, 2), (16, 64)])
def test_groups_of_any_size(spark, monkeypatch, blocks, fan):
    monkeypatch.setattr(packing, "FAN", fan)
    rng = np.random.default_rng(blocks)
    docs = [(i, None if i % 7 == 0 else "hot" if i % 3 else f"g{i % 5}",
             [" ".join(["w"] * int(n)) or " " for n in rng.integers(0, 14, rng.integers(0, 6))]) for i in range(300)]
    docs.append((300, "only empty", []))
    df = spark.createDataFrame(docs, "id long, g string, s array<string>")
    got = {(r.g, r.pack): (r.n_sentences, r.n_tokens, r.text) for r in packing.pack_groups(df, "g", ["id"], "s", LIMIT, blocks).collect()}
    want = {}
    for g in {d[1] for d in docs}:
        sents = [s for _, x, own in docs if x == g for s in own]
        for s, p in zip(sents, one_pass([len(s.split()) for s in sents])):
            want.setdefault((g, p), []).append(s)
    assert got == {k: (len(v), sum(len(s.split()) for s in v), " ".join(v)) for k, v in want.items()}


def test_no_task_holds_a_group(spark):
    """Every grouped step is keyed by a block or a bounded run of tables, never by the group alone."""
    df = spark.createDataFrame([(i, "one", ["a b", "c"]) for i in range(64)], "id long, g string, s array<string>")
    plan = packing.pack_groups(df, "g", ["id"], "s", 4, 8)._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "hashpartitioning(" in line:
            assert line.split("hashpartitioning(")[1].count("#") >= 2 or "hashpartitioning(id#" in line
    assert "SinglePartition" not in plan


def test_rows_without_sentences_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a", []), (2, None, None)], "id long, g string, s array<string>")
    assert packing.pack_groups(df, "g", ["id"], "s").count() == 0
    assert packing.pack_groups(df.limit(0), "g", ["id"], "s").count() == 0
