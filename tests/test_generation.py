"""The compiled table gives the rows of the step-by-step joins, whatever its head holds."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import generation, ngram


@pytest.fixture(scope="module")
def dist(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(40)]
    rows = {}
    for _ in range(900):
        a, b = (words[min(int(rng.expovariate(0.15)), 39)] for _ in range(2))
        rows[a, b] = rows.get((a, b), 0) + 1
    model = spark.createDataFrame([(a, b, n) for (a, b), n in rows.items()], "ctx string, tok string, cnt long")
    full = ngram.count_dist(model).unionByName(ngram.backoff_dist(model).drop("p"))
    return ngram.top_p(ngram.top_k(full, 10), 0.9)


@pytest.fixture(scope="module")
def prompts(spark):
    rng = random.Random(9)
    rows = [(f"p{i}", [rng.choice(["w0", "w7", "w39", "never", "w3"]) for _ in range(rng.randint(0, 30))]) for i in range(120)]
    return spark.createDataFrame(rows, "id string, out array<string>")


def collected(df):
    return {r.id: r.out for r in df.collect()}


@pytest.mark.parametrize("head_bytes", [1 << 26, 9_000, 3_000, 0])
def test_same_rows_as_a_join_for_each_step(spark, dist, prompts, head_bytes):
    want = collected(ngram.generate(prompts, dist, "id", max_length=25))
    got = collected(generation.generate(prompts, dist, "id", max_length=25, head_bytes=head_bytes))
    assert got == want and any(len(v) == 25 for v in got.values())


def test_whole_table_in_the_head_needs_no_shuffle(spark, dist, prompts):
    plan = generation.generate(prompts, dist, "id", max_length=25)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_rounds_follow_the_tail(spark, dist, monkeypatch):
    """A head with most of the weight takes most steps: far fewer rounds than steps."""
    rounds = []
    plain = generation.drawn
    monkeypatch.setattr(generation, "drawn", lambda *a: rounds.append(1) or plain(*a))
    prompts = spark.createDataFrame([(f"q{i}", ["w0"]) for i in range(20)], "id string, out array<string>")
    table = generation.interval_rows(dist)
    sizes = table.groupBy("ctx").agg(generation.context_bytes().alias("b"), F.max("tot").alias("t")).orderBy(F.desc("t")).collect()
    head = sum(r.b for r in sizes[:16])
    out = collected(generation.generate(prompts, dist, "id", max_length=101, head_bytes=head))
    assert {len(v) for v in out.values()} == {101} and 0 < len(rounds) <= 30


def test_without_back_off_a_prompt_ends(spark):
    model = spark.createDataFrame([("a", "b", 1)], "ctx string, tok string, cnt long")
    dist = ngram.next_token_dist(model)
    prompts = spark.createDataFrame([(1, ["a"]), (2, []), (3, ["x"])], "id long, out array<string>")
    for head in (1 << 20, 0):
        assert collected(generation.generate(prompts, dist, "id", 5, head_bytes=head)) == {1: ["a", "b"], 2: [], 3: ["x"]}
    assert generation.generate(prompts.limit(0), dist, "id", 5).count() == 0


def test_draws_ship_one_token(spark, dist):
    """The join's output holds the drawn token, not the context's list."""
    prompts = spark.createDataFrame([(i, f"w{i % 41}") for i in range(300)], "id long, ctx string")
    out = ngram.sample_next(prompts, ngram.interval_rows(dist), "id", 4)
    assert out.count() == 1200 and out.where("tok is null").count() == 0
    table = {}
    for r in ngram.with_cdf(dist).collect():
        table.setdefault(r.ctx, []).append((r.cum, r.tok, r.tot))
    for r in out.join(prompts, "id").collect():
        rows = sorted(table.get(r.ctx) or table[None])
        u = generation._uniform(42, r.id, r.draw)
        assert r.tok == next(t for c, t, tot in rows if c >= u * tot)


def test_the_head_is_packed_by_the_tasks(spark, dist, monkeypatch):
    """The driver gets bytes, never the table's rows or its lists, and workers unpack the same table."""
    monkeypatch.setattr(type(dist), "toPandas", lambda self: pytest.fail("rows on the driver"))
    head = generation._compiled(generation.interval_rows(dist))
    assert all(isinstance(p, bytes) for p in head.parts) and "table" not in vars(head)
    want = {}
    for r in generation.interval_rows(dist).orderBy("cum").collect():
        want.setdefault(r.ctx, []).append((r.cum, r.tok, r.tot))
    t = head.table
    got = {c: [(t.cums[j], t.names[t.toks[j]], t.tots[i]) for j in range(t.starts[i], t.starts[i + 1])] for c, i in t.contexts.items()}
    assert got == want and None in got
    assert generation._compiled(generation.interval_rows(dist.limit(0))).table.contexts == {}
