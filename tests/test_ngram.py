"""Count-model evaluation and sampling (FIXTURES 10, D20, D21, L1-L6)."""

import math
import random

from pyspark.sql import functions as F

from tessera.operators import ngram


def test_top_k_then_top_p_fixture(spark):
    dist = spark.createDataFrame([("c", "a", 0.5), ("c", "b", 0.3), ("c", "d", 0.15), ("c", "e", 0.05)],
                                 "ctx string, tok string, p double")
    out = {r.tok: round(r.p, 6) for r in ngram.top_p(ngram.top_k(dist, 3), 0.6).collect()}
    assert out == {"a": 0.625, "b": 0.375}


def test_top_k_keeps_ties_and_top_p_keeps_first(spark):
    dist = spark.createDataFrame([("c", "a", 0.4), ("c", "b", 0.3), ("c", "x", 0.3)], "ctx string, tok string, p double")
    assert ngram.top_k(dist, 2).count() == 3
    assert [r.tok for r in ngram.top_p(dist, 0.0).collect()] == ["a"]


def reference_ppl(stream, model, V, L, S, weighting="window"):
    """The notebook's loop over windows with a bigram scorer (label shift:
    the first input of a window is never a scored target)."""
    n = len(stream)
    total, scored_all = 0.0, 0
    ctx_tot = {}
    for (c, _), k in model.items():
        ctx_tot[c] = ctx_tot.get(c, 0) + k
    for i in range(0, n, S):
        b, e = max(i + S - L, 0), min(i + S, n)
        trg = e - i
        nll = [-math.log((model.get((stream[g - 1], stream[g]), 0) + 1) / (ctx_tot.get(stream[g - 1], 0) + V))
               for g in range(max(i, b + 1), e)]
        if not nll:
            continue                                    # D21
        scored_all += len(nll)
        total += (sum(nll) / len(nll)) * trg if weighting == "window" else sum(nll)
    return math.exp(total / (n if weighting == "window" else scored_all))


def test_windowed_perplexity_matches_loop(spark):
    rnd = random.Random(4)
    words = ["a", "b", "c", "d", "e"]
    train = [[rnd.choice(words) for _ in range(rnd.randint(2, 9))] for _ in range(20)]
    stream = [rnd.choice(words + ["z"]) for _ in range(37)]
    model_df = ngram.fit_bigram(spark.createDataFrame([(t,) for t in train], "tokens array<string>"))
    model = {(r.ctx, r.tok): r.cnt for r in model_df.collect()}
    V = len({w for pair in model for w in pair}) + 1
    st = spark.createDataFrame([(g, stream[g], stream[g - 1] if g else None) for g in range(len(stream))],
                               "g long, tok string, prev string")
    for L, S in ((8, 8), (8, 3), (5, 5), (6, 1)):
        for weighting in ("window", "scored"):
            tg = ngram.stream_targets(st, F.lit(len(stream)), L, S, weighting)
            got = ngram.corpus_perplexity(tg, model_df, F.lit(len(stream)), 1.0, weighting).first().perplexity
            assert abs(got - round(reference_ppl(stream, model, V, L, S, weighting), 6)) < 1e-5


def test_unigram_formula(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",)], "tok string")
    test = spark.createDataFrame([("a",), ("c",)], "tok string")
    r = ngram.unigram_perplexity(train, test).first()
    # n = 3, v = 2: p(a) = 3/6, p(c) = 1/6
    assert r.n_tokens == 2 and abs(r.perplexity - round(math.exp(-(math.log(0.5) + math.log(1 / 6)) / 2), 6)) < 1e-9


def test_sampling_is_seeded_and_greedy_is_top(spark):
    dist = spark.createDataFrame([("c", "a", 0.6), ("c", "b", 0.4)], "ctx string, tok string, p double")
    prompts = spark.createDataFrame([(i, "c") for i in range(200)], "id long, ctx string")
    one = {(r.id, r.draw): r.tok for r in ngram.sample_next(prompts, dist, "id", 2, seed=9).collect()}
    two = {(r.id, r.draw): r.tok for r in ngram.sample_next(prompts, dist, "id", 2, seed=9).collect()}
    assert one == two and len(one) == 400
    share = sum(1 for t in one.values() if t == "a") / 400
    assert 0.5 < share < 0.7
    greedy = ngram.sample_next(prompts, dist, "id", 1, do_sample=False)
    assert {r.tok for r in greedy.collect()} == {"a"}


def test_no_prompt_is_lost(spark):
    model = spark.createDataFrame([("a", "b", 3), ("b", "a", 2), ("b", "c", 1)], "ctx string, tok string, cnt long")
    prompts = spark.createDataFrame([(1, "a"), (2, "unseen"), (3, None), (4, "c")], "id long, ctx string")
    dist = ngram.next_token_dist(model)
    full = dist.unionByName(ngram.backoff_dist(model))
    got = {r.id: (r.tok, r.p) for r in ngram.sample_next(prompts, full, "id", 1, do_sample=False).collect()}
    assert got == {1: ("b", 1.0), 2: ("b", 0.5), 3: ("b", 0.5), 4: ("b", 0.5)}
    assert ngram.sample_next(prompts, full, "id", 3).count() == 12
    bare = {r.id: r.tok for r in ngram.sample_next(prompts, dist, "id", 1).collect()}
    assert bare == {1: "b", 2: None, 3: None, 4: None}


def test_generation_reaches_the_length_from_the_whole_prompt(spark):
    model = spark.createDataFrame([("a", "b", 3), ("b", "a", 2), ("b", "c", 1)], "ctx string, tok string, cnt long")
    dist = ngram.next_token_dist(model).unionByName(ngram.backoff_dist(model))
    start = {1: ["x", "a"], 2: [], 3: ["a"] * 7, 4: ["a", "b", "c"]}
    prompts = spark.createDataFrame(list(start.items()), "id long, out array<string>")
    got = {r.id: r.out for r in ngram.generate(prompts, dist, "id", max_length=6, per_cut=2).collect()}
    assert {k: len(v) for k, v in got.items()} == {1: 6, 2: 6, 3: 7, 4: 6}
    assert all(got[k][:len(v)] == v for k, v in start.items()) and got[1][2] == "b"
    empty = ngram.generate(prompts.where("id < 0"), dist, "id", max_length=6)
    assert empty.count() == 0
