"""Invariants from SURVEY 5.2 and the outside-model hook."""

import math

import pandas as pd
from pyspark.sql import functions as F

from tessera.operators import classifier as CL
from tessera.operators import ngram
from tessera.operators import tokens as tk
from tessera.operators.scoring import perplexity_of, score_with
from tessera.operators.splits import sample_n, shuffle, split_fixed

SF = "/root/testdata/sf0.001"


def test_split_disjoint_and_total(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id")
    s = split_fixed(d, "doc_id", 10, 15)
    counts = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts["test"] == 10 and counts["valid"] == 15 and sum(counts.values()) == d.count()
    assert s.where("split = 'test'").join(s.where("split = 'train'"), "doc_id", "left_anti").count() == 10
    again = split_fixed(d, "doc_id", 10, 15)
    assert s.exceptAll(again).count() == 0


def test_shuffle_ordinal_is_a_permutation(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id")
    sh = shuffle(d, "doc_id", seed=3)
    ords = sorted(r.ord for r in sh.collect())
    assert ords == list(range(1, d.count() + 1))
    assert sample_n(d, "doc_id", 3, seed=3).count() == 3


def test_windows_cover_stream_once(spark):
    n, L, S = 53, 8, 3
    toks = spark.createDataFrame([(g, g) for g in range(n)], "g long, id int")
    w = tk.strided_windows(toks, F.lit(n), L, S)
    assert w.agg(F.sum("trg_len")).first()[0] == n
    scored = w.select(F.explode(tk.scored_ids("target_ids")).alias("x"))
    assert scored.count() == n and scored.distinct().count() == n


def test_filtered_distribution_sums_to_one(spark):
    model = spark.createDataFrame([("c", str(i), i + 1) for i in range(80)] + [("d", "x", 3), ("d", "y", 3)],
                                  "ctx string, tok string, cnt long")
    dist = ngram.top_p(ngram.top_k(ngram.next_token_dist(model), 50), 0.95)
    for r in dist.groupBy("ctx").agg(F.sum("p").alias("s")).collect():
        assert abs(r.s - 1.0) < 1e-12


def test_packing_keeps_every_sentence_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    from tessera.functions.text import split_sentences
    s = docs.select("doc_id", split_sentences("text").alias("s"))
    packs = tk.pack_sentences(s, "s", 64, keep=["doc_id"])
    a = packs.groupBy("doc_id").agg(F.sum("n_sentences").alias("n"))
    b = s.select("doc_id", F.size("s").alias("n")).where("n > 0")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_outside_model_scoring(spark):
    def make_model():
        def score(texts: pd.Series) -> pd.DataFrame:
            n = texts.str.split().str.len()
            return pd.DataFrame({"nll_sum": n * 2.0, "n_tokens": n})
        return score

    df = spark.createDataFrame([(1, "a b c"), (2, "d e")], "k long, text string")
    out = score_with(df, "k", "text", make_model)
    assert {r.key: r.n_tokens for r in out.collect()} == {"1": 3, "2": 2}
    assert abs(perplexity_of(out).first().perplexity - 7.389056099) < 1e-6   # exp(10 / 5)


def test_naive_bayes_by_hand(spark):
    docs = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(
        [("good fine good", 1), ("bad poor", 0), ("good", 1), ("bad bad", 0), (None, 1), ("", 0), ("good bad", None)] * 12)],
        "doc_id long, text string, label int")
    rows = CL.naive_bayes(docs, (0, 1), (0.5, 2.0), (1, 3), seeds=2).collect()
    heads = CL.seeded_splits(docs.where("label is not null"), 2).collect()
    for seed in (0, 1):
        train = [r for r in heads if r.seed == seed and r.split == "train"]
        counts = {}
        for r in train:
            for t in (r.text or "").split():
                counts.setdefault(t, [0, 0])[r.label] += 1
        mine = [r for r in rows if r.seed == seed]
        held = {r.doc_id: r for r in heads if r.seed == seed and r.split != "train"}
        assert sorted({r.doc_id for r in mine}) == sorted(held) and len(mine) == 4 * len(held)
        for r in mine:
            words = {t: n for t, n in counts.items() if sum(n) >= r.min_count}
            s = []
            for c in (0, 1):
                size = sum(n[c] for n in words.values()) + r.smoothing * len(words)
                z = math.log((sum(x.label == c for x in train) + 1) / (len(train) + 2))
                s.append(z + sum(math.log((words[t][c] + r.smoothing) / size)
                                 for t in (held[r.doc_id].text or "").split() if t in words))
            assert r.pred == s.index(max(s))
            assert abs(r.loss - (math.log(sum(math.exp(x) for x in s)) - s[r.label])) < 1e-9
    assert CL.naive_bayes(docs.limit(0), (0, 1)).count() == 0
    assert CL.sweep(docs, (0, 1), (1.0,), (1,), 1, do_eval=False) is None


def test_logistic_option(spark):
    docs = spark.createDataFrame([(i, "good fine" if i % 2 else "bad poor", float(i % 2), "train" if i < 30 else "test")
                                  for i in range(40)], "doc_id long, text string, label double, split string")
    feats = CL.featurize(docs, num_features=64)
    model = CL.fit_logistic(feats.where("split = 'train'"))
    r = CL.evaluate(CL.predict_logistic(model, feats.where("split = 'test'"))).first()
    assert r.metric_1 == 1.0 and r.metric_2 == 1.0 and r.loss < 0.2
