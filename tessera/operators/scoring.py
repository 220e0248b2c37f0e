"""Batch scoring with an outside model.

The reference scores text with a neural model on one GPU.  Here any model
that maps a batch of texts to per-text negative log-likelihoods and token
counts plugs in through ``mapInPandas``: the model is built once per task by
``make_model`` (never shipped per row), and rows cross the JVM/Python border
in Arrow batches.  The result feeds the same corpus-perplexity aggregate.
"""

from __future__ import annotations

import math
import os
import pickle
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ngram import bigram_nll, context_totals, vocab_size

SCORE_SCHEMA = "key string, nll_sum double, n_tokens long"


def score_with(df: DataFrame, key: str, text: str,
               make_model: Callable[[], Callable[[pd.Series], pd.DataFrame]]) -> DataFrame:
    """``make_model()`` returns ``fn(texts) -> DataFrame(nll_sum, n_tokens)``.
    Output ``(key, nll_sum, n_tokens)`` per input row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make_model()
        for b in batches:
            scored = model(b["text"])
            yield pd.DataFrame({"key": b["key"].astype(str), "nll_sum": scored["nll_sum"].astype(float),
                                "n_tokens": scored["n_tokens"].astype("int64")})

    src = df.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    return src.mapInPandas(run, SCORE_SCHEMA)


def perplexity_of(scores: DataFrame) -> DataFrame:
    """Token-weighted corpus perplexity of per-row NLL sums."""
    return scores.agg(F.sum("n_tokens").alias("n_tokens"),
                      F.exp(F.sum("nll_sum") / F.sum("n_tokens")).alias("perplexity"))


# --------------------------------------------------------------------------
# A count model as a file on the executors, or a join beyond its bound
# --------------------------------------------------------------------------

#: Rows of a bigram model that a worker may hold (some 200 bytes each).
MODEL_ROWS = 2_000_000


def ship_model(model: DataFrame, k: float = 1.0, max_rows: int = MODEL_ROWS) -> str | None:
    """Write a bigram model (ctx, tok, cnt) to one file and give it to the executors; its name for
    :func:`count_scorer`, or None if it has more than ``max_rows`` rows."""
    if model.count() > max_rows:
        return None
    spark = model.sparkSession
    rows, heads = model.select("ctx", "tok", "cnt").toPandas(), context_totals(model).toPandas()  # at most max_rows
    counts = dict(zip(zip(rows["ctx"], rows["tok"]), rows["cnt"].tolist()))
    totals = dict(zip(heads["ctx"], heads["ctx_cnt"].tolist()))
    v = spark.range(1).select(vocab_size(model)).first()[0]
    name = f"counts-{uuid.uuid4().hex}.pickle"
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-model-"), name)  # on the driver; addFile hands out its content
    with open(path, "wb") as f:
        pickle.dump((counts, totals, v, k), f)
    spark.sparkContext.addFile(path)
    return name


def count_scorer(name: str) -> Callable[[], Callable[[pd.Series], pd.DataFrame]]:
    """``make_model`` for :func:`score_with` of a shipped model.  A text is an array of tokens, the first of which
    is context only (null: none)."""
    def make() -> Callable[[pd.Series], pd.DataFrame]:
        with open(SparkFiles.get(name), "rb") as f:
            counts, totals, v, k = pickle.load(f)

        def score(texts: pd.Series) -> pd.DataFrame:
            out = []
            for tokens in texts:
                pairs = [(a, b) for a, b in zip(tokens[:-1], tokens[1:]) if a is not None]
                out.append((math.fsum(-math.log((counts.get(p, 0) + k) / (totals.get(p[0], 0) + k * v)) for p in pairs), len(pairs)))
            return pd.DataFrame(out, columns=["nll_sum", "n_tokens"])

        return score

    return make


def score_bigrams(df: DataFrame, key: str, tokens: str, model: DataFrame, k: float = 1.0, max_rows: int = MODEL_ROWS) -> DataFrame:
    """``(key, nll_sum, n_tokens)`` of token arrays under a bigram model: by the model's file on the executors within
    ``max_rows``, by a join of the distinct pairs beyond."""
    name = ship_model(model, k, max_rows)
    if name is not None:
        return score_with(df, key, tokens, count_scorer(name))
    pairs = F.arrays_zip(F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0))).alias("ctx"),
                         F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0))).alias("tok"))
    rows = df.select(F.col(key).cast("string").alias("key"), F.explode_outer(pairs).alias("p")).select("key", "p.ctx", "p.tok")
    counted = rows.groupBy("key", "ctx", "tok").agg(F.count("*").alias("m"))
    nll = bigram_nll(counted.where("ctx is not null").select("ctx", "tok").distinct(), model, k)
    scored = counted.join(nll, ["ctx", "tok"], "left")
    return scored.groupBy("key").agg(F.coalesce(F.sum(F.col("m") * F.col("nll")), F.lit(0.0)).alias("nll_sum"),
                                     F.coalesce(F.sum(F.when(F.col("ctx").isNotNull(), F.col("m"))), F.lit(0)).alias("n_tokens"))
