"""Count language models on Spark.

The reference scores text with a neural model; here the model is a unigram /
bigram count table whose training and scoring are aggregates and joins.  The
evaluation contract (strided windows, masked targets, window-weighted mean,
corpus perplexity) and the sampling contract (top-k, top-p, draw) are the
reference's.

Scale notes: token rows are pre-aggregated to distinct (context, token) pairs
before any join, so a hot token costs one row, not millions; model sides are
unique per key, so skewed keys only ever sit on one side of a join (AQE
splits them); vocabulary sizes and totals are scalar subqueries, never cross
joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import GEN_MAX_LENGTH, TOP_K, TOP_P
from ..functions.text import explode_nonempty, md5_unit
from ..session import cut_lineage


def unigram_counts(tokens: DataFrame, tok: str = "tok") -> DataFrame:
    """Token counts (map-side partial aggregation handles hot tokens)."""
    return tokens.groupBy(tok).agg(F.count(F.lit(1)).alias("cnt"))


def unigram_perplexity(train_tokens: DataFrame, test_tokens: DataFrame,
                       tok: str = "tok", k: float = 1.0) -> DataFrame:
    """Add-k unigram: ``p = (c + k) / (n + k * (v + 1))`` with n train tokens and
    v train types (one extra type for everything unseen).  Returns one row
    ``(n_tokens, perplexity)`` with ``perplexity = exp(mean(-ln p))``."""
    # the counts feed two scalars and a join: written once to the shared
    # checkpoint folder instead of re-tokenising the training corpus per use
    counts = cut_lineage(unigram_counts(train_tokens, tok))
    n = counts.select(F.sum("cnt")).scalar()
    v = counts.select(F.count(F.lit(1))).scalar()
    test = test_tokens.groupBy(tok).agg(F.count(F.lit(1)).alias("m"))
    scored = test.join(counts, tok, "left").select(
        "m", (-F.log((F.coalesce(F.col("cnt"), F.lit(0)) + F.lit(k))
                     / (n + F.lit(k) * (v + F.lit(1))))).alias("nll"))
    return scored.agg(
        F.sum("m").alias("n_tokens"),
        F.round(F.exp(F.sum(F.col("m") * F.col("nll")) / F.sum("m")), 6).alias("perplexity"))


# --------------------------------------------------------------------------
# Bigram model
# --------------------------------------------------------------------------

def bigram_pairs(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(ctx, tok) for every adjacent pair inside each token array."""
    pairs = F.arrays_zip(F.slice(F.col(tokens), 1, F.greatest(F.size(tokens) - 1, F.lit(0))),
                         F.slice(F.col(tokens), 2, F.greatest(F.size(tokens) - 1, F.lit(0))))
    return (df.select(explode_nonempty(pairs).alias("p")).where(F.col("p").isNotNull())
            .select(F.col("p").getField("0").alias("ctx"), F.col("p").getField("1").alias("tok")))


def fit_bigram(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """L1: bigram counts ``(ctx, tok, cnt)`` over adjacent pairs of each text."""
    return bigram_pairs(df, tokens).groupBy("ctx", "tok").agg(F.count(F.lit(1)).alias("cnt"))


def context_totals(model: DataFrame) -> DataFrame:
    return model.groupBy("ctx").agg(F.sum("cnt").alias("ctx_cnt"))


def vocab_size(model: DataFrame) -> Column:
    """Scalar subquery: distinct tokens of the model plus one unseen type."""
    types = model.select(F.col("ctx").alias("t")).union(model.select(F.col("tok").alias("t")))
    return types.select(F.count_distinct("t") + F.lit(1)).scalar()


def bigram_nll(pairs: DataFrame, model: DataFrame, k: float = 1.0) -> DataFrame:
    """L2 over distinct pairs: ``-ln p(tok | ctx)`` with add-k smoothing,
    ``p = (c(ctx,tok) + k) / (c(ctx) + k V)``; unseen pairs and contexts get
    the smoothed mass.  ``pairs`` has (ctx, tok, ...)."""
    v = vocab_size(model)
    ctx = context_totals(model)
    joined = (pairs.join(model, ["ctx", "tok"], "left").join(ctx, "ctx", "left"))
    p = ((F.coalesce(F.col("cnt"), F.lit(0)) + F.lit(k))
         / (F.coalesce(F.col("ctx_cnt"), F.lit(0)) + F.lit(k) * v))
    return joined.withColumn("nll", -F.log(p)).drop("cnt", "ctx_cnt")


# --------------------------------------------------------------------------
# Strided-window evaluation (A12 / L3), without materialising windows
# --------------------------------------------------------------------------

def window_of(g: Column, stride: int) -> Column:
    """Start of the only window whose targets contain position ``g``."""
    return F.floor(g / F.lit(stride)).cast("long") * F.lit(stride)


def stream_targets(stream: DataFrame, n_total: Column, max_len: int, stride: int,
                   weighting: str = "window") -> DataFrame:
    """One row per token position of the stream with its scoring weight.

    ``stream`` has (g, tok, prev) - global position, token, previous token in
    the stream.  Window ``i`` targets positions ``[i, min(i+stride, N))`` and
    sees inputs from ``begin = max(i + stride - max_len, 0)``; a target is
    scored when its left neighbour is inside the window (g > begin).  With
    ``weighting='window'`` (the reference, D20) each window's mean is weighted
    by ``trg_len``, so a scored token weighs ``trg_len / scored``; with
    ``'scored'`` every scored token weighs 1.  Windows without any scored
    target (D21) contribute nothing; N is unchanged.
    """
    if stride > max_len:
        raise ValueError("stride must be <= max_len")
    w = window_of(F.col("g"), stride)
    begin = F.greatest(w + F.lit(stride - max_len), F.lit(0))
    end = F.least(w + F.lit(stride), n_total)
    trg = end - w
    scored_in_window = trg - F.when(begin == w, 1).otherwise(0)
    out = stream.select(
        "g", "tok", "prev", w.alias("win"), trg.alias("trg_len"),
        scored_in_window.alias("n_scored"), (F.col("g") > begin).alias("scored"))
    if weighting == "window":
        weight = F.col("trg_len").cast("double") / F.col("n_scored")
    elif weighting == "scored":
        weight = F.lit(1.0)
    else:
        raise ValueError("weighting is 'window' or 'scored'")
    return out.withColumn("weight", F.when(F.col("scored"), weight))


def corpus_perplexity(targets: DataFrame, model: DataFrame, n_total: Column,
                      k: float = 1.0, weighting: str = "window") -> DataFrame:
    """``exp(sum_w mean_nll_w * trg_len_w / N)``.  Scored targets are
    grouped to distinct (ctx, tok, weight) before the model join."""
    grouped = (targets.where("scored")
               .groupBy(F.col("prev").alias("ctx"), "tok", "weight")
               .agg(F.count(F.lit(1)).alias("m")))
    scored = bigram_nll(grouped, model, k)
    denom = n_total if weighting == "window" else F.sum("m")
    return scored.agg(
        F.sum("m").alias("n_scored"),
        F.round(F.exp(F.sum(F.col("m") * F.col("weight") * F.col("nll")) / denom), 6)
        .alias("perplexity"))


# --------------------------------------------------------------------------
# Next-token distribution, top-k, top-p, sampling
# --------------------------------------------------------------------------

def count_dist(model: DataFrame) -> DataFrame:
    """``(ctx, tok, w)`` for :func:`top_k` and :func:`top_p`, which make ``p`` of the weights they keep."""
    return model.select("ctx", "tok", F.col("cnt").cast("double").alias("w"))


def next_token_dist(model: DataFrame) -> DataFrame:
    """Maximum-likelihood next-token distribution ``(ctx, tok, w, p)``; ``w`` is
    the count, kept so that the filters below compare exact integers."""
    return (model.join(context_totals(model), "ctx")
            .select("ctx", "tok", F.col("cnt").cast("double").alias("w"),
                    (F.col("cnt") / F.col("ctx_cnt")).alias("p")))


def backoff_dist(model: DataFrame) -> DataFrame:
    """What follows a context the model has not seen, as the rows of the null
    context: every token by how often it follows any other."""
    counts = model.groupBy("tok").agg(F.sum("cnt").alias("cnt"))
    total = model.select(F.sum("cnt")).scalar()
    return counts.select(F.lit(None).cast("string").alias("ctx"), "tok", F.col("cnt").cast("double").alias("w"),
                         (F.col("cnt") / total).alias("p"))


def _renorm(df: DataFrame) -> DataFrame:
    return df.withColumn("p", F.col("w") / F.sum("w").over(Window.partitionBy("ctx")))


def top_k(dist: DataFrame, k: int = TOP_K) -> DataFrame:
    """L4: keep tokens ranked <= k per context by weight ``w`` (ties at the
    k-th kept), then renormalise.  ``rank() <= k`` lets Spark insert a partial
    group limit before the shuffle, so a huge context ships at most k rows per
    task.  A distribution without counts uses ``w = p``."""
    if "w" not in dist.columns:
        dist = dist.withColumn("w", F.col("p"))
    rk = F.rank().over(Window.partitionBy("ctx").orderBy(F.col("w").desc()))
    return _renorm(dist.withColumn("_rk", rk).where(F.col("_rk") <= k).drop("_rk"))


def top_p(dist: DataFrame, p: float = TOP_P) -> DataFrame:
    """Keep a token while the mass ranked before it is <= p of the total
    (the first token always stays), then renormalise.  Applied after
    :func:`top_k`, so each context holds a bounded number of rows."""
    if "w" not in dist.columns:
        dist = dist.withColumn("w", F.col("p"))
    before = F.coalesce(F.sum("w").over(
        Window.partitionBy("ctx").orderBy(F.col("w").desc(), F.col("tok"))
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    total = F.sum("w").over(Window.partitionBy("ctx"))
    kept = dist.withColumn("_keep", before <= F.lit(p) * total).where("_keep").drop("_keep")
    return _renorm(kept)


def with_cdf(dist: DataFrame) -> DataFrame:
    """Cumulative weight per context in (w desc, tok) order and the total."""
    if "w" not in dist.columns:
        dist = dist.withColumn("w", F.col("p"))
    w = (Window.partitionBy("ctx").orderBy(F.col("w").desc(), F.col("tok"))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (dist.withColumn("cum", F.sum("w").over(w))
            .withColumn("tot", F.sum("w").over(Window.partitionBy("ctx"))))


def cdf_rows(dist: DataFrame) -> DataFrame:
    """One row per context: ``cdf``, its (cum, tok, p) in draw order, and ``tot``."""
    entries = F.collect_list(F.struct("cum", "tok", "p"))
    return with_cdf(dist).groupBy("ctx").agg(F.array_sort(entries).alias("cdf"), F.max("tot").alias("tot"))


def _pick(rows: DataFrame, cdf: DataFrame, u: Column, out: str) -> DataFrame:
    """Add ``out`` = (cum, tok, p) of the first token after ``ctx`` whose
    cumulative weight reaches ``u * tot``; a context without a row takes the
    row of the null context."""
    back = cdf.where(F.col("ctx").isNull()).select(F.struct("cdf", "tot")).scalar()
    known = cdf.where(F.col("ctx").isNotNull()).select("ctx", F.struct("cdf", "tot").alias("_d"))
    joined = (rows.join(known, "ctx", "left").withColumn("_d", F.coalesce(F.col("_d"), back))
              .withColumn("_u", u * F.col("_d.tot")))
    reached = F.filter(F.col("_d.cdf"), lambda c: c["cum"] >= F.col("_u"))
    return joined.withColumn(out, F.get(reached, F.lit(0))).drop("_d", "_u")


def interval_rows(dist: DataFrame) -> DataFrame:
    """``(ctx, tok, p, before, cum, tot)``: each token's interval of its context's cumulative weight."""
    return with_cdf(dist).select("ctx", "tok", "p", (F.col("cum") - F.col("w")).alias("before"), "cum", "tot")


def drawn(rows: DataFrame, intervals: DataFrame, out: str) -> DataFrame:
    """Add ``out`` = (tok, p): the token of ``ctx`` whose interval holds ``u`` of the total (null: no such context).
    The draw is in the join's condition, so one row of the context leaves the join for each draw."""
    known = intervals.where(F.col("ctx").isNotNull()).select(
        F.col("ctx").alias("_ctx"), F.struct("tok", "p").alias(out), F.col("before").alias("_b"), F.col("cum").alias("_c"),
        F.col("tot").alias("_t"))
    aim = F.col("u") * F.col("_t")
    here = (F.col("_c") >= aim) & ((F.col("_b") < aim) | (F.col("_b") == 0))
    return rows.join(known, (F.col("ctx") == F.col("_ctx")) & here, "left").drop("_ctx", "_b", "_c", "_t")


def sample_next(prompts: DataFrame, dist: DataFrame, id_col: str, n: int = 1,
                seed: int = 42, do_sample: bool = True) -> DataFrame:
    """``n`` draws per prompt, ``n`` rows each.  ``prompts`` has (id_col,
    ctx); ``dist`` is a filtered distribution or its :func:`interval_rows`.  Inverse
    CDF with a seeded md5 uniform u: the first token whose cumulative weight
    reaches ``u * total``.  Greedy (``do_sample=False``) takes the top token.  An
    unknown or null context draws from the rows of ``dist`` whose ``ctx`` is null
    (:func:`backoff_dist`); without such rows its tokens are null."""
    u = md5_unit(F.lit(seed), F.col(id_col), F.col("draw")) if do_sample else F.lit(0.0)
    draws = prompts.select(id_col, "ctx", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("draw")).withColumn("u", u)
    intervals = dist if "before" in dist.columns else interval_rows(dist)
    back = intervals.where(F.col("ctx").isNull()).select(
        F.struct(F.array_sort(F.collect_list(F.struct("cum", "tok", "p"))).alias("cdf"), F.max("tot").alias("tot"))).scalar()
    found = drawn(draws, intervals, "_d").withColumn("_b", F.when(F.col("_d").isNull(), back))
    reached = F.get(F.filter(F.col("_b.cdf"), lambda c: c["cum"] >= F.col("u") * F.col("_b.tot")), F.lit(0))
    return found.withColumn("_b", F.when(F.col("_d").isNull(), reached)).select(
        id_col, "draw", F.coalesce("_d.tok", "_b.tok").alias("tok"), F.coalesce("_d.p", "_b.p").alias("p"))


def generate(prompts: DataFrame, dist: DataFrame, id_col: str, max_length: int = GEN_MAX_LENGTH,
             seed: int = 42, per_cut: int = 10) -> DataFrame:
    """L7 by one join a step, the plain form of :func:`tessera.operators.generation.generate`,
    for small batches: continue every prompt, ``(id_col, out)`` with its tokens in ``out``, to ``max_length`` tokens, the prompt included; a prompt as long already stays
    as it is.  Step ``s`` is draw ``s`` of :func:`sample_next` after the last
    token.  Every ``per_cut`` steps the state is written and read again, so
    plans stay short and a lost executor costs ``per_cut`` steps at most."""
    cdf = cut_lineage(cdf_rows(dist))
    state = cut_lineage(prompts.select(id_col, "out"))
    shortest = state.select(F.min(F.size("out"))).first()[0]
    steps = 0 if shortest is None else max(0, max_length - shortest)
    for step in range(steps):
        u = md5_unit(F.lit(seed), F.col(id_col), F.lit(step))
        drawn = _pick(state.withColumn("ctx", F.try_element_at("out", F.lit(-1))), cdf, u, "_pick")
        more = (F.size("out") < max_length) & F.col("_pick").isNotNull()
        state = drawn.select(id_col, F.when(more, F.concat("out", F.array("_pick.tok")))
                             .otherwise(F.col("out")).alias("out"))
        if (step + 1) % per_cut == 0 or step + 1 == steps:
            state = cut_lineage(state)
    return state
