"""Toxic passages by maximum-scoring segments.

Token weights are log-odds of the toxic against the clean labelled documents
(by documents that hold the word) with a Dirichlet prior from the counts of the
whole corpus, taken at their lower confidence bound; words whose log-odds are
not significant weigh nothing, and a word outside the lexicon has the weight of
its first letters.  Every token also costs a small
drift, so that the mean weight of clean text is below zero.  One linear scan
finds all maximal segments (Ruzzo and Tompa).  Segment scores are calibrated
by extreme-value statistics (Karlin and Altschul): lambda solves
``sum p e^(lambda s) = 1`` under the clean word distribution, K comes from the
clean labelled documents, and a segment counts by ``lambda S - ln(K n)``.  A
logistic curve over their sum gives the score.

The lexicon holds every word that ``Settings`` lets in, without a cap: a word is in
``min_docs`` labelled documents at least, and of these there are ``max_labelled`` at
most (the first by hash of the id), which bounds what the driver gathers.

Nulls and empty texts have no segment and get the score of no evidence.  With
no labelled row of either class every document scores 0, an empty table has no row.
Repeated rows are scored alike; a long text is scanned whole, in its length;
columns of the input are not needed besides ``doc_id``, ``text``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, small_batches

TOKEN = re.compile(r"[^\W_]+")
#: Letters of a word's stem, to which words outside the lexicon back off.
STEM = 4
OUT = "n_tokens int, evidence double, passages array<struct<start:int,end:int,score:double>>"


@dataclass(frozen=True)
class Settings:
    #: Labelled rows of which the classifier is fitted, at most.
    max_labelled: int = 200_000
    #: Weight of the corpus prior, as a share of the labelled counts.
    prior: float = 0.01
    #: Least absolute z of a word's log-odds, standard deviations taken off
    #: them, and least documents with the word.
    min_z: float = 5.0
    shrink: float = 3.0
    min_docs: int = 5
    #: Mean weight of a token of clean text.
    drift: float = 0.1
    #: Documents with doc_id's crc32 modulo this of 0 are held out (0: none are).
    fold: int = 5
    #: Distinct words that a Python worker counts before it hands them on.
    flush: int = 300_000


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    neutral: float
    lam: float
    log_k: float
    bias: float
    slope: float


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def held_out(doc_id: Column, fold: int = 5) -> Column:
    """True where crc32 of the id as text leaves no remainder (null id: held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % fold == 0, F.lit(True))


def segments(weights: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end exclusive, score), in linear time."""
    up = np.flatnonzero(weights > 0)
    if not len(up):
        return []
    total = np.concatenate(([0.0], np.cumsum(weights)))
    low, high, first, last, link = [], [], [], [], []
    for i in up.tolist():
        lo, hi, start = total[i], total[i + 1], i
        while True:
            j = len(low) - 1
            while j >= 0 and low[j] >= lo:
                j = link[j]
            if j < 0 or high[j] >= hi:
                break
            lo, start = low[j], first[j]
            del low[j:], high[j:], first[j:], last[j:], link[j:]
        low.append(lo), high.append(hi), first.append(start), last.append(i + 1), link.append(j)
    return [(a, b, float(h - w)) for a, b, h, w in zip(first, last, high, low)]


def labelled(labels: DataFrame, settings: Settings) -> DataFrame:
    """(doc_id, toxic) of the training folds: one row per id, bounded by max_labelled."""
    rows = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
            .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    if settings.fold:
        rows = rows.where(~held_out(F.col("doc_id"), settings.fold))
    n = rows.count()
    if n <= settings.max_labelled:
        return rows
    # the first by hash, the same in every run; somewhat more than these pass the filter, so no task hands on many
    near = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31))
    return rows.where(near < 1.2 * settings.max_labelled / n * (1 << 31)).orderBy(near, "doc_id").limit(settings.max_labelled)


def _counted(flush: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        everywhere, docs = Counter(), (Counter(), Counter(), Counter())

        def rows():
            keys = list(everywhere)
            out = pd.DataFrame({"word": keys, "n": [everywhere[k] for k in keys]}
                               | {name: [c[k] for k in keys] for name, c in zip(("clean", "toxic", "other"), docs)})
            for c in (everywhere, *docs):
                c.clear()
            return out

        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                found = tokens(text)
                found += [t[:STEM] + "*" for t in found if len(t) > STEM]
                everywhere.update(found)
                docs[2 if toxic < 0 else 1 if toxic else 0].update(set(found))
                if len(everywhere) > flush:
                    yield rows()
        yield rows()

    return run


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model | None:
    """The model, or None where the training rows lack a class."""
    spark = docs.sparkSession
    small_batches(spark)
    train = cut(labelled(labels, settings), "tox-train")
    classes = {r.toxic: r["count"] for r in train.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).count().collect()}
    if not classes.get(0) or not classes.get(1):
        return None
    marked = docs.select("doc_id", "text").join(F.broadcast(train), "doc_id", "left")  # at most max_labelled rows
    parts = marked.select("text", F.coalesce(F.col("toxic"), F.lit(-1)).alias("toxic")).mapInPandas(
        _counted(settings.flush), "word string, n long, clean long, toxic long, other long")
    counts = cut(parts.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("n", "clean", "toxic", "other")]), "tox-words")
    n, n0, n1, n2 = counts.agg(*[F.sum(c) for c in ("n", "clean", "toxic", "other")]).first()
    if not n0 or not n1:
        return None
    a0 = settings.prior * (n0 + n1)
    a = (F.col("clean") + F.col("toxic") + F.col("other")) * (a0 / (n0 + n1 + n2))
    y1, y0 = F.col("toxic") + a, F.col("clean") + a
    delta = F.log(y1 / (n1 + a0 - y1)) - F.log(y0 / (n0 + a0 - y0))
    sd = F.sqrt(1 / y1 + 1 / y0)
    known = (counts.where(F.col("toxic") + F.col("clean") >= settings.min_docs)
             .select("word", delta.alias("delta"), sd.alias("sd"), (F.col("n") / n).alias("p"),
                     (y0 / (n0 + a0) / ((y0 + y1) / (n0 + n1 + 2 * a0))).alias("clean_share"))
             .where(F.abs(F.col("delta") / F.col("sd")) >= settings.min_z)
             .select("word", (F.signum("delta") * (F.abs("delta") - settings.shrink * F.col("sd"))).alias("delta"),
                     F.abs(F.col("delta") / F.col("sd")).alias("z"), (F.col("p") * F.col("clean_share")).alias("p")))
    # every one of them is in min_docs labelled documents at least, of which there are max_labelled at most
    top = sorted(known.collect(), key=lambda r: (-r.z, r.word))
    p = np.array([r.p for r in top] + [max(1e-9, 1 - sum(r.p for r in top))])
    s = np.array([r.delta for r in top] + [0.0])
    shift = float((p * s).sum()) + settings.drift
    s = s - shift
    lexicon = {r.word: float(r.delta - shift) for r in top}
    lam = _lambda(p / p.sum(), s)
    raw = Model(lexicon, -shift, lam, 0.0, 0.0, 0.0)
    # the labelled documents' best segments give K, then the logistic curve
    own = cut(docs.select("doc_id", "text").join(F.broadcast(train), "doc_id")
              .select("toxic", _best(raw)(F.col("text")).alias("b")).select("toxic", "b.*"), "tox-best")
    clean = own.where("toxic = 0").agg(F.count("*"), F.sum(F.col("n_tokens") * F.exp(-lam * F.col("best")))).first()
    log_k = math.log(clean[0] / clean[1]) if clean[0] and clean[1] else 0.0
    model = Model(lexicon, -shift, lam, log_k, 0.0, 0.0)
    bins = (docs.select("doc_id", "text").join(F.broadcast(train), "doc_id")
            .select("toxic", scorer(model)(F.col("text"))["evidence"].alias("x"))
            .groupBy(F.round(_curve(F.col("x")), 2).alias("x"), (F.col("toxic") > 0).cast("int").alias("y"))
            .count().collect())
    bias, slope = _logistic([(r.x, r.y, r["count"]) for r in bins])
    return Model(lexicon, -shift, lam, log_k, bias, slope)


def _curve(x: Column) -> Column:
    return F.log1p(x)


def _lambda(p: np.ndarray, s: np.ndarray) -> float:
    """The positive root of sum p e^(lambda s) = 1; 1 where no weight is positive."""
    if not (s > 0).any():
        return 1.0
    f = lambda x: float((p * np.exp(x * s)).sum()) - 1.0
    hi = 0.5
    while f(hi) < 0 and hi < 64:
        hi *= 2
    lo = 0.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) < 0 else (lo, mid)
    return max(hi, 1e-3)


def _logistic(rows: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Ridge logistic curve by Newton's method over binned (x, label, count)."""
    x, y, n = (np.array(v, dtype=float) for v in zip(*rows))
    w, z = np.zeros(2), np.stack([np.ones_like(x), x], 1)
    for _ in range(60):
        q = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (n * (y - q)) - 0.1 * w
        h = (z * (n * q * (1 - q))[:, None]).T @ z + 0.1 * np.eye(2)
        w = w + np.clip(np.linalg.solve(h, g), -2, 2)
    return float(w[0]), float(max(w[1], 0.0))


def _weights(model: Model, text: str | None) -> np.ndarray:
    get, rest = model.lexicon.get, model.neutral
    return np.array([w if (w := get(t)) is not None else get(t[:STEM] + "*", rest) if len(t) > STEM else rest
                     for t in tokens(text)], dtype=float)


def _best(model: Model):
    @F.pandas_udf("n_tokens int, best double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch:
                w = _weights(model, text)
                out.append((len(w), max((s for *_, s in segments(w)), default=0.0)))
            yield pd.DataFrame(out, columns=["n_tokens", "best"])

    return run


def scorer(model: Model):
    """Text -> struct of OUT: passages whose calibrated score is above zero, and their sum."""

    @F.pandas_udf(OUT)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch:
                w = _weights(model, text)
                floor = model.log_k + math.log(max(len(w), 1))
                found = [(a, b, model.lam * s - floor) for a, b, s in segments(w) if model.lam * s > floor]
                out.append((len(w), float(sum(s for *_, s in found)),
                            [{"start": a, "end": b, "score": s} for a, b, s in found]))
            yield pd.DataFrame(out, columns=["n_tokens", "evidence", "passages"])

    return run


def score(docs: DataFrame, model: Model | None, text: str = "text", out: str = "toxicity") -> DataFrame:
    """Add ``out``: struct<n_tokens, evidence, passages, score, predicted>.  A
    column of that name in the input is replaced."""
    if model is None:
        none = F.array().cast("array<struct<start:int,end:int,score:double>>")
        return docs.withColumn(out, F.struct(F.lit(0).alias("n_tokens"), F.lit(0.0).alias("evidence"),
                                             none.alias("passages"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted")))
    raw = f"__{out}_raw"
    df = docs.withColumn(raw, scorer(model)(F.col(text)))
    value = 1 / (1 + F.exp(-(model.bias + model.slope * _curve(F.col(raw)["evidence"]))))
    df = df.withColumn(f"{raw}_p", value)
    return df.withColumn(out, F.struct(f"{raw}.*", F.col(f"{raw}_p").alias("score"),
                                       (F.col(f"{raw}_p") >= 0.5).cast("int").alias("predicted"))).drop(raw, f"{raw}_p")
