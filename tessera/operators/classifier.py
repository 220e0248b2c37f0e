"""Text classifier fit, evaluation and sweep (M1-M3, M6).

The reference fine-tunes a neural model per (rate, batch size, seed).  Here
the checked classifier is multinomial naive Bayes, whose parameters are counts:
its grid is ``smoothing`` x ``min_count`` x seeds, and a seed draws the dev
part, so runs differ as repeated draws do.  All runs share one pass: counts are
grouped by seed, every grid point is a pair of columns, and no driver loop
submits a job per run.  Logistic regression on Spark ML is an option with its
own parameters (:func:`fit_logistic`).

A document without a label is left out; one without known tokens gets the
priors.  ``labels`` is the declared class list (P7), so the columns per class
are bounded by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import TOKEN_PATTERN, explode_nonempty, md5_unit, tokenize
from ..session import cut_lineage
from .metrics import accuracy, f1_binary

TEST_SEED, DEV_SEED = 42, 43


def seeded_splits(docs: DataFrame, seeds: int = 1, key: str = "doc_id", test: float = 0.2,
                  dev: float = 0.25) -> DataFrame:
    """Each document once per seed with its ``split``: one fixed test part, and
    a dev part of the rest drawn by the seed (row-local, no shuffle)."""
    runs = docs.withColumn("seed", F.explode(F.sequence(F.lit(0), F.lit(seeds - 1))))
    return runs.withColumn("split", F.when(md5_unit(F.lit(TEST_SEED), F.col(key)) < test, "test")
                           .when(md5_unit(F.col("seed") + DEV_SEED, F.col(key)) < dev, "dev").otherwise("train"))


def bags(docs: DataFrame, text: str = "text", key: str = "doc_id", label: str = "label") -> DataFrame:
    """(key, label, tok, m): token counts of each labelled document."""
    words = docs.where(F.col(label).isNotNull()).select(key, F.col(label).alias("label"),
                                                        explode_nonempty(tokenize(text)).alias("tok"))
    return words.where(F.col("tok").isNotNull()).groupBy(key, "label", "tok").agg(F.count(F.lit(1)).alias("m"))


def _cells(seeds: int, labels: Sequence[int]) -> list[tuple[int, int]]:
    return [(s, i) for s in range(seeds) for i in range(len(labels))]


def _total(s: int, labels: Sequence[int]) -> Column:
    return sum((F.col(f"n_{s}_{i}") for i in range(1, len(labels))), F.col(f"n_{s}_0"))


def fit_naive_bayes(train_bags: DataFrame, labels: Sequence[int], seeds: int) -> DataFrame:
    """M1: (tok, n_0_0, n_0_1, ...), training occurrences by seed and class.  ``train_bags`` has each bag once, with the
    seeds it is dev of as bits of ``dev``."""
    return train_bags.groupBy("tok").agg(*[
        F.coalesce(F.sum(F.when((F.getbit("dev", F.lit(s)) == 0) & (F.col("label") == labels[i]), F.col("m"))), F.lit(0)).alias(f"n_{s}_{i}")
        for s, i in _cells(seeds, labels)])


def predict_naive_bayes(words: DataFrame, train_docs: DataFrame, eval_docs: DataFrame, eval_bags: DataFrame,
                        labels: Sequence[int], smoothing: Sequence[float], min_counts: Sequence[int], seeds: int,
                        key: str = "doc_id") -> DataFrame:
    """(seed, split, key, label, run_idx, smoothing, min_count, pred, loss) for
    every document and grid point, ``run_idx`` in product order with the seed
    last.  Bags are joined with the words once for all seeds and grid points; the join
    has one row per token on the model's side, so a hot token is many rows on the
    other side only, which AQE splits."""
    grid = [(a, c) for a in smoothing for c in min_counts]
    cells, k = _cells(seeds, labels), len(labels)
    known = {(s, j): _total(s, labels) >= max(1, c) for s in range(seeds) for j, c in enumerate(min_counts)}
    size = words.agg(*[x for (s, j), here in known.items() for x in (
        F.count(F.when(here, F.lit(1))).alias(f"v_{s}_{j}"),
        *[F.coalesce(F.sum(F.when(here, F.col(f"n_{s}_{i}"))), F.lit(0)).alias(f"t_{s}_{j}_{i}") for i in range(k)])]).first()
    prior = train_docs.agg(*[F.coalesce(F.sum(F.when((F.getbit("dev", F.lit(s)) == 0) & (F.col("label") == labels[i]), F.lit(1))), F.lit(0))
                             .alias(f"d_{s}_{i}") for s, i in cells]).first()
    # logarithms once for each word, not for each of its places
    logs = words.select(
        "tok", *[F.struct(*[known[s, j].alias(f"k_{j}") for j in range(len(min_counts))]).alias(f"h_{s}") for s in range(seeds)],
        *[F.log(F.col(f"n_{s}_{i}") + F.lit(float(a))).alias(f"l_{s}_{n}_{i}") for s, i in cells for n, a in enumerate(smoothing)])
    met = eval_bags.join(logs, "tok")
    sums = met.groupBy(key).agg(
        *[F.sum(F.when(F.col(f"h_{s}.k_{j}"), F.col("m"))).alias(f"m_{s}_{j}") for s, j in known],
        *[F.sum(F.when(F.col(f"h_{s}.k_{list(min_counts).index(c)}"), F.col("m") * F.col(f"l_{s}_{list(smoothing).index(a)}_{i}"))).alias(f"s_{s}_{g}_{i}")
          for g, (a, c) in enumerate(grid) for s, i in cells])
    rows = eval_docs.select(key, "label", "test", "dev").join(sums, key, "left")
    zero, points = F.lit(0.0), []
    for s in range(seeds):
        n = sum(prior[f"d_{s}_{i}"] for i in range(k))
        for g, (a, c) in enumerate(grid):
            j = list(min_counts).index(c)
            scores = F.array(*[
                F.log(F.lit((prior[f"d_{s}_{i}"] + 1.0) / (n + float(k)))) + F.coalesce(F.col(f"s_{s}_{g}_{i}"), zero)
                - F.coalesce(F.col(f"m_{s}_{j}"), F.lit(0)) * F.log(F.lit(size[f"t_{s}_{j}_{i}"] + float(a) * size[f"v_{s}_{j}"] + 1e-300))
                for i in range(k)])
            points.append(F.struct(F.lit(s).alias("seed"), F.lit(g).alias("g"), F.lit(float(a)).alias("smoothing"),
                                   F.lit(int(c)).alias("min_count"), scores.alias("scores"), F.lit(bool(n)).alias("fitted")))
    names = F.array(*[F.lit(c).cast("long") for c in labels])
    out = rows.select(key, "test", "dev", F.col("label").cast("long").alias("label"), F.explode(F.array(*points)).alias("p"))
    out = out.where((F.col("test") | (F.getbit("dev", F.col("p.seed")) == 1)) & F.col("p.fitted"))
    out = out.select(F.col("p.seed").alias("seed"), F.when(F.col("test"), "test").otherwise("dev").alias("split"), key, "label",
                     F.col("p.g").alias("g"), F.col("p.smoothing").alias("smoothing"),
                     F.col("p.min_count").alias("min_count"), F.col("p.scores").alias("s"), F.array_max("p.scores").alias("top"))
    mass = F.aggregate(F.transform("s", lambda x: F.exp(x - F.col("top"))), zero, lambda x, y: x + y)
    return out.select("seed", "split", key, "label", "g", "smoothing", "min_count",
                      F.element_at(names, F.array_position("s", F.col("top")).cast("int")).alias("pred"),
                      (F.col("top") + F.log(mass) - F.try_element_at("s", F.array_position(names, F.col("label")).cast("int")))
                      .alias("loss"))


def with_parts(docs: DataFrame, seeds: int, key: str = "doc_id", test: float = 0.2, dev: float = 0.25) -> DataFrame:
    """The splits of :func:`seeded_splits` without a row per seed: ``test``, and ``dev`` with a bit for each seed."""
    bits = [F.when(md5_unit(F.lit(s + DEV_SEED), F.col(key)) < dev, F.lit(1 << s)).otherwise(F.lit(0)).cast("long") for s in range(seeds)]
    in_test = md5_unit(F.lit(TEST_SEED), F.col(key)) < test
    return docs.withColumn("test", in_test).withColumn("dev", sum(bits[1:], bits[0]))


def naive_bayes(docs: DataFrame, labels: Sequence[int], smoothing: Sequence[float] = (1.0,),
                min_counts: Sequence[int] = (1,), seeds: int = 1, key: str = "doc_id") -> DataFrame:
    """M1 on every seed (63 at most): predictions of the dev and test documents.  Token counts of the documents are
    written once, with their seeds as bits, and shuffled once by token and once by document for all runs."""
    docs = docs.where(F.col("label").isNotNull())
    bag = with_parts(cut_lineage(bags(docs, key=key), "bags"), seeds, key)
    heads = with_parts(docs.select(key, "label"), seeds, key)
    words = cut_lineage(fit_naive_bayes(bag.where("not test"), labels, seeds), "words")
    return predict_naive_bayes(words, heads.where("not test"), heads.where("test or dev <> 0"),
                               bag.where("test or dev <> 0").select(key, "tok", "m"), labels, smoothing, min_counts, seeds, key)


def evaluate(pred: DataFrame, *by: str) -> DataFrame:
    """M2: accuracy, F1 and mean log-loss of predictions, by any columns."""
    return pred.groupBy(*by).agg(accuracy().alias("metric_1"), f1_binary().alias("metric_2"), F.avg("loss").alias("loss"))


def sweep(docs: DataFrame, labels: Sequence[int], smoothing: Sequence[float], min_counts: Sequence[int],
          seeds: int, do_train: bool = True, do_eval: bool = True) -> DataFrame | None:
    """M3 + M6: the run table of the whole grid, one row per (run, phase); a
    missing metric stays null.  Nothing is returned unless both stages run."""
    if not (do_train and do_eval):
        return None
    pred = naive_bayes(docs, labels, smoothing, min_counts, seeds)
    runs = evaluate(pred, "g", "smoothing", "min_count", "seed", F.col("split").alias("phase"))
    return runs.select((F.col("g") * seeds + F.col("seed")).cast("long").alias("run_idx"),
                       F.format_string("%d_%.1e_%d", "seed", "smoothing", "min_count").alias("run_key"),
                       "smoothing", "min_count", "seed", "phase", "metric_1", "metric_2", "loss")


# --------------------------------------------------------------------------
# Logistic regression (optional, Spark ML)
# --------------------------------------------------------------------------

def featurize(df: DataFrame, text: str = "text", num_features: int = 1 << 16) -> DataFrame:
    """Token counts hashed to ``num_features`` dimensions, IDF-weighted.  With
    a ``split`` column the IDF is fitted on the training rows only."""
    tok = RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=TOKEN_PATTERN, gaps=False,
                         toLowercase=False)
    tf = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features)
    idf = IDF(inputCol="_tf", outputCol="features")
    fit_on = df.where(F.col("split") == "train") if "split" in df.columns else df
    model = Pipeline(stages=[tok, tf, idf]).fit(fit_on)
    return model.transform(df).drop("_tokens", "_tf")


def fit_logistic(train: DataFrame, reg_param: float = 0.01, max_iter: int = 20, label: str = "label"):
    """Logistic regression on ``features``, over every training row."""
    return LogisticRegression(featuresCol="features", labelCol=label, regParam=reg_param, maxIter=max_iter).fit(train)


def predict_logistic(model, df: DataFrame, label: str = "label") -> DataFrame:
    """(..., label, pred, loss) of a fitted model, ready for :func:`evaluate`."""
    p = F.greatest(F.element_at(vector_to_array("probability"), F.col(label).cast("int") + 1), F.lit(1e-15))
    return model.transform(df).withColumn("loss", -F.log(p)).withColumn("pred", F.col("prediction").cast("long")).withColumn(
        "label", F.col(label).cast("long")).drop("features", "rawPrediction", "probability", "prediction")
