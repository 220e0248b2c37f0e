"""Classification and correlation metrics.

Every metric is an aggregate over (pred, label) rows: partial aggregation on
each task, one tiny final merge.  Confusion counts are grouped to at most
classes^2 rows before marginals are taken, and one such table
(:func:`confusion`) serves every classification metric of an input.  Ranks
(Spearman) are built on the distinct values with distributed offsets, never
with a one-task window, and are joined to distinct pairs with their counts, so
a hot value is one row for each partner.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import ACCURACY_CONFIGS, CONFIG_METRICS, METRIC_CONFIGS
from ..session import cut_lineage
from .ordering import offset_index


def _nan() -> Column:
    return F.lit(float("nan"))


def pair(preds: DataFrame, refs: DataFrame, key: str) -> DataFrame:
    """Predictions and references matched on an explicit key."""
    return preds.join(refs, key, "inner")


def unmatched(preds: DataFrame, refs: DataFrame, key: str) -> DataFrame:
    """Keys present on one side only, with the side that has them."""
    a = preds.select(key).distinct().withColumn("_p", F.lit(True))
    b = refs.select(key).distinct().withColumn("_r", F.lit(True))
    j = a.join(b, key, "full")
    return j.where(F.col("_p").isNull() | F.col("_r").isNull()).select(
        key, F.when(F.col("_p").isNull(), F.lit("reference")).otherwise(F.lit("prediction"))
        .alias("only_in"))


def confusion(df: DataFrame, pred="pred", label="label") -> DataFrame:
    """Counts ``n`` of each (pred, label): the weighted input of A1-A4."""
    return df.groupBy(pred, label).agg(F.count(F.lit(1)).alias("n"))


def _weight(weight: str | None) -> Column:
    return F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")


def accuracy(pred="pred", label="label", weight: str | None = None) -> Column:
    """A1: mean of pred = label over complete pairs."""
    same, w = F.col(pred) == F.col(label), _weight(weight)
    return F.try_divide(F.sum(F.when(same, w).when(~same, F.lit(0))).cast("double"),
                        F.sum(F.when(same.isNotNull(), w)))


def f1_binary(pred="pred", label="label", positive=1, weight: str | None = None) -> Column:
    """A2: binary F1 for the positive class, 0 when undefined."""
    p, y, w = F.col(pred) == positive, F.col(label) == positive, _weight(weight)
    tp = F.coalesce(F.sum(F.when(p & y, w)), F.lit(0))
    fp = F.coalesce(F.sum(F.when(p & ~y, w)), F.lit(0))
    fn = F.coalesce(F.sum(F.when(~p & y, w)), F.lit(0))
    return F.coalesce(F.try_divide(2.0 * tp, 2 * tp + fp + fn), F.lit(0.0))


def mse(pred="pred", label="label") -> Column:
    """Mean squared error."""
    d = F.col(pred).cast("double") - F.col(label).cast("double")
    return F.avg(d * d)


def pearson(x="pred", y="label") -> Column:
    """A5: Pearson correlation over complete pairs; NaN for a constant column
    (no ANSI error)."""
    x, y = F.col(x).cast("double"), F.col(y).cast("double")
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    den = F.sqrt(F.var_pop(x) * F.var_pop(y))
    return F.coalesce(F.try_divide(F.covar_pop(x, y), F.when(den > 0, den)), _nan())


def average_ranks(df: DataFrame, cols: Sequence[str], weight: str | None = None) -> DataFrame:
    """``(c, value, rank)``, the 1-based average rank of each distinct value (as double) of the ``c``-th of
    ``cols``; ties share the mean rank.  The values of all columns are counted (``weight``: rows a row stands for) and
    offset by one distributed prefix sum over (column, value); a column's own offsets begin at its least."""
    each = df.select(F.explode(F.array(*(F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("value")) for i, c in enumerate(cols))))
                     .alias("x"), _weight(weight).alias("_w"))
    counts = each.where("x.value is not null").groupBy("x.c", "x.value").agg(F.sum("_w").alias("_n"))
    off = offset_index(counts, ["c", "value"], "_n", "_o", keep=["_n"])
    first = off.groupBy("c").agg(F.min("_o").alias("_f")).withColumnRenamed("c", "_k")  # a row for each column
    return off.join(F.broadcast(first), F.col("c") == F.col("_k")).select(
        "c", "value", (F.col("_o") - F.col("_f") + (F.col("_n") + 1) / 2.0).alias("rank"))


def spearman(df: DataFrame, x: str = "pred", y: str = "label") -> DataFrame:
    """Pearson over average ranks of complete pairs, one row ``(spearmanr)``.
    Distinct pairs are written once with their counts; the mean rank is known
    (``(N + 1) / 2``), so the moments are centred."""
    pairs = cut_lineage(df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
                        .groupBy(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).agg(F.count(F.lit(1)).alias("_n")), "pairs")
    mean = (pairs.agg(F.sum("_n")).scalar() + 1) / F.lit(2.0)
    ranks = average_ranks(pairs, ["x", "y"], "_n")
    rx, ry = (ranks.where(F.col("c") == i).select(F.col("value").alias(c), F.col("rank").alias(f"r{c}")) for i, c in enumerate("xy"))
    ranked = pairs.join(rx, "x").join(ry, "y").select("_n", (F.col("rx") - mean).alias("a"), (F.col("ry") - mean).alias("b"))
    n, a, b = F.col("_n"), F.col("a"), F.col("b")
    den = F.sqrt(F.sum(n * a * a)) * F.sqrt(F.sum(n * b * b))
    return ranked.agg(F.coalesce(F.try_divide(F.sum(n * a * b), F.when(den > 0, den)), _nan()).alias("spearmanr"))


def matthews(df: DataFrame, pred: str = "pred", label: str = "label", weight: str | None = None) -> DataFrame:
    """A4: multiclass Matthews correlation, 0 when the denominator is 0.
    ``(c*s - sum t_k p_k) / sqrt((s^2 - sum p_k^2)(s^2 - sum t_k^2))`` with
    products in double.  Each confusion cell gives a row to its label's and to
    its prediction's marginal, so the input is read once."""
    cells = df.groupBy(F.col(label).alias("t"), F.col(pred).alias("p")).agg(
        F.sum(_weight(weight)).cast("double").alias("n"))
    zero = F.lit(0.0)
    sides = cells.select(F.explode(F.array(
        F.struct(F.col("t").alias("k"), F.col("n").alias("tk"), zero.alias("pk"),
                 F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(zero).alias("c")),
        F.struct(F.col("p").alias("k"), zero.alias("tk"), F.col("n").alias("pk"), zero.alias("c")))).alias("m")).select("m.*")
    marg = sides.groupBy("k").agg(*[F.sum(v).alias(v) for v in ("tk", "pk", "c")])
    s, c, tp, tt, pp = (F.col(v) for v in ("s", "c", "tp", "tt", "pp"))
    den = (s * s - pp) * (s * s - tt)
    return marg.agg(
        F.sum("tk").alias("s"), F.sum("c").alias("c"), F.sum(F.col("tk") * F.col("pk")).alias("tp"),
        F.sum(F.col("tk") * F.col("tk")).alias("tt"), F.sum(F.col("pk") * F.col("pk")).alias("pp")
    ).select(F.coalesce(F.try_divide(c * s - tp, F.when(den > 0, F.sqrt(den))), zero).alias("matthews_correlation"))


def acc_and_f1(df: DataFrame, pred="pred", label="label", weight: str | None = None) -> DataFrame:
    """A3: accuracy and F1 in one pass."""
    return df.agg(accuracy(pred, label, weight).alias("accuracy"), f1_binary(pred, label, weight=weight).alias("f1"))


def pearson_and_spearman(df: DataFrame, pred="pred", label="label") -> DataFrame:
    """Pearson (one aggregate over the rows) and Spearman."""
    return df.agg(pearson(pred, label).alias("pearson")).select(
        "pearson", spearman(df, pred, label).scalar().alias("spearmanr"))


def _long(wide: DataFrame, names: list[str]) -> DataFrame:
    stack = ", ".join(f"'{n}', `{n}`" for n in names)
    return wide.selectExpr(f"stack({len(names)}, {stack}) as (metric, value)")


def metric_by_config(df: DataFrame, config: str, pred="pred", label="label", weight: str | None = None) -> DataFrame:
    """Metric set chosen by configuration name, long form (metric, value).
    Unknown names are refused.  With ``weight`` the rows are confusion counts
    (classification only)."""
    if config not in METRIC_CONFIGS:
        raise KeyError(f"metric configuration must be one of {METRIC_CONFIGS}")
    if config == "cola":
        wide = matthews(df, pred, label, weight)
    elif config == "stsb":
        wide = pearson_and_spearman(df.select(F.col(pred).cast("float").alias(pred),
                                              F.col(label).cast("float").alias(label)),
                                    pred, label)
    elif config in ("mrpc", "qqp"):
        wide = acc_and_f1(df, pred, label, weight)
    elif config in ACCURACY_CONFIGS:
        wide = df.agg(accuracy(pred, label, weight).alias("accuracy"))
    else:  # pragma: no cover - the lists above cover every legal name
        raise KeyError(config)
    names = CONFIG_METRICS.get(config, ["accuracy"])
    return _long(wide, names).withColumn("config", F.lit(config))


def combined_score(metrics: DataFrame, by: str = "config") -> DataFrame:
    """A10: mean of all metrics of a result that has more than one."""
    return (metrics.groupBy(by).agg(F.avg("value").alias("combined_score"),
                                    F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > 1).drop("_n"))
