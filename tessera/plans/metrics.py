"""Metric queries.

Binary set: ``labels`` joined to ``documents`` on doc_id, ``pred = n_chars > 800``,
``label = quality``.  Three-class set: ``label = quality + toxic``,
``pred = least(n_chars div 1000, 2)``.  Regression set: ``lineitem``,
``l_extendedprice / 1000`` against ``l_quantity``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..sources.tables import load
from .registry import query

SQL_BIN = """
pr AS (SELECT doc_id, CAST(d.n_chars > 800 AS BIGINT) AS pred, CAST(l.quality AS BIGINT) AS label
       FROM labels l JOIN documents d USING (doc_id))"""
SQL_MULTI = """
pm AS (SELECT doc_id, CAST(least(d.n_chars // 1000, 2) AS BIGINT) AS pred,
              CAST(l.quality + l.toxic AS BIGINT) AS label
       FROM labels l JOIN documents d USING (doc_id))"""
SQL_REG = """
rg AS (SELECT l_extendedprice / 1000.0 AS pred, l_quantity AS label FROM lineitem)"""
SQL_F1 = """coalesce(2.0 * sum(CASE WHEN pred = 1 AND label = 1 THEN 1 ELSE 0 END) /
   nullif(2 * sum(CASE WHEN pred = 1 AND label = 1 THEN 1 ELSE 0 END)
          + sum(CASE WHEN pred = 1 AND label <> 1 THEN 1 ELSE 0 END)
          + sum(CASE WHEN pred <> 1 AND label = 1 THEN 1 ELSE 0 END), 0), 0.0)"""
SQL_ACC = "avg(CASE WHEN pred = label THEN 1.0 ELSE 0.0 END)"


def _mcc_sql(src: str) -> str:
    return f"""
conf AS (SELECT label AS t, pred AS p, count(*)::DOUBLE AS n FROM {src} GROUP BY label, pred),
tkk AS (SELECT t AS k, sum(n) AS tk FROM conf GROUP BY t),
pkk AS (SELECT p AS k, sum(n) AS pk FROM conf GROUP BY p),
mg AS (SELECT coalesce(tk, 0) AS tk, coalesce(pk, 0) AS pk FROM tkk FULL JOIN pkk USING (k)),
ag AS (SELECT sum(tk) AS s, sum(tk * pk) AS tp, sum(tk * tk) AS tt, sum(pk * pk) AS pp FROM mg),
cc AS (SELECT coalesce(sum(n), 0) AS c FROM conf WHERE t = p),
mcc AS (SELECT CASE WHEN (s * s - pp) * (s * s - tt) > 0
                    THEN (c * s - tp) / sqrt((s * s - pp) * (s * s - tt)) ELSE 0.0 END AS v
        FROM ag, cc)"""


def _spearman_sql(src: str, x="pred", y="label") -> str:
    return f"""
rk AS (SELECT {x}, {y},
              rank() OVER (ORDER BY {x}) + (count(*) OVER (PARTITION BY {x}) - 1) / 2.0 AS rx,
              rank() OVER (ORDER BY {y}) + (count(*) OVER (PARTITION BY {y}) - 1) / 2.0 AS ry
       FROM {src})"""


PEARSON = "covar_pop({x}, {y}) / sqrt(var_pop({x}) * var_pop({y}))"


def binary_pairs(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select(
        "doc_id", (F.col("n_chars") > 800).cast("long").alias("pred"))
    refs = load(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("long").alias("label"))
    return M.pair(docs, refs, "doc_id")


def multi_pairs(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select(
        "doc_id", F.least(F.floor(F.col("n_chars") / 1000), F.lit(2)).cast("long").alias("pred"))
    refs = load(spark, sf_dir, "labels").select(
        "doc_id", (F.col("quality") + F.col("toxic")).cast("long").alias("label"))
    return M.pair(docs, refs, "doc_id")


def regression_pairs(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select(
        (F.col("l_extendedprice") / 1000.0).alias("pred"), F.col("l_quantity").alias("label"))


@query("metric_accuracy", f"WITH {SQL_BIN} SELECT count(*) AS n, round({SQL_ACC}, 6) AS accuracy FROM pr")
def metric_accuracy(spark, sf_dir):
    """A1 + J6."""
    return binary_pairs(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"),
                                           F.round(M.accuracy(), 6).alias("accuracy"))


@query("metric_unmatched", """
SELECT doc_id, CASE WHEN l.doc_id IS NULL THEN 'prediction' ELSE 'reference' END AS only_in
FROM (SELECT doc_id FROM documents) d FULL JOIN (SELECT doc_id FROM labels) l USING (doc_id)
WHERE d.doc_id IS NULL OR l.doc_id IS NULL
""")
def metric_unmatched(spark, sf_dir):
    """Keys with a prediction and no reference (or the reverse)."""
    return M.unmatched(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"), "doc_id")


@query("metric_f1", f"WITH {SQL_BIN} SELECT round({SQL_F1}, 6) AS f1 FROM pr")
def metric_f1(spark, sf_dir):
    """A2."""
    return binary_pairs(spark, sf_dir).agg(F.round(M.f1_binary(), 6).alias("f1"))


@query("metric_acc_f1", f"WITH {SQL_BIN} SELECT round({SQL_ACC}, 6) AS accuracy, round({SQL_F1}, 6) AS f1 FROM pr")
def metric_acc_f1(spark, sf_dir):
    """A3."""
    r = M.acc_and_f1(binary_pairs(spark, sf_dir))
    return r.select(F.round("accuracy", 6).alias("accuracy"), F.round("f1", 6).alias("f1"))


@query("metric_mcc", f"WITH {SQL_MULTI}, {_mcc_sql('pm')} SELECT round(v, 6) AS matthews_correlation FROM mcc")
def metric_mcc(spark, sf_dir):
    """A4, three classes."""
    r = M.matthews(multi_pairs(spark, sf_dir))
    return r.select(F.round("matthews_correlation", 6).alias("matthews_correlation"))


@query("metric_pearson", f"WITH {SQL_REG} SELECT round({PEARSON.format(x='pred', y='label')}, 6) AS pearson FROM rg")
def metric_pearson(spark, sf_dir):
    """A5."""
    return regression_pairs(spark, sf_dir).agg(F.round(M.pearson(), 6).alias("pearson"))


@query("metric_spearman", f"WITH {SQL_REG}, {_spearman_sql('rg')} SELECT round({PEARSON.format(x='rx', y='ry')}, 6) AS spearmanr FROM rk")
def metric_spearman(spark, sf_dir):
    """A6 with W2 average ranks."""
    r = M.spearman(regression_pairs(spark, sf_dir))
    return r.select(F.round("spearmanr", 6).alias("spearmanr"))


@query("metric_corr_pair", f"""WITH {SQL_REG}, {_spearman_sql('rg')}
SELECT round({PEARSON.format(x='pred', y='label')}, 6) AS pearson,
       round({PEARSON.format(x='rx', y='ry')}, 6) AS spearmanr FROM rk""")
def metric_corr_pair(spark, sf_dir):
    """A7."""
    r = M.pearson_and_spearman(regression_pairs(spark, sf_dir))
    return r.select(F.round("pearson", 6).alias("pearson"), F.round("spearmanr", 6).alias("spearmanr"))


@query("metric_mse", f"WITH {SQL_REG} SELECT round(avg((pred - label) * (pred - label)), 6) AS mse FROM rg")
def metric_mse(spark, sf_dir):
    """A8."""
    return regression_pairs(spark, sf_dir).agg(F.round(M.mse(), 6).alias("mse"))


SQL_DISPATCH = f"""
WITH {SQL_BIN}, {SQL_MULTI}, {_mcc_sql('pm')},
rf AS (SELECT CAST(l_extendedprice / 1000.0 AS FLOAT) AS pred, CAST(l_quantity AS FLOAT) AS label
       FROM lineitem),
{_spearman_sql('rf')},
lng AS (
  SELECT 'cola' AS config, 'matthews_correlation' AS metric, v AS value FROM mcc
  UNION ALL SELECT 'mrpc', 'accuracy', {SQL_ACC} FROM pr
  UNION ALL SELECT 'mrpc', 'f1', {SQL_F1} FROM pr
  UNION ALL SELECT 'sst2', 'accuracy', {SQL_ACC} FROM pr
  UNION ALL SELECT 'stsb', 'pearson', {PEARSON.format(x='pred', y='label')} FROM rk
  UNION ALL SELECT 'stsb', 'spearmanr', {PEARSON.format(x='rx', y='ry')} FROM rk)"""


def _dispatch(spark, sf_dir):
    b, m, r = binary_pairs(spark, sf_dir), multi_pairs(spark, sf_dir), regression_pairs(spark, sf_dir)
    cells = M.confusion(b)
    parts = [M.metric_by_config(M.confusion(m), "cola", weight="n"), M.metric_by_config(cells, "mrpc", weight="n"),
             M.metric_by_config(cells, "sst2", weight="n"), M.metric_by_config(r, "stsb")]
    return reduce(lambda a, c: a.unionByName(c), parts)


@query("metric_dispatch", SQL_DISPATCH + " SELECT config, metric, round(value, 6) AS value FROM lng")
def metric_dispatch(spark, sf_dir):
    """Cola, mrpc, sst2 and stsb through the dispatch (stsb on float32)."""
    return _dispatch(spark, sf_dir).select("config", "metric", F.round("value", 6).alias("value"))


@query("metric_combined", SQL_DISPATCH + """
SELECT config, round(avg(value), 6) AS combined_score FROM lng GROUP BY config HAVING count(*) > 1""")
def metric_combined(spark, sf_dir):
    """A10: combined score of the configurations with several metrics."""
    r = M.combined_score(_dispatch(spark, sf_dir))
    return r.select("config", F.round("combined_score", 6).alias("combined_score"))
