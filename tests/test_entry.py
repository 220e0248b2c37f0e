"""Driver contract: entry, registry and a sample of queries at sf0.001."""

import importlib.util
import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
entry_mod = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry_mod)

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].perplexity > 1


def test_registry_consistent():
    q, sql = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(sql) <= set(q)
    assert len(q) >= 80


@pytest.mark.parametrize("name", ["index_articles", "article_parse", "lm_windows", "metric_dispatch",
                                  "packed_docs", "nli_repair", "best_run", "clf_eval", "lm_generate_counts"])
def test_query_runs_small(spark, name):
    df = entry_mod.queries()[name](spark, SF)
    assert df.count() >= 0 and len(df.columns) > 0
