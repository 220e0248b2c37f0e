"""Edge cases from SURVEY 5.2: D21, empty split, null text, CSV by extension."""

import math

from pyspark.sql import functions as F

from tessera.functions.text import count_tokens, tokenize
from tessera.operators import ngram
from tessera.operators.html import parse_article
from tessera.operators.splits import split_fixed, split_fraction
from tessera.session import scratch_path
from tessera.sources import files


def test_final_one_token_window_is_left_out(spark):
    # L = S = 4 and N = 9: the last window holds one token and no left context
    stream = ["a", "b", "a", "b", "a", "b", "a", "b", "a"]
    st = spark.createDataFrame([(g, stream[g], stream[g - 1] if g else None) for g in range(9)],
                               "g long, tok string, prev string")
    tg = ngram.stream_targets(st, F.lit(9), 4, 4)
    last = tg.where("win = 8").first()
    assert last.trg_len == 1 and last.n_scored == 0 and not last.scored and last.weight is None
    model = spark.createDataFrame([("a", "b", 4), ("b", "a", 3)], "ctx string, tok string, cnt long")
    r = ngram.corpus_perplexity(tg, model, F.lit(9)).first()
    # windows 0 and 4 each score 3 tokens, weighted by 4/3; N stays 9
    v = 3
    nll_ab, nll_ba = -math.log((4 + 1) / (4 + v)), -math.log((3 + 1) / (3 + v))
    want = math.exp((4 / 3 * (nll_ab + nll_ba + nll_ab) + 4 / 3 * (nll_ab + nll_ba + nll_ab)) / 9)
    assert r.n_scored == 6 and abs(r.perplexity - round(want, 6)) < 1e-6


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "doc_id long")
    assert split_fixed(empty, "doc_id", 5, 5).count() == 0
    assert split_fraction(empty, "doc_id").count() == 0
    d = spark.createDataFrame([(1,), (2,)], "doc_id long")
    s = {r.doc_id: r.split for r in split_fixed(d, "doc_id", 5, 5).collect()}
    assert sorted(s.values()) == ["test", "test"]


def test_null_text(spark):
    df = spark.createDataFrame([(1, None), (2, "a b")], "k long, t string")
    out = {r.k: (r.toks, r.n) for r in df.select("k", tokenize("t").alias("toks"),
                                                  count_tokens("t").alias("n")).collect()}
    assert out[1] == (None, None) and out[2] == (["a", "b"], 2)
    parsed = {r.k: (r.content, r.ok) for r in parse_article(df, "k", "t").collect()}
    assert parsed[1] == (None, False) and parsed[2] == (None, False)


def test_read_table_csv(spark):
    p = scratch_path(spark, "t") + ".csv"
    spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string").coalesce(1).write.option("header", True).csv(p)
    got = sorted((r.a, r.b) for r in files.read_table(spark, p).collect())
    assert got == [(1, "x"), (2, "y")]


def test_quoted_fields_double_their_quotes(spark):
    p = files.write_lines(spark.createDataFrame([('"say ""hi"""\t"a\\"\tend',)], "v string"), scratch_path(spark, "quoted"))
    row = files.read_tsv(spark, p, "a string, b string, c string", quoting=True).first()
    assert tuple(row) == ('say "hi"', "a\\", "end")


def test_materialize_writes_again_after_a_write_that_did_not_end(spark):
    p = scratch_path(spark, "half")
    spark.range(3).write.parquet(p)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, False)
    assert files.materialize(spark.range(5), p).count() == 5
    assert files.materialize(spark.range(9), p).count() == 5


def test_argument_validation(spark):
    import pytest
    from tessera.operators import tokens as tk
    toks = spark.createDataFrame([(0, 1)], "g long, id int")
    with pytest.raises(ValueError):
        tk.strided_windows(toks, F.lit(1), 2, 3)
    st = spark.createDataFrame([(0, "a", None)], "g long, tok string, prev string")
    with pytest.raises(ValueError):
        ngram.stream_targets(st, F.lit(1), 4, 4, weighting="mean")


def test_clear_scratch_deletes_only_its_own(spark):
    from tessera.session import clear_scratch, cut_lineage, ensure_checkpoint_dir
    kept = ensure_checkpoint_dir(spark).rstrip("/") + "/tessera-scratch/another-application/t"
    spark.range(3).write.mode("overwrite").parquet(kept)
    cut = cut_lineage(spark.range(5))
    path = cut.inputFiles()[0]
    assert cut.count() == 5
    clear_scratch(spark)
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(path))
    assert spark.read.parquet(kept).count() == 3
