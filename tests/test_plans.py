"""Plan shapes that matter at scale."""

from pyspark.sql import functions as F

from tessera.functions.text import explode_nonempty, tokenize
from tessera.operators import experiments as X
from tessera.operators import ngram
from tessera.operators.ordering import global_offsets
from tessera.session import scratch_path
from tessera.sources import files


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_read_prunes_partitions(spark):
    path = scratch_path(spark, "splitds")
    spark.range(10).withColumn("split", F.when(F.col("id") < 3, "test").otherwise("train")) \
        .write.partitionBy("split").parquet(path)
    df = files.read_split(spark, path, "test")
    p = df._jdf.queryExecution().optimizedPlan().toString() + plan(df)
    assert "PartitionFilters: [isnotnull(split" in p and df.count() == 3


def test_grid_has_no_cartesian(spark):
    g = X.grid(spark.createDataFrame([("cls",)], "task string"), "1e-5/2e-5", "8/16", 5)
    p = plan(g)
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


def test_top_k_uses_group_limit(spark):
    dist = spark.createDataFrame([("c", str(i), 1.0 / (i + 1)) for i in range(100)], "ctx string, tok string, p double")
    assert "WindowGroupLimit" in plan(ngram.top_k(dist, 5))


def test_tokenizer_runs_once_per_row(spark):
    d = spark.createDataFrame([("a b c",)], "text string")
    counts = d.select(explode_nonempty(tokenize("text")).alias("t")).where("t is not null").groupBy("t").count()
    assert plan(counts).count("regexp_extract_all") == 1


def test_offsets_window_is_partitioned_by_block(spark):
    df = spark.range(1000).withColumn("n", F.lit(2))
    p = plan(global_offsets(df, ["id"], "n", blocks=4))
    assert "hashpartitioning(_tsr_blk" in p


def test_index_anchors_scan_pages_once(spark):
    from tessera.operators.html import index_anchors
    path = scratch_path(spark, "pages_plan")
    spark.createDataFrame([(1, '<span class="a" id="b">2004</span><li>1 <a href="/wiki/X" title="Y">')],
                          "page_id long, html string").write.parquet(path)
    p = plan(index_anchors(spark.read.parquet(path)))
    assert p.count("FileScan parquet") == 1


def test_encode_reads_input_once(spark):
    from tessera.operators import tokens as tk
    path = scratch_path(spark, "docs_plan")
    spark.createDataFrame([(1, "a b"), (2, "")], "k long, text string").write.parquet(path)
    docs = spark.read.parquet(path).select("k", tokenize("text").alias("tokens"))
    voc = spark.createDataFrame([(5, "a")], "id int, tok string")
    enc = tk.encode(docs, "k", voc)
    assert plan(enc).count("FileScan parquet") == 1
    assert {r.k: r.input_ids for r in enc.collect()} == {1: [5, 2], 2: []}


def test_report_has_no_nested_loop(spark):
    runs = spark.createDataFrame(
        [(0, "a", 1e-5, 8, 0, "dev", 0.5, 0.1, 1.0), (0, "a", 1e-5, 8, 0, "test", 0.4, 0.1, 1.0)],
        "run_idx long, run_key string, learning_rate double, batch_size int, seed int, phase string, "
        "metric_1 double, metric_2 double, loss double")
    r = X.report(runs)
    p = plan(r)
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p
    assert r.first().best_run_key == "a"
