"""Benchmark-table and experiment queries (S1-S5, S13-S15, P4-P7, P10-P12,
U3, A15, W4, J4, J5, J7-J11, A11, A17, M1-M5, T20, T21).

Task files are written from the driver's tables into the session's shared
folder and read back, so the readers and repairs run on real files whose
size grows with the tables (FIXTURES 5).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import count_tokens, truncate_at_punct
from ..operators import classifier as CL
from ..operators import logistic
from ..operators import experiments as X
from ..operators import tables as TB
from ..operators.corpus import union_sources
from ..operators.splits import split_fixed
from ..session import cut_lineage, scratch_path
from ..sources import files
from ..sources.tables import load
from .registry import query

# text of a document as one TSV-safe line (no tabs, newlines or quotes)
SQL_LINE = "replace(regexp_replace(text, '[\\t\\n]', ' ', 'g'), '\"', '''')"


def line_text(col="text"):
    return F.replace(F.regexp_replace(F.col(col), r"[\t\n]", " "), F.lit('"'), F.lit("'"))


def _nli_word():
    return (F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "entailment")
            .when((F.col("quality") == 0) & (F.col("toxic") == 0), "neutral")
            .when((F.col("quality") == 0) & (F.col("toxic") == 1), "contradiction")
            .otherwise("other"))


SQL_NLI_WORD = """CASE WHEN quality = 1 AND toxic = 0 THEN 'entailment'
     WHEN quality = 0 AND toxic = 0 THEN 'neutral'
     WHEN quality = 0 AND toxic = 1 THEN 'contradiction' ELSE 'other' END"""

PAIR_SCHEMA = "label int, idx1 bigint, idx2 bigint, sentence1 string, sentence2 string"


@query("src_tsv_roundtrip", f"""
SELECT CAST(l.quality AS INTEGER) AS label, d.doc_id AS idx1, d.doc_id + 1 AS idx2,
       {SQL_LINE} AS sentence1, d.source AS sentence2
FROM documents d JOIN labels l USING (doc_id)""")
def src_tsv_roundtrip(spark, sf_dir):
    """Pair-task TSV (no header, declared columns, quotes as plain text)."""
    d = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id")
    out = d.select(F.col("quality").alias("label"), F.col("doc_id").alias("idx1"),
                   (F.col("doc_id") + 1).alias("idx2"), line_text().alias("sentence1"),
                   F.col("source").alias("sentence2"))
    path = files.write_tsv(out, scratch_path(spark, "pair_tsv"))
    return files.read_tsv(spark, path, PAIR_SCHEMA)


@query("pair_repair", f"""
SELECT d.doc_id AS idx1,
       {SQL_LINE} AS sentence1,
       CASE WHEN d.lang = 'es' THEN NULL ELSE d.source END AS sentence2,
       d.lang <> 'es' AS ok
FROM documents d""")
def pair_repair(spark, sf_dir):
    """P4 after the glued read of D8: lines ``label, idx1, idx2, "s1<TAB>s2"``
    read with quoting glue both sentences into ``sentence1``; the repair
    splits them.  Spanish rows carry one sentence only (the reference's
    IndexError), and come out with ``ok = false``."""
    d = load(spark, sf_dir, "documents")
    glued = F.when(F.col("lang") == "es", line_text()).otherwise(
        F.concat(line_text(), F.lit("\t"), F.col("source")))
    lines = d.select(F.concat_ws("\t", F.lit("1"), F.col("doc_id"), F.col("doc_id") + 1,
                                 F.concat(F.lit('"'), glued, F.lit('"'))).alias("value"))
    path = scratch_path(spark, "pair_glued")
    lines.write.mode("overwrite").text(path)
    read = files.read_tsv(spark, path, PAIR_SCHEMA, quoting=True)
    return TB.repair_pair(read).select("idx1", "sentence1", "sentence2", "ok")


SQL_NLI = f"""
WITH n AS (SELECT d.doc_id, {SQL_LINE} AS premise, d.source AS hypothesis, {SQL_NLI_WORD} AS word
           FROM documents d JOIN labels l USING (doc_id))
SELECT premise, hypothesis,
       CASE word WHEN 'entailment' THEN 0 WHEN 'neutral' THEN 1 WHEN 'contradiction' THEN 2 END AS label,
       word AS label_word
FROM n"""


def _nli_read(spark, sf_dir):
    d = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id")
    lines = d.select(F.concat(F.lit('"'), line_text(), F.lit("\t"), F.col("source"), F.lit('"\t'),
                              _nli_word()).alias("value"))
    # written verbatim; every part file starts with the header line
    path = files.write_lines(lines, scratch_path(spark, "nli_tsv"), "premise\thypothesis\tlabel")
    read = files.read_tsv(spark, path, "premise string, hypothesis string, label string",
                          header=True, quoting=True)
    return TB.repair_nli(read)


@query("nli_repair", SQL_NLI)
def nli_repair(spark, sf_dir):
    """S2 + P5 + P6 + T13: inference TSV with a header line, glued premise,
    label word shifted into ``hypothesis``; unknown words -> null (D9)."""
    return _nli_read(spark, sf_dir).select("premise", "hypothesis", "label", "label_word")


@query("cast_features", f"""
WITH r AS ({SQL_NLI})
SELECT label, label_word, count(*) AS n, label IS NOT NULL AS in_domain FROM r GROUP BY label, label_word""")
def cast_features(spark, sf_dir):
    """The repaired table cast to its declared features (3-name class
    label); out-of-domain rows are counted, not dropped."""
    r = TB.cast_features(_nli_read(spark, sf_dir), {"label": "int"}, names=["e", "n", "c"])
    return r.groupBy("label", "label_word").agg(F.count(F.lit(1)).alias("n"),
                                                F.first("in_domain").alias("in_domain"))


@query("src_tsv_header", f"""
SELECT {SQL_LINE} AS sentence, CAST(l.toxic AS INTEGER) AS label
FROM documents d JOIN labels l USING (doc_id)""")
def src_tsv_header(spark, sf_dir):
    """S3: review-task TSV with one header line skipped."""
    d = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id")
    out = d.select(line_text().alias("sentence"), F.col("toxic").alias("label"))
    path = files.write_tsv(out, scratch_path(spark, "review_tsv"), header=True)
    return files.read_tsv(spark, path, "sentence string, label int", header=True)


@query("src_json_roundtrip", "SELECT doc_id, lang, source, n_chars FROM documents")
def src_json_roundtrip(spark, sf_dir):
    """A ``.json`` path is read as JSON lines (the extension picks it)."""
    d = load(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    path = scratch_path(spark, "docs") + ".json"
    d.write.mode("overwrite").json(path)
    return files.read_table(spark, path, "doc_id long, lang string, source string, n_chars long")


@query("generic_table", f"""
WITH c AS (SELECT 'class' AS src, {SQL_LINE} AS sentence, d.source, CAST(l.quality AS VARCHAR) AS label
           FROM documents d JOIN labels l USING (doc_id)),
r AS (SELECT 'score' AS src, {SQL_LINE} AS sentence, d.source, NULL AS label FROM documents d JOIN labels l USING (doc_id)),
u AS (SELECT * FROM c UNION ALL SELECT * FROM r)
SELECT src, 'sentence' AS text_1, 'source' AS text_2, src = 'score' AS regression,
       CAST(CASE WHEN label IS NOT NULL THEN dense_rank() OVER (PARTITION BY src ORDER BY label) - 1 END AS INTEGER) AS label_id,
       count(*) AS n, CAST(sum(length(sentence)) AS BIGINT) AS chars_1, CAST(sum(length(source)) AS BIGINT) AS chars_2
FROM u GROUP BY src, label""")
def generic_table(spark, sf_dir):
    """Files without a task.  The extension picks the reader, the text
    columns and the label domain come from the table, and a floating-point
    label makes it a regression (no domain)."""
    d = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id")
    d = d.select(line_text().alias("sentence"), "source", "quality", (F.col("n_chars") / 1000.0).alias("score"))
    parts = []
    for src, label, kind in (("class", "quality", "int"), ("score", "score", "double")):
        path = scratch_path(spark, src) + ".csv"
        (d.select("sentence", "source", F.col(label).cast(kind).alias("label")).write.option("header", True)
         .option("escape", '"').csv(path))
        t = files.read_table(spark, path, f"sentence string, source string, label {kind}")
        a, b = TB.resolve_text_columns(t.columns)
        regression = TB.is_regression(t)
        rows = (t.withColumn("id", F.lit(None).cast("int")) if regression
                else t.join(TB.label_domain(t), "label", "left"))
        parts.append(rows.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(a)).alias("chars_1"),
                                            F.sum(F.length(b)).alias("chars_2"))
                     .select(F.lit(src).alias("src"), F.lit(a).alias("text_1"), F.lit(b).alias("text_2"),
                             F.lit(regression).alias("regression"), F.col("id").alias("label_id"), "n", "chars_1", "chars_2"))
    return parts[0].unionByName(parts[1])


@query("split_union_counts", """
WITH r AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS rn
           FROM documents),
s AS (SELECT CASE WHEN rn <= 60 THEN 'test' WHEN rn <= 120 THEN 'validation' ELSE 'train' END AS split,
             CASE WHEN rn <= 60 THEN 'test' WHEN rn <= 120 THEN 'dev' ELSE 'train' END AS file_split,
             n_chars FROM r)
SELECT split, file_split, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM s GROUP BY split, file_split""")
def split_union_counts(spark, sf_dir):
    """S5 + S13: one file set per split (``train_0``, ``valid_0``, ``test_0``)
    read into one dataset; the split name also comes from the file name."""
    d = split_fixed(load(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    base = scratch_path(spark, "splits")
    names = {"train": "train_0.tsv", "validation": "valid_0.tsv", "test": "test_0.tsv"}
    fname = F.concat(F.col("split"), F.lit("_0.tsv"))
    # one pass over the documents writes all three file sets
    files.write_tsv(d.select("doc_id", "n_chars", fname.alias("file")), base, partition_by="file")
    paths = {split: f"{base}/file={f}" for split, f in names.items()}
    u = files.read_splits(spark, paths, lambda s, p: files.read_tsv(s, p, "doc_id bigint, n_chars bigint"))
    u = files.with_file_split(u, "file_split")
    return u.groupBy("split", "file_split").agg(F.count(F.lit(1)).alias("n"),
                                                F.sum("n_chars").alias("chars"))


SQL_CODES = """
c AS (SELECT doc_id, CASE lang WHEN 'fr' THEN 'CLS' WHEN 'en' THEN 'PAWSX' WHEN 'de' THEN 'XNLI'
                     ELSE 'WSD' END || '-' || source AS code FROM documents),
reg AS (SELECT * FROM (VALUES ('cls', 'sentence', NULL, 'sst2'), ('pawsx', 'sentence1', 'sentence2', 'mrpc'),
                              ('xnli', 'premise', 'hypothesis', 'mnli'))
        t(task, sentence1_key, sentence2_key, metric))"""


def task_codes(spark, sf_dir):
    d = load(spark, sf_dir, "documents")
    code = F.concat(F.when(F.col("lang") == "fr", "CLS").when(F.col("lang") == "en", "PAWSX")
                    .when(F.col("lang") == "de", "XNLI").otherwise("WSD"), F.lit("-"), F.col("source"))
    return d.select("doc_id", code.alias("code"))


@query("task_metric_join", f"""WITH {SQL_CODES}
SELECT doc_id, lower(split_part(code, '-', 1)) AS task, split_part(code, '-', 2) AS subtask,
       sentence1_key, sentence2_key, metric, metric IS NOT NULL AS known
FROM c LEFT JOIN reg ON reg.task = lower(split_part(code, '-', 1))""")
def task_metric_join(spark, sf_dir):
    """S14 + S15 + J7: task codes split, looked up in the task registry;
    ``wsd`` has no loader and no metric (D10) and stays unknown."""
    t = TB.with_task(task_codes(spark, sf_dir), "code")
    return t.select("doc_id", "task", "subtask", "sentence1_key", "sentence2_key", "metric", "known")


@query("corpus_filter", f"""
WITH u AS (SELECT doc_id, source, lang, text FROM documents
           UNION ALL SELECT item_id, 'benchmark', 'fr', text FROM benchmark),
t AS (SELECT source, doc_id, lang,
             len(regexp_extract_all(text, '\\p{{L}}+|\\p{{N}}+|[^\\s\\p{{L}}\\p{{N}}]+')) AS n_tokens FROM u)
SELECT source, doc_id, CAST(n_tokens AS INTEGER) AS n_tokens FROM t
WHERE source IN ('src0', 'src1', 'src2', 'src3', 'src4', 'benchmark') AND n_tokens >= 50 AND lang = 'fr'""")
def corpus_filter(spark, sf_dir):
    """U3 + P10 + P11 + P12: documents and the benchmark passages as one
    corpus, kept by source allow-list, length and language."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    bench = load(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text",
                                                    F.lit("fr").alias("lang"))
    u = docs.unionByName(union_sources({"benchmark": bench}), allowMissingColumns=True)
    f = TB.filter_lang(TB.filter_long(TB.filter_sources(
        u, ["src0", "src1", "src2", "src3", "src4", "benchmark"]), 50))
    return f.select("source", "doc_id", count_tokens("text").alias("n_tokens"))


@query("label_domain", """
SELECT lang AS label, CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS id
FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL)""")
def label_domain(spark, sf_dir):
    """A15 + W4 + R1: sorted label domain of the language column."""
    return TB.label_domain(load(spark, sf_dir, "documents"), "lang")


MODEL_LABELS = [("FR", 0), ("EN", 1), ("DE", 2), ("ES", 3)]


@query("label_align", """
WITH dd AS (SELECT lang AS label, CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS data_id
            FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL)),
m AS (SELECT lower(name) AS label, id AS model_id FROM (VALUES ('FR', 0), ('EN', 1), ('DE', 2), ('ES', 3)) t(name, id)),
eq AS (SELECT (SELECT list_sort(list(label)) FROM m) = (SELECT list_sort(list(label)) FROM dd) AS aligned)
SELECT dd.label, data_id, CAST(model_id AS INTEGER) AS model_id,
       CAST(CASE WHEN aligned THEN model_id ELSE data_id END AS INTEGER) AS label_id, aligned
FROM dd LEFT JOIN m USING (label), eq""")
def label_align(spark, sf_dir):
    """The model's label names (upper case) matched to the data's domain."""
    model = spark.createDataFrame(MODEL_LABELS, "name string, id int")
    return TB.align_labels(model, TB.label_domain(load(spark, sf_dir, "documents"), "lang"))


# ---------------------------------------------------------------- experiments

@query("grid_runs", f"""WITH {SQL_CODES},
tasks AS (SELECT DISTINCT lower(split_part(code, '-', 1)) AS task FROM c),
g AS (SELECT task, CASE WHEN task IN ('pawsx', 'xnli', 'wsd') THEN 1 ELSE 5 END AS n FROM tasks),
x AS (SELECT task, n, lr_idx, lr, bs_idx, bs, seed
      FROM g, (VALUES (0, 1e-5), (1, 2e-5), (2, 5e-5)) a(lr_idx, lr), (VALUES (0, 8), (1, 16)) b(bs_idx, bs),
           range(0, 5) s(seed) WHERE seed < n)
SELECT task, CAST(lr_idx * 2 * n + bs_idx * n + seed AS BIGINT) AS run_idx, CAST(lr AS DOUBLE) AS learning_rate,
       CAST(bs AS INTEGER) AS batch_size, CAST(seed AS INTEGER) AS seed,
       printf('%d_%.1e_%d', seed, lr, bs) AS run_key, 2 AS steps, CAST(2 * bs AS INTEGER) AS final_batch
FROM x""")
def grid_runs(spark, sf_dir):
    """J4 + J5 + T21 + M5 + X2: the run grid of every task found in the data
    ('1e-5/2e-5/5e-5' x '8/16' x seeds, one seed for pawsx/xnli/wsd)."""
    tasks = TB.with_task(task_codes(spark, sf_dir), "code").select("task").distinct()
    return X.grid(tasks, "1e-5/2e-5/5e-5", "8/16", 5, steps=2)


SQL_RUNS = """
rt AS (SELECT CAST(l_partkey % 3 AS INTEGER) AS lr_idx, CAST(l_suppkey % 3 AS INTEGER) AS bs_idx,
              l_linenumber - 1 AS seed, CASE l_linestatus WHEN 'O' THEN 'dev' ELSE 'test' END AS phase,
              avg(l_discount) AS metric_1, avg(l_tax) AS metric_2, avg(l_quantity) / 50 AS loss
       FROM lineitem GROUP BY ALL),
runs AS (SELECT CAST(lr_idx * 21 + bs_idx * 7 + seed AS BIGINT) AS run_idx,
                [1e-5, 2e-5, 5e-5][lr_idx + 1] AS learning_rate, [8, 16, 32][bs_idx + 1] AS batch_size,
                CAST(seed AS INTEGER) AS seed, phase, metric_1, metric_2, loss FROM rt),
runs2 AS (SELECT *, printf('%d_%.1e_%d', seed, learning_rate, batch_size) AS run_key FROM runs)"""


def run_table(spark, sf_dir):
    """A run table with the shape of the reference's results (FIXTURES 9),
    derived from ``lineitem``: rate from the part key, batch size from the
    supplier key, seed from the line number, phase from the line status."""
    li = load(spark, sf_dir, "lineitem")
    g = li.groupBy(F.pmod("l_partkey", F.lit(3)).cast("int").alias("lr_idx"),
                   F.pmod("l_suppkey", F.lit(3)).cast("int").alias("bs_idx"),
                   (F.col("l_linenumber") - 1).alias("seed"),
                   F.when(F.col("l_linestatus") == "O", "dev").otherwise("test").alias("phase")).agg(
        F.avg("l_discount").alias("metric_1"), F.avg("l_tax").alias("metric_2"),
        (F.avg("l_quantity") / 50).alias("loss"))
    lr = F.element_at(F.array(F.lit(1e-5), F.lit(2e-5), F.lit(5e-5)), F.col("lr_idx") + 1)
    bs = F.element_at(F.array(F.lit(8), F.lit(16), F.lit(32)), F.col("bs_idx") + 1)
    from ..functions.text import run_key
    r = g.select((F.col("lr_idx") * 21 + F.col("bs_idx") * 7 + F.col("seed")).cast("long").alias("run_idx"),
                 lr.alias("learning_rate"), bs.alias("batch_size"), F.col("seed").cast("int").alias("seed"),
                 "phase", "metric_1", "metric_2", "loss")
    return r.withColumn("run_key", run_key("seed", "learning_rate", "batch_size"))


@query("run_table", f"""WITH {SQL_RUNS}
SELECT run_idx, run_key, learning_rate, batch_size, seed, phase, round(metric_1, 6) AS metric_1,
       round(metric_2, 6) AS metric_2, round(loss, 6) AS loss FROM runs2""")
def run_table_q(spark, sf_dir):
    """M3 output shape: one row per (run, phase)."""
    r = run_table(spark, sf_dir)
    return r.select("run_idx", "run_key", "learning_rate", "batch_size", "seed", "phase",
                    *[F.round(c, 6).alias(c) for c in ("metric_1", "metric_2", "loss")])


@query("best_run", f"""WITH {SQL_RUNS},
dev AS (SELECT * FROM runs2 WHERE phase = 'dev'),
b AS (SELECT arg_max(run_key, (metric_1, -run_idx)) AS k FROM dev),
best AS (SELECT dev.* FROM dev, b WHERE dev.run_key = b.k),
same AS (SELECT dev.* FROM dev JOIN best USING (learning_rate, batch_size)),
st AS (SELECT round_even(avg(metric_1) * 100, 1) AS avg_dev_1, round_even(stddev_pop(metric_1) * 100, 1) AS std_dev_1,
              round_even(avg(metric_2) * 100, 1) AS avg_dev_2, round_even(stddev_pop(metric_2) * 100, 1) AS std_dev_2,
              count(*) AS n_same FROM same),
t AS (SELECT run_key, metric_1 AS test_metric_1, metric_2 AS test_metric_2 FROM runs2 WHERE phase = 'test')
SELECT best.run_key AS best_run_key, best.seed AS best_seed, best.learning_rate AS best_learning_rate,
       best.batch_size AS best_batch_size, round_even(best.metric_1 * 100, 1) AS best_dev_1,
       round_even(best.metric_2 * 100, 1) AS best_dev_2, round(t.test_metric_1, 6) AS test_metric_1,
       round(t.test_metric_2, 6) AS test_metric_2, avg_dev_1, std_dev_1, avg_dev_2, std_dev_2, n_same
FROM best LEFT JOIN t USING (run_key), st""")
def best_run(spark, sf_dir):
    """M4 = A17 + J9 + A11 + J8 on the run table."""
    r = X.report(run_table(spark, sf_dir))
    return r.withColumn("test_metric_1", F.round("test_metric_1", 6)).withColumn(
        "test_metric_2", F.round("test_metric_2", 6))


@query("paired_prompts", f"""
WITH a AS (SELECT conv_id, turn, text AS prompt FROM conversations WHERE role = 'user'),
b AS (SELECT conv_id, turn - 1 AS turn, text AS completion FROM conversations WHERE role = 'assistant')
SELECT conv_id, turn, prompt, completion,
       regexp_extract(completion, '^[^.,;:!?]*[.,;:!?]?', 0) AS first_clause
FROM a JOIN b USING (conv_id, turn)""")
def paired_prompts(spark, sf_dir):
    """J11 + T20: prompt and completion side by side, the completion also cut
    at its first punctuation mark."""
    p = X.pair_turns(load(spark, sf_dir, "conversations"))
    return p.select("conv_id", "turn", "prompt", "completion",
                    truncate_at_punct("completion").alias("first_clause"))


SMOOTHING, MIN_COUNTS, CLF_SEEDS = (0.1, 0.3, 1.0, 3.0), (1, 2), 5


def _sql_clf(smoothing, min_counts, seeds):
    u = "CAST(('0x' || substr(md5({}), 1, 8)) AS BIGINT) / 4294967296.0"
    points = ", ".join(f"({g}, CAST({a} AS DOUBLE), {c})" for g, (a, c) in enumerate(
        (a, c) for a in smoothing for c in min_counts))
    return f"""
d AS (SELECT doc_id, CAST(quality AS BIGINT) AS label, regexp_extract_all(text, '\\p{{L}}+|\\p{{N}}+|[^\\s\\p{{L}}\\p{{N}}]+') AS toks
      FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL),
s AS (SELECT d.*, CAST(t.seed AS INTEGER) AS seed,
             CASE WHEN {u.format("'42:' || doc_id")} < 0.2 THEN 'test'
                  WHEN {u.format("(t.seed + 43) || ':' || doc_id")} < 0.25 THEN 'dev' ELSE 'train' END AS split
      FROM d, range({seeds}) t(seed)),
bag AS (SELECT seed, split, doc_id, label, tok, count(*) AS m
        FROM (SELECT seed, split, doc_id, label, unnest(toks) AS tok FROM s) GROUP BY ALL),
w AS (SELECT seed, tok, coalesce(sum(m) FILTER (label = 0), 0) AS n0, coalesce(sum(m) FILTER (label = 1), 0) AS n1
      FROM bag WHERE split = 'train' GROUP BY ALL),
pt(g, a, mc) AS (VALUES {points}),
sz AS (SELECT seed, g, count(*) AS v, sum(n0) AS t0, sum(n1) AS t1 FROM w, pt WHERE n0 + n1 >= mc GROUP BY ALL),
pri AS (SELECT seed, count(*) AS n, count(*) FILTER (label = 0) AS d0, count(*) FILTER (label = 1) AS d1
        FROM s WHERE split = 'train' GROUP BY seed),
sm AS (SELECT seed, doc_id, g, sum(m) AS m, sum(m * ln(n0 + a)) AS s0, sum(m * ln(n1 + a)) AS s1
       FROM bag JOIN w USING (seed, tok), pt WHERE split <> 'train' AND n0 + n1 >= mc GROUP BY ALL),
sc AS (SELECT s.seed, s.split AS phase, s.doc_id, s.label, pt.g, a AS smoothing, mc AS min_count,
              ln((d0 + 1.0) / (n + 2.0)) + coalesce(s0, 0) - coalesce(sm.m, 0) * ln(t0 + a * v) AS z0,
              ln((d1 + 1.0) / (n + 2.0)) + coalesce(s1, 0) - coalesce(sm.m, 0) * ln(t1 + a * v) AS z1
       FROM s JOIN pri USING (seed) CROSS JOIN pt JOIN sz ON sz.seed = s.seed AND sz.g = pt.g
       LEFT JOIN sm ON sm.seed = s.seed AND sm.doc_id = s.doc_id AND sm.g = pt.g WHERE s.split <> 'train'),
pr AS (SELECT *, CAST(CASE WHEN z1 > z0 THEN 1 ELSE 0 END AS BIGINT) AS pred,
              greatest(z0, z1) + ln(exp(z0 - greatest(z0, z1)) + exp(z1 - greatest(z0, z1)))
              - CASE label WHEN 0 THEN z0 ELSE z1 END AS loss FROM sc),
ev AS (SELECT g, smoothing, min_count, seed, phase, avg(CASE WHEN pred = label THEN 1.0 ELSE 0.0 END) AS metric_1,
              coalesce(2.0 * sum(CASE WHEN pred = 1 AND label = 1 THEN 1 ELSE 0 END)
                       / nullif(sum(CASE WHEN pred = 1 THEN 1 ELSE 0 END) + sum(CASE WHEN label = 1 THEN 1 ELSE 0 END), 0), 0.0)
                AS metric_2, avg(loss) AS loss FROM pr GROUP BY ALL)"""


SQL_SWEEP = f"""{_sql_clf(SMOOTHING, MIN_COUNTS, CLF_SEEDS)},
rt AS (SELECT CAST(g * {CLF_SEEDS} + seed AS BIGINT) AS run_idx, printf('%d_%.1e_%d', seed, smoothing, min_count) AS run_key,
              smoothing, min_count, seed, phase, metric_1, metric_2, loss FROM ev)"""


def _clf_docs(spark, sf_dir):
    d = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id")
    return d.select("doc_id", "text", F.col("quality").alias("label"))


@query("clf_predictions", f"WITH {_sql_clf((1.0,), (1,), 1)} SELECT doc_id, label, pred FROM pr WHERE phase = 'test'")
def clf_predictions(spark, sf_dir):
    """M1: fit on the training split, predictions on the test split."""
    pred = CL.naive_bayes(_clf_docs(spark, sf_dir), (0, 1))
    return pred.where("split = 'test'").select("doc_id", "label", "pred")


def _rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if c in ("metric_1", "metric_2", "loss") else c for c in df.columns])


@query("clf_eval", f"""WITH {_sql_clf((1.0,), (1,), 1)}
SELECT phase, round(metric_1, 6) AS metric_1, round(metric_2, 6) AS metric_2, round(loss, 6) AS loss FROM ev""")
def clf_eval(spark, sf_dir):
    """M2: accuracy, F1 and log-loss on dev and test."""
    pred = CL.naive_bayes(_clf_docs(spark, sf_dir), (0, 1))
    return _rounded(CL.evaluate(pred, F.col("split").alias("phase")))


def _clf_sweep(spark, sf_dir):
    return CL.sweep(_clf_docs(spark, sf_dir), (0, 1), SMOOTHING, MIN_COUNTS, CLF_SEEDS)


@query("clf_sweep", f"""WITH {SQL_SWEEP}
SELECT run_idx, run_key, smoothing, min_count, seed, phase, round(metric_1, 6) AS metric_1,
       round(metric_2, 6) AS metric_2, round(loss, 6) AS loss FROM rt""")
def clf_sweep(spark, sf_dir):
    """M3: the run table of 4 smoothings x 2 minimum counts x 5 seeds."""
    return _rounded(_clf_sweep(spark, sf_dir))


LOGISTIC = logistic.Grid(rates=(0.5, 2.0), batches=(32, 256), seeds=3, steps=25, reg=1e-4)


def logistic_runs(spark, sf_dir):
    return logistic.sweep(_clf_docs(spark, sf_dir), LOGISTIC)


@query("clf_logistic_runs")
def clf_logistic_runs(spark, sf_dir):
    """M1-M3: the run table of 2 learning rates x 2 batch sizes x 3 seeds of logistic regression over hashed TF-IDF.
    Gradient steps are no SQL; pytest holds them against a plain re-statement."""
    return _rounded(logistic_runs(spark, sf_dir))


@query("clf_logistic_report")
def clf_logistic_report(spark, sf_dir):
    """M4 of the logistic sweep: the best dev run by learning rate, batch size and seed."""
    return X.report(cut_lineage(logistic_runs(spark, sf_dir), "runs"))


@query("clf_runs", f"""WITH {SQL_SWEEP},
dev AS (SELECT * FROM rt WHERE phase = 'dev'),
b AS (SELECT arg_max(run_key, (metric_1, -run_idx)) AS k FROM dev),
best AS (SELECT dev.* FROM dev, b WHERE dev.run_key = b.k),
same AS (SELECT dev.* FROM dev JOIN best USING (smoothing, min_count)),
st AS (SELECT round_even(avg(metric_1) * 100, 1) AS avg_dev_1, round_even(stddev_pop(metric_1) * 100, 1) AS std_dev_1,
              round_even(avg(metric_2) * 100, 1) AS avg_dev_2, round_even(stddev_pop(metric_2) * 100, 1) AS std_dev_2,
              count(*) AS n_same FROM same),
t AS (SELECT run_key, metric_1 AS test_metric_1, metric_2 AS test_metric_2 FROM rt WHERE phase = 'test')
SELECT best.run_key AS best_run_key, best.seed AS best_seed, best.smoothing AS best_smoothing,
       best.min_count AS best_min_count, round_even(best.metric_1 * 100, 1) AS best_dev_1,
       round_even(best.metric_2 * 100, 1) AS best_dev_2, round(t.test_metric_1, 6) AS test_metric_1,
       round(t.test_metric_2, 6) AS test_metric_2, avg_dev_1, std_dev_1, avg_dev_2, std_dev_2, n_same
FROM best LEFT JOIN t USING (run_key), st""")
def clf_runs(spark, sf_dir):
    """M3 + M4: the sweep's best dev run and its report."""
    r = X.report(cut_lineage(_clf_sweep(spark, sf_dir), "runs"), params=("smoothing", "min_count"))
    return r.withColumn("test_metric_1", F.round("test_metric_1", 6)).withColumn(
        "test_metric_2", F.round("test_metric_2", 6))
