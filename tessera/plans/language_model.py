"""Language-model evaluation queries (S6, P1, P2, P13, K1, K3, K6-K8, L1-L8, A12,
plus the streaming token counts).

Data: ``documents``.  The held-out part is a seeded md5 draw of 10% of the
documents (so the scored stream grows with the table); the rest trains the
count model.  Paragraphs are lines of ``text`` (FIXTURES 6), right-stripped,
blanks dropped, in (doc_id, pos) order - the reference's concatenated test set.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import GEN_MAX_LENGTH
from ..functions.text import count_tokens, explode_nonempty, posexplode_nonempty, rtrim_ws, tokenize
from ..operators import generation, kneser_ney, ngram, scoring, tokens as tk
from ..operators.ordering import global_offsets
from ..operators.splits import split_fixed, split_fraction
from ..session import cut_lineage
from ..sources.tables import load
from .registry import query

TOKEN_RE = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+"
WIN_LEN, WIN_STRIDE = 128, 64          # overlapping windows
BLOCK_LEN = 1024                       # the notebook's n_positions = stride

# ---------------------------------------------------------------- DuckDB parts
HELD_FRACTION = 0.1

# held-out = seeded md5 draw below HELD_FRACTION (grows with the table)
SQL_HOLDOUT = f"""
d AS (SELECT doc_id, text, regexp_extract_all(text, '{TOKEN_RE}') AS toks FROM documents),
r AS (SELECT doc_id, text, toks,
             CAST(('0x' || substr(md5('42:' || doc_id), 1, 8)) AS BIGINT) / 4294967296.0 < {HELD_FRACTION}
               AS held FROM d)"""

SQL_TEST_PARAS = SQL_HOLDOUT + f""",
sp AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS para,
              CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS BIGINT) AS pos
       FROM r WHERE held),
tp AS (SELECT doc_id, pos, rtrim(para) AS paragraph,
              regexp_extract_all(rtrim(para), '{TOKEN_RE}') AS toks
       FROM sp WHERE length(rtrim(para)) > 0),
tt AS (SELECT doc_id, pos, unnest(toks) AS tok, generate_subscripts(toks, 1) AS k FROM tp),
gs AS (SELECT row_number() OVER (ORDER BY doc_id, pos, k) - 1 AS g, tok FROM tt),
gp AS (SELECT g, tok, lag(tok) OVER (ORDER BY g) AS prev FROM gs),
nt AS (SELECT count(*) AS n FROM gs)"""

SQL_BIGRAM = f""",
trd AS (SELECT toks FROM r WHERE NOT held),
pr AS (SELECT toks[i] AS ctx, toks[i + 1] AS tok
       FROM (SELECT toks, unnest(range(1, len(toks))) AS i FROM trd)),
m AS (SELECT ctx, tok, count(*) AS cnt FROM pr GROUP BY ctx, tok),
ct AS (SELECT ctx, sum(cnt) AS ctx_cnt FROM m GROUP BY ctx),
vv AS (SELECT count(*) + 1 AS v FROM (SELECT ctx FROM m UNION SELECT tok FROM m))"""

SQL_VOCAB = f""",
tru AS (SELECT unnest(toks) AS tok FROM r WHERE NOT held),
vc AS (SELECT tok, count(*) AS cnt FROM tru GROUP BY tok),
voc AS (SELECT CAST(row_number() OVER (ORDER BY cnt DESC, tok) + 4 AS INTEGER) AS id, tok
        FROM vc)"""


def _sql_targets(L: int, S: int) -> str:
    return f""",
tg AS (SELECT g, tok, prev,
              g // {S} * {S} AS w,
              greatest(g // {S} * {S} + {S - L}, 0) AS b,
              least(g // {S} * {S} + {S}, nt.n) - g // {S} * {S} AS trg
       FROM gp, nt),
sc AS (SELECT prev AS ctx, tok,
              trg::DOUBLE / (trg - CASE WHEN b = w THEN 1 ELSE 0 END) AS weight
       FROM tg WHERE g > b)"""


def _sql_window_ids(L: int, S: int) -> str:
    return SQL_TEST_PARAS + SQL_VOCAB + f""",
gi AS (SELECT g, CAST(coalesce(voc.id, 2) AS INTEGER) AS id FROM gs LEFT JOIN voc USING (tok)),
ex AS (SELECT g, id, unnest(range(g // {S} * {S},
                                  least((g + {L - S}) // {S} * {S}, (nt.n - 1) // {S} * {S}) + 1,
                                  {S})) AS win_start
       FROM gi, nt),
wins AS (SELECT win_start,
                greatest(win_start + {S - L}, 0) AS begin_loc,
                least(win_start + {S}, nt.n) AS end_loc,
                CAST(least(win_start + {S}, nt.n) - win_start AS INTEGER) AS trg_len,
                list(id ORDER BY g) AS input_ids,
                list(CASE WHEN g < win_start THEN -100 ELSE id END ORDER BY g) AS target_ids
         FROM ex, nt GROUP BY win_start, nt.n)"""


# ---------------------------------------------------------------- Spark parts
def holdout_docs(spark, sf_dir):
    """Evaluation split of the LM queries: a seeded md5 draw holds out
    ``HELD_FRACTION`` of the documents, so the scored stream grows with the
    table."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", tokenize("text").alias("tokens"))
    return split_fraction(docs, "doc_id", test=HELD_FRACTION, valid=0.0, seed=42)


def paragraphs(docs):
    """Lines of the text, right-stripped, blanks dropped."""
    p = (docs.select("doc_id", posexplode_nonempty(F.split("text", "\n")).alias("pos", "para"))
         .where(F.col("pos").isNotNull()))
    p = p.select("doc_id", F.col("pos").cast("long").alias("pos"),
                 rtrim_ws("para").alias("paragraph"))
    return p.where(F.length("paragraph") > 0)


def test_paragraphs(split):
    return paragraphs(split.where("split = 'test'"))


def test_stream(spark, sf_dir):
    """The held-out stream, a document a row: its paragraphs' tokens with their global offset and the token before
    them.  Tokens never span lines, so a document's tokens are those of its right-stripped lines."""
    split = holdout_docs(spark, sf_dir)
    lines = F.array_join(F.transform(F.split("text", "\n"), lambda x: rtrim_ws(x)), "\n")
    docs = split.where("split = 'test'").select("doc_id", tokenize(lines).alias("tokens"))
    return split, tk.token_stream(docs, ["doc_id"], "tokens").where("n > 0")


def train_vocab(split):
    train = (split.where("split = 'train'").select(explode_nonempty("tokens").alias("tok"))
             .where(F.col("tok").isNotNull()))
    return tk.build_vocab(train, "tok", 1)


def bigram_model(split):
    """Bigram counts of the training split, written once (the model is read
    by the pair join, the context totals and the vocabulary size)."""
    return cut_lineage(ngram.fit_bigram(split.where("split = 'train'"), "tokens"))


def n_total(stream):
    """N, the stream length: one aggregate over the materialised stream, used
    as a literal in every window bound."""
    return F.lit(stream.select(F.coalesce(F.sum("n"), F.lit(0)).cast("long")).first()[0])


@query("lm_unigram_perplexity", f"""
WITH {SQL_HOLDOUT},
tr AS (SELECT unnest(toks) AS tok FROM r WHERE NOT held),
te AS (SELECT unnest(toks) AS tok FROM r WHERE held),
c AS (SELECT tok, count(*) AS c FROM tr GROUP BY tok),
s AS (SELECT (SELECT count(*) FROM tr) AS n, (SELECT count(*) FROM c) AS v)
SELECT count(*) AS n_tokens,
       round(exp(avg(-ln((coalesce(c.c, 0) + 1.0) / (s.n + s.v + 1.0)))), 6) AS perplexity
FROM te LEFT JOIN c USING (tok) CROSS JOIN s
""")
def lm_unigram_perplexity(spark, sf_dir):
    """Minimum slice: add-one unigram fitted on the training documents,
    perplexity of the held-out documents' tokens."""
    split = holdout_docs(spark, sf_dir)
    toks = split.select("split", explode_nonempty("tokens").alias("tok")).where(F.col("tok").isNotNull())
    return ngram.unigram_perplexity(toks.where("split = 'train'"), toks.where("split = 'test'"))


@query("stream_token_counts", f"""
SELECT tok, count(*) AS cnt FROM (SELECT unnest(regexp_extract_all(text, '{TOKEN_RE}')) AS tok FROM documents)
GROUP BY tok""")
def stream_token_counts(spark, sf_dir):
    """L1 (unigram counts) as a stateful Structured Streaming aggregation over
    landed document files.  In update mode each micro-batch appends only the
    tokens whose running count changed (with its epoch) to a Parquet table in
    the shared folder, so a batch costs what it changed, not the whole
    vocabulary; running counts only grow, so the latest is the largest."""
    from ..session import scratch_path
    from ..streaming.corpus_stream import token_count_stream, write_counts_stream
    landed = scratch_path(spark, "landed_docs")
    load(spark, sf_dir, "documents").select("doc_id", "text").write.parquet(landed)
    table, ckpt = scratch_path(spark, "stream_counts"), scratch_path(spark, "stream_counts_ckpt")

    def sink(batch, epoch):
        batch.withColumn("epoch", F.lit(epoch)).write.mode("append").parquet(table)

    docs = spark.readStream.schema("doc_id long, text string").option("maxFilesPerTrigger", 64).parquet(landed)
    q = write_counts_stream(token_count_stream(docs), sink, ckpt, mode="update")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(table).groupBy("tok").agg(F.max("cnt").alias("cnt"))


@query("lm_paragraph_scan", """
WITH r AS (SELECT doc_id, text,
                  row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS rn FROM documents),
sp AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS para,
              CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS BIGINT) AS pos
       FROM r WHERE rn <= 60)
SELECT doc_id, pos, rtrim(para) AS paragraph FROM sp WHERE length(rtrim(para)) > 0
""")
def lm_paragraph_scan(spark, sf_dir):
    """S6 + P1 + P2: the corpus is written split-partitioned, then the test
    split is read back by partition pruning and cut into paragraphs."""
    from ..sources.files import read_split, write_split_dataset
    docs = split_fixed(load(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    path = write_split_dataset(docs, "lm_corpus")
    return paragraphs(read_split(spark, path, "test"))


@query("lm_train_scan", """
WITH r AS (SELECT doc_id, text,
                  row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS rn FROM documents),
sp AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS para,
              CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS BIGINT) AS pos
       FROM r WHERE rn > 120)
SELECT doc_id, pos, rtrim(para) AS paragraph FROM sp WHERE length(rtrim(para)) > 0
""")
def lm_train_scan(spark, sf_dir):
    """S6 + P1 + P2 on the part that grows with the table: the training split read back by partition pruning."""
    from ..sources.files import read_split, write_split_dataset
    docs = split_fixed(load(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return paragraphs(read_split(spark, write_split_dataset(docs, "lm_corpus"), "train"))


@query("lm_stream", f"""
WITH {SQL_TEST_PARAS}
SELECT doc_id, pos, CAST(len(toks) AS INTEGER) AS n,
       CAST(sum(len(toks)) OVER (ORDER BY doc_id, pos) - len(toks) AS BIGINT) AS start
FROM tp
""")
def lm_stream(spark, sf_dir):
    """Global token offset of every held-out paragraph."""
    paras = test_paragraphs(holdout_docs(spark, sf_dir)).select("doc_id", "pos", count_tokens("paragraph").alias("n"))
    return global_offsets(paras, ["doc_id", "pos"], "n", "start").where("n > 0")


@query("lm_windows", f"""
WITH {_sql_window_ids(WIN_LEN, WIN_STRIDE)}
SELECT * FROM wins
""")
def lm_windows(spark, sf_dir):
    """K3 + K7 + K8: encoded stream cut into overlapping windows with masks."""
    split, stream = test_stream(spark, sf_dir)
    enc = tk.encode(stream.select("start", "n", "tokens"), "start", train_vocab(split), "tokens", "ids")
    return tk.strided_windows_rows(enc, n_total(stream), WIN_LEN, WIN_STRIDE, "ids")


@query("lm_windows_scored", f"""
WITH {_sql_window_ids(WIN_LEN, WIN_STRIDE)}
SELECT win_start, list_filter(target_ids, lambda x: x <> -100) AS scored_ids,
       CAST(len(list_filter(target_ids, lambda x: x <> -100)) AS INTEGER) AS n_scored
FROM wins
""")
def lm_windows_scored(spark, sf_dir):
    """The scored targets of each window."""
    w = lm_windows(spark, sf_dir)
    s = tk.scored_ids("target_ids")
    return w.select("win_start", s.alias("scored_ids"), F.size(s).alias("n_scored"))


@query("lm_bigram_counts", f"""
WITH {SQL_HOLDOUT}{SQL_BIGRAM}
SELECT ctx, tok, cnt FROM m
""")
def lm_bigram_counts(spark, sf_dir):
    """L1: bigram counts of the training documents."""
    return bigram_model(holdout_docs(spark, sf_dir))


def _targets(spark, sf_dir, L, S, weighting="window"):
    split, stream = test_stream(spark, sf_dir)
    n = n_total(stream)
    tg = ngram.stream_targets(tk.stream_tokens(stream), n, L, S, weighting)
    return split, tg, n


@query("lm_nll", f"""
WITH {SQL_TEST_PARAS}{SQL_BIGRAM}{_sql_targets(WIN_LEN, WIN_STRIDE)}
SELECT g, tg.tok, prev, round(-ln((coalesce(m.cnt, 0) + 1.0) / (coalesce(ct.ctx_cnt, 0) + vv.v)), 6) AS nll
FROM tg LEFT JOIN m ON m.ctx = tg.prev AND m.tok = tg.tok
        LEFT JOIN ct ON ct.ctx = tg.prev CROSS JOIN vv
WHERE g > b
""")
def lm_nll(spark, sf_dir):
    """L2: add-one bigram NLL of every scored target of the held-out stream."""
    split, tg, _ = _targets(spark, sf_dir, WIN_LEN, WIN_STRIDE)
    pairs = tg.where("scored").select("g", "tok", F.col("prev").alias("ctx"))
    pairs = cut_lineage(pairs, "nll-targets")
    known = ngram.bigram_nll(pairs.select("ctx", "tok").distinct(), bigram_model(split))  # every pair is scored once
    return pairs.join(known, ["ctx", "tok"]).select("g", "tok", F.col("ctx").alias("prev"), F.round("nll", 6).alias("nll"))


@query("lm_outside_scores", f"""
WITH {SQL_TEST_PARAS}{SQL_BIGRAM},
gd AS (SELECT doc_id, tok, lag(tok) OVER (ORDER BY doc_id, pos, k) AS prev FROM tt)
SELECT CAST(doc_id AS VARCHAR) AS key, count(prev) AS n_tokens,
       round(coalesce(sum(CASE WHEN prev IS NOT NULL THEN -ln((coalesce(m.cnt, 0) + 1.0) / (coalesce(ct.ctx_cnt, 0) + vv.v)) END), 0), 4) AS nll_sum
FROM gd LEFT JOIN m ON m.ctx = gd.prev AND m.tok = gd.tok LEFT JOIN ct ON ct.ctx = gd.prev CROSS JOIN vv GROUP BY doc_id
""")
def lm_outside_scores(spark, sf_dir):
    """An outside model, here the bigram counts written to a file that every task loads, scores the held-out
    documents; their sums are those of ``lm_nll``."""
    split, stream = test_stream(spark, sf_dir)
    texts = stream.select("doc_id", F.concat(F.array("prev"), "tokens").alias("tokens"))
    scores = scoring.score_bigrams(texts, "doc_id", "tokens", bigram_model(split))
    return scores.select("key", "n_tokens", F.round("nll_sum", 4).alias("nll_sum"))


def _sql_ppl(L, S, weighting):
    nll = "-ln((coalesce(m.cnt, 0) + 1.0) / (coalesce(ct.ctx_cnt, 0) + vv.v))"
    if weighting == "window":
        value = f"exp(sum(weight * {nll}) / any_value(nt.n))"
    else:
        value = f"exp(sum({nll}) / count(*))"
    return f"""
WITH {SQL_TEST_PARAS}{SQL_BIGRAM}{_sql_targets(L, S)}
SELECT count(*) AS n_scored, round({value}, 6) AS perplexity
FROM sc LEFT JOIN m USING (ctx, tok) LEFT JOIN ct USING (ctx) CROSS JOIN vv CROSS JOIN nt
"""


def _ppl(spark, sf_dir, L, S, weighting):
    split, tg, n = _targets(spark, sf_dir, L, S, weighting)
    return ngram.corpus_perplexity(tg, bigram_model(split), n, 1.0, weighting)


@query("lm_perplexity", _sql_ppl(BLOCK_LEN, BLOCK_LEN, "window"))
def lm_perplexity(spark, sf_dir):
    """Windows of 1,024 with stride 1,024 as in the notebook; every
    window's first token has no left context (D20 weighting)."""
    return _ppl(spark, sf_dir, BLOCK_LEN, BLOCK_LEN, "window")


@query("lm_perplexity_strided", _sql_ppl(WIN_LEN, WIN_STRIDE, "window"))
def lm_perplexity_strided(spark, sf_dir):
    """L3/A12 with overlapping windows (128 / 64)."""
    return _ppl(spark, sf_dir, WIN_LEN, WIN_STRIDE, "window")


@query("lm_perplexity_token_mean", _sql_ppl(WIN_LEN, WIN_STRIDE, "scored"))
def lm_perplexity_token_mean(spark, sf_dir):
    """A12 with ``weighting='scored'``: the exact mean over scored tokens."""
    return _ppl(spark, sf_dir, WIN_LEN, WIN_STRIDE, "scored")


N_GRAM = 3


@query("lm_trigram_perplexity", f"""
WITH {SQL_TEST_PARAS},
gw AS (SELECT g, tok, g // {BLOCK_LEN} * {BLOCK_LEN} AS b, lag(tok) OVER (ORDER BY g) AS p1, lag(tok, 2) OVER (ORDER BY g) AS p2 FROM gs),
tg AS (SELECT tok AS w, p1, CASE WHEN g - 2 >= b THEN p2 END AS p2,
              trg::DOUBLE / (trg - 1) AS weight
       FROM (SELECT *, least(b + {BLOCK_LEN}, nt.n) - b AS trg FROM gw, nt) WHERE g > b),
trd AS (SELECT toks, unnest(range(1, len(toks) + 1)) AS i FROM r WHERE NOT held),
c3 AS (SELECT CASE WHEN i > 2 THEN toks[i - 2] ELSE '<s>' END AS a, CASE WHEN i > 1 THEN toks[i - 1] ELSE '<s>' END AS b,
              toks[i] AS w, count(*) AS c FROM trd GROUP BY ALL),
c2 AS (SELECT b, w, count(*) AS c FROM c3 GROUP BY ALL),
c1 AS (SELECT w, count(*) AS c FROM c2 GROUP BY ALL),
d3 AS (SELECT CASE WHEN count(*) FILTER (c = 1) = 0 THEN 0.5 ELSE
           count(*) FILTER (c = 1) / (count(*) FILTER (c = 1) + 2.0 * count(*) FILTER (c = 2)) END AS d FROM c3),
d2 AS (SELECT CASE WHEN count(*) FILTER (c = 1) = 0 THEN 0.5 ELSE
           count(*) FILTER (c = 1) / (count(*) FILTER (c = 1) + 2.0 * count(*) FILTER (c = 2)) END AS d FROM c2),
d1 AS (SELECT CASE WHEN count(*) FILTER (c = 1) = 0 THEN 0.5 ELSE
           count(*) FILTER (c = 1) / (count(*) FILTER (c = 1) + 2.0 * count(*) FILTER (c = 2)) END AS d, count(*) AS v, sum(c) AS tot FROM c1),
t3 AS (SELECT a, b, sum(c) AS tot, count(*) AS types FROM c3 GROUP BY a, b),
t2 AS (SELECT b, sum(c) AS tot, count(*) AS types FROM c2 GROUP BY b),
s1 AS (SELECT tg.*, greatest(coalesce(c1.c, 0) - d1.d, 0) / d1.tot + d1.d * d1.v / d1.tot / (d1.v + 1) AS q
       FROM tg LEFT JOIN c1 USING (w) CROSS JOIN d1),
s2 AS (SELECT s1.w, p1, p2, weight, CASE WHEN t2.tot IS NULL THEN q
              ELSE greatest(coalesce(c2.c, 0) - d2.d, 0) / t2.tot + d2.d * t2.types / t2.tot * q END AS q
       FROM s1 LEFT JOIN c2 ON c2.b = p1 AND c2.w = s1.w LEFT JOIN t2 ON t2.b = p1 CROSS JOIN d2),
s3 AS (SELECT weight, CASE WHEN t3.tot IS NULL THEN q
              ELSE greatest(coalesce(c3.c, 0) - d3.d, 0) / t3.tot + d3.d * t3.types / t3.tot * q END AS q
       FROM s2 LEFT JOIN c3 ON c3.a = p2 AND c3.b = p1 AND c3.w = s2.w LEFT JOIN t3 ON t3.a = p2 AND t3.b = p1 CROSS JOIN d3)
SELECT count(*) AS n_scored, round(exp(sum(weight * -ln(q)) / any_value(nt.n)), 6) AS perplexity FROM s3, nt
""")
def lm_trigram_perplexity(spark, sf_dir, n: int = N_GRAM):
    """L1-L3 of order 3: interpolated Kneser-Ney, windows of 1,024 with stride 1,024."""
    split, stream = test_stream(spark, sf_dir)
    total = n_total(stream)
    windows = tk.strided_windows_rows(stream.select("start", "n", "tokens"), total, BLOCK_LEN, BLOCK_LEN, "tokens", mask=False)
    model = kneser_ney.fit(split.where("split = 'train'"), n)
    return kneser_ney.perplexity(kneser_ney.window_targets(windows, n), model, total)


def _sql_dist(docs: str, backoff: bool = False) -> str:
    """The filtered distribution; the null context holds the back-off."""
    back = "\n         UNION ALL SELECT NULL, tok, sum(cnt)::DOUBLE FROM m GROUP BY tok" if backoff else ""
    return f"""
WITH {docs}{SQL_BIGRAM},
dist AS (SELECT m.ctx, tok, cnt::DOUBLE AS w FROM m{back}),
tk AS (SELECT ctx, tok, w FROM (SELECT *, rank() OVER (PARTITION BY ctx ORDER BY w DESC) AS rk
                               FROM dist) WHERE rk <= 50),
tkn AS (SELECT ctx, tok, w, w / sum(w) OVER (PARTITION BY ctx) AS p FROM tk),
tpb AS (SELECT *, coalesce(sum(w) OVER (PARTITION BY ctx ORDER BY w DESC, tok
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
                  sum(w) OVER (PARTITION BY ctx) AS total FROM tkn),
tpn AS (SELECT ctx, tok, w, w / sum(w) OVER (PARTITION BY ctx) AS p FROM tpb
        WHERE before <= 0.95 * total)"""


SQL_DIST = _sql_dist(SQL_HOLDOUT)


def filtered_dist(split, k=50, p=0.95, backoff=False):
    model = bigram_model(split)
    dist = ngram.count_dist(model)
    if backoff:
        dist = dist.unionByName(ngram.backoff_dist(model).drop("p"))
    return ngram.top_p(ngram.top_k(dist, k), p)


@query("lm_top_k", SQL_DIST +"\nSELECT ctx, tok, round(p, 6) AS p FROM tkn")
def lm_top_k(spark, sf_dir):
    """L4: top-50 next tokens per context, renormalised."""
    dist = ngram.count_dist(bigram_model(holdout_docs(spark, sf_dir)))
    return ngram.top_k(dist, 50).select("ctx", "tok", F.round("p", 6).alias("p"))


@query("lm_top_p", SQL_DIST + "\nSELECT ctx, tok, round(p, 6) AS p FROM tpn")
def lm_top_p(spark, sf_dir):
    """L5 after L4: nucleus 0.95 of the top-50, renormalised."""
    return filtered_dist(holdout_docs(spark, sf_dir)).select(
        "ctx", "tok", F.round("p", 6).alias("p"))


SQL_CDF = _sql_dist(SQL_TEST_PARAS, backoff=True) + """,
cdf AS (SELECT ctx, tok, p, sum(w) OVER (PARTITION BY ctx ORDER BY w DESC, tok
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
               sum(w) OVER (PARTITION BY ctx) AS tot FROM tpn),
ca AS MATERIALIZED (SELECT ctx, list({'cum': cum, 'tok': tok, 'p': p} ORDER BY cum, tok) AS c,
                           max(tot) AS tot FROM cdf GROUP BY ctx),
bo AS MATERIALIZED (SELECT c, tot FROM ca WHERE ctx IS NULL)"""


@query("lm_sample_next", SQL_CDF + """,
pm AS (SELECT doc_id || ':' || pos AS prompt_id, toks[len(toks)] AS ctx FROM tp WHERE len(toks) > 0),
dr AS (SELECT prompt_id, ctx, unnest(range(0, 3)) AS draw FROM pm),
du AS (SELECT *, CAST(('0x' || substr(md5('42:' || prompt_id || ':' || draw), 1, 8)) AS BIGINT)
                 / 4294967296.0 AS u FROM dr),
pk AS (SELECT prompt_id, draw, list_filter(coalesce(ca.c, bo.c), lambda x: x.cum >= u * coalesce(ca.tot, bo.tot))[1] AS s
       FROM du LEFT JOIN ca ON ca.ctx = du.ctx CROSS JOIN bo)
SELECT prompt_id, CAST(draw AS INTEGER) AS draw, s.tok AS tok, round(s.p, 6) AS p FROM pk
""")
def lm_sample_next(spark, sf_dir):
    """Three seeded draws of the next token after the last token of every
    held-out paragraph, from the top-k / top-p filtered distribution; an unseen
    last token backs off to the unigram distribution."""
    split = holdout_docs(spark, sf_dir)
    paras = test_paragraphs(split).withColumn("tokens", tokenize("paragraph"))
    prompts = paras.where(F.size("tokens") > 0).select(
        F.concat_ws(":", "doc_id", "pos").alias("prompt_id"),
        F.element_at("tokens", -1).alias("ctx"))
    intervals = cut_lineage(ngram.interval_rows(filtered_dist(split, backoff=True)), "intervals")
    out = ngram.sample_next(prompts, intervals, "prompt_id", n=3, seed=42)
    return out.select("prompt_id", "draw", "tok", F.round("p", 6).alias("p"))


@query("lm_generate_counts", SQL_CDF.replace("WITH", "WITH RECURSIVE", 1) + f""",
gen AS (SELECT doc_id || ':' || pos AS prompt_id, toks AS out, 0 AS step FROM tp WHERE len(toks) > 0
        UNION ALL
        SELECT g.prompt_id,
               list_append(g.out, list_filter(coalesce(ca.c, bo.c), lambda x: x.cum >=
                   CAST(('0x' || substr(md5('42:' || g.prompt_id || ':' || g.step), 1, 8)) AS BIGINT)
                   / 4294967296.0 * coalesce(ca.tot, bo.tot))[1].tok),
               g.step + 1
        FROM gen g LEFT JOIN ca ON ca.ctx = g.out[len(g.out)] CROSS JOIN bo
        WHERE len(g.out) < {GEN_MAX_LENGTH})
SELECT prompt_id, CAST(max(len(out)) AS INTEGER) AS n_tokens, array_to_string(arg_max(out, step), ' ') AS text
FROM gen GROUP BY prompt_id""")
def lm_generate_counts(spark, sf_dir, max_length: int = GEN_MAX_LENGTH):
    """Every held-out paragraph continued to ``max_length`` tokens, prompt
    included.  Output: prompt, length and text."""
    split = holdout_docs(spark, sf_dir)
    paras = test_paragraphs(split).withColumn("tokens", tokenize("paragraph"))
    prompts = paras.where(F.size("tokens") > 0).select(
        F.concat_ws(":", "doc_id", "pos").alias("prompt_id"), F.col("tokens").alias("out"))
    out = generation.generate(prompts, filtered_dist(split, backoff=True), "prompt_id", max_length)
    return out.select("prompt_id", F.size("out").alias("n_tokens"), F.array_join("out", " ").alias("text"))
