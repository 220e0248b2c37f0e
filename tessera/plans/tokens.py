"""Token and array queries.

Vocabulary: tokens of ``documents`` seen at least twice, the 1,000 most
frequent (count desc, token), after the five special tokens.  Encoded text:
``conversations`` turns.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import PACK_MAX_TOKENS
from ..functions.text import (count_tokens, explode_nonempty, posexplode_nonempty, split_sentences,
                              tokenize, truncate_at_punct)
from ..operators import packing, tokens as tk
from ..operators.experiments import pair_turns
from ..operators.splits import split_fixed
from ..session import cut_lineage
from ..sources.tables import load
from .registry import query

TOKEN_RE = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+"
MIN_COUNT, MAX_LEN, PAIR_BUDGET = 2, 32, 64

SQL_VOCAB = f"""
vt AS (SELECT unnest(regexp_extract_all(text, '{TOKEN_RE}')) AS tok FROM documents),
vc AS (SELECT tok, count(*) AS cnt FROM vt GROUP BY tok HAVING count(*) >= {MIN_COUNT}),
voc AS (SELECT CAST(row_number() OVER (ORDER BY cnt DESC, tok) + 4 AS INTEGER) AS id, tok, cnt FROM vc)"""

SQL_ENC = SQL_VOCAB + f""",
ct AS (SELECT conv_id, turn, role, regexp_extract_all(text, '{TOKEN_RE}') AS toks FROM conversations),
ex AS (SELECT conv_id, turn, unnest(toks) AS tok, generate_subscripts(toks, 1) AS k FROM ct),
ids AS (SELECT conv_id, turn, list(CAST(coalesce(voc.id, 2) AS INTEGER) ORDER BY k) AS input_ids
        FROM ex LEFT JOIN voc USING (tok) GROUP BY conv_id, turn),
enc AS (SELECT ct.conv_id, ct.turn, ct.role, coalesce(ids.input_ids, CAST([] AS INTEGER[])) AS input_ids
        FROM ct LEFT JOIN ids USING (conv_id, turn))"""


def vocab(spark, sf_dir):
    """K2 over all documents, tokens seen at least MIN_COUNT times, written once: the
    encode and the decode read it instead of re-tokenising the corpus."""
    toks = (load(spark, sf_dir, "documents").select(explode_nonempty(tokenize("text")).alias("tok"))
            .where(F.col("tok").isNotNull()))
    return cut_lineage(tk.build_vocab(toks, "tok", MIN_COUNT), "vocab")


def encoded_turns(spark, sf_dir, voc=None):
    c = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role",
                                                    tokenize("text").alias("tokens"))
    return tk.encode(c, ["conv_id", "turn"], voc if voc is not None else vocab(spark, sf_dir))


@query("tokens_per_doc", f"""
SELECT doc_id, CAST(len(regexp_extract_all(text, '{TOKEN_RE}')) AS INTEGER) AS n_tokens FROM documents""")
def tokens_per_doc(spark, sf_dir):
    """K1: word / number / symbol tokens per document (whole texts)."""
    return load(spark, sf_dir, "documents").select("doc_id", count_tokens("text").alias("n_tokens"))


@query("vocab_top", f"""WITH {SQL_VOCAB}
SELECT id, tok, cnt FROM voc
UNION ALL SELECT * FROM (VALUES (0, '</s>', NULL), (1, '<s>', NULL), (2, '<unk>', NULL), (3, '<pad>', NULL),
                                (4, '<mask>', NULL)) v(id, tok, cnt)""")
def vocab_top(spark, sf_dir):
    """K2: vocabulary with the five special tokens first."""
    return vocab(spark, sf_dir)


@query("encode_docs", f"WITH {SQL_ENC} SELECT conv_id, turn, input_ids FROM enc")
def encode_docs(spark, sf_dir):
    """K3: conversation turns encoded, unknown tokens as ``<unk>``."""
    return encoded_turns(spark, sf_dir).select("conv_id", "turn", "input_ids")


@query("pad_truncate", f"""WITH {SQL_ENC}
SELECT conv_id, turn,
       list_concat(input_ids[1:{MAX_LEN}], list_transform(range(greatest(0, {MAX_LEN} - len(input_ids))), lambda x: 3))
         AS input_ids,
       list_concat(list_transform(range(least(len(input_ids), {MAX_LEN})), lambda x: 1),
                   list_transform(range(greatest(0, {MAX_LEN} - len(input_ids))), lambda x: 0)) AS attention_mask
FROM enc""")
def pad_truncate(spark, sf_dir):
    """K4: truncate and pad to a fixed length with a mask."""
    e = encoded_turns(spark, sf_dir)
    ids, mask = tk.pad_truncate("input_ids", MAX_LEN)
    return e.select("conv_id", "turn", ids.alias("input_ids"), mask.alias("attention_mask"))


@query("pad_to_batch", f"""WITH {SQL_ENC},
bt AS (SELECT *, (row_number() OVER (ORDER BY conv_id, turn) - 1) // 8 AS batch FROM enc),
b AS (SELECT *, max(len(input_ids)) OVER (PARTITION BY batch) - len(input_ids) AS r FROM bt)
SELECT conv_id, turn, list_concat(input_ids, list_transform(range(r), lambda x: 3)) AS padded_ids,
       list_concat(list_transform(range(len(input_ids)), lambda x: 1), list_transform(range(r), lambda x: 0))
         AS attention_mask
FROM b""")
def pad_to_batch(spark, sf_dir):
    """Dynamic padding to the longest example of each batch of 8
    examples in (conversation, turn) order."""
    e = tk.with_batches(encoded_turns(spark, sf_dir), ["conv_id", "turn"], 8, ids="input_ids")
    e = tk.pad_to_batch(e, "input_ids", "batch", longest="longest")
    return e.select("conv_id", "turn", "padded_ids", "attention_mask")


@query("encode_pair", f"""WITH {SQL_ENC},
pr AS (SELECT a.conv_id, a.turn, a.input_ids AS a, b.input_ids AS b, len(a.input_ids) AS la, len(b.input_ids) AS lb
       FROM enc a JOIN enc b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1
       WHERE a.role = 'user' AND b.role = 'assistant'),
k AS (SELECT *, least(la, lb) AS m FROM pr)
SELECT conv_id, turn,
  a[1:CASE WHEN la + lb <= {PAIR_BUDGET} THEN la WHEN {PAIR_BUDGET} - m >= m THEN (CASE WHEN la <= lb THEN la ELSE {PAIR_BUDGET} - m END)
          ELSE {(PAIR_BUDGET + 1) // 2} END] AS ids_a,
  b[1:CASE WHEN la + lb <= {PAIR_BUDGET} THEN lb WHEN {PAIR_BUDGET} - m >= m THEN (CASE WHEN la <= lb THEN {PAIR_BUDGET} - m ELSE lb END)
          ELSE {PAIR_BUDGET // 2} END] AS ids_b
FROM k""")
def encode_pair(spark, sf_dir):
    """K5: prompt and completion encoded as a pair, longest side cut first."""
    pairs = pair_turns(encoded_turns(spark, sf_dir), value="input_ids", out=("a", "b"))
    ia, ib = tk.truncate_pair("a", "b", PAIR_BUDGET)
    return pairs.select("conv_id", "turn", ia.alias("ids_a"), ib.alias("ids_b"))


@query("decode_roundtrip", f"""WITH {SQL_VOCAB},
ct AS (SELECT conv_id, turn, regexp_extract_all(text, '{TOKEN_RE}') AS toks FROM conversations),
ex AS (SELECT conv_id, turn, unnest(toks) AS tok, generate_subscripts(toks, 1) AS k FROM ct),
kept AS (SELECT conv_id, turn, string_agg(tok, ' ' ORDER BY k) AS text FROM ex JOIN voc USING (tok)
         GROUP BY conv_id, turn)
SELECT ct.conv_id, ct.turn, coalesce(kept.text, '') AS text FROM ct LEFT JOIN kept USING (conv_id, turn)""")
def decode_roundtrip(spark, sf_dir):
    """decode(encode(text)): in-vocabulary tokens joined by spaces,
    ``<unk>`` and other special ids skipped."""
    voc = vocab(spark, sf_dir)
    return tk.decode(encoded_turns(spark, sf_dir, voc), ["conv_id", "turn"], voc)


@query("argmax_embedding", """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax,
       CAST(embedding[1] AS DOUBLE) AS first_score, label FROM embeddings""")
def argmax_embedding(spark, sf_dir):
    """K10 + K11: first position of the largest score, and the first score."""
    e = load(spark, sf_dir, "embeddings")
    return e.select("vec_id", tk.argmax("embedding").alias("argmax"),
                    F.element_at("embedding", 1).cast("double").alias("first_score"), "label")


SQL_SENTENCES = """
ss AS (SELECT doc_id, list_filter(string_split(regexp_replace(text, '([.!?])\\s+|\\n+', '\\1' || chr(1), 'g'),
                                               chr(1)), lambda x: length(x) > 0) AS sents FROM documents)"""


@query("sentences", f"""WITH {SQL_SENTENCES}
SELECT doc_id, CAST(generate_subscripts(sents, 1) - 1 AS INTEGER) AS pos, unnest(sents) AS sentence FROM ss""")
def sentences(spark, sf_dir):
    """Sentence segmentation of whole documents."""
    d = load(spark, sf_dir, "documents").select("doc_id", split_sentences("text").alias("s"))
    return (d.select("doc_id", posexplode_nonempty("s").alias("pos", "sentence"))
            .where(F.col("pos").isNotNull()))


@query("packed_docs", f"""WITH RECURSIVE {SQL_SENTENCES},
s AS (SELECT doc_id, unnest(sents) AS sent, generate_subscripts(sents, 1) AS k FROM ss),
sn AS (SELECT doc_id, k, sent, len(regexp_extract_all(sent, '{TOKEN_RE}')) AS n FROM s),
p(doc_id, k, pack, tot) AS (
  SELECT doc_id, k, 0, n FROM sn WHERE k = 1
  UNION ALL
  SELECT sn.doc_id, sn.k,
         CASE WHEN p.tot + sn.n <= {PACK_MAX_TOKENS} THEN p.pack ELSE p.pack + 1 END,
         CASE WHEN p.tot + sn.n <= {PACK_MAX_TOKENS} THEN p.tot + sn.n ELSE sn.n END
  FROM p JOIN sn ON sn.doc_id = p.doc_id AND sn.k = p.k + 1)
SELECT doc_id, CAST(pack AS INTEGER) AS pack, CAST(count(*) AS INTEGER) AS n_sentences,
       CAST(sum(n) AS BIGINT) AS n_tokens, string_agg(sent, ' ' ORDER BY k) AS text
FROM p JOIN sn USING (doc_id, k) GROUP BY doc_id, pack""")
def packed_docs(spark, sf_dir):
    """K9: each document's sentences greedily packed into pieces of at most
    ``PACK_MAX_TOKENS`` tokens (a longer sentence is a piece of its own)."""
    d = load(spark, sf_dir, "documents").select("doc_id", split_sentences("text").alias("s"))
    return tk.pack_sentences(d, "s", PACK_MAX_TOKENS, keep=["doc_id"])


@query("packed_groups", f"""WITH RECURSIVE {SQL_SENTENCES},
s AS (SELECT source, doc_id, sents, unnest(sents) AS sent, generate_subscripts(sents, 1) AS k
      FROM ss JOIN (SELECT doc_id, source FROM documents) USING (doc_id)),
sn AS (SELECT source, sent, len(regexp_extract_all(sent, '{TOKEN_RE}')) AS n,
              row_number() OVER (PARTITION BY source ORDER BY doc_id, k) AS r FROM s),
c AS (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY r ROWS UNBOUNDED PRECEDING) AS cum FROM sn),
ends AS (SELECT source, cum, min(r) AS r FROM c GROUP BY source, cum),
nx AS MATERIALIZED (SELECT c.source, c.r, greatest(coalesce(e.r, 9223372036854775807), c.r + 1) AS nxt
       FROM c ASOF LEFT JOIN ends e ON c.source = e.source AND c.cum - c.n + {PACK_MAX_TOKENS} < e.cum),
p(source, pack, r, nxt) AS (
  SELECT source, 0, r, nxt FROM nx WHERE r = 1
  UNION ALL
  SELECT nx.source, p.pack + 1, nx.r, nx.nxt FROM p JOIN nx ON nx.source = p.source AND nx.r = p.nxt),
q AS (SELECT source, r, pack FROM p),
pl AS (SELECT c.*, q.pack FROM c ASOF JOIN q ON c.source = q.source AND c.r >= q.r)
SELECT source, CAST(pack AS BIGINT) AS pack, count(*) AS n_sentences, CAST(sum(n) AS BIGINT) AS n_tokens,
       string_agg(sent, ' ' ORDER BY r) AS text
FROM pl GROUP BY source, pack""")
def packed_groups(spark, sf_dir):
    """K9 across documents: the sentences of all documents of a source, in (document, position) order,
    packed into pieces of at most ``PACK_MAX_TOKENS`` tokens."""
    d = load(spark, sf_dir, "documents").select("source", "doc_id", split_sentences("text").alias("s"))
    return packing.pack_groups(d, "source", ["doc_id"], "s", PACK_MAX_TOKENS)


@query("truncate_at_punct", """
SELECT conv_id, turn, regexp_extract(text, '^[^.,;:!?]*[.,;:!?]?', 0) AS first_clause
FROM conversations WHERE role = 'assistant'""")
def truncate_at_punct_q(spark, sf_dir):
    """Completions cut after their first punctuation mark."""
    c = load(spark, sf_dir, "conversations").where("role = 'assistant'")
    return c.select("conv_id", "turn", truncate_at_punct("text").alias("first_clause"))


@query("corpus_token_counts", f"""
WITH r AS (SELECT doc_id, lang, len(regexp_extract_all(text, '{TOKEN_RE}')) AS n,
                  row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS rn FROM documents)
SELECT lang, CASE WHEN rn <= 60 THEN 'test' WHEN rn <= 120 THEN 'valid' ELSE 'train' END AS split,
       CAST(sum(n) AS BIGINT) AS n_tokens, count(*) AS n_docs FROM r GROUP BY ALL""")
def corpus_token_counts(spark, sf_dir):
    """Corpus size in tokens by language and split."""
    d = split_fixed(load(spark, sf_dir, "documents").select("doc_id", "lang", tokenize("text").alias("t")),
                    "doc_id")
    return tk.token_count(d, "t", ["lang", "split"])
