"""Token, array and packing operators.

A corpus is never one string or one array.  Paragraphs stay rows; their global
token offsets come from :func:`tessera.operators.ordering.global_offsets`
(distributed prefix sums), and windows are rebuilt from token rows grouped by
window start, so each group is bounded by the window length.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import NOT_SCORED, PAD_ID, SPECIAL_TOKENS, UNK_ID
from ..functions.text import TOKEN_PATTERN, explode_nonempty, posexplode_nonempty
from ..session import cut_lineage, default_blocks
from .ordering import global_offsets, offset_index


# --------------------------------------------------------------------------
# K2 / K3 / K12 vocabulary, encode, decode
# --------------------------------------------------------------------------

def build_vocab(tokens: DataFrame, tok: str = "tok", min_count: int = 1,
                max_size: int | None = None) -> DataFrame:
    """K2: ``(id, tok, cnt)``; ids 0-4 are the special tokens, then tokens by
    (count desc, token) from id 5, numbered by a distributed prefix sum.
    ``max_size`` caps the regular entries where a fixed vocabulary is wanted;
    by default every token has its id."""
    counts = tokens.where(F.col(tok).isNotNull()).groupBy(F.col(tok).alias("tok")).agg(
        F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") >= min_count)
    ranked = global_offsets(counts.withColumn("_neg", -F.col("cnt")), ["_neg", "tok"], None, "_o")
    if max_size is not None:
        ranked = ranked.where(F.col("_o") < max_size)
    ranked = ranked.select((F.col("_o") + len(SPECIAL_TOKENS)).cast("int").alias("id"), "tok", "cnt")
    spark = tokens.sparkSession
    specials = spark.createDataFrame(
        [(i, t) for i, t in enumerate(SPECIAL_TOKENS)], "id int, tok string").withColumn(
        "cnt", F.lit(None).cast("long"))
    return specials.unionByName(ranked)


#: Vocabulary rows up to which an encode or decode sends the vocabulary to every task (some 100 bytes each).
BROADCAST_ROWS = 300_000


def _by_blocks(df: DataFrame, keys: list[str], items: str, table: DataFrame, blocks: int) -> DataFrame:
    """``df`` with ``items`` replaced by what ``table`` (k, v) has for them, as texts (null: nothing), for a table of
    any size.  Rows are dealt into blocks by key; each block asks the table for its distinct items once, and a
    block's rows meet its answers in one task, so neither the table nor a row per item is moved to the rows."""
    own = cut_lineage(df.withColumn("_b", F.pmod(F.xxhash64(*keys), F.lit(blocks)).cast("int")), "lookup")
    asked = own.select("_b", F.explode(F.array_distinct(items)).alias("_k")).distinct()
    answers = asked.join(table.select(F.col("k").alias("_k"), "v"), "_k").select(
        F.col("_b").alias("_at"), F.col("_k").cast("string").alias("_k"), F.col("v").cast("string").alias("_v"))
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields if f.name not in ("_b", items)]

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        get = dict(zip(found["_k"].to_pylist(), found["_v"].to_pylist())).get
        lists = [None if x is None else [get(str(i)) for i in x] for x in rows[items].to_pylist()]
        return rows.drop_columns(["_b", items]).append_column("_found", pa.array(lists, pa.list_(pa.string())))

    return own.groupBy("_b").cogroup(answers.groupBy("_at")).applyInArrow(run, ", ".join([*kept, "_found array<string>"]))


def encode(df: DataFrame, key, vocab: DataFrame, tokens: str = "tokens",
           out: str = "input_ids", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """K3: token array -> id array, unknown tokens -> ``<unk>``.  No token is a
    row of a shuffle: a vocabulary of up to ``broadcast_rows`` goes to every task,
    tokens are looked up where they are and put back in order by one aggregation,
    which also carries the other columns (``collect_list`` combines map-side, so
    about one row per key is shuffled); for a larger one each block of rows asks for
    its distinct tokens (:func:`_by_blocks`).  Rows without tokens keep an empty array."""
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in df.columns if c not in keys and c != tokens]
    if vocab.count() > broadcast_rows:
        table = vocab.select(F.col("tok").alias("k"), F.col("id").alias("v"))
        found = _by_blocks(df, keys, tokens, table, default_blocks(df.sparkSession))
        ids = F.transform(F.coalesce("_found", F.array().cast("array<string>")), lambda x: F.coalesce(x.cast("int"), F.lit(UNK_ID)))
        return found.select(*keys, *others, ids.alias(out))
    ex = df.select(*keys, *others, posexplode_nonempty(tokens).alias("pos", "tok"))
    ids = (ex.join(F.broadcast(vocab.select("tok", "id")), "tok", "left")
           .select(*keys, *others, "pos",
                   F.when(F.col("pos").isNotNull(), F.coalesce("id", F.lit(UNK_ID))).alias("id")))
    item = F.when(F.col("pos").isNotNull(), F.struct("pos", "id"))
    back = ids.groupBy(*keys).agg(*[F.first(c).alias(c) for c in others],
                                  F.array_sort(F.collect_list(item)).alias("_p"))
    return back.select(*keys, *others, F.transform("_p", lambda s: s["id"]).alias(out))


def decode(df: DataFrame, key, vocab: DataFrame, ids: str = "input_ids",
           out: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Ids -> text, special tokens skipped, pieces joined with a space.
    One pass over the (unique) keys, as :func:`encode`; a key without pieces gives ''."""
    keys = [key] if isinstance(key, str) else list(key)
    regular = vocab.where(F.col("id") >= len(SPECIAL_TOKENS)).select("id", "tok")
    if vocab.count() > broadcast_rows:
        found = _by_blocks(df.select(*keys, ids), keys, ids, regular.toDF("k", "v"), default_blocks(df.sparkSession))
        return found.select(*keys, F.coalesce(F.array_join("_found", " "), F.lit("")).alias(out))  # nulls are left out
    toks = df.select(*keys, F.posexplode_outer(ids).alias("pos", "id")).join(F.broadcast(regular), "id", "left")
    item = F.when(F.col("tok").isNotNull(), F.struct("pos", "tok"))
    back = toks.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("_p"))
    return back.select(*keys, F.array_join(F.transform("_p", lambda s: s["tok"]), " ").alias(out))


# --------------------------------------------------------------------------
# K4 / K4b / K5 / K10 array shaping
# --------------------------------------------------------------------------

def pad_truncate(ids, max_len: int, pad: int = PAD_ID) -> tuple[Column, Column]:
    """K4: ids cut to ``max_len`` and right-padded, plus the attention mask."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    n = F.least(F.size(ids), F.lit(max_len))
    rest = F.greatest(F.lit(max_len) - F.size(ids), F.lit(0))
    padded = F.concat(F.slice(ids, 1, F.lit(max_len)), F.array_repeat(F.lit(pad), rest))
    mask = F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), rest))
    return padded, mask


def pad_to_batch(df: DataFrame, ids: str, batch: str, pad: int = PAD_ID, longest: str | None = None) -> DataFrame:
    """Pad every example to the longest in its batch (batches are small,
    bounded groups).  With a column ``longest`` (see :func:`with_batches`) rows
    stay where they are."""
    most = F.col(longest) if longest else F.max(F.size(ids)).over(Window.partitionBy(batch))
    rest = most - F.size(ids)
    return df.withColumn("_tsr_n", rest).select(
        "*", F.concat(F.col(ids), F.array_repeat(F.lit(pad), F.col("_tsr_n"))).alias("padded_ids"),
        F.concat(F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), F.col("_tsr_n")))
        .alias("attention_mask")).drop("_tsr_n")


def with_batches(df: DataFrame, order_cols: list[str], batch_size: int, out: str = "batch",
                 ids: str | None = None, longest: str = "longest") -> DataFrame:
    """Consecutive batches of ``batch_size`` examples in the global order of
    ``order_cols`` (distributed row number); every batch is a bounded group.
    With ``ids`` each row also learns the longest array of its batch.  Both come
    from keys and lengths alone and are joined back by key; the examples are
    written once and not dealt by ranges or batches."""
    own = cut_lineage(df, "examples")
    size = F.size(ids).alias("_tsr_s") if ids else F.lit(0).alias("_tsr_s")
    index = offset_index(own.select(*order_cols, size), order_cols, None, "_tsr_o", keep=["_tsr_s"])
    index = index.withColumn(out, F.floor(F.col("_tsr_o") / batch_size).cast("long")).drop("_tsr_o")
    if ids:
        index = index.withColumn(longest, F.max("_tsr_s").over(Window.partitionBy(out)))
    return own.join(index.drop("_tsr_s"), order_cols)


def truncate_pair(a, b, budget: int) -> tuple[Column, Column]:
    """K5 longest-first truncation in closed form: with ``m = min(la, lb)``
    both stay whole if they fit; if ``budget - m >= m`` the shorter stays whole
    and the longer keeps ``budget - m``; otherwise the first keeps
    ``ceil(budget/2)`` and the second ``floor(budget/2)`` (one-at-a-time
    removal from the longer side, the second on ties)."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    la, lb = F.size(a), F.size(b)
    m = F.least(la, lb)
    M = F.lit(budget)
    fits = la + lb <= M
    keep_a = (F.when(fits, la)
              .when(M - m >= m, F.when(la <= lb, la).otherwise(M - m))
              .otherwise(F.lit((budget + 1) // 2)))
    keep_b = (F.when(fits, lb)
              .when(M - m >= m, F.when(la <= lb, M - m).otherwise(lb))
              .otherwise(F.lit(budget // 2)))
    return F.slice(a, 1, keep_a), F.slice(b, 1, keep_b)


def argmax(col) -> Column:
    """0-based position of the first maximum."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.array_position(c, F.array_max(c)) - 1).cast("int")


# --------------------------------------------------------------------------
# K6 / K7 / K8 token stream and strided windows
# --------------------------------------------------------------------------

def token_stream(paras: DataFrame, order_cols: list[str], tokens: str = "tokens",
                 blocks: int | None = None) -> DataFrame:
    """Add ``start`` = global offset of each row's first token in the
    order of ``order_cols`` (distributed prefix sum), ``n`` = its tokens and
    ``prev`` = the stream's token before its first one.  The rows are written
    once; only keys, sizes and last tokens are dealt by ranges, and the offsets
    are joined back by key, so no token array crosses the range exchange.
    Rows without tokens keep their place (``n = 0``) and share ``start`` with
    the next row, so drop them before ``start`` serves as a key."""
    own = cut_lineage(paras.select("*", F.size(tokens).alias("n"), F.try_element_at(tokens, F.lit(-1)).alias("prev")), "stream-rows")
    return own.drop("prev").join(offset_index(own, order_cols, "n", "start", blocks, carry="prev"), order_cols)


def stream_tokens(stream: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Per-token rows ``(g, tok, prev)`` of a :func:`token_stream`; ``prev`` is
    the previous token of the global stream, across rows as well."""
    before = F.concat(F.array("prev"), F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0))))
    pairs = F.arrays_zip(F.col(tokens).alias("tok"), before.alias("prev"))  # exploded alone: the array is not copied to each row
    ex = stream.where(F.col("n") > 0).select("start", F.posexplode(pairs).alias("k", "p"))
    return ex.select((F.col("start") + F.col("k")).alias("g"), "p.tok", "p.prev")


def windows_of_token(g: Column, n_total: Column, max_len: int, stride: int) -> Column:
    """Starts of all windows whose inputs contain position ``g``
    (at most ``ceil(max_len / stride)`` of them)."""
    first = F.floor(g / F.lit(stride)).cast("long") * F.lit(stride)
    last_by_len = F.floor((g + F.lit(max_len - stride)) / F.lit(stride)).cast("long") * F.lit(stride)
    last_start = F.floor((n_total - F.lit(1)) / F.lit(stride)).cast("long") * F.lit(stride)
    return F.sequence(first, F.least(last_by_len, last_start), F.lit(stride).cast("long"))


def strided_windows(tokens: DataFrame, n_total: Column, max_len: int, stride: int,
                    value: str = "id") -> DataFrame:
    """K7 + K8: ``(win_start, begin_loc, end_loc, trg_len, input_ids,
    target_ids)`` for ``i = 0, stride, ...``: ``begin = max(i+stride-L, 0)``,
    ``end = min(i+stride, N)``, ``trg_len = end - i``; targets are the inputs
    with all but the last ``trg_len`` set to -100.  ``tokens`` has (g, value).
    Each token is copied to the <= ceil(L/stride) windows that contain it and
    windows are rebuilt by a group of at most L rows."""
    if stride > max_len:
        raise ValueError("stride must be <= max_len")
    ex = tokens.select("g", value, F.explode(windows_of_token(F.col("g"), n_total, max_len, stride))
                       .alias("win_start"))
    grouped = ex.groupBy("win_start").agg(
        F.array_sort(F.collect_list(F.struct("g", value))).alias("_p"))
    begin = F.greatest(F.col("win_start") + F.lit(stride - max_len), F.lit(0)).cast("long")
    end = F.least(F.col("win_start") + F.lit(stride), n_total).cast("long")
    w = grouped.select("win_start", begin.alias("begin_loc"), end.alias("end_loc"),
                       (end - F.col("win_start")).cast("int").alias("trg_len"),
                       F.transform("_p", lambda s: s[value]).alias("input_ids"))
    return w.withColumn("target_ids", mask_targets("input_ids", "trg_len"))


def strided_windows_rows(stream: DataFrame, n_total: Column, max_len: int, stride: int,
                         ids: str = "ids", mask: bool = True) -> DataFrame:
    """K7 + K8 from stream rows ``(start, n, ids)`` instead of single tokens:
    each row sends one slice of its array to every window it overlaps, and a
    window concatenates its slices in ``start`` order.  Same output as
    :func:`strided_windows`, with one shuffled row per (row, window) pair
    rather than ``ceil(L/stride)`` rows per token; a window group holds at most
    ``max_len`` tokens.  ``mask=False`` leaves ``target_ids`` out (for windows of tokens)."""
    if stride > max_len:
        raise ValueError("stride must be <= max_len")
    S, L = stride, max_len
    first = F.floor(F.col("start") / F.lit(S)).cast("long") * F.lit(S)
    last = F.least(F.floor((F.col("start") + F.col("n") + F.lit(L - S - 1)) / F.lit(S)).cast("long") * F.lit(S),
                   F.floor((n_total - F.lit(1)) / F.lit(S)).cast("long") * F.lit(S))
    def begin_of(w):
        return F.greatest(w + F.lit(S - L), F.lit(0)).cast("long")

    def end_of(w):
        return F.least(w + F.lit(S), n_total).cast("long")

    def sliced(w):  # before the explode, which would copy the whole array to every window
        lo, hi = F.greatest(begin_of(w), F.col("start")), F.least(end_of(w), F.col("start") + F.col("n"))
        return F.struct(w.alias("w"), F.slice(ids, (lo - F.col("start") + 1).cast("int"),
                                              F.greatest(hi - lo, F.lit(0)).cast("int")).alias("s"))

    live = stream.where(F.col("n") > 0).select("start", "n", ids, first.alias("_first"), last.alias("_last"))
    ex = live.select("start", explode_nonempty(F.transform(F.sequence("_first", "_last", F.lit(S).cast("long")), sliced)).alias("x"))
    piece = ex.where(F.size("x.s") > 0).select(F.col("x.w").alias("win_start"), "start", F.col("x.s").alias("_s"))
    begin, end = begin_of(F.col("win_start")), end_of(F.col("win_start"))
    grouped = piece.groupBy("win_start").agg(F.array_sort(F.collect_list(F.struct("start", "_s"))).alias("_p"))
    w = grouped.select("win_start", begin.alias("begin_loc"), end.alias("end_loc"),
                       (end - F.col("win_start")).cast("int").alias("trg_len"),
                       F.flatten(F.transform("_p", lambda s: s["_s"])).alias("input_ids"))
    return w.withColumn("target_ids", mask_targets("input_ids", "trg_len")) if mask else w


def mask_targets(ids, trg_len) -> Column:
    """K8: all but the last ``trg_len`` entries -> -100."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    trg = F.col(trg_len) if isinstance(trg_len, str) else trg_len
    return F.transform(ids, lambda v, k: F.when(k < F.size(ids) - trg, F.lit(NOT_SCORED)).otherwise(v))


def scored_ids(col) -> Column:
    """The targets that are scored (not -100)."""
    return F.filter(F.col(col) if isinstance(col, str) else col, lambda x: x != F.lit(NOT_SCORED))


def document_windows(df: DataFrame, ids: str, max_len: int, stride: int) -> DataFrame:
    """K7 per document: the same windows inside each row (no shuffle)."""
    n = F.size(ids)
    starts = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(stride))
    ex = df.where(n > 0).select("*", F.explode(starts).alias("win_start"))
    begin = F.greatest(F.col("win_start") + F.lit(stride - max_len), F.lit(0))
    end = F.least(F.col("win_start") + F.lit(stride), F.size(ids))
    out = ex.select("*", begin.alias("begin_loc"), end.alias("end_loc"),
                    (end - F.col("win_start")).alias("trg_len"))
    out = out.withColumn("input_ids", F.slice(ids, F.col("begin_loc") + 1,
                                              F.col("end_loc") - F.col("begin_loc")))
    return out.withColumn("target_ids", mask_targets("input_ids", "trg_len"))


# --------------------------------------------------------------------------
# K9 greedy packing, A14 token counts
# --------------------------------------------------------------------------

def pack_starts(ns: Column, max_tokens: int) -> Column:
    """1-based positions where a new pack begins, in one pass over the length
    array: successive elements are joined while the pack total stays <=
    max_tokens; an element longer than the limit is a pack of its own."""
    init = F.struct(F.lit(0).alias("k"), F.lit(-1).alias("pack"),
                    F.lit(0).cast("long").alias("tot"), F.array().cast("array<int>").alias("st"))

    def step(acc, n):
        k = acc["k"] + 1
        join = (acc["pack"] >= 0) & (acc["tot"] + n <= F.lit(max_tokens))
        return F.struct(k.alias("k"),
                        F.when(join, acc["pack"]).otherwise(acc["pack"] + 1).alias("pack"),
                        F.when(join, acc["tot"] + n).otherwise(n.cast("long")).alias("tot"),
                        F.when(join, acc["st"]).otherwise(F.concat(acc["st"], F.array(k))).alias("st"))

    return F.aggregate(ns, init, step, lambda acc: acc["st"])


def pack_sentences(df: DataFrame, sentences: str, max_tokens: int = 1024,
                   keep: list[str] | None = None) -> DataFrame:
    """K9 within each row (a document's ordered sentences): one output row per
    pack with ``pack``, ``n_sentences``, ``n_tokens`` and the joined ``text``.
    Never crosses rows; one pass over the sentences to find pack starts."""
    keep = keep or []
    ns = F.transform(sentences, lambda s: F.regexp_count(s, F.lit(TOKEN_PATTERN)))
    d = df.select(*keep, F.col(sentences).alias("_s"), ns.alias("_n"))
    d = d.withColumn("_st", pack_starts(F.col("_n"), max_tokens))
    ex = (d.select(*keep, "_s", "_n", "_st", posexplode_nonempty("_st").alias("pack", "s"))
          .where(F.col("pack").isNotNull()))
    nxt = F.coalesce(F.try_element_at("_st", F.col("pack") + 2), F.size("_s") + 1)
    ln = nxt - F.col("s")
    return ex.select(
        *keep, F.col("pack").cast("int").alias("pack"), ln.cast("int").alias("n_sentences"),
        F.aggregate(F.slice("_n", F.col("s"), ln), F.lit(0).cast("long"), lambda a, x: a + x)
        .alias("n_tokens"),
        F.array_join(F.slice("_s", F.col("s"), ln), " ").alias("text"))


def token_count(df: DataFrame, tokens: str, by: list[str]) -> DataFrame:
    """Tokens of a corpus by the given keys."""
    return df.groupBy(*by).agg(F.sum(F.size(tokens)).cast("long").alias("n_tokens"),
                               F.count(F.lit(1)).alias("n_docs"))
