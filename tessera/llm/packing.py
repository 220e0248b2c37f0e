"""Packing by non-negative least squares over shallow length combinations.

Texts are tokenised once and written with their rank among the rows of equal
remainder in their partition.  Whole windows of a document are sequences of
their own; its remainder (under one window) is packed.  The histogram of
remainders, at most ``window - 1`` counts whatever the corpus, is all that the
plan needs: combinations of two or three lengths that fill a window are the
columns of a non-negative least-squares problem, its solution is rounded down
to repeat counts, and the residual is packed greedily, longest first with the
longest lengths that fit.  Patterns that would leave more than ``slack`` tokens
of a window unused are not made: those remainders are laid end to end and cut
at the windows' ends.  The last of these windows is cut into powers of two,
which need no padding.

Every place follows from a row's global rank among equal lengths: per-partition
counts give the offsets, so no task sees more than its share.  Null and empty
texts are the single end id.  Repeated rows are packed as often as they occur.
Columns other than doc_id and text are not used.
"""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, cut, small_batches

WINDOW = 1024
SLACK = 8
TOKENIZER = "byte_bpe_50k"
_ENCODERS: dict[str, object] = {}


def encoder(name: str):
    """The byte-level BPE of the public vocabulary: ids as the tokenizer file's, kept per worker."""
    if name not in _ENCODERS:
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _ENCODERS[name] = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                            special_tokens={"<|endoftext|>": 50256})
    return _ENCODERS[name]


def encode(text: str | None, name: str = TOKENIZER, end: int = 0) -> np.ndarray:
    """Ids of a text and the end id, little-endian unsigned 32-bit."""
    ids = encoder(name).encode_to_numpy(text, allowed_special="all") if text else np.empty(0, dtype="<u4")
    return np.append(ids.astype("<u4", copy=False), np.uint32(end)).astype("<u4", copy=False)


def _tokenised(window: int, name: str, end: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seen, full = TaskContext.get().partitionId(), np.zeros(window, dtype=np.int64), 0
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = encode(text, name, end)
                rest = len(ids) % window
                out.append((doc_id, part, rest, int(seen[rest]), full, len(ids), ids.tobytes()))
                seen[rest] += 1
                full += len(ids) // window
            yield pd.DataFrame(out, columns=["doc_id", "part", "rest", "rank", "full", "doc_tokens", "ids"])

    return run


@dataclass(frozen=True)
class Plan:
    """Where rows of each remainder go.  ``runs[r]``: (first rank, first
    sequence, offset, ranks in a sequence); from rank ``tail[r]`` on, rows lie
    in the stream from token ``base[r]``, whose windows begin at sequence
    ``stream``.  ``total`` tokens are in the stream."""

    window: int
    runs: dict[int, list[tuple[int, int, int, int]]]
    tail: dict[int, int]
    base: dict[int, int]
    stream: int
    total: int
    sequences: int


def combinations(window: int, present: np.ndarray) -> list[tuple[int, ...]]:
    """Pairs of lengths that fill a window, the power of two of half a window, and triples with one of
    64 evenly spread lengths; only of lengths that occur."""
    has = set(np.flatnonzero(present).tolist()) - {0}
    out = [(a, window - a) for a in sorted(has) if a >= window - a and window - a in has]
    out += [(a,) for a in sorted(has) if a & (a - 1) == 0 and 2 * a >= window]
    step = max(1, window // 64)
    for c in sorted(x for x in has if x % step == step // 2):
        rest = window - c
        out += [(a, rest - a, c) for a in sorted(has) if a >= rest - a > 0 and rest - a in has][::step]
    return out


def nnls(columns: list[tuple[int, ...]], counts: np.ndarray, rounds: int = 200) -> np.ndarray:
    """x >= 0 that lowers |A x - counts|; column j of A counts the lengths of
    combination j.  Multiplicative steps keep x non-negative."""
    if not columns:
        return np.zeros(0)
    j = np.repeat(np.arange(len(columns)), [len(c) for c in columns])
    i = np.concatenate([np.array(c) for c in columns])
    up = np.bincount(j, counts[i], len(columns)) + 1e-12
    x = np.full(len(columns), 1.0) * (counts.sum() / max(1, len(i)))
    for _ in range(rounds):
        made = np.bincount(i, x[j], len(counts))
        x *= up / (np.bincount(j, made[i], len(columns)) + 1e-12)
    return x


def plan(counts: np.ndarray, window: int = WINDOW, slack: int = SLACK, first: int = 0) -> Plan:
    """The plan for ``counts[r]`` remainders of each length r (0: none to place)."""
    left = np.array(counts, dtype=np.int64)
    left[0] = 0
    runs: dict[int, list[tuple[int, int, int, int]]] = {int(r): [] for r in np.flatnonzero(left)}
    used = np.zeros(len(left), dtype=np.int64)
    seq = first

    def place(lengths: tuple[int, ...], times: int) -> None:
        nonlocal seq
        at, of = 0, sorted(lengths, reverse=True)
        for r in dict.fromkeys(of):
            k = of.count(r)
            runs[r].append((int(used[r]), seq, at, k))
            used[r] += k * times
            left[r] -= k * times
            at += k * r
        seq += times

    columns = combinations(window, left)
    x = np.floor(nnls(columns, left.astype(float)) + 1e-9).astype(np.int64)
    for j in np.argsort(-x, kind="stable"):
        need = {r: columns[j].count(r) for r in set(columns[j])}
        times = min(int(x[j]), *[int(left[r]) // k for r, k in need.items()])
        if times > 0:
            place(columns[j], times)
    odd = np.zeros(len(left), dtype=np.int64)  # what no full pattern takes
    while left.any():
        big = int(np.flatnonzero(left)[-1])
        need, room = {big: 1}, window - big
        for r in np.flatnonzero(left)[::-1].tolist():
            k = min(room // r, int(left[r]) - need.get(r, 0))
            if k > 0:
                need[r] = need.get(r, 0) + k
                room -= k * r
            if not room:
                break
        if room <= slack:
            place(tuple(r for r, k in need.items() for _ in range(k)), min(int(left[r]) // k for r, k in need.items()))
        else:
            odd[big], left[big] = left[big], 0
    base, total = {}, 0
    for r in np.flatnonzero(odd)[::-1].tolist():
        base[r], total = total, total + r * int(odd[r])
    return Plan(window, runs, {r: int(used[r]) for r in runs}, base, seq, total, seq + total // window + bin(total % window).count("1"))


def locate(p: Plan, rest: int, rank: int) -> list[tuple[int, int, int, int]]:
    """(start in the remainder, length, sequence, offset) of the remainder's pieces."""
    if not rest:
        return []
    if rank < p.tail[rest]:
        runs = p.runs[rest]
        first, seq, at, k = runs[bisect_right(runs, (rank, 1 << 62)) - 1]
        return [(0, rest, seq + (rank - first) // k, at + (rank - first) % k * rest)]
    out, at, done = [], p.base[rest] + (rank - p.tail[rest]) * rest, 0
    whole = p.total - p.total % p.window
    while done < rest:
        if at < whole:
            size, seq, offset = p.window, p.stream + at // p.window, at % p.window
        else:  # the last window: its powers of two, largest first
            seq, offset, over = p.stream + whole // p.window, at - whole, p.total - whole
            size = 1 << over.bit_length() - 1
            while offset >= size:
                offset, over, seq = offset - size, over - size, seq + 1
                size = 1 << over.bit_length() - 1
        n = min(rest - done, size - offset)
        out.append((done, n, seq, offset))
        done, at = done + n, at + n
    return out


def pack(docs: DataFrame, window: int = WINDOW, slack: int = SLACK, tokenizer: str = TOKENIZER, end: int = 0) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary), doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = cut(docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(  # pandas has no null integers
        _tokenised(window, tokenizer, end),
        "doc_id string, part int, rest int, rank long, full long, doc_tokens long, ids binary")
        .withColumn("doc_id", F.col("doc_id").cast(kind)), "pack-ids")
    # per partition: rows of each remainder and whole windows
    by_part = cut(rows.groupBy("part", "rest").agg(F.count("*").alias("n"), F.sum(F.floor(F.col("doc_tokens") / window)).alias("w")),
                  "pack-parts")
    counts = np.zeros(window, dtype=np.int64)
    windows = 0
    for r in by_part.groupBy("rest").agg(F.sum("n").alias("n"), F.sum("w").alias("w")).collect():  # at most ``window`` rows
        counts[r.rest], windows = r.n, windows + r.w
    made = plan(counts, window, slack, int(windows))
    shared = spark.sparkContext.broadcast(made)  # bounded by the window, not by the corpus
    starts = by_part.select("part", "rest", F.expr("sum(n) over (partition by rest order by part) - n").alias("before"))
    full = by_part.groupBy("part").agg(F.sum("w").alias("w"))
    n_parts = full.count()
    full = _running(full, "part", "w")
    offsets = starts.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("rest", "before"))).alias("before"))
    offsets = offsets.join(full, "part").select("part", "before", F.col("start").alias("first"))
    if n_parts * window * 12 <= BROADCAST_BYTES:
        offsets = F.broadcast(offsets)  # else Spark joins by part
    located = rows.join(offsets, "part").select(
        "doc_id", "doc_tokens", "rest", (F.col("rank") + F.try_element_at("before", F.col("rest"))).alias("rank"),
        (F.col("full") + F.col("first")).alias("full"), "ids")

    @F.pandas_udf("array<struct<start:long,length:long,sequence_id:long,offset:long>>")
    def places(rest: pd.Series, rank: pd.Series, tokens: pd.Series, full: pd.Series) -> pd.Series:
        p, out = shared.value, []
        for r, k, n, f in zip(rest, rank, tokens, full):
            lead = [{"start": i * window, "length": window, "sequence_id": int(f) + i, "offset": 0} for i in range(n // window)]
            at = n - n % window
            out.append(lead + [{"start": at + a, "length": b, "sequence_id": s, "offset": o} for a, b, s, o in locate(p, r, k)])
        return pd.Series(out)

    return (located.withColumn("p", F.explode(places("rest", "rank", "doc_tokens", "full")))
            .select("doc_id", "p.start", "p.length",
                    F.expr("substring(ids, cast(p.start * 4 + 1 as int), cast(p.length * 4 as int))").alias("ids"),
                    "doc_tokens", "p.sequence_id", "p.offset"))


def _running(df: DataFrame, key: str, value: str, block: int = 1024) -> DataFrame:
    """(key, start): sums of ``value`` before each key, in blocks of consecutive keys."""
    b = F.floor(F.col(key) / block)
    inner = df.select(key, b.alias("b"), F.expr(f"sum({value}) over (partition by floor({key} / {block}) order by {key}) - {value}").alias("inner"))
    blocks = df.groupBy(b.alias("b")).agg(F.sum(value).alias("t"))  # a row for 1,024 partitions of the input
    outer = blocks.select("b", F.expr("sum(t) over (order by b) - t").alias("outer"))
    return inner.join(outer, "b").select(key, (F.col("inner") + F.col("outer")).alias("start"))
