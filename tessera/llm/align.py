"""Two tokenizers' ids of the same text, aligned by bytes, with corpus-wide counts of linked ids.

Tokenizer A reads a space and the text, B the text (it adds the space itself),
so both cut the same bytes.  Offsets where both end a token cut the tokens into
groups; an A and a B token are linked where their bytes overlap.  Every cut of
either tokenizer ends exactly one link, so links are found by one merge of the
two offset lists, for a whole batch of documents at once.

An id pair's count is the number of documents that hold it linked.  The map
from each A id to the B id of the same bytes is made first: pairs of this map,
which exact one-to-one groups give, are counted in one vector of A's
vocabulary in each task, and only other pairs, which irregular groups give,
are shuffled to be counted.  Counts go back to the documents as a broadcast
while the table of pairs is under ``BROADCAST_BYTES``, else by a join.

Each row is encoded once; its ids are written as 16-bit numbers and the second
pass reads them.  Null and empty texts, and texts that a tokenizer does not
give back byte for byte (a U+2581 in the text, which B writes for a space),
have no tokens: zeros and an empty ``groups_sha256``.  Strings of special
tokens are plain text.  Repeated rows count as documents of their own, rows
without id likewise; an empty table gives no row.  Long texts are worked on
whole; columns other than doc_id and text are not used.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, cut, small_batches

NAME_A, NAME_B = "byte_bpe_50k", "piece_bpe_32k"
ROW = ("n_a long, n_b long, n_groups long, n_links long, groups_sha256 string")
#: Tokens that are aligned together, and distinct pairs that a task holds before it hands them on.
STEP, HELD = 1 << 20, 1 << 20


@dataclass(frozen=True)
class Pair:
    """Both tokenizers, the bytes of their ids, and A's id -> B's id of the same bytes (-1: none).
    ``by_word``: no piece of B has a space after another character."""

    names: tuple[str, str]
    by_word: bool
    a: object
    b: object
    bytes_a: list[bytes]
    bytes_b: list[bytes]
    len_a: np.ndarray
    len_b: np.ndarray
    same: np.ndarray


@lru_cache(maxsize=1)
def tokenizers(name_a: str = NAME_A, name_b: str = NAME_B) -> Pair:
    """A by its ranks (the same vocabulary and ids as its .json file), B by its model file; once per worker."""
    import public_tokenizers
    import sentencepiece
    import tiktoken

    with open(public_tokenizers.path(f"{name_a}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(x): int(n) for x, n in (line.split() for line in f if line.strip())}
    a = tiktoken.Encoding(name_a, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(f"{name_b}.model"))
    bytes_a = [b""] * (max(ranks.values()) + 1)
    for x, n in ranks.items():
        bytes_a[n] = x
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
               for i in range(b.get_piece_size())]
    # pieces before byte tokens: a byte token is only used where no piece has the byte
    ids = {}
    for i in sorted(range(len(bytes_b)), key=lambda i: (b.is_byte(i), i)):
        if not (b.is_control(i) or b.is_unknown(i)):
            ids.setdefault(bytes_b[i], i)
    same = np.array([ids.get(x, -1) for x in bytes_a], dtype=np.int64)
    if max(len(bytes_a), len(bytes_b)) > 1 << 16:
        raise ValueError("ids are kept in 16 bits")
    by_word = not any(re.search(b"[^ ] ", x) for x in bytes_b)
    return Pair((name_a, name_b), by_word, a, b, bytes_a, bytes_b, np.array([len(x) for x in bytes_a], dtype=np.int64),
                np.array([len(x) for x in bytes_b], dtype=np.int64), same)


#: Where a text can't be cut at a space: A would take the spaces around it together, or B two spaces as one piece.
CLOSE = re.compile(r"  |\s \s| \Z")
#: Words whose ids a worker remembers beyond a batch.
WORDS = 1 << 18
_KNOWN: dict[tuple[str, str], dict[str, tuple[bytes, bytes] | None]] = {}


def _whole(texts: list[str], pair: Pair) -> list[tuple[bytes, bytes] | None]:
    """Ids of each text, none of them empty, as 16-bit numbers; None if their bytes differ from a space and the text."""
    of_a, of_b = pair.bytes_a.__getitem__, pair.bytes_b.__getitem__
    out = []
    ids = pair.a.encode_ordinary
    for text, b in zip(texts, pair.b.encode(texts, num_threads=1)):
        raw, a = (" " + text).encode(), ids(" " + text)
        same = b"".join(map(of_a, a)) == raw and b"".join(map(of_b, b)) == raw
        out.append((array("H", a).tobytes(), array("H", b).tobytes()) if same else None)
    return out


def encode(texts: list[str | None], pair: Pair) -> list[tuple[bytes, bytes]]:
    """Ids of both tokenizers for each text, none of either if the bytes differ from a space and the text.  Both
    begin a token at a space after another character, whatever follows (``pair.by_word`` tells whether no piece of
    B goes on beyond one), so words with their space are encoded once and remembered."""
    known = _KNOWN.setdefault(pair.names, {})
    if len(known) > WORDS:
        known.clear()
    words = [t.split(" ") if t and pair.by_word and not CLOSE.search(" " + t) else None for t in texts]
    new = list(set().union(*(w for w in words if w)) - known.keys())
    known.update(zip(new, _whole(new, pair)))
    rest = [t for t, w in zip(texts, words) if t and not w]
    whole = iter(_whole(rest, pair))
    out = []
    for text, own in zip(texts, words):
        if own:
            found = [known[w] for w in own]
            out.append((b"", b"") if None in found else (b"".join([x[0] for x in found]), b"".join([x[1] for x in found])))
        else:
            out.append(text and next(whole) or (b"", b""))
    return out


@dataclass(frozen=True)
class Aligned:
    """Links of a batch of documents and, for each document, its numbers."""

    doc: np.ndarray      # of each link: index of its document
    a: np.ndarray        # of each link: A's id
    b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    group_a: np.ndarray  # of each A token: index of its group in the batch
    group_b: np.ndarray


def align(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, pair: Pair) -> Aligned:
    """Links and groups of documents whose ids lie end to end in ``a`` and ``b``: one merge of the ends of both."""
    a, b = a.astype(np.int64), b.astype(np.int64)
    end_a, end_b = np.cumsum(pair.len_a[a]), np.cumsum(pair.len_b[b])
    ends = np.concatenate([[0], end_a])[np.cumsum(n_a)]  # of the documents
    every = np.concatenate([end_a, end_b])
    order = np.argsort(every, kind="stable")  # two runs; an end of A comes before the same end of B
    every, of_a = every[order], order < len(a)
    first = np.diff(every, prepend=-1) != 0
    cuts, at = every[first], np.flatnonzero(first)
    at_a = (np.cumsum(of_a) - of_a)[at]  # ends of A before the cut: the token of A that it ends or lies in
    shared = np.diff(at, append=len(every)) == 2
    group = (np.cumsum(shared) - shared)[np.cumsum(first) - 1]
    upto = lambda n: np.diff(n[np.searchsorted(cuts, ends, "right")], prepend=0)
    n_links = upto(np.arange(len(cuts) + 1))
    # a document without tokens ends where the one before it ends, and has no cut of its own
    return Aligned(np.repeat(np.arange(len(n_a)), n_links), a[at_a], b[at - at_a], upto(np.concatenate([[0], np.cumsum(shared)])),
                   n_links, group[of_a], group[~of_a])


@lru_cache(maxsize=1)
def _table() -> np.ndarray:
    out = np.zeros((1 << 16, 6), dtype=np.uint8)
    out[:, :5] = np.array([str(i) for i in range(1 << 16)], dtype="S5").view(np.uint8).reshape(-1, 5)
    return out


def group_hashes(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, found: Aligned) -> list[str]:
    """SHA-256 of ``a1,a2|b1;a3|b2`` for each document, '' without tokens."""
    n, groups = len(a) + len(b), int(found.n_groups.sum())
    in_a, in_b = np.bincount(found.group_a, minlength=groups), np.bincount(found.group_b, minlength=groups)
    at_a = np.arange(len(a)) + (np.cumsum(in_b) - in_b)[found.group_a]  # after the B tokens of earlier groups
    at_b = np.arange(len(b)) + np.cumsum(in_a)[found.group_b]           # after the A tokens of its group
    text = np.zeros((n, 6), dtype=np.uint8)
    text[at_a], text[at_b] = _table()[a], _table()[b]
    side, group = np.empty(n, dtype=bool), np.empty(n, dtype=np.int64)
    side[at_a], side[at_b], group[at_a], group[at_b] = False, True, found.group_a, found.group_b
    text[:, 5] = ord(",")
    text[:-1, 5][side[1:] != side[:-1]] = ord("|")
    text[:-1, 5][group[1:] != group[:-1]] = ord(";")
    size = np.concatenate([[0], np.cumsum((text != 0).sum(1))])
    flat = text[text != 0].tobytes()
    upto = np.concatenate([[0], np.cumsum(n_a + n_b)])
    return [hashlib.sha256(flat[size[i]:size[j] - 1]).hexdigest() if j > i else "" for i, j in zip(upto, upto[1:])]


def _steps(sizes: list[int], most: int) -> Iterator[slice]:
    """Runs of rows of at most ``most`` tokens together (a longer row alone)."""
    first = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield slice(first, i)
            first, total = i, 0
        total += n
    if sizes:
        yield slice(first, len(sizes))


def _counted(name_a: str, name_b: str):
    """First pass: a row for each document, and the task's pair counts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair = tokenizers(name_a, name_b)
        vector = np.zeros(len(pair.len_a), dtype=np.int64)
        codes, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        part = lambda c, n: pd.DataFrame({"codes": [c], "docs": [n], "counts": True})
        for batch in batches:
            made = encode(batch["text"].tolist(), pair)
            ids = batch["doc_id"].tolist()  # as text: a null would make the column one of floats
            for s in _steps([(len(x) + len(y)) // 2 for x, y in made], STEP):
                n_a, n_b = (np.array([len(x[k]) // 2 for x in made[s]], dtype=np.int64) for k in (0, 1))
                a, b = (np.frombuffer(b"".join([x[k] for x in made[s]]), dtype="<u2") for k in (0, 1))
                got = align(a, b, n_a, n_b, pair)
                code = got.a << 16 | got.b
                exact = pair.same[got.a] == got.b
                vector += np.bincount(np.unique(got.doc[exact] << 16 | got.a[exact]) & 0xFFFF, minlength=len(vector))
                odd = np.unique(got.doc[~exact] << 32 | code[~exact]) & 0xFFFFFFFF
                codes, at = np.unique(np.concatenate([codes, odd]), return_inverse=True)
                counts = np.bincount(at, np.concatenate([counts, np.ones(len(odd), np.int64)]), len(codes)).astype(np.int64)
                yield pd.DataFrame({
                    "doc_id": pd.array([None if x is None else int(x) for x in ids[s]], dtype="Int64"),
                    "n_a": n_a, "n_b": n_b, "n_groups": got.n_groups, "n_links": got.n_links,
                    "groups_sha256": group_hashes(a, b, n_a, n_b, got),
                    "a": [x for x, _ in made[s]], "b": [y for _, y in made[s]], "counts": False})
                if len(codes) > HELD:
                    yield part(codes, counts)
                    codes, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        some = np.flatnonzero(vector)
        yield part(np.concatenate([some << 16 | pair.same[some], codes]), np.concatenate([vector[some], counts]))

    cols = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "codes", "docs", "counts"]
    return lambda batches: (pd.DataFrame({c: x[c] if c in x else [None] * len(x) for c in cols}) for x in run(batches))


def _again(batch: pd.DataFrame, pair: Pair) -> Iterator[tuple[slice, Aligned]]:
    """Links of written rows."""
    for s in _steps((batch["n_a"] + batch["n_b"]).tolist(), STEP):
        a, b = (np.frombuffer(b"".join(batch[k].iloc[s]), dtype="<u2") for k in "ab")
        yield s, align(a, b, batch["n_a"].to_numpy()[s], batch["n_b"].to_numpy()[s], pair)


OUT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def alignments(docs: DataFrame, name_a: str = NAME_A, name_b: str = NAME_B, most: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair's count is
    the highest of their A id), count_sum, groups_sha256, and the ids ``a`` and ``b`` (little-endian
    16-bit).  ``most``: bytes up to which the pair counts are broadcast."""
    spark = docs.sparkSession
    small_batches(spark)
    schema = f"doc_id long, {ROW}, a binary, b binary, codes array<long>, docs array<long>, counts boolean"
    own = cut(docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
              .mapInPandas(_counted(name_a, name_b), schema), "align-ids")
    counts = pair_counts(own)
    rows = own.where("not counts").drop("codes", "docs", "counts")
    best = counts.groupBy(F.shiftright("code", 16).alias("a")).agg(F.max("n").alias("n")).toPandas()  # one row per id of A
    best = dict(zip(best["a"].tolist(), best["n"].tolist()))
    if counts.count() * 16 <= most:
        return _by_broadcast(rows, counts, best, name_a, name_b)
    return _by_join(rows, counts, best, name_a, name_b)


def pair_counts(own: DataFrame) -> DataFrame:
    """(code, n): documents that hold the pair ``code`` = A id << 16 | B id linked."""
    each = own.where("counts").select(F.explode(F.arrays_zip("codes", "docs")).alias("x"))
    return cut(each.groupBy(F.col("x.codes").alias("code")).agg(F.sum("x.docs").alias("n")), "align-counts")


def _by_broadcast(rows: DataFrame, counts: DataFrame, best: dict, name_a: str, name_b: str) -> DataFrame:
    table = counts.toPandas().sort_values("code")
    held = rows.sparkSession.sparkContext.broadcast((table["code"].to_numpy(), table["n"].to_numpy(), best))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair = tokenizers(name_a, name_b)
        codes, n, high = held.value
        top = np.zeros(len(pair.len_a), dtype=np.int64)
        top[list(high)] = list(high.values())
        for batch in batches:
            for s, got in _again(batch, pair):
                out, size = batch.iloc[s].copy(), len(batch.iloc[s])
                count = n[np.searchsorted(codes, got.a << 16 | got.b)] if len(got.a) else np.empty(0, np.int64)
                out["n_best"] = np.bincount(got.doc[count == top[got.a]], minlength=size)
                total = np.concatenate([[0], np.cumsum(count)])
                upto = np.cumsum(got.n_links)
                out["count_sum"] = total[upto] - total[upto - got.n_links]
                yield out[[*OUT, "a", "b"]]

    return rows.mapInPandas(run, f"doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                                 f"count_sum long, groups_sha256 string, a binary, b binary")


def _by_join(rows: DataFrame, counts: DataFrame, best: dict, name_a: str, name_b: str) -> DataFrame:
    """The counts are joined to one row per document and distinct irregular pair; the vector of
    the map's pairs (one count for each id of A) goes to every task."""
    spark = rows.sparkSession
    same = tokenizers(name_a, name_b).same
    known = spark.createDataFrame([(i << 16 | int(b),) for i, b in enumerate(same.tolist()) if b >= 0], "code long")
    vector = {r.code >> 16: r.n for r in counts.join(F.broadcast(known), "code", "left_semi").collect()}
    held = spark.sparkContext.broadcast((vector, best))
    keyed = cut(rows.withColumn("key", F.monotonically_increasing_id()), "align-keyed")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair = tokenizers(name_a, name_b)
        exact_n, top = np.zeros(len(pair.len_a), dtype=np.int64), np.zeros(len(pair.len_a), dtype=np.int64)
        for into, from_ in zip((exact_n, top), held.value):
            into[list(from_)] = list(from_.values())
        for batch in batches:
            for s, got in _again(batch, pair):
                keys = batch["key"].to_numpy()[s]
                exact = pair.same[got.a] == got.b
                n = exact_n[got.a[exact]]
                sums, bests = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
                np.add.at(sums, got.doc[exact], n)
                np.add.at(bests, got.doc[exact], n == top[got.a[exact]])
                yield pd.DataFrame({"key": keys, "code": pd.array([None] * len(keys), dtype="Int64"), "top": 0, "times": bests, "n": sums})
                pairs, times = np.unique(got.doc[~exact] << 32 | got.a[~exact] << 16 | got.b[~exact], return_counts=True)
                code = pairs & 0xFFFFFFFF
                yield pd.DataFrame({"key": keys[pairs >> 32], "code": pd.array(code, dtype="Int64"), "top": top[code >> 16],
                                    "times": times, "n": 0})

    each = cut(keyed.select("key", "n_a", "n_b", "a", "b").mapInPandas(run, "key long, code long, top long, times long, n long"),
               "align-pairs")
    done = each.where("code is null").select("key", F.col("times").alias("n_best"), F.col("n").alias("count_sum"))
    odd = each.where("code is not null").drop("n").join(counts, "code").groupBy("key").agg(
        F.sum(F.when(F.col("n") == F.col("top"), F.col("times")).otherwise(0)).alias("b2"),
        F.sum(F.col("n") * F.col("times")).alias("s2"))
    out = keyed.join(done, "key").join(odd, "key", "left")
    return out.select(*OUT[:5], (F.col("n_best") + F.coalesce("b2", F.lit(0))).alias("n_best"),
                      (F.col("count_sum") + F.coalesce("s2", F.lit(0))).alias("count_sum"), "groups_sha256", "a", "b")
