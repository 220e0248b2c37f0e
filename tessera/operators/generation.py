"""Batch generation from a compiled next-token table.

A prompt is continued token by token, so a join for every step would move all
prompts some two hundred times.  Here the distribution is compiled once:

* ``head``: the contexts with most weight, in rows of cumulative weights, up to
  ``head_bytes`` together, and always the null context (the back-off).  Tasks
  pack it into flat arrays, the driver hands on their bytes, and every task holds it and walks its prompts from token to token as long as their last
  token is a context of the head.
* ``tail``: the other contexts, as rows with their interval of the cumulative
  weight.  Prompts that stop at one of them are joined with the tail once, all
  of them together; the join picks the one row that the draw falls into, and
  they walk on.

A table within ``head_bytes`` is all head and nothing is shuffled.  A larger one
costs one join for each time that a prompt meets a rare context; contexts follow
the frequencies of words, so a head of some megabytes takes most steps.

The draws are those of :func:`~tessera.operators.ngram.sample_next`: step ``s``
of a prompt uses the md5 uniform of (seed, prompt, s), whatever route it took.
"""

from __future__ import annotations

import hashlib
import pickle
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import GEN_MAX_LENGTH
from ..session import cut_lineage, default_blocks
from .ngram import drawn, interval_rows
from .ordering import global_offsets

HEAD_BYTES = 128 << 20
#: Estimated bytes in a worker's memory: of a context (its text, place and share of the list of tokens, without the
#: characters) and of one of its tokens (a number and its cumulative weight).
CONTEXT_BYTES, TOKEN_BYTES = 220, 12
PACKED_FROM = pa.schema([("ctx", pa.string()), ("cum", pa.float64()), ("tok", pa.string()), ("tot", pa.float64())])


def context_bytes() -> Column:
    """Estimated bytes of a context's rows, as an aggregate."""
    return F.count("*") * TOKEN_BYTES + 2 * F.coalesce(F.max(F.length("ctx")), F.lit(0)) + CONTEXT_BYTES


def split_table(rows: DataFrame, head_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """(head, tail) of written interval rows; ``tail`` is None if all fits into the head."""
    contexts = rows.groupBy("ctx").agg(F.max("tot").alias("tot"), context_bytes().alias("bytes"))
    if (contexts.agg(F.sum("bytes")).first()[0] or 0) <= head_bytes:
        return rows, None
    keyed = contexts.select("ctx", "bytes", F.col("ctx").isNotNull().cast("int").alias("_known"), (-F.col("tot")).alias("_neg"),
                            F.coalesce("ctx", F.lit("")).alias("_c"))
    placed = global_offsets(keyed, ["_known", "_neg", "_c"], "bytes", "_at")
    chosen = cut_lineage(placed.where((F.col("_known") == 0) | (F.col("_at") + F.col("bytes") <= head_bytes)).select("ctx"), "gen-head")
    head = rows.where("ctx is null").unionByName(rows.join(chosen, "ctx", "left_semi"))
    return head, cut_lineage(rows.where("ctx is not null").join(chosen, "ctx", "left_anti"), "gen-tail")


@dataclass(frozen=True)
class Table:
    """Contexts by text: their place, from which their entries start (and end before the next one's) and their total;
    entries: cumulative weight and token number."""

    contexts: dict[str | None, int]
    starts: array
    tots: array
    cums: array
    toks: array
    names: list[str]


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's share of the head, sorted by context and cumulative weight, as one row of bytes."""
    rows = pa.Table.from_batches(batches, PACKED_FROM).combine_chunks()
    if not rows.num_rows:
        return
    ctx, tok = (rows[c].combine_chunks().dictionary_encode(null_encoding="encode") for c in ("ctx", "tok"))
    first = np.concatenate([[0], np.flatnonzero(np.diff(ctx.indices.to_numpy())) + 1])
    names = ctx.dictionary.to_pylist()
    held = ([names[i] for i in ctx.indices.to_numpy()[first]], first, rows["tot"].to_numpy()[first], rows["cum"].to_numpy(),
            tok.indices.to_numpy(), tok.dictionary.to_pylist())
    yield pa.RecordBatch.from_pydict({"part": pa.array([pickle.dumps(held)], pa.binary())})


class Head:
    """The head in the parts that the tasks packed, at most ``HEAD_BYTES`` of them; unpacked once in each worker, never on the driver."""

    def __init__(self, parts: list[bytes]):
        self.parts = parts

    @cached_property
    def table(self) -> Table:
        out = Table({}, array("q"), array("d"), array("d"), array("i"), [])
        numbers: dict[str, int] = {}
        for part in self.parts:
            contexts, first, tots, cums, toks, names = pickle.loads(part)
            number = np.array([numbers.setdefault(x, len(numbers)) for x in names], np.int32)
            out.contexts.update((c, i) for i, c in enumerate(contexts, len(out.contexts)))
            out.starts.frombytes((first + len(out.cums)).astype(np.int64).tobytes())
            for held, new in ((out.tots, tots), (out.cums, cums), (out.toks, number[toks])):
                held.frombytes(new.tobytes())
        out.starts.append(len(out.cums))
        out.names.extend(numbers)
        return out


def _compiled(head: DataFrame) -> Head:
    """The head's rows in flat arrays, built by the tasks; the driver gets their bytes, a few parts at a time."""
    rows = head.select("ctx", "cum", "tok", "tot").repartition(default_blocks(head.sparkSession), "ctx").sortWithinPartitions("ctx", "cum")
    packed = cut_lineage(rows.mapInArrow(_pack, "part binary"), "gen-packed")
    return Head([bytes(r["part"]) for r in packed.toLocalIterator()])


def _uniform(seed: int, key, step: int) -> float:
    return int(hashlib.md5(f"{seed}:{key}:{step}".encode()).hexdigest()[:8], 16) / 4294967296.0


def _walker(table, all_here: bool, id_col: str, max_length: int, seed: int):
    """Continues each prompt until its length is reached or its last token is a context of the tail.
    A row that was joined (``asked``) first takes the token it was given, or the back-off's."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = table.value.table
        head, starts, tots, cums, toks, names = held.contexts, held.starts, held.tots, held.cums, held.toks, held.names
        back = head.get(None)

        def step(entry: int, out: list, u: float) -> bool:
            hi = starts[entry + 1]
            i = bisect_left(cums, u * tots[entry], starts[entry], hi)
            if i < hi:
                out.append(names[toks[i]])
            return i < hi

        for batch in batches:
            made = []
            for key, out, n0, asked, tok in zip(batch[id_col], batch["out"], batch["n0"], batch["asked"], batch["tok"]):
                out, live, u = list(out), True, None
                if asked:
                    if tok is not None:
                        out.append(tok)
                    else:
                        live = back is not None and step(back, out, _uniform(seed, key, len(out) - n0))
                while live and len(out) < max_length:
                    ctx = out[-1] if out else None
                    entry = head.get(ctx)
                    u = _uniform(seed, key, len(out) - n0)
                    if entry is None and ctx is not None and not all_here:
                        break
                    entry = back if entry is None else entry
                    live = entry is not None and step(entry, out, u)
                live = live and len(out) < max_length
                made.append((key, out, n0, live, out[-1] if live else None, u if live else None, None))
            yield pd.DataFrame(made, columns=[id_col, "out", "n0", "asked", "ctx", "u", "tok"])

    return run


def generate(prompts: DataFrame, dist: DataFrame, id_col: str, max_length: int = GEN_MAX_LENGTH, seed: int = 42,
             head_bytes: int = HEAD_BYTES) -> DataFrame:
    """Continue every prompt, ``(id_col, out)`` with its tokens in ``out``, to ``max_length`` tokens, the prompt
    included; a prompt as long already stays as it is.  ``dist`` is a filtered distribution; an unknown last token
    draws from its rows of null ``ctx``, and without such rows ends the prompt.  Every round is a written table."""
    spark = prompts.sparkSession
    head, tail = split_table(cut_lineage(interval_rows(dist), "gen-table"), head_bytes)
    table = spark.sparkContext.broadcast(_compiled(head))
    kind = dict(prompts.dtypes)[id_col]
    schema = f"{id_col} {kind}, out array<string>, n0 int, asked boolean, ctx string, u double, tok string"
    walk = _walker(table, tail is None, id_col, max_length, seed)
    state = prompts.select(id_col, "out", F.size("out").alias("n0"), F.lit(False).alias("asked"), F.lit(None).cast("string").alias("tok"))
    state = state.mapInPandas(walk, schema)
    if tail is None:
        return state.select(id_col, "out")
    done = []
    while True:
        state = cut_lineage(state, "gen-round")
        done.append(state.where("not asked").select(id_col, "out"))
        live = state.where("asked")
        if live.isEmpty():
            break
        state = drawn(live.drop("tok"), tail, "_d").select(
            id_col, "out", "n0", "asked", F.col("_d.tok").alias("tok")).mapInPandas(walk, schema)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out
