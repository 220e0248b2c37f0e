"""Near duplicates by SimHash fingerprints, pigeonhole blocks and Hamming distance.

The 64 bits fall into ``distance + 2`` blocks.  Two fingerprints at most
``distance`` bits apart agree in two blocks at least, so each fingerprint is
filed once under every pair of blocks, files are joined on the kept bits, and
the join condition verifies the distance.  Fingerprints are made distinct
first, so exact copies cost nothing.  A file of more than ``max_file`` distinct
fingerprints is not compared pair by pair: its members are filed again under
every value one bit away in the bits left open; members of one such file are
at most two bits apart, and any two that close share one, so a star per file
carries every link of the file exactly.

Null and empty texts have fingerprint zero, linked like any other.  Texts of
fewer words than a shingle are one shingle.  Rows repeat in the output as in
the input; a null ``doc_id`` stays null and never names a component unless no
member has an id.  Other columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, small_batches, text_key

BITS = 64


def simhash(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Fingerprint as a signed 64-bit integer."""
    found = text.encode().lower().split() if text else []  # bytes: A-Z only, ASCII blanks only
    if not found:
        return 0
    if shingle == 3 and len(found) > 3:
        grams = map(b" ".join, zip(found, found[1:], found[2:]))
    else:
        grams = (b" ".join(found[i:i + shingle]) for i in range(max(1, len(found) - shingle + 1)))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(g, seed) for g in grams), dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(h), 1 << 16):  # bounded memory however long the text
        part = h[i:i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([simhash(t, shingle) for t in batch], dtype="int64")

    return run(text)


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def masks(distance: int) -> list[int]:
    """Bits kept by each table: every pair of ``distance + 2`` blocks."""
    n = distance + 2
    edges = [BITS * i // n for i in range(n + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [a | b for a, b in combinations(blocks, 2)]


def links(fps: DataFrame, distance: int = 2, max_file: int = 256) -> DataFrame:
    """(a, b): links between distinct fingerprints (column ``fp``) at most
    ``distance`` bits apart.  Every pair in a file of up to ``max_file`` is
    given; of larger files a set of true links that joins the same groups."""
    if distance != 2 and max_file < (1 << 62):
        max_file = 1 << 62  # the refinement by one-bit neighbours is exact for two bits
    keep = masks(distance)
    files = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")) for m in keep]))
                       .alias("t", "k"))
    large = cut(files.groupBy("t", "k").agg(F.count("*").alias("n")).where(F.col("n") > max_file).select("t", "k"), "sim-large")
    some = not large.isEmpty()
    small = files.join(large, ["t", "k"], "left_anti") if some else files
    x, y = small.alias("x"), small.alias("y")
    differ = F.col("x.fp").bitwiseXOR(F.col("y.fp"))
    found = x.join(y, (F.col("x.t") == F.col("y.t")) & (F.col("x.k") == F.col("y.k")) & (F.col("x.fp") < F.col("y.fp"))
                   & (F.bit_count(differ) <= distance)).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    if some:
        flips = F.element_at(F.array(*[F.array(*[F.lit(_signed(1 << b)).cast("long") for b in range(BITS) if not m >> b & 1])
                                       for m in keep]), F.col("t") + 1)
        near = files.join(large, ["t", "k"]).select("fp", "t", F.explode(F.concat(
            F.array("fp"), F.transform(flips, lambda f: F.col("fp").bitwiseXOR(f)))).alias("mid"))
        stars = near.join(near.groupBy("t", "mid").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1"),
                          ["t", "mid"]).where(F.col("fp") != F.col("a"))
        found = found.unionByName(stars.select("a", F.col("fp").alias("b")))
    return found.distinct()


def stars(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (a, b), root the
    least node of its component.  Alternates large and small stars; every
    round is a written table and no step holds a component in one task."""
    e = cut(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
            "cc-edges")
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))).distinct()
        e = cut(small, "cc-round")
        state = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if state == seen:
            break
        seen = state
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _grouped(own: DataFrame, distance: int, max_file: int) -> DataFrame:
    """(fp, root, component_id) of every fingerprint of ``own`` (doc_id, fp): ``root`` is the least fingerprint of
    its component, and tells components without ids or of the same least id apart."""
    nodes = own.groupBy("fp").agg(F.min("doc_id").alias("first"))
    member = stars(links(nodes.select("fp"), distance, max_file))
    known = nodes.join(member, nodes["fp"] == member["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = known.groupBy("root").agg(F.min("first").alias("component_id"))
    return known.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, distance: int = 2, shingle: int = 3, max_file: int = 256) -> DataFrame:
    """One row per document: doc_id, fp (signed long), component_id."""
    small_batches(docs.sparkSession)
    own = cut(docs.select("doc_id", fingerprint(F.col("text"), shingle).alias("fp")), "sim-fp")
    # written, so that both sides of the join are dealt for it and a fingerprint of many documents can be split
    groups = cut(_grouped(own, distance, max_file), "sim-groups")
    return own.join(groups, "fp").select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, distance: int = 2, shingle: int = 3, max_file: int = 256) -> DataFrame:
    """The documents with one row left of each component: of its rows with the least id (a null id only if no row
    has one) that of the least fingerprint and then text, whichever other rows have the same id.  Rows that agree
    in id and text are one document; one of them stays."""
    small_batches(docs.sparkSession)
    key = text_key(F.col("text"))
    own = cut(docs.select("doc_id", fingerprint(F.col("text"), shingle).alias("fp"), key.alias("key")), "sim-fp")
    first = own.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "fp", "key")).alias("best"))
    kept = first.join(_grouped(own, distance, max_file).select("fp", "root"), "fp").groupBy("root").agg(F.min("best").alias("best"))
    kept = cut(kept.select(F.col("best.doc_id").alias("__id"), F.col("best.key").alias("__key")), "sim-kept")
    same = docs["doc_id"].eqNullSafe(F.col("__id")) & (key == F.col("__key"))
    return docs.withColumn("__own", key).join(kept, same, "left_semi").dropDuplicates(["doc_id", "__own"]).drop("__own")
