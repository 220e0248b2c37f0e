"""Near duplicates of vectors by a robust-pruned graph over overlapping cluster shards.

Vectors that are equal are one node.  Centroids are fitted on a bounded sample
of nodes (``SAMPLE``, by hash order); every node is a member of the shards of
its ``overlap`` nearest centroids, the nearest is its home.  Each shard builds
a graph: near candidates and some far ones, both robust-pruned (a candidate
goes when one already chosen is ``ALPHA`` times nearer to it than the node),
with reverse edges.  The lists of a node from all its shards are united into
one flat graph.  Each node is then searched in its home shard: greedily from
the shard's medoid with a beam, then by range expansion over everything within
``SLACK`` of the threshold; a search that has not met its own node goes on from
there, too.  Every pair is verified by its cosine in double precision.

A shard of more than ``CAP`` members is dealt into slices by hash: each slice
has its own graph, and each node is searched in every slice of its home shard,
one pair of slices in a task.  So a group of near copies that holds a third of
all rows is worked on in bounded pieces and no link of it is dropped; pairs
are counted where they are found and never leave the task, which hands on one
count per node and a spanning forest for the components.

``audit`` compares link counts with brute force for a bounded set of queries
(``AUDIT`` by hash order, half of them among the linked), against all nodes;
while the share found is under ``goal``, the overlap and the beam are doubled
and the shards searched again, until every node is in every shard.

Null vectors, zero vectors and those with null, NaN or infinite components link
with nothing; neither do vectors of different lengths.  Copies and rows of equal
``vec_id`` are rows of their own and link with each other.  A null ``vec_id``
names a component only if no member has an id; such a row is kept only then.
An empty table gives no row.  Other columns are not used.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .simhash import stars

SAMPLE, AUDIT = 16_384, 512
ALPHA, SLACK = 1.2, 0.05
CAP = 8_192
log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Settings:
    """``size``: nodes a shard's home cell has on average; ``near`` and ``far`` edges of a node in a shard,
    ``pool`` near candidates; ``beam`` of the greedy search."""

    threshold: float = 0.95
    size: int = 2_048
    overlap: int = 4
    near: int = 8
    far: int = 4
    pool: int = 32
    beam: int = 16
    cap: int = CAP
    goal: float = 0.99


def units(vectors: list) -> np.ndarray:
    """Rows of length one, in double precision (scaled first, so squares neither overflow nor vanish)."""
    x = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def centroids(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means; an empty cell keeps its centre."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        home = (x @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, home, x)
        norm = np.sqrt((sums * sums).sum(1))
        c[norm > 0] = sums[norm > 0] / norm[norm > 0, None]
    return c


def robust_prune(x: np.ndarray, rows: np.ndarray, pool: np.ndarray, most: int) -> np.ndarray:
    """For nodes ``rows`` with candidates ``pool`` (nearest first, -1: none): at most ``most`` of them, -1 filled."""
    out = np.full((len(rows), most), -1)
    if not pool.shape[1]:
        return out
    c = x[pool]
    between = np.sqrt(np.maximum(0, 2 - 2 * (c @ c.transpose(0, 2, 1))))
    own = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("bcd,bd->bc", c, x[rows])))
    alive, each = pool >= 0, np.arange(len(rows))
    for r in range(most):
        some = alive.any(1)
        pick = alive.argmax(1)
        out[some, r] = pool[each, pick][some]
        alive &= ALPHA * between[each, pick] > own
        alive[each, pick] = False
    return out


def build(x: np.ndarray, s: Settings, seed: int = 0) -> list[np.ndarray]:
    """Neighbours of each row of ``x``: pruned near and far candidates and reverse edges."""
    n, rng = len(x), np.random.default_rng(seed)
    pool, edges = min(s.pool, n - 1), []
    for i in range(0, n, 256):
        rows = np.arange(i, min(n, i + 256))
        sim = x[rows] @ x.T
        sim[np.arange(len(rows)), rows] = -np.inf
        near = np.argpartition(-sim, pool - 1, axis=1)[:, :pool] if pool else np.empty((len(rows), 0), int)
        far = rng.integers(0, n, (len(rows), 4 * s.far))
        far[far == rows[:, None]] = -1
        for some, most in ((near, s.near), (far, s.far)):
            order = np.argsort(-np.take_along_axis(sim, some, 1), axis=1, kind="stable")
            some = np.take_along_axis(some, order, 1)
            kept = robust_prune(x, rows, some, most)
            a, b = np.nonzero(kept >= 0)
            edges.append(np.stack([rows[a], kept[a, b]]))
    a, b = np.concatenate(edges, axis=1) if edges else np.empty((2, 0), int)
    # reverse edges: the nearest of those that point here
    sim = np.einsum("ij,ij->i", x[a], x[b])
    order = np.lexsort((-sim, b))
    to, back = b[order], a[order]
    rank = np.arange(len(to)) - np.searchsorted(to, to)
    kept = rank < s.near + s.far
    a, b = np.concatenate([a, to[kept]]), np.concatenate([b, back[kept]])
    code = np.unique(a * n + b)
    return np.split(code % n, np.searchsorted(code // n, np.arange(1, n)))


def padded(lists: list[np.ndarray]) -> np.ndarray:
    size = np.array([len(x) for x in lists])
    out = np.full((len(lists), max(1, size.max(initial=0))), -1)
    out[np.arange(out.shape[1]) < size[:, None]] = np.concatenate(lists) if size.sum() else []
    return out


def search(x: np.ndarray, nbrs: np.ndarray, medoid: int, q: np.ndarray, own: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) of all pairs found with cosine >= threshold; ``own``: each query's own node (-1: not here),
    which is no hit."""
    m, n, low = len(q), len(x), s.threshold - SLACK
    seen, opened = np.zeros((m, n), dtype=bool), np.zeros((m, n), dtype=bool)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    each = np.arange(m)[:, None]

    def meet(rows: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cosines of the pairs not met before, by row."""
        new = nodes >= 0
        rows, nodes = rows[new], nodes[new]
        new = ~seen[rows, nodes]
        code = np.unique(rows[new] * n + nodes[new])
        rows, nodes = code // n, code % n
        seen[rows, nodes] = True
        sim = np.einsum("ij,ij->i", q[rows], x[nodes])
        near = sim >= low
        found.append((rows[near], nodes[near], sim[near]))
        return rows, nodes, sim

    ids, sims, done = np.full((m, s.beam), -1), np.full((m, s.beam), -np.inf), np.ones((m, s.beam), dtype=bool)
    meet(np.arange(m), np.full(m, medoid))
    ids[:, 0], sims[:, 0], done[:, 0] = medoid, q @ x[medoid], False
    while not done.all():
        score = np.where(done, -np.inf, sims)
        at = np.argsort(-score, axis=1)[:, :4]
        nodes = np.where(np.take_along_axis(score, at, 1) > -np.inf, np.take_along_axis(ids, at, 1), -1)
        np.put_along_axis(done, at, True, 1)
        opened[np.broadcast_to(each, nodes.shape)[nodes >= 0], nodes[nodes >= 0]] = True
        step = np.where(nodes[:, :, None] >= 0, nbrs[nodes], -1).reshape(m, -1)
        rows, nodes, sim = meet(np.broadcast_to(each, step.shape).ravel(), step.ravel())
        if not len(rows):
            continue
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        wide = place.max() + 1
        more, worth = np.full((m, wide), -1), np.full((m, wide), -np.inf)
        more[rows, place], worth[rows, place] = nodes, sim
        sims = np.concatenate([sims, worth], axis=1)
        best = np.argpartition(-sims, s.beam - 1, axis=1)[:, :s.beam]
        ids = np.take_along_axis(np.concatenate([ids, more], axis=1), best, 1)
        done = np.take_along_axis(np.concatenate([done, more < 0], axis=1), best, 1)
        sims = np.take_along_axis(sims, best, 1)
    here = np.flatnonzero(own >= 0)
    meet(here, own[here])  # a search that missed its own node goes on from it
    at = 0
    while at < len(found):  # range expansion; what it meets within range is appended
        rows, nodes, _ = found[at]
        at += 1
        new = ~opened[rows, nodes]
        rows, nodes = rows[new], nodes[new]
        opened[rows, nodes] = True
        for i in range(0, len(rows), 8192):
            step = nbrs[nodes[i:i + 8192]]
            meet(np.repeat(rows[i:i + 8192], step.shape[1]), step.ravel())
    rows, nodes, sim = (np.concatenate(c) for c in zip(*found))
    hit = (sim >= s.threshold) & (nodes != own[rows])
    return rows[hit], nodes[hit]


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least node of each node's component."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _assigned(centres: dict[int, np.ndarray], overlap: int):
    """A row for each shard of a node; lengths without a sampled vector have one shard."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, some in batch.groupby("dim"):
                c = centres.get(dim)
                if c is None:
                    yield some.assign(shard=0, home=True)
                    continue
                x = units(some["v"].tolist())
                nearest = np.argsort(-(x @ c.T), axis=1, kind="stable")[:, :overlap]
                for k in range(nearest.shape[1]):
                    yield some.assign(shard=nearest[:, k], home=k == 0)

    return run


def _built(s: Settings):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        ids = pdf["id"].to_numpy()
        lists = build(units(pdf["v"].tolist()), s, int(ids[0]) & 0xFFFFFFFF)
        return pd.DataFrame({"id": ids, "nbrs": [ids[x] for x in lists]})

    return run


def _searched(s: Settings):
    """Link counts of the queries and a spanning forest of all pairs found here."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        ids, x = pdf["id"].to_numpy(), units(pdf["v"].tolist())
        base, query = np.flatnonzero(pdf["base"]), np.flatnonzero(pdf["query"])
        links, a, b = np.zeros(len(pdf), dtype=np.int64), [], []
        if len(base) and len(query):
            y, copies = x[base], pdf["copies"].to_numpy()
            place = np.full(len(pdf), -1)
            place[base] = np.arange(len(base))
            lists = []
            for nb in pdf["nbrs"].iloc[base]:
                nb = np.asarray(nb, dtype=np.int64)
                at = np.minimum(np.searchsorted(ids[base], nb), len(base) - 1)
                lists.append(at[ids[base][at] == nb])
            nbrs = padded(lists)
            medoid = int((y @ y.sum(0)).argmax())
            for i in range(0, len(query), 256):
                some = query[i:i + 256]
                r, to = search(y, nbrs, medoid, x[some], place[some], s)
                np.add.at(links, some[r], copies[base[to]])
                a.append(some[r])
                b.append(base[to])
        root = _roots(len(pdf), np.concatenate(a), np.concatenate(b)) if a else np.arange(len(pdf))
        out = pd.DataFrame({"id": ids, "n": links, "root": ids[root]})
        return out[pdf["query"].to_numpy() | (out["root"] != out["id"]).to_numpy()]

    return run


def _shards(nodes: DataFrame, centres: dict[int, np.ndarray], s: Settings) -> DataFrame:
    """Nodes in each of their shards: dim, shard, slices of the shard, slice, id, v, copies, home."""
    own = cut(nodes.mapInPandas(_assigned(centres, s.overlap), "id long, v array<double>, copies long, dim int, shard int, home boolean"),
              "graph-members")
    slices = own.groupBy("dim", "shard").agg(F.ceil(F.count("*") / s.cap).cast("int").alias("slices"))
    bounded = F.broadcast(slices)  # a row for each shard: at most SAMPLE / 4 of them, and one for each length of vectors
    return own.join(bounded, ["dim", "shard"]).withColumn("slice", F.pmod(F.xxhash64("id"), "slices").cast("int"))


def _links(nodes: DataFrame, centres: dict[int, np.ndarray], s: Settings) -> DataFrame:
    """(id, n, root): a row for each node and task that counted or linked it."""
    members = _shards(nodes.select("id", "v", "copies", F.size("v").alias("dim")), centres, s)
    lists = members.groupBy("dim", "shard", "slice").applyInPandas(_built(s), "id long, nbrs array<long>")
    flat = cut(lists.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("nbrs"))).alias("nbrs")), "graph-lists")
    # every pair of slices of a shard is one task: queries of slice i on the graph of slice j
    at = F.sequence(F.lit(0), F.col("slices") - 1)
    as_base = F.transform(at, lambda i: F.struct(i.alias("i"), F.col("slice").alias("j"), F.lit(True).alias("base"),
                                                 (F.col("home") & (i == F.col("slice"))).alias("query")))
    as_query = F.when(F.col("home"), F.transform(F.filter(at, lambda j: j != F.col("slice")), lambda j: F.struct(
        F.col("slice").alias("i"), j.alias("j"), F.lit(False).alias("base"), F.lit(True).alias("query"))))
    pieces = members.join(flat, "id").select("dim", "shard", "id", "v", "copies", "nbrs", F.explode(
        F.concat(as_base, F.coalesce(as_query, F.slice(as_base, 1, 0)))).alias("u"))
    pieces = pieces.select("dim", "shard", F.col("u.i").alias("i"), F.col("u.j").alias("j"), "id", "v", "copies", "nbrs",
                           F.col("u.base").alias("base"), F.col("u.query").alias("query"))
    return cut(pieces.groupBy("dim", "shard", "i", "j").applyInPandas(_searched(s), "id long, n long, root long"), "graph-links")


def audit(nodes: DataFrame, counted: DataFrame, threshold: float) -> float:
    """Share of the links of ``AUDIT`` queries that were found, by brute force over all nodes.
    ``counted``: (id, n) links of each node without its own copies."""
    by_hash = lambda df: df.orderBy(F.xxhash64("id"), "id").limit(AUDIT // 2).select("id", "n")
    ids = by_hash(counted).unionByName(by_hash(counted.where("n > 0"))).distinct()
    asked = nodes.join(F.broadcast(ids), "id").select("id", "v", "n").toPandas()
    if asked.empty:
        return 1.0
    asked["dim"] = [len(v) for v in asked["v"]]
    groups = {d: (g["id"].to_numpy(), units(g["v"].tolist())) for d, g in asked.groupby("dim")}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = {d: np.zeros(len(g[0]), dtype=np.int64) for d, g in groups.items()}
        for batch in batches:
            for dim, some in batch.groupby("dim"):
                if dim in groups:
                    q, x = groups[dim], units(some["v"].tolist())
                    near = (q[1] @ x.T >= threshold) & (q[0][:, None] != some["id"].to_numpy())
                    n[dim] += near @ some["copies"].to_numpy()
        for d, (i, _) in groups.items():
            yield pd.DataFrame({"id": i, "n": n[d]})

    true = nodes.select("id", "v", "copies", F.size("v").alias("dim")).mapInPandas(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    true = {r["id"]: r["n"] for r in true.collect()}
    found = sum(min(n, true[i]) for i, n in zip(asked["id"], asked["n"]))
    return found / total if (total := sum(true.values())) else 1.0


def near_duplicates(vectors: DataFrame, settings: Settings | None = None) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    s = settings or Settings()
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    fine = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists("v", lambda x: x != 0)
    own = own.withColumn("v", F.when(F.coalesce(fine, F.lit(False)), F.col("v")))
    nodes = own.where("v is not null").groupBy("v").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    nodes = cut(nodes.select(F.monotonically_increasing_id().alias("id"), "v", "copies", "first"), "graph-nodes")
    sizes = {r["dim"]: r["n"] for r in nodes.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).collect()}
    # by hash, about twice as many as are taken: no task hands on more than its share
    some = nodes.where(F.pmod(F.xxhash64("v"), F.lit(1 << 31)) < min(1.0, 2 * SAMPLE / max(1, sum(sizes.values()))) * (1 << 31))
    sample = some.orderBy(F.xxhash64("v"), "id").limit(SAMPLE).select("v").toPandas()["v"].tolist()
    by_dim: dict[int, list] = {}
    for v in sample:
        by_dim.setdefault(len(v), []).append(v)
    centres = {d: centroids(units(x), max(1, min(-(-sizes[d] // s.size), -(-len(x) // 4)))) for d, x in by_dim.items()}
    cells = max([1, *map(len, centres.values())])
    while True:
        links = _links(nodes, centres, s)
        counted = cut(links.groupBy("id").agg(F.sum("n").alias("n")), "graph-counts")
        recall = audit(nodes, counted, s.threshold)
        log.info("embedding links: recall %.4f at overlap %d, beam %d", recall, s.overlap, s.beam)
        if recall >= s.goal or s.overlap >= cells:
            break
        s = replace(s, overlap=2 * s.overlap, beam=2 * s.beam)
    member = stars(links.where("root != id").select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = cut(member.join(nodes.select(F.col("id").alias("node"), "first"), "node"), "graph-named")
    # written, so that both sides of the join are dealt for it and a component of many nodes can be split
    least = cut(named.groupBy("root").agg(F.min("first").alias("least")), "graph-least")
    named = named.select("node", "root").join(least, "root").select(F.col("node").alias("id"), "least")
    known = nodes.join(counted, "id", "left").join(named, "id", "left").select(
        F.col("v").alias("w"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("least", "first").alias("component_id"))
    linked = own.join(known, own["v"] == known["w"]).select("vec_id", "n_links", "component_id")
    alone = own.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
