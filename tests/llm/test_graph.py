"""Embedding near duplicates against all cosines."""

import math

import numpy as np
import pytest
from tessera.llm import graph
from tessera.llm.queries import QUERIES

FIELDS = "vec_id long, embedding array<double>, label int"


def brute(rows, threshold=0.95):
    """{place: (vec_id, n_links, component_id, kept)} of [(vec_id, vector)]."""
    fine = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v) for _, v in rows]
    n, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for dim in {len(v) for (_, v), ok in zip(rows, fine) if ok}:
        at = [i for i, (_, v) in enumerate(rows) if fine[i] and len(v) == dim]
        x = np.array([rows[i][1] for i in at], dtype=np.float64)
        x /= np.abs(x).max(1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(np.triu(x @ x.T >= threshold, 1))):
            n[at[a]] += 1
            n[at[b]] += 1
            root[find(at[a])] = find(at[b])
    least = {}
    for i, (v, _) in enumerate(rows):
        if v is not None:
            least[find(i)] = min(v, least.get(find(i), v))
    return sorted(((v, n[i], c, v == c) for i, (v, _) in enumerate(rows) for c in [least.get(find(i))]), key=str)


def got(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], FIELDS)


def clustered(seed, n=900, dim=24, copies=60):
    """Loose background, chains and dense groups of near copies, exact copies."""
    rng = np.random.default_rng(seed)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    out = [unit(rng.normal(size=(n, dim)))]
    for size in (2, 3, 5, 9, copies, 4 * copies):
        centre = unit(rng.normal(size=dim))
        out.append(unit(centre + rng.normal(size=(size, dim)) * 0.045))
    walk = [unit(rng.normal(size=dim))]
    for _ in range(40):  # a chain: neighbours link, ends do not
        walk.append(unit(walk[-1] + rng.normal(size=dim) * 0.045))
    x = np.concatenate([*out, np.array(walk)])
    x = np.concatenate([x, x[rng.integers(0, len(x), 50)]]) * rng.uniform(0.1, 9, (len(x) + 50, 1))
    return [(int(i), v.tolist()) for i, v in zip(rng.permutation(len(x)), x)]


def test_whole_table(spark, sf):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert got(QUERIES["op11_graph"](spark, sf)) == brute(rows)


@pytest.mark.parametrize("settings", [graph.Settings(), graph.Settings(size=150, overlap=3), graph.Settings(size=400, cap=120, goal=1.0)])
def test_clusters_whole_shards_and_slices(spark, settings):
    rows = clustered(settings.size)
    assert got(graph.near_duplicates(table(spark, rows), settings)) == brute(rows)


def test_recall_of_the_first_search(spark):
    """What one build and search finds, before the audit widens anything."""
    rows = clustered(3, n=3000)
    out = got(graph.near_duplicates(table(spark, rows), graph.Settings(size=256, goal=0)))
    want = brute(rows)
    assert sum(x[1] for x in out) >= 0.99 * sum(x[1] for x in want)
    assert all(x[1] <= y[1] for x, y in zip(sorted(out), sorted(want)))


def test_audit_widens_a_poor_search(spark):
    rows = clustered(4, n=1500)
    poor = graph.Settings(size=40, overlap=1, beam=4, pool=2, near=1, far=1)
    once = got(graph.near_duplicates(table(spark, rows), graph.Settings(**(vars(poor) | {"goal": 0}))))
    wide = got(graph.near_duplicates(table(spark, rows), graph.Settings(**(vars(poor) | {"goal": 1.0}))))
    total = sum(x[1] for x in brute(rows))
    assert sum(x[1] for x in once) < sum(x[1] for x in wide) and sum(x[1] for x in wide) >= 0.99 * total


def test_odd_rows(spark):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0]
    rows = [(1, a), (1, a), (2, [5.0, 0.1, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [float("nan"), 1.0]),
            (8, [float("inf"), 1.0]), (None, a), (None, b), (9, [0.0, 2.0]), (10, [-1.0, 0.0, 0.0]), (11, [1e200, 1e200]),
            (12, [1e-200, 1e-200]), (None, None), (13, [1.0, -0.0, 0.0]), (None, [7.0]), (None, [8.0])]
    df = table(spark, rows)
    for name in ("id", "v", "w", "n", "root", "copies", "dim", "shard", "slice", "home", "kept"):
        df = df.selectExpr("*", f"'extra' as {name}")
    out = got(graph.near_duplicates(df))
    want = [(v, n, c, v == c) for v, n, c, _ in brute(rows)]
    assert out == sorted(want, key=str)
    assert graph.near_duplicates(df.limit(0)).count() == 0
    assert got(graph.near_duplicates(table(spark, [(1, None), (2, [0.0])]))) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_robust_prune_drops_what_a_chosen_one_covers():
    x = graph.units([[1, 0], [1, 0.1], [1, 0.11], [1, -0.3]])
    assert graph.robust_prune(x, np.array([0]), np.array([[1, 2, 3]]), 3).tolist() == [[1, 3, -1]]
