"""The logistic sweep against one plain run after another."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from tessera.operators import logistic as lr
from tessera.plans import catalog

TOKEN = regex.compile(r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+")
PLACES = 1 << 14


def unit(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:8], 16) / 4294967296.0


def part(key, seed):
    return "test" if unit(42, key) < 0.2 else "dev" if unit(seed + 43, key) < 0.25 else "train"


def mixed(h, seed, step):
    m = (1 << 64) - 1
    z = (h + 0x9E3779B97F4A7C15 * (1_000_003 * seed + step + 1)) & m
    z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 & m
    z = (z ^ z >> 27) * 0x94D049BB133111EB & m
    return ((z ^ z >> 31) >> 11) / (1 << 53)


def plain_runs(docs, grid, hashes):
    """{run_idx: {phase: (accuracy, F1, loss)}} of [(key, text, label)]."""
    docs = [d for d in docs if d[2] is not None]
    bags = {k: Counter(zlib.crc32(t.encode()) % PLACES for t in TOKEN.findall(text or "")) for k, text, _ in docs}
    free = [k for k, _, _ in docs if unit(42, k) >= 0.2]
    df = Counter(i for k in free for i in bags[k])
    x = np.zeros((len(docs), PLACES + 1))
    for row, (k, _, _) in enumerate(docs):
        for i, n in bags[k].items():
            x[row, i] = n * math.log((len(free) + 1) / (df[i] + 1))
        x[row] /= np.linalg.norm(x[row]) or 1
    x[:, -1] = 1
    y = np.array([d[2] for d in docs], dtype=float)
    out = {}
    for run, (rate, size, seed) in enumerate(grid.runs()):
        parts = np.array([part(k, seed) for k, _, _ in docs])
        share = min(1, size / max(1, (parts == "train").sum()))
        w = np.zeros(PLACES + 1)
        for step in range(grid.steps):
            at = (parts == "train") & np.array([mixed(hashes[k], seed, step) < share for k, _, _ in docs])
            if at.any():
                g = x[at].T @ (1 / (1 + np.exp(-x[at] @ w)) - y[at]) / at.sum()
                g[:-1] += grid.reg * w[:-1]
                w -= rate * g
        z, out[run] = x @ w, {}
        for phase in ("dev", "test"):
            at = parts == phase
            pred = z[at] > 0
            tp, fp, fn = (pred & (y[at] == 1)).sum(), (pred & (y[at] == 0)).sum(), (~pred & (y[at] == 1)).sum()
            out[run][phase] = ((pred == (y[at] == 1)).mean(), 2 * tp / max(1, 2 * tp + fp + fn),
                               np.logaddexp(0, np.where(y[at] == 1, -z[at], z[at])).mean())
    return out


def key_hashes(df):
    return {r[0]: r[1] % (1 << 64) for r in df.select("doc_id", F.xxhash64("doc_id")).collect()}


def check(got, want, grid):
    assert len(got) == 2 * len(grid.runs())
    for r in got:
        acc, f1, loss = want[r.run_idx][r.phase]
        assert (r.learning_rate, r.batch_size, r.seed) == grid.runs()[r.run_idx]
        assert abs(r.metric_1 - acc) < 1e-6 and abs(r.metric_2 - f1) < 1e-6 and abs(r.loss - loss) < 1e-6


def test_registered_sweep_over_the_whole_table(spark):
    from tessera.plans import benchmark

    sf = "/root/testdata/sf0.01"
    docs = benchmark._clf_docs(spark, sf)
    rows = [(r.doc_id, r.text, r.label) for r in docs.collect()]
    want = plain_runs(rows, benchmark.LOGISTIC, key_hashes(docs))
    got = catalog.queries()["clf_logistic_runs"](spark, sf).collect()
    check(got, want, benchmark.LOGISTIC)
    best = max(r.metric_1 for r in got if r.phase == "dev")
    majority = max(np.mean([x[2] for x in rows]), 1 - np.mean([x[2] for x in rows]))
    assert best >= majority  # it learns at least the classes' shares


def test_learning_rate_and_batch_size_drive_the_fit(spark):
    docs = spark.createDataFrame([(i, f"{'good fine' if i % 2 else 'bad poor'} word{i % 13} x{i % 5}", i % 2) for i in range(300)],
                                 "doc_id long, text string, label int")
    grid = lr.Grid(rates=(0.1, 3.0), batches=(8, 1000), seeds=2, steps=15)
    got = lr.sweep(docs, grid).collect()
    check(got, plain_runs([(r.doc_id, r.text, r.label) for r in docs.collect()], grid, key_hashes(docs)), grid)
    loss = {(r.learning_rate, r.batch_size, r.seed): r.loss for r in got if r.phase == "test"}
    assert all(loss[3.0, b, s] < loss[0.1, b, s] for b in grid.batches for s in range(2)) and len(set(loss.values())) == 8
    assert all(r.metric_1 == 1 for r in got if r.learning_rate == 3.0 and r.batch_size == 1000)


@pytest.mark.parametrize("rows", [[], [(1, None, 1), (2, "", 0), (3, "a", None)]])
def test_no_words_or_no_documents(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    grid = lr.Grid(seeds=2, steps=2)
    for r in lr.sweep(docs, grid).collect():
        assert math.isfinite(r.loss)


def test_documents_are_not_shuffled_in_a_step(spark):
    """A step's only exchange is of the tasks' gradients by feature."""
    docs = spark.createDataFrame([(i, f"w{i}", i % 2) for i in range(50)], "doc_id long, text string, label int")
    rows = lr.features(docs)
    plan = lr.predict(rows, np.zeros(((1 << 14) + 1, 1)), lr.Grid())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_a_batch_is_worked_on_in_slices(monkeypatch):
    """Cells at a time are bounded however many or long a batch's documents are; no document is lost or cut."""
    import pyarrow as pa

    monkeypatch.setattr(lr, "CELLS", 60)
    lists = [[*range(n)] for n in (3, 0, 40, 1, 1, 0, 7, 7, 7, 0)]
    batch = pa.RecordBatch.from_pydict({"idx": pa.array(lists, pa.list_(pa.int32())), "val": pa.array([[float(i) for i in x] for x in lists])})
    parts = list(lr._slices(iter([batch, batch.slice(0, 0), batch.slice(2, 3)]), 3))
    assert [x for p in parts for x in p.column("idx").to_pylist()] == lists + lists[2:5]
    assert max(len(p.column("idx").flatten()) for p in parts) <= 20 + 40 and len(parts) > 4
    for p in parts:
        rows, idx, val = lr._matrix(p)
        assert idx.tolist() == val.tolist() == [i for x in p.column("idx").to_pylist() for i in x]
        assert rows.tolist() == [r for r, x in enumerate(p.column("idx").to_pylist()) for _ in x]
