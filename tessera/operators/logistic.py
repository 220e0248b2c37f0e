"""M1-M3 as a trained classifier: logistic regression over hashed TF-IDF, a whole sweep in one pass a step.

The reference tunes one model after another for each learning rate, batch size
and seed.  Here the runs of a grid are columns of one weight matrix
(``num_features`` + 1 rows, one column per run), so a step of all runs is one
job: each task scores its documents against all columns, keeps for each run the
documents of its mini-batch (a hash of seed, step and document below ``batch
size / training documents``), and hands on its gradient, summed over the task;
Spark sums the tasks' gradients by feature and the driver takes the step.  The
documents are featurised once, written, and never shuffled again; what moves is
bounded by ``num_features`` times runs, both parameters.

Features: tokens hashed by CRC-32 to ``num_features`` places, counts times
ln((n + 1) / (df + 1)) over the documents outside the test part, scaled to
length 1.  A seed draws the dev part of the rest and the order of the batches;
the test part is fixed.  The loss has an L2 term ``reg / 2 * |w|^2`` (not on the
intercept).  Labels are 0 and 1; a document without a label is left out, one
without tokens is scored by the intercept alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import explode_nonempty, md5_unit, run_key, tokenize
from ..session import cut_lineage
from .classifier import DEV_SEED, TEST_SEED, evaluate

PARTS = ("train", "dev", "test")


@dataclass(frozen=True)
class Grid:
    """Runs in product order, the seed last; ``steps`` gradient steps each."""

    rates: Sequence[float] = (1.0,)
    batches: Sequence[int] = (1024,)
    seeds: int = 1
    steps: int = 20
    reg: float = 0.0

    def runs(self) -> list[tuple[float, int, int]]:
        return [(r, b, s) for r in self.rates for b in self.batches for s in range(self.seeds)]


def features(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "label", num_features: int = 1 << 14,
             seeds: int = 1, test: float = 0.2, dev: float = 0.25) -> DataFrame:
    """``(key, label, h, idx, val, parts)``, written: features of each labelled document, a hash of its key, and for
    each seed its part as a place in ``PARTS``."""
    own = docs.where(F.col(label).isNotNull())
    parts = F.when(md5_unit(F.lit(TEST_SEED), F.col(key)) < test, F.array_repeat(F.lit(2), seeds)).otherwise(F.array(
        *(F.when(md5_unit(F.lit(s + DEV_SEED), F.col(key)) < dev, 1).otherwise(0) for s in range(seeds))))
    own = own.select(key, F.col(label).cast("long").alias("label"), parts.alias("parts"), text)
    place = F.pmod(F.crc32(F.col("tok").cast("binary")), F.lit(num_features)).cast("int")
    counts = own.select(key, "parts", explode_nonempty(tokenize(text)).alias("tok")).where("tok is not null").groupBy(
        key, "parts", place.alias("i")).agg(F.count("*").alias("n"))
    counts = cut_lineage(counts, "lr-counts")
    n = own.where(F.get("parts", F.lit(0)) != 2).count()
    df = counts.where(F.get("parts", F.lit(0)) != 2).groupBy("i").agg(F.count("*").alias("df"))  # at most num_features rows
    weighted = counts.join(F.broadcast(df), "i", "left").select(
        key, F.struct("i", (F.col("n") * F.log(F.lit(n + 1.0) / (F.coalesce("df", F.lit(0)) + 1.0))).alias("v")).alias("x"))
    rows = weighted.groupBy(key).agg(F.array_sort(F.collect_list("x")).alias("x"))
    rows = rows.withColumn("norm", F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, x: a + x["v"] * x["v"])))
    rows = rows.select(key, F.transform("x", lambda x: x["i"]).alias("idx"),
                       F.transform("x", lambda x: F.when(F.col("norm") > 0, x["v"] / F.col("norm")).otherwise(0.0)).alias("val"))
    out = own.drop(text).join(rows, key, "left").select(
        key, "label", F.xxhash64(F.col(key)).alias("h"), F.coalesce("idx", F.array().cast("array<int>")).alias("idx"),
        F.coalesce("val", F.array().cast("array<double>")).alias("val"), "parts")
    return cut_lineage(out, "lr-features")


def draw(h: np.ndarray, seed: int, step: int) -> np.ndarray:
    """Uniform in [0, 1) of (document, seed, step), by the finaliser of SplitMix64."""
    z = h.astype(np.int64).view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (1_000_003 * seed + step + 1)) & 0xFFFFFFFFFFFFFFFF)
    for shift, mul in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ z >> np.uint64(shift)) * np.uint64(mul)
    return ((z ^ z >> np.uint64(31)) >> np.uint64(11)) / float(1 << 53)


#: Cells, features of documents times runs, that a task works on at a time (8 bytes each, a few arrays of them).
CELLS = 1 << 20


def _slices(batches: Iterator[pa.RecordBatch], runs: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of documents whose features times ``runs`` are about ``CELLS``, however many or long
    a batch's documents are; a document is never cut."""
    most = max(1, CELLS // max(1, runs))
    for batch in batches:
        sizes = pc.list_value_length(batch.column("idx")).to_numpy(zero_copy_only=False) + 1
        block = (np.cumsum(sizes) - sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(batch)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of each entry, feature, value) of a batch."""
    idx, val = batch.column("idx"), batch.column("val")
    rows = np.repeat(np.arange(len(batch)), pc.list_value_length(idx).to_numpy(zero_copy_only=False))
    return rows, idx.flatten().to_numpy(zero_copy_only=False).astype(np.int64), val.flatten().to_numpy(zero_copy_only=False)


def _parts(batch: pa.RecordBatch) -> np.ndarray:
    """Documents x seeds."""
    return batch.column("parts").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)


def _scores(entries, n: int, w: np.ndarray) -> np.ndarray:
    """Linear scores (documents x runs); the last row of ``w`` is the intercept."""
    rows, idx, val = entries
    own = w[idx]
    return w[-1] + np.stack([np.bincount(rows, val * own[:, k], n) for k in range(w.shape[1])], axis=1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def gradient(entries, label: np.ndarray, chosen: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the gradients of the log-loss over the chosen documents of each run, and their number."""
    rest = (_sigmoid(_scores(entries, len(label), w)) - label[:, None]) * chosen
    rows, idx, val = entries
    out = np.stack([np.bincount(idx, val * rest[rows, k], len(w)) for k in range(w.shape[1])], axis=1)
    out[-1] = rest.sum(0)
    return out, chosen.sum(0)


def _members(batch: pa.RecordBatch, grid: Grid, shares: np.ndarray, step: int) -> np.ndarray:
    parts, h = _parts(batch), _column(batch, "h")
    u = {s: draw(h, s, step) for s in range(grid.seeds)}
    return np.stack([(parts[:, s] == 0) & (u[s] < shares[k]) for k, (_, _, s) in enumerate(grid.runs())], axis=1).astype(np.float64)


def fit(rows: DataFrame, grid: Grid, num_features: int = 1 << 14) -> np.ndarray:
    """Weights (num_features + 1, runs) after ``grid.steps`` steps from zero; a step takes the mean gradient of its
    mini-batch, and none if that is empty."""
    runs = grid.runs()
    spark = rows.sparkSession
    counts = rows.select([F.sum((F.get("parts", F.lit(s)) == 0).cast("long")).alias(f"n{s}") for s in range(grid.seeds)]).first()
    shares = np.array([min(1.0, b / max(1, counts[f"n{s}"] or 0)) for _, b, s in runs])
    rates = np.array([r for r, _, _ in runs])
    w = np.zeros((num_features + 1, len(runs)))
    for step in range(grid.steps):
        held = spark.sparkContext.broadcast(w)

        def run(batches: Iterator[pa.RecordBatch], step=step, held=held) -> Iterator[pa.RecordBatch]:
            total, seen = np.zeros((num_features + 1, len(runs))), np.zeros(len(runs))
            for batch in _slices(batches, len(runs)):
                g, k = gradient(_matrix(batch), _column(batch, "label"), _members(batch, grid, shares, step), held.value)
                total += g
                seen += k
            some = np.flatnonzero(total.any(1))
            for rows_of, places in ((total[some], some), (seen[None], np.array([-1]))):
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in np.ascontiguousarray(rows_of.T)),
                                                  pa.array(places.astype(np.int32))], [*cols, "i"])

        cols = [f"g{k}" for k in range(len(runs))]
        parts = rows.mapInArrow(run, ", ".join([*(f"{c} double" for c in cols), "i int"]))
        found = parts.groupBy("i").agg(*(F.sum(c).alias(c) for c in cols)).toPandas()  # at most num_features + 2 rows
        seen = found.loc[found["i"] == -1, cols].to_numpy().sum(0)
        g = np.zeros_like(w)
        place = found["i"] >= 0
        g[found.loc[place, "i"].to_numpy()] = found.loc[place, cols].to_numpy()
        move = np.divide(g, seen, out=np.zeros_like(g), where=seen > 0)
        move[:-1] += grid.reg * w[:-1] * (seen > 0)
        w = w - rates * move
        held.destroy()
    return w


def predict(rows: DataFrame, w: np.ndarray, grid: Grid, key: str = "doc_id") -> DataFrame:
    """``(key, run_idx, seed, split, label, pred, loss)`` of the dev and test documents of every run."""
    runs = grid.runs()
    held = rows.sparkSession.sparkContext.broadcast(w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, len(runs)):
            z = _scores(_matrix(batch), len(batch), held.value)
            parts, label = _parts(batch), _column(batch, "label")
            for k, (_, _, s) in enumerate(runs):
                at = np.flatnonzero(parts[:, s] > 0)
                loss = np.logaddexp(0, np.where(label[at] == 1, -z[at, k], z[at, k]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key).take(pa.array(at)), pa.array(np.full(len(at), k)), pa.array(np.full(len(at), s, np.int32)),
                     pa.array(parts[at, s]), pa.array(label[at]), pa.array((z[at, k] > 0).astype(np.int64)), pa.array(loss)],
                    [key, "run_idx", "seed", "part", "label", "pred", "loss"])

    kind = dict(rows.dtypes)[key]
    out = rows.mapInArrow(run, f"{key} {kind}, run_idx long, seed int, part int, label long, pred long, loss double")
    names = F.array(*(F.lit(p) for p in PARTS))
    return out.withColumn("split", F.get(names, "part")).drop("part")


def sweep(docs: DataFrame, grid: Grid, num_features: int = 1 << 14, key: str = "doc_id") -> DataFrame:
    """M3: the run table of the whole grid, one row per (run, phase): run_idx, run_key, learning_rate, batch_size, seed,
    phase, metric_1 (accuracy), metric_2 (F1), loss."""
    rows = features(docs, key, num_features=num_features, seeds=grid.seeds)
    pred = predict(rows, fit(rows, grid, num_features), grid, key)
    found = evaluate(pred, "run_idx", F.col("split").alias("phase"))
    runs = F.array(*(F.struct(F.lit(float(r)).alias("rate"), F.lit(b).alias("size"), F.lit(s).alias("seed")) for r, b, s in grid.runs()))
    run = F.get(runs, F.col("run_idx").cast("int"))
    return found.select("run_idx", run["rate"].alias("learning_rate"), run["size"].alias("batch_size"), run["seed"].alias("seed"),
                        "phase", "metric_1", "metric_2", "loss").withColumn("run_key", run_key("seed", "learning_rate", "batch_size"))
