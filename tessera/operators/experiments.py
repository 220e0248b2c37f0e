"""Experiment grid, run table and best-run report
(J4, J5, J8, J9, J11, A11, A17, M4, M5, T21, X2).

The grid is generated by exploding the parameter arrays on each task row
(no cross join); the report is pure DataFrame work: dev runs are aggregated
once by configuration, the best configuration is taken by ``max_by``, and its
test result is an equi-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import SINGLE_SEED_TASKS
from ..functions.text import run_key


def parse_list(col) -> Column:
    """``'1e-5/2e-5'`` -> ``array<double>``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.transform(F.split(c, "/"), lambda x: x.cast("double"))


def seed_count(task: Column, n_seeds: int) -> Column:
    """One seed for the single-seed tasks, ``n_seeds`` otherwise (>= 1)."""
    return F.when(F.lower(task).isin(SINGLE_SEED_TASKS), F.lit(1)).otherwise(
        F.lit(max(1, n_seeds)))


def grid(tasks: DataFrame, rates: str, batches: str, n_seeds: int,
         steps: int = 1, task: str = "task") -> DataFrame:
    """J4 + J5 + T21 + M5: every (rate, batch size, seed) run of each task in
    product order, with ``run_idx``, ``run_key`` and the effective batch
    (``steps * batch_size``).  ``rates`` / ``batches`` are '/'-separated."""
    t = tasks.select(task, parse_list(F.lit(rates)).alias("_lr"), parse_list(F.lit(batches)).alias("_bs"),
                     seed_count(F.col(task), n_seeds).alias("_n"))
    t = t.select(task, "_n", F.size("_bs").alias("_nb"), F.posexplode("_lr").alias("lr_idx", "learning_rate"),
                 "_bs")
    t = t.select(task, "_n", "_nb", "lr_idx", "learning_rate",
                 F.posexplode("_bs").alias("bs_idx", "_b"))
    t = t.select(task, "_n", "_nb", "lr_idx", "learning_rate", "bs_idx",
                 F.col("_b").cast("int").alias("batch_size"),
                 F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("seed"))
    run_idx = (F.col("lr_idx") * F.col("_nb") * F.col("_n") + F.col("bs_idx") * F.col("_n")
               + F.col("seed"))
    return t.select(task, run_idx.cast("long").alias("run_idx"), "learning_rate", "batch_size",
                    F.col("seed").cast("int").alias("seed"),
                    run_key("seed", "learning_rate", "batch_size").alias("run_key"),
                    F.lit(steps).alias("steps"),
                    (F.lit(steps) * F.col("batch_size")).alias("final_batch"))


PARAMS = ("learning_rate", "batch_size")


def run_cols(params=PARAMS) -> list[str]:
    return ["run_idx", "run_key", *params, "seed", "phase", "metric_1", "metric_2", "loss"]


RUN_COLS = run_cols()


def run_order(metric: str):
    """Larger metric first, then the first run; a NaN or missing metric never wins."""
    m = F.col(metric).cast("double")
    return F.struct(F.when(~F.isnan(m), m).alias("m"), -F.col("run_idx"))


def best_run(runs: DataFrame, metric: str = "metric_1", phase: str = "dev", params=PARAMS) -> DataFrame:
    """The run with the largest ``metric`` on ``phase``; the first run
    (smallest ``run_idx``) wins ties, as a strict ``>`` scan does."""
    dev = runs.where(F.col("phase") == phase)
    best = dev.agg(F.max_by(F.struct(*run_cols(params)), run_order(metric)).alias("b"))
    return best.select("b.*")


def report(runs: DataFrame, metric: str = "metric_1", params=PARAMS) -> DataFrame:
    """M4 = A17 -> J9 -> A11 -> J8: best dev run, mean and population std (x100,
    one decimal, half-even) of the runs sharing its configuration (``params``:
    rate and batch size), and the test metrics of the best run's key.

    Dev runs are aggregated once per configuration: the config's best run
    and its statistics.  The best run overall is the best of the config bests
    (same tie rule), so its config's statistics come with it - no self-join,
    no subquery; then one equi-join fetches its test row."""
    dev = runs.where(F.col("phase") == "dev")
    order = run_order(metric)
    per_cfg = dev.groupBy(*params).agg(
        F.max_by(F.struct(*run_cols(params)), order).alias("best"),
        F.max(order).alias("_key"),
        F.bround(F.avg("metric_1") * 100, 1).alias("avg_dev_1"),
        F.bround(F.stddev_pop("metric_1") * 100, 1).alias("std_dev_1"),
        F.bround(F.avg("metric_2") * 100, 1).alias("avg_dev_2"),
        F.bround(F.stddev_pop("metric_2") * 100, 1).alias("std_dev_2"),
        F.count(F.lit(1)).alias("n_same"))
    stats = ["avg_dev_1", "std_dev_1", "avg_dev_2", "std_dev_2", "n_same"]
    top = per_cfg.agg(F.max_by(F.struct("best", *stats), F.col("_key")).alias("t")).select("t.*")
    b = top.select(F.col("best.run_key").alias("best_run_key"), F.col("best.seed").alias("best_seed"),
                   *[F.col(f"best.{p}").alias(f"best_{p}") for p in params],
                   F.bround(F.col("best.metric_1") * 100, 1).alias("best_dev_1"),
                   F.bround(F.col("best.metric_2") * 100, 1).alias("best_dev_2"), *stats)
    test = runs.where(F.col("phase") == "test").select(
        "run_key", F.col("metric_1").alias("test_metric_1"), F.col("metric_2").alias("test_metric_2"))
    return b.join(test, b.best_run_key == test.run_key, "left").drop("run_key")    # J8


def pair_turns(conv: DataFrame, first: str = "user", second: str = "assistant",
               value: str = "text", out: tuple[str, str] = ("prompt", "completion")) -> DataFrame:
    """Each ``first`` turn with the ``second`` turn right after it.  Both
    turns map to the pair key (conversation, first turn) and one aggregation
    puts them side by side - a single pass instead of a self-join."""
    pair_turn = F.when(F.col("role") == first, F.col("turn")).otherwise(F.col("turn") - 1)
    keyed = conv.where(F.col("role").isin(first, second)).select(
        "conv_id", pair_turn.alias("turn"), "role", value)
    g = keyed.groupBy("conv_id", "turn").agg(
        F.first(F.when(F.col("role") == first, F.col(value)), ignorenulls=True).alias(out[0]),
        F.first(F.when(F.col("role") == second, F.col(value)), ignorenulls=True).alias(out[1]))
    return g.where(F.col(out[0]).isNotNull() & F.col(out[1]).isNotNull())
