"""Metrics against pure-Python re-statements and edge sets (FIXTURES 8, 9)."""

import math
import random


from tessera.operators import experiments as X
from tessera.operators import metrics as M


def py_mcc(y, p):
    classes = sorted(set(y) | set(p))
    s = len(y)
    c = sum(1 for a, b in zip(y, p) if a == b)
    t = {k: sum(1 for a in y if a == k) for k in classes}
    q = {k: sum(1 for b in p if b == k) for k in classes}
    num = c * s - sum(t[k] * q[k] for k in classes)
    den = math.sqrt((s * s - sum(v * v for v in q.values())) * (s * s - sum(v * v for v in t.values())))
    return 0.0 if den == 0 else num / den


def py_avg_ranks(xs):
    order = sorted(range(len(xs)), key=lambda i: xs[i])
    ranks = [0.0] * len(xs)
    i = 0
    while i < len(order):
        j = i
        while j + 1 < len(order) and xs[order[j + 1]] == xs[order[i]]:
            j += 1
        for k in range(i, j + 1):
            ranks[order[k]] = (i + j) / 2 + 1
        i = j + 1
    return ranks


def py_pearson(a, b):
    ma, mb = sum(a) / len(a), sum(b) / len(b)
    cov = sum((x - ma) * (y - mb) for x, y in zip(a, b))
    va, vb = sum((x - ma) ** 2 for x in a), sum((y - mb) ** 2 for y in b)
    return cov / math.sqrt(va * vb)


def test_mcc_multiclass_and_edges(spark):
    rnd = random.Random(1)
    y = [rnd.randint(0, 2) for _ in range(300)]
    p = [v if rnd.random() < 0.6 else rnd.randint(0, 2) for v in y]
    df = spark.createDataFrame(list(zip(p, y)), "pred long, label long")
    assert abs(M.matthews(df).first()[0] - py_mcc(y, p)) < 1e-12
    one = spark.createDataFrame([(1, 1)] * 5, "pred long, label long")
    assert M.matthews(one).first()[0] == 0.0


def test_f1_accuracy_edges(spark):
    df = spark.createDataFrame([(0, 1), (0, 0), (0, 1)], "pred long, label long")
    r = M.acc_and_f1(df).first()
    assert r.f1 == 0.0 and abs(r.accuracy - 1 / 3) < 1e-12


def test_pearson_constant_is_nan(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "pred double, label double")
    assert math.isnan(df.agg(M.pearson()).first()[0])


def test_spearman_with_ties(spark):
    rnd = random.Random(8)
    x = [float(rnd.randint(0, 6)) for _ in range(200)]
    y = [v + rnd.randint(-3, 3) for v in x]
    df = spark.createDataFrame(list(zip(x, y)), "pred double, label double")
    want = py_pearson(py_avg_ranks(x), py_avg_ranks(y))
    assert abs(M.spearman(df).first().spearmanr - want) < 1e-9
    r = M.pearson_and_spearman(df).first()
    assert abs(r.pearson - py_pearson(x, y)) < 1e-9


def test_glue_dispatch_refuses_unknown(spark):
    import pytest
    df = spark.createDataFrame([(1, 1)], "pred long, label long")
    with pytest.raises(KeyError):
        M.metric_by_config(df, "wsd")
    long = M.metric_by_config(df, "mrpc").collect()
    assert sorted(r.metric for r in long) == ["accuracy", "f1"]


RUNS = [  # run_idx, key, lr, bs, seed, phase, m1, m2, loss
    (0, "0_1.0e-05_8", 1e-5, 8, 0, "dev", 0.80, 0.1, 1.0),
    (1, "1_1.0e-05_8", 1e-5, 8, 1, "dev", 0.90, 0.2, 1.0),
    (2, "0_2.0e-05_8", 2e-5, 8, 0, "dev", 0.90, 0.3, 1.0),   # tie on the best: run 1 wins
    (3, "1_2.0e-05_8", 2e-5, 8, 1, "dev", 0.70, 0.4, 1.0),
    (1, "1_1.0e-05_8", 1e-5, 8, 1, "test", 0.85, 0.5, 1.0),
]


def test_best_run_report(spark):
    runs = spark.createDataFrame(RUNS, "run_idx long, run_key string, learning_rate double, batch_size int, "
                                       "seed int, phase string, metric_1 double, metric_2 double, loss double")
    r = X.report(runs).first()
    assert r.best_run_key == "1_1.0e-05_8" and r.best_dev_1 == 90.0
    assert r.avg_dev_1 == 85.0 and r.std_dev_1 == 5.0 and r.n_same == 2      # population std
    assert r.test_metric_1 == 0.85


def test_grid_order_and_seeds(spark):
    tasks = spark.createDataFrame([("cls",), ("xnli",)], "task string")
    g = X.grid(tasks, "1e-5/2e-5", "8/16", 3).orderBy("task", "run_idx").collect()
    cls = [(r.learning_rate, r.batch_size, r.seed) for r in g if r.task == "cls"]
    assert cls == [(lr, bs, s) for lr in (1e-5, 2e-5) for bs in (8, 16) for s in range(3)]
    assert [r.run_idx for r in g if r.task == "cls"] == list(range(12))
    assert len([r for r in g if r.task == "xnli"]) == 4


def test_correlations_use_complete_pairs(spark):
    from tessera.operators.metrics import pearson, spearman
    rows = [(1.0, 2.0), (2.0, 1.0), (3.0, 5.0), (4.0, 4.0), (5.0, 6.0)]
    whole = spark.createDataFrame(rows, "pred double, label double")
    holes = spark.createDataFrame([*rows, (900.0, None), (None, -70.0), (None, None)], "pred double, label double")
    for frame in (lambda d: d.agg(pearson().alias("r")), spearman):
        assert abs(frame(whole).first()[0] - frame(holes).first()[0]) < 1e-12


def test_nan_metric_never_wins(spark):
    from tessera.operators.experiments import RUN_COLS, best_run
    rows = [(0, "a", 0.1, 8, 0, "dev", float("nan"), 0.0, 0.0), (1, "b", 0.1, 8, 1, "dev", 0.9, 0.0, 0.0), (2, "c", 0.1, 8, 2, "dev", None, 0.0, 0.0)]
    schema = ("run_idx long, run_key string, learning_rate double, batch_size int, seed int, phase string, "
              "metric_1 double, metric_2 double, loss double")
    assert best_run(spark.createDataFrame(rows, schema).select(*RUN_COLS)).first().run_key == "b"
