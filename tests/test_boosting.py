import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from shelfwise.operators import boosting


def plain_tree(bins, g, h, depth, rate):
    """One tree as nested tuples, every cut of every node tried on the rows themselves."""
    value = -rate * g.sum() / (h.sum() + 1)
    best = (1e-6, None)
    if depth:
        for f in range(bins.shape[1]):
            for b in range(bins[:, f].max()):
                low = bins[:, f] <= b
                if h[low].sum() >= 1 and h[~low].sum() >= 1:
                    score = lambda m: g[m].sum() ** 2 / (h[m].sum() + 1)
                    gain = 0.5 * (score(low) + score(~low) - score(low | True))
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, b))
    if best[1] is None:
        return value
    f, b = best[1]
    low = bins[:, f] <= b
    return (f, b, plain_tree(bins[low], g[low], h[low], depth - 1, rate), plain_tree(bins[~low], g[~low], h[~low], depth - 1, rate))


def walked(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def plain_margins(bins, y, task, outputs, base, rounds, depth, rate):
    margin = np.full((len(y), outputs), base)
    for _ in range(rounds):
        trees = [plain_tree(bins, *boosting.gradients(task, y, margin, k), depth, rate) for k in range(outputs)]
        margin = margin + np.array([[walked(t, row) for t in trees] for row in bins])
    return margin


def frame(spark, x, y):
    return spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, label double").repartition(3)


@pytest.mark.parametrize("task, outputs, few", [("binary", 1, 10_000), ("softmax", 3, 10_000), ("squared", 1, 10_000), ("squared", 1, 10)])
def test_trees_equal_plain_ones(spark, task, outputs, few):
    rng = np.random.default_rng(outputs)
    n, rounds = (500, 4) if few > 10 else (120, 2)
    x = rng.integers(0, 9, (n, 3))
    signal = x[:, 0] + 2 * (x[:, 1] > 4) + rng.normal(0, 1, n)
    y = {"binary": (signal > 5).astype(float), "softmax": np.digitize(signal, [3, 7]).astype(float), "squared": signal}[task]
    model = boosting.fit_boosted(frame(spark, x, y), ["a", "b", "c"], task, 3, rounds=rounds, depth=3, rate=0.3, few=few)
    base = y.mean() if task == "squared" else 0.0
    assert model.margins(x.astype(float)) == pytest.approx(plain_margins(x, y, task, outputs, base, rounds, 3, 0.3), abs=1e-8)


def test_predictions(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 3))
    y = ((x[:, 0] > 0) & (x[:, 1] > 0)).astype(float)
    df = frame(spark, x, y)
    model = boosting.fit_boosted(df, ["a", "b", "c"], "binary", rounds=30)
    got = model.transform(df).withColumn("p", vector_to_array("probability")).collect()
    assert np.mean([r.prediction == r.label for r in got]) > 0.97
    assert all(abs(sum(r.p) - 1) < 1e-9 and r.prediction == float(r.p[1] > r.p[0]) for r in got)
    assert all(len(e) <= boosting.BINS - 1 for e in model.edges)
    gaps = spark.createDataFrame([(None, 1.0, None)], "a double, b double, c double")
    assert model.transform(gaps).first().prediction == model.transform(gaps.fillna(0.0)).first().prediction


@pytest.mark.parametrize("task, outputs", [("softmax", 3), ("binary", 1), ("squared", 1)])
def test_a_level_of_all_outputs_is_one_job(spark, task, outputs):
    """Trees grown by jobs equal those grown in the driver, over more rounds than margins are kept unwritten."""
    rng = np.random.default_rng(11)
    x = rng.integers(0, 30, (600, 3))
    signal = x[:, 0] + 3.0 * (x[:, 1] > 14) + rng.normal(0, 1, 600)
    y = {"binary": (signal > 15).astype(float), "softmax": np.digitize(signal, [9, 21]).astype(float), "squared": signal}[task]
    df, rounds, depth = frame(spark, x, y), boosting.WRITTEN + 2, 3
    spark.sparkContext.setJobGroup(f"boosted-{task}", "")
    spread = boosting.fit_boosted(df, ["a", "b", "c"], task, 3, rounds=rounds, depth=depth, few=0)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"boosted-{task}"))
    spark.sparkContext.setJobGroup("rest", "")
    held = boosting.fit_boosted(df, ["a", "b", "c"], task, 3, rounds=rounds, depth=depth)
    assert spread.margins(x.astype(float)) == pytest.approx(held.margins(x.astype(float)), abs=1e-8)
    assert jobs <= rounds * depth + 30
