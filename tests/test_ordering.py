import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.functions import ordering
from shelfwise.functions.ordering import number_rows, previous_values, quantiles, running_totals
from shelfwise.operators.metrics import classification_metrics, roc_auc, roc_auc_one_vs_rest
from shelfwise.operators.model import stratified_split


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one key, many ties in the value."""
    rng = random.Random(1)
    rows = [(i, "hot" if i % 3 == 0 else f"k{rng.randrange(40)}", float(rng.randrange(30))) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "id int, k string, v double").repartition(7)


def test_positions(skewed):
    rows, df = skewed
    got = {r.id: (r.position, r._total) for r in number_rows(df, [F.desc("v"), F.asc("id")], ["k"]).collect()}
    want = {}
    for key in {r[1] for r in rows}:
        group = sorted((r for r in rows if r[1] == key), key=lambda r: (-r[2], r[0]))
        want |= {r[0]: (i, len(group)) for i, r in enumerate(group)}
    assert got == want


def test_positions_without_key(skewed):
    rows, df = skewed
    got = {r.id: r.position for r in number_rows(df, [F.asc("v"), F.asc("id")]).collect()}
    assert got == {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (r[2], r[0])))}


def test_positions_with_null_key(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id int, k string")
    assert {r.id: r.position for r in number_rows(df, [F.col("id")], ["k"]).collect()} == {1: 0, 2: 1, 3: 0}


def test_running_totals(skewed):
    rows, df = skewed
    got = {r.id: (r.v_before, r.v_total) for r in running_totals(df, [F.asc("id")], ["v"], ["k"]).collect()}
    sums, want = {}, {}
    for i, k, v in sorted(rows):
        want[i] = sums.get(k, 0.0)
        sums[k] = want[i] + v
    assert got == {i: (want[i], sums[k]) for i, k, _ in rows}


def test_quantiles(skewed):
    rows, df = skewed
    wanted = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = {r.k: [r[n] for n in wanted] for r in quantiles(df, "v", wanted, ["k"]).collect()}
    for key in {r[1] for r in rows}:
        assert got[key] == pytest.approx(np.quantile([r[2] for r in rows if r[1] == key], list(wanted.values())).tolist())
    one = quantiles(df, "v", wanted).first()
    assert list(one) == pytest.approx(np.quantile([r[2] for r in rows], list(wanted.values())).tolist())


def test_quantiles_by_narrowing(spark, monkeypatch):
    """Many passes: few buckets, nothing listed early, heavy tails, infinities and NaN."""
    monkeypatch.setattr(ordering, "BUCKETS", 5)
    monkeypatch.setattr(ordering, "LISTED", 1)
    rng = np.random.default_rng(2)
    values = [*np.exp(rng.normal(0, 12, 60)).tolist(), *[7.0] * 30, float("inf"), float("-inf"), float("-inf")]
    df = spark.createDataFrame([("a", v) for v in values] + [(None, 1.0), (None, 2.0), ("n", float("nan")), ("n", 1.0), ("b", None)], "k string, v double")
    for p in (0.0, 0.5, 0.97):
        got = {r.k: r.q for r in quantiles(df, "v", {"q": p}, ["k"]).collect()}
        assert set(got) == {"a", None, "n"}
        assert got[None] == 1 + p
        assert got["a"] == pytest.approx(float(np.quantile(np.array(values), p)), nan_ok=True)
    plan = quantiles(df, "v", {"q": 0.5}, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def test_previous_values(skewed):
    rows, df = skewed
    got = {r.id: r.v_previous for r in previous_values(df, [F.col("id")], ["v"], ["k"]).collect()}
    last, want = {}, {}
    for i, k, v in sorted(rows):
        want[i] = last.get(k)
        last[k] = v
    assert got == want
    got = {r.id: r.v_previous for r in previous_values(df, [F.col("id")], ["v"]).collect()}
    assert got == {i: (rows[i - 1][2] if i else None) for i, _, _ in rows}


def test_quantiles_of_a_whole_table_need_no_loop_join(spark):
    found = quantiles(spark.range(101).select(F.col("id").cast("double").alias("v")), "v", {"m": 0.5, "q": 0.255})
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in found.collect()] == [(50.0, 25.5)]


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "v double")
    assert quantiles(empty, "v", {"m": 0.5}).first().m is None


def test_approximate_quantiles(skewed):
    _, df = skewed
    assert 13 <= quantiles(df, "v", {"m": 0.5}, approximate=True).first().m <= 16


def test_split_keeps_shares(skewed):
    rows, df = skewed
    marked = stratified_split(df, "id", "k").collect()
    for key in {r[1] for r in rows}:
        n = sum(r.k == key for r in marked)
        assert sum(r.is_test for r in marked if r.k == key) == int(n * 0.2 + 0.5)
    again = stratified_split(df.repartition(3), "id", "k").collect()
    assert {r.id for r in marked if r.is_test} == {r.id for r in again if r.is_test}


def test_auc(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(2), rng.randrange(8) / 8) for _ in range(300)]
    df = spark.createDataFrame(rows, "label int, s double").repartition(5)
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert roc_auc(df, F.col("label") == 1, "s").first().roc_auc == pytest.approx(want)
    both = df.select("label", F.array(1 - F.col("s"), F.col("s")).alias("p"))
    assert roc_auc_one_vs_rest(both, "label", "p").first().roc_auc == pytest.approx(want)
    assert roc_auc(df.where("label = 1"), F.col("label") == 1, "s").first().roc_auc is None


def test_metrics(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (2, 0)], "label int, prediction int")
    m = classification_metrics(df).first()
    assert m.accuracy == pytest.approx(0.6)
    assert m.precision == pytest.approx((2 * 0.5 + 2 * 2 / 3 + 0) / 5)
    assert m.recall == pytest.approx((2 * 0.5 + 2 * 1.0 + 0) / 5)
    assert m.f1 == pytest.approx((2 * 0.5 + 2 * 0.8) / 5)


def test_area_over_sixty_classes(spark):
    rng = random.Random(6)
    rows = [(rng.randrange(60), [round(rng.random(), 2) for _ in range(60)]) for _ in range(400)]
    areas = []
    for c in range(60):
        pos, neg = [p[c] for y, p in rows if y == c], [p[c] for y, p in rows if y != c]
        if pos:
            areas.append(sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg)))
    got = roc_auc_one_vs_rest(spark.createDataFrame(rows, "label int, p array<double>"), "label", "p").first().roc_auc
    assert got == pytest.approx(sum(areas) / len(areas))
