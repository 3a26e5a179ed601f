import numpy as np
import pytest

from shelfwise.operators import isolation


def plain_depth(tree, point, node=0):
    if tree.feature[node] < 0:
        return tree.depth[node]
    goes = tree.left if point[tree.feature[node]] <= tree.cut[node] else tree.right
    return plain_depth(tree, point, goes[node])


def plain_leaf_sizes(tree, points):
    """Depth and number of sample rows of every leaf, by sending the sample down one row at a time."""
    sizes = {}
    for p in points:
        node, depth = 0, 0
        while tree.feature[node] >= 0:
            node = (tree.left if p[tree.feature[node]] <= tree.cut[node] else tree.right)[node]
            depth += 1
        sizes.setdefault(node, [depth, 0])[1] += 1
    return sizes


def test_trees_are_what_they_say():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(size=(100, 3)), np.zeros((40, 3))])
    tree = isolation.grow(points, rng)
    for node, (depth, size) in plain_leaf_sizes(tree, points).items():
        assert tree.depth[node] == pytest.approx(depth + isolation.expected_depth(size))
        assert depth <= 8
    asked = rng.normal(size=(50, 3)) * 3
    assert isolation.depths(tree, asked).tolist() == [plain_depth(tree, p) for p in asked]
    assert [isolation.expected_depth(n) for n in (0, 1, 2)] == [0, 0, 1]


def test_planted_outliers_come_first(spark):
    rng = np.random.default_rng(2)
    rows = [(i, *map(float, p)) for i, p in enumerate(rng.normal(size=(3000, 3)))]
    rows += [(9000 + i, *p) for i, p in enumerate([(9.0, 9.0, 9.0), (-9.0, 9.0, -9.0), (9.0, -9.0, -9.0)])] + [(9999, None, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double").repartition(5)
    got = isolation.isolation_outliers(df, "id", ["a", "b", "c"]).collect()
    assert len(got) == 3004 and all(0 < r.score < 1 for r in got)
    top = sorted(got, key=lambda r: -r.score)[:3]
    assert {r.id for r in top} == {9000, 9001, 9002} and all(r.is_outlier for r in top)
    again = {r.id: r.score for r in isolation.isolation_outliers(df.repartition(2), "id", ["a", "b", "c"]).collect()}
    assert again == {r.id: r.score for r in got}
    forest, size = isolation.fit_isolation(df, "id", ["a", "b", "c"])
    point = np.array([9.0, 9.0, 9.0])
    mean = np.mean([plain_depth(t, point) for t in forest])
    assert {r.id: r.score for r in got}[9000] == pytest.approx(2 ** (-mean / isolation.expected_depth(size)))


def test_few_rows(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 1.0)], "id long, a double")
    assert isolation.isolation_outliers(df.limit(0), "id", ["a"]).count() == 0
    assert {r.score for r in isolation.isolation_outliers(df, "id", ["a"]).collect()} == {0.5}
