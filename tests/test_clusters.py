import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from shelfwise.operators import cluster, neighbors, ward


def frame(spark, points):
    d = len(points[0])
    names = [f"x{i}" for i in range(d)]
    df = spark.createDataFrame([(f"p{i:05d}", *map(float, p)) for i, p in enumerate(points)], f"id string, " + ", ".join(f"{n} double" for n in names))
    return df.repartition(5), names


def brute_dbscan(points, eps, min_samples):
    """Cluster labels by the definition, clusters numbered by smallest core."""
    p = np.array(points, dtype=float)
    near = [np.flatnonzero(((p - q) ** 2).sum(-1) <= eps * eps) for q in p]
    core = [len(n) >= min_samples for n in near]
    labels, current = [-1] * len(p), 0
    for i in range(len(p)):
        if not core[i] or labels[i] != -1:
            continue
        stack, labels[i] = [i], current
        while stack:
            for j in near[stack.pop()]:
                if core[j] and labels[j] == -1:
                    labels[j] = current
                    stack.append(j)
        current += 1
    for i in range(len(p)):
        if not core[i]:
            touching = [labels[j] for j in near[i] if core[j]]
            labels[i] = min(touching) if touching else -1
    return labels, [len(n) for n in near]


def check(spark, points, eps, min_samples):
    df, names = frame(spark, points)
    labels, counts = brute_dbscan(points, eps, min_samples)
    got = {r.id: r.cluster for r in neighbors.dbscan(df, "id", names, eps, min_samples).collect()}
    assert [got[f"p{i:05d}"] for i in range(len(points))] == labels
    near = {r.id: (r.n_neighbors, r.is_core) for r in neighbors.eps_neighbors(df, "id", names, eps, min_samples).collect()}
    assert [near[f"p{i:05d}"] for i in range(len(points))] == [(c, c >= min_samples) for c in counts]


def test_line_example(spark):
    points = [(0.0,), (0.4,), (0.8,), (1.2,), (1.6,), (10.0,)]
    df, names = frame(spark, points)
    got = {r.id: r.cluster for r in neighbors.dbscan(df, "id", names, 0.5, 3).collect()}
    assert [got[f"p{i:05d}"] for i in range(6)] == [0, 0, 0, 0, 0, -1]


@pytest.mark.parametrize("d,seed", [(1, 1), (2, 2), (3, 3)])
def test_blobs_against_definition(spark, d, seed):
    rng = np.random.default_rng(seed)
    blobs = [rng.normal(c, 0.35, (60, d)) for c in (0.0, 3.0, 5.0)]
    noise = rng.uniform(-2, 8, (40, d))
    check(spark, np.vstack([*blobs, noise]).tolist(), 0.5, 5)


def test_crowded_cells_and_copies(spark):
    """Third of the rows on one spot, two crowded cells that touch only at their edges."""
    rng = np.random.default_rng(4)
    copies = [(0.0, 0.0)] * 150
    left = rng.uniform((2.0, 0.0), (2.3, 0.3), (120, 2)).tolist()
    right = rng.uniform((2.75, 0.0), (3.0, 0.3), (120, 2)).tolist()
    scattered = rng.uniform((-1, -1), (5, 3), (40, 2)).tolist()
    for eps in (0.46, 0.5):
        check(spark, copies + left + right + scattered, eps, 5)


def test_no_core(spark):
    df, names = frame(spark, [(0.0, 0.0), (5.0, 5.0)])
    assert {r.cluster for r in neighbors.dbscan(df, "id", names, 0.5, 3).collect()} == {-1}


@pytest.mark.parametrize("d, eps", [(5, 0.9), (6, 1.1)])
def test_many_features(spark, d, eps):
    rng = np.random.default_rng(d)
    blobs = [rng.normal(c, 0.3, (50, d)) for c in (0.0, 2.0)]
    flat = np.column_stack([np.zeros((60, 4)), rng.uniform(0, 9, (60, d - 4))])  # alike in the first four features
    check(spark, np.vstack([*blobs, flat, rng.uniform(-2, 6, (30, d))]).tolist(), eps, 5)


def test_components_of_chain_and_star(spark):
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)]
    star = [("s000", f"s{i:03d}") for i in range(1, 80)]
    random.Random(5).shuffle(chain)
    got = {r.node: r.root for r in neighbors.connected_components(spark.createDataFrame(chain + star, "a string, b string")).collect()}
    assert len(got) == 61 + 80
    assert {v for k, v in got.items() if k[0] == "c"} == {"c000"}
    assert {v for k, v in got.items() if k[0] == "s"} == {"s000"}


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(6)
    points = np.vstack([rng.normal(c, 0.2, (40, 2)) for c in (0.0, 3.0, 6.0)])
    rows = [(i, i // 40, [float(x) for x in p]) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "id int, cluster int, e array<double>").repartition(4)
    return points, df.withColumn("features", array_to_vector("e"))


def test_kmeans(blobs):
    points, df = blobs
    model = cluster.fit_kmeans(df.drop("cluster"), 3, restarts=4)
    got = {r.id: r.cluster for r in cluster.assign(model, df.drop("cluster")).collect()}
    assert [got[i] for i in range(120)] == [i // 40 for i in range(120)]
    assert np.allclose(model.centres, [points[40 * c : 40 * c + 40].mean(0) for c in range(3)])
    assert model.cost == pytest.approx(sum(((points[40 * c : 40 * c + 40] - model.centres[c]) ** 2).sum() for c in range(3)))
    assert len(model.costs) == 4 and model.cost == min(model.costs)
    assert cluster.fit_kmeans(df.limit(0), 3).centres == []


def test_restarts_equal_runs_of_their_own(blobs):
    """Each restart alone, by plain Lloyd steps from the same starting centres."""
    points, df = blobs
    model = cluster.fit_kmeans(df.drop("cluster"), 4, restarts=3, seed=5)
    first = df.select("e", F.xxhash64("e", F.lit(5)).alias("h")).orderBy("h", "e").collect()
    start = np.array([r.e for r in first])
    for i, cost in enumerate(model.costs):
        centres = cluster.spread_out(start, 4, np.random.default_rng(5 + i))
        for _ in range(100):
            best = ((points[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
            centres = np.array([points[best == c].mean(0) if (best == c).any() else centres[c] for c in range(4)])
        assert cost == pytest.approx(((points - centres[best]) ** 2).sum())


def plain_ward(points, k):
    """Smallest member of every point's cluster, and the merge costs, by trying all pairs at every step."""
    groups = {i: [i] for i in range(len(points))}
    costs = []
    while len(groups) > 1:
        if len(groups) == k:
            labels = {i: g for g, members in groups.items() for i in members}

        def cost(a, b):
            x, y = points[groups[a]], points[groups[b]]
            return len(x) * len(y) / (len(x) + len(y)) * ((x.mean(0) - y.mean(0)) ** 2).sum()

        best, a, b = min((cost(a, b), a, b) for a in groups for b in groups if a < b)
        costs.append(best)
        groups[a] += groups.pop(b)
    return [labels[i] for i in range(len(points))], costs


def chained(points, limit, few, spark, k=4):
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "id int, e array<double>").withColumn("features", array_to_vector("e"))
    found = ward.ward(df, "id", k, limit=limit, few=few)
    labels = {r.id: r.cluster for r in found.labels.collect()}
    first = {}
    for i in range(len(points)):
        first.setdefault(labels[i], i)
    assert list(first) == list(range(len(first)))  # numbered by smallest key
    return [first[labels[i]] for i in range(len(points))], sorted(r.cost for r in found.merges.collect())


@pytest.mark.parametrize("limit, few", [(1000, 1000), (5, 1000), (8, 8)])
def test_ward_is_exact_however_it_is_run(spark, limit, few):
    rng = np.random.default_rng(limit + few)
    points = np.concatenate([rng.normal(size=(8, 3)), rng.exponential(size=(6, 3)) * [5.0, 1.0, 0.1], np.ones((3, 3))])
    labels, costs = plain_ward(points, 4)
    got, merged = chained(points, limit, few, spark)
    assert got == labels
    assert np.allclose(merged, sorted(costs)[2:])  # equal points are one from the start


def test_ward_leaves_no_tables_with_the_driver(spark, monkeypatch):
    plans, cut = [], ward.cut_lineage

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    rows = [(f"p{i:02d}", 1.0, float(i * i % 17), float(i)) for i in range(40)]
    state = ward.Merger(cut(spark.createDataFrame(rows, "id string, w double, f0 double, f1 double")), 2)
    monkeypatch.setattr(ward, "cut_lineage", seen)
    edges = ward.cut_lineage(state.pairs(20.0))
    state.round(edges, 20.0)
    assert state.nodes.count() < 40
    assert len(plans) == 4 and not [p for p in plans if "Broadcast" in p]


@pytest.mark.parametrize("weighted", [False, True])
def test_a_region_merges_what_nothing_can_forestall(weighted):
    rng = np.random.default_rng(4)
    points = rng.normal(size=(200, 3)) * [1.0, 0.2, 3.0]
    weights = rng.integers(1, 50, 200).astype(float) if weighted else np.ones(200)
    costs = np.array(sorted(c for *_, c in ward.chain_merges(points, weights)))
    all_ = ward.merge_region(points.copy(), weights.copy(), np.ones(200, dtype=bool), np.inf, 1)
    assert np.allclose([c for *_, c in all_], costs)
    assert ward.merge_region(points.copy(), weights.copy(), np.ones(200, dtype=bool), np.inf, 20) == all_[:180]
    own = points[:, 2] < 0
    some = ward.merge_region(points.copy(), weights.copy(), own, np.inf, 1)
    assert own.sum() / 3 < len(some) < own.sum()
    assert own[[i for a, b, _ in some for i in (a, b)]].all()
    assert max(np.abs(costs - c).min() for *_, c in some) < 1e-9


def test_merges_of_regions_hold_what_hierarchical_checks_asks_for():
    points = np.random.default_rng(6).normal(size=(300, 3))
    x, w, alive, merges = points.copy(), np.ones(300), np.ones(300, dtype=bool), []
    for own in (points[:, 0] < 0, points[:, 0] >= 0):  # each sees the other as it was at first
        at, weights = points.copy(), np.ones(300)
        found = ward.merge_region(at, weights, own, np.inf, 1)
        x[own], w[own] = at[own], weights[own]
        alive[[b for _, b, _ in found]] = False
        merges += found
    left = np.flatnonzero(alive)
    assert len(left) < 150
    merges += [(left[a], left[b], c) for a, b, c in ward.merge_region(x[left], w[left], np.ones(len(left), dtype=bool), np.inf, 1)]
    last = {}
    for a, b, cost in merges:
        assert cost >= max(last.get(a, 0.0), last.get(b, 0.0)) - 1e-9
        last[a] = cost
    assert len(merges) == 299 and sum(c for *_, c in merges) == pytest.approx(((points - points.mean(0)) ** 2).sum())


@pytest.mark.parametrize("region, k", [(40, 4)])
def test_ward_of_many_regions(spark, monkeypatch, region, k):
    rng = np.random.default_rng(region)
    points = np.concatenate([rng.normal(size=(30, 3)), rng.exponential(size=(30, 3)) * [5.0, 1.0, 0.1], np.ones((2, 3))])
    labels, costs = plain_ward(points, k)
    seen, merge_regions = [], ward.Merger.merge_regions
    monkeypatch.setattr(ward.Merger, "merge_regions", lambda self, *a: seen.append(a[0]) or merge_regions(self, *a))
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "id int, e array<double>").withColumn("features", array_to_vector("e"))
    found = ward.ward(df, "id", k, limit=8, few=1000, region=region)
    of = {r.id: r.cluster for r in found.labels.collect()}
    first = {}
    for i in range(len(points)):
        first.setdefault(of[i], i)
    assert [first[of[i]] for i in range(len(points))] == labels
    assert np.allclose(sorted(r.cost for r in found.merges.collect()), sorted(costs)[1:])
    assert len(seen) > 1 and seen[0] == 61


def test_ward_needs_few_tables_for_many_merges(spark, monkeypatch):
    cuts, cut = [], ward.cut_lineage
    monkeypatch.setattr(ward, "cut_lineage", lambda df: cuts.append(df) or cut(df))
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(rng.normal(size=(120, 2)))]
    df = spark.createDataFrame(rows, "id int, e array<double>").withColumn("features", array_to_vector("e"))
    assert ward.ward(df, "id", 3, limit=4, few=8).merges.count() == 119
    assert len(cuts) <= 8  # not some for every round


def test_ward_of_equal_gaps(spark):
    line = np.arange(16.0)[:, None]
    for limit, few in ((100, 100), (5, 1000)):
        _, merged = chained(line, limit, few, spark)
        assert sum(merged) == pytest.approx(((line - line.mean()) ** 2).sum())
        assert merged[:6] == pytest.approx([0.5] * 6)


def test_ward_of_few_rows(spark, blobs):
    _, df = blobs
    assert ward.ward(df.limit(0), "id").labels.count() == 0
    got = ward.ward(df.where("id in (3, 50)"), "id", 5)
    assert sorted(map(tuple, got.labels.collect())) == [(3, 0), (50, 1)] and got.merges.count() == 1
    rows = cluster.hierarchical(df.drop("cluster"), 3, "id").collect()
    assert {(r.id // 40, r.cluster) for r in rows} == {(0, 0), (1, 1), (2, 2)}


def test_quality(blobs):
    points, df = blobs
    labels = np.arange(120) // 40
    q = cluster.cluster_quality(df).first()
    centres = np.array([points[labels == c].mean(0) for c in range(3)])
    within = sum(((points[labels == c] - centres[c]) ** 2).sum() for c in range(3))
    between = sum(40 * ((centres[c] - points.mean(0)) ** 2).sum() for c in range(3))
    spread = [np.sqrt(((points[labels == c] - centres[c]) ** 2).sum(-1)).mean() for c in range(3)]
    db = np.mean([max((spread[i] + spread[j]) / np.linalg.norm(centres[i] - centres[j]) for j in range(3) if j != i) for i in range(3)])
    assert (q.n_clusters, q.n_noise) == (3, 0)
    assert q.calinski_harabasz == pytest.approx((between / 2) / (within / 117))
    assert q.davies_bouldin == pytest.approx(db)


def test_quality_of_one_cluster(blobs):
    _, df = blobs
    one = cluster.cluster_quality(df.withColumn("cluster", F.lit(0))).first()
    assert (one.n_clusters, one.calinski_harabasz, one.davies_bouldin) == (1, None, None)
    assert cluster.silhouette(df.withColumn("cluster", F.lit(0))) is None


def test_silhouette(blobs):
    points, df = blobs
    labels = np.arange(120) // 40
    far = ((points[:, None] - points[None]) ** 2).sum(-1)
    scores = []
    for i in range(120):
        a = far[i][labels == labels[i]].sum() / 39
        b = min(far[i][labels == c].mean() for c in range(3) if c != labels[i])
        scores.append((b - a) / max(a, b))
    assert cluster.silhouette(df) == pytest.approx(np.mean(scores))


def test_pca(blobs):
    points, df = blobs
    centred = points - points.mean(0)
    df = df.select("id", array_to_vector(F.array(*[F.col("e")[i] - float(points.mean(0)[i]) for i in range(2)])).alias("features"))
    got, shares = cluster.pca(df, 2, "id")
    values, vectors = np.linalg.eigh(np.cov(centred.T))
    first = vectors[:, -1] * np.sign(vectors[np.abs(vectors[:, -1]).argmax(), -1])
    xs = {r.id: r.x for r in got.collect()}
    assert [xs[i] for i in range(120)] == pytest.approx((centred @ first).tolist())
    assert shares[0] == pytest.approx(values[-1] / values.sum())


def test_a_scan_of_centres_needs_no_shuffle(spark, blobs):
    _, df = blobs
    rows = df.drop("cluster").repartition(3).checkpoint()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("centres", "")
    cluster.fit_kmeans(rows, 3, restarts=4)
    spark.sparkContext.setJobGroup("rest", "")
    jobs = [tracker.getJobInfo(i) for i in tracker.getJobIdsForGroup("centres")]
    assert len(jobs) > 4 and sum(len(j.stageIds) > 1 for j in jobs) <= 2  # the start and the count of rows


@pytest.mark.parametrize("block", [1024, 16])
def test_many_features_by_blocks(spark, monkeypatch, block):
    """Points of uncrowded boxes are compared by blocks, crowded boxes are opened; both give what the definition says."""
    monkeypatch.setattr(neighbors, "BLOCK", block)
    rng = np.random.default_rng(9)
    crowd, loose = rng.normal(0, 0.02, (90, 6)), rng.normal(0, 0.4, (120, 6))
    points = np.vstack([crowd, loose, loose[:20], rng.normal(3, 0.3, (40, 6))])
    df, names = frame(spark, points.tolist())
    grid = neighbors.EpsGrid(df, "id", names, 0.7)
    direct = grid.weights_direct(grid.points, grid.points).collect()
    _, counts = brute_dbscan(points, 0.7, 5)
    assert [next(r.hits for r in direct if r.pt == f"p{i:05d}") for i in range(len(crowd) + len(loose))] == counts[:210]
    check(spark, points.tolist(), 0.7, 5)


@pytest.mark.parametrize("d", [2, 3, 4])
def test_few_features_by_regions(spark, monkeypatch, d):
    """Small regions, tiles and deals, weighted points, distances of exactly eps far from the origin."""
    for name, value in (("FEWEST", 20), ("MOST", 20), ("AT_ONCE", 2), ("TILE", 4), ("ROW", 8)):
        monkeypatch.setattr(neighbors, name, value)
    rng = np.random.default_rng(20 + d)
    lattice = 1e6 + rng.integers(0, 9, (120, d)) / 4  # many copies where there are few places
    cloud = 1e6 + rng.normal(4, 0.3, (80, d))
    lone = 1e6 + rng.uniform(-30, 30, (30, d))
    check(spark, np.vstack([lattice, cloud, lone]).tolist(), 0.5, 5)


def test_cells_that_touch_only_inside(spark):
    """Cells whose outermost points are too far apart are linked by points between, and clusters of such cells apart stay apart."""
    line = [(0.15, 0.02 * i) for i in range(8)] + [(0.0, 0.0), (0.0, 0.3), (0.3, 0.0), (0.3, 0.3)]
    beside = [(0.65 + 0.001 * i, 0.16) for i in range(6)] + [(0.9, 0.0), (0.95, 0.3), (0.8, 0.34)]
    apart = [(1.5 + 0.01 * i, 0.1 * (i % 4)) for i in range(9)]
    for eps in (0.36, 0.53):
        check(spark, line + beside + apart, eps, 4)


def test_rows_without_a_finite_place_have_no_neighbours(spark):
    rows = [("a", 0.0), ("b", 0.1), ("c", float("nan")), ("d", float("inf")), ("e", None), ("f", 0.2)]
    df = spark.createDataFrame(rows, "id string, x0 double")
    got = {r.id: r.n_neighbors for r in neighbors.eps_neighbors(df, "id", ["x0"], 0.5, 3).collect()}
    assert got == {"a": 3, "b": 3, "f": 3}


@pytest.mark.parametrize("operator", ["eps_neighbors", "dbscan"])
def test_no_step_writes_more_rows_than_points(spark, monkeypatch, operator):
    """Crowded boxes side by side, none of them dense: what a point and the boxes around it tell each other is no row."""
    written, plain = [], neighbors.cut_lineage

    def counted(df):
        df = plain(df)
        written.append(df.count())
        return df

    monkeypatch.setattr(neighbors, "cut_lineage", counted)
    points = np.random.default_rng(31).uniform(0, 1, (3000, 3))
    df, names = frame(spark, points.tolist())
    assert getattr(neighbors, operator)(df, "id", names, 0.5, 300).count() == 3000
    assert max(written) <= 2 * 3000, written
