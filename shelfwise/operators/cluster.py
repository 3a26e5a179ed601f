"""K-means, projection and cluster quality; Ward clusters come from ``ward``."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.model import scaled_pipeline
from shelfwise.operators.prep import scalars, zscore
from shelfwise.operators.ward import ward
from shelfwise.session import cut_lineage

CLUSTER_FEATURES = ("price", "rating", "reviews_count")
CENTRE_BLOCK, CENTRE_ROWS = 4096, 32  # centres compared at a time, from the driver's and from the task's side
INITIAL = 2000  # rows that starting centres are chosen from
TASK_ROWS = 4_000_000  # rows that a task is to hold at most


def scaled_vectors(df: DataFrame, key: str, features: Sequence[str] = CLUSTER_FEATURES) -> DataFrame:
    """(key, raw features, standardised vector), missing values as 0 before scaling."""
    filled = df.select(key, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])
    scaled = zscore(filled, features, "_z")
    assembler = VectorAssembler(inputCols=[f"{c}_z" for c in features], outputCol="features")
    return assembler.transform(scaled).drop(*[f"{c}_z" for c in features])


class Centres(NamedTuple):
    """Centres in ascending order, their cost (sum of squared distances), and the cost of every restart."""

    centres: list[tuple[float, ...]]
    cost: float
    costs: list[float]


def spread_out(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Starting centres: each next one drawn by its squared distance from those before."""
    centres = [points[rng.integers(len(points))]]
    gap = np.full(len(points), np.inf)
    while len(centres) < k:
        gap = np.minimum(gap, ((points - centres[-1]) ** 2).sum(1))
        total = gap.sum()
        centres.append(points[rng.choice(len(points), p=gap / total) if total else rng.integers(len(points))])
    return np.array(centres)


def _nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centre, the first of several, and its squared distance; ``points`` by feature."""
    best, least = np.zeros(points.shape[1], dtype=np.intp), np.full(points.shape[1], np.inf)
    for i, centre in enumerate(centres):
        gap = np.zeros(points.shape[1])
        for x, c in zip(points, centre):
            x = x - c
            x *= x
            gap += x
        nearer = gap < least
        best[nearer] = i
        np.minimum(least, gap, out=least)
    return best, least


def fit_kmeans(
    vectors: DataFrame, k: int = 5, restarts: int = 10, seed: int = 42, max_iter: int = 300, tol: float = 1e-10
) -> Centres:
    """The cheapest of several seeded runs, all of which move their centres in the same scan of the rows.

    Every run starts from its own spread-out choice among at most ``INITIAL`` rows, drawn by hash.  The rows are written
    once as blocks of plain arrays.  A scan sums the rows of the clusters of all runs that still move inside the tasks,
    each of which hands back one row.  An empty cluster keeps its centre.  A run ends when none of its centres moves by
    more than ``tol``, or after ``max_iter`` scans.
    """
    rows = cut_lineage(vectors.select(vector_to_array("features").alias("x")))
    first = rows.orderBy(F.xxhash64("x", F.lit(seed)), "x").limit(INITIAL).collect()
    if not first:
        return Centres([], 0.0, [0.0] * restarts)
    points = np.array([r["x"] for r in first], dtype=float)
    d = points.shape[1]
    centres = np.stack([spread_out(points, k, np.random.default_rng(seed + i)) for i in range(restarts)])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if part.num_rows:
                x = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(x.T, dtype=float).tobytes()], pa.binary())], names=["x"])

    width = max(rows.sparkSession.sparkContext.defaultParallelism, rows.count() // TASK_ROWS + 1)
    blocks = cut_lineage(rows.coalesce(width).mapInArrow(pack, "x binary"))

    def scan(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows and their sums per run and cluster, and the cost per run."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((*at.shape[:2], d + 2))
            for part in batches:
                for cell in part.column(0):
                    x = np.frombuffer(cell.as_buffer()).reshape(d, -1)
                    for own, centre in zip(total, at):
                        best, gap = _nearest(x, centre)
                        own[:, 0] += np.bincount(best, minlength=k)
                        own[:, 1] += np.bincount(best, gap, minlength=k)
                        for j in range(d):
                            own[:, 2 + j] += np.bincount(best, x[j], minlength=k)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

        total = np.zeros((*at.shape[:2], d + 2))
        for r in blocks.mapInArrow(run, "sums binary").collect():
            total += np.frombuffer(r["sums"]).reshape(total.shape)
        return total[:, :, 0], total[:, :, 1].sum(1), total[:, :, 2:]

    cost, moving = np.zeros(restarts), np.arange(restarts)
    for _ in range(max_iter):
        at = centres[moving]
        n, cost[moving], sums = scan(at)
        centres[moving] = np.where(n[:, :, None] > 0, sums / np.maximum(n, 1.0)[:, :, None], at)
        moving = moving[np.abs(centres[moving] - at).max(axis=(1, 2)) > tol]
        if not len(moving):
            break
    best = int(cost.argmin())
    return Centres(sorted(tuple(float(v) for v in c) for c in centres[best]), float(cost[best]), [float(c) for c in cost])


def fit_cluster_model(
    df: DataFrame, features: Sequence[str] = CLUSTER_FEATURES, k: int = 5, seed: int = 42
) -> PipelineModel:
    """Scaling and K-means as one model that can be stored and applied to new rows."""
    filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])
    estimator = KMeans(k=k, maxIter=300, seed=seed, featuresCol="features", predictionCol="cluster")
    return scaled_pipeline(cut_lineage(filled), features, estimator)


def assign(model: Centres, vectors: DataFrame) -> DataFrame:
    """Cluster per row: the number of the nearest centre, the first of several."""
    x = vector_to_array("features")
    gap = lambda c: F.aggregate(
        F.zip_with(x, F.lit(list(c)), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v
    )
    gaps = F.array(*[gap(c) for c in model.centres])
    return vectors.withColumn("_gaps", gaps).withColumn(
        "cluster", (F.array_position("_gaps", F.array_min("_gaps")) - 1).cast("int")
    ).drop("_gaps")


def hierarchical(vectors: DataFrame, k: int = 5, key: str = "product_id") -> DataFrame:
    """``vectors`` with the exact Ward cluster of every row; see ``operators.ward``."""
    vectors = cut_lineage(vectors)
    return vectors.join(ward(vectors, key, k).labels, key)


def pca(vectors: DataFrame, k: int = 2, key: str = "product_id") -> tuple[DataFrame, list[float]]:
    """Coordinates on the first ``k`` components and their explained variance shares.

    Input is centred already; the sign makes the largest loading of each component positive.
    """
    model = PCA(k=k, inputCol="features", outputCol="pc").fit(vectors)
    loadings = model.pc.toArray()
    signs = [1.0 if loadings[np.abs(loadings[:, j]).argmax(), j] >= 0 else -1.0 for j in range(k)]
    pc = vector_to_array("pc")
    names = ["x", "y"] if k == 2 else [f"pc{j + 1}" for j in range(k)]
    coordinates = [(pc[j] * F.lit(signs[j])).alias(n) for j, n in enumerate(names)]
    return model.transform(vectors).select(key, *coordinates), [float(v) for v in model.explainedVariance]


def covariance(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Population covariance of every column pair in one aggregate: (a, b, cov)."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    one = df.agg(*[F.covar_pop(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}") for a, b in pairs])
    cells = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}__{b}").alias("cov")) for a, b in pairs]
    return one.select(F.explode(F.array(*cells)).alias("c")).select("c.a", "c.b", "c.cov")


def as_vectors(df: DataFrame, array_column: str) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(array_column).cast("array<double>")))


def _worst_overlap(profile: DataFrame) -> DataFrame:
    """Largest (s_i + s_j) / d_ij over the other clusters, per cluster.

    Centres are compared block by block, so neither the driver nor a task holds
    more than one block of them besides its own batch.
    """
    profile = cut_lineage(profile.withColumn("_block", F.lit(0)))
    n = profile.count()
    blocks = max(1, -(-n // CENTRE_BLOCK))
    profile = profile.withColumn("_block", F.pmod(F.xxhash64("label"), F.lit(blocks)).cast("int"))
    parts = []
    for block in range(blocks):
        rows = profile.where(F.col("_block") == block).select("label", "centre", "spread").collect()
        names = np.array([r.label for r in rows])
        centres = np.array([r.centre for r in rows])
        spreads = np.array([r.spread for r in rows])

        def compare(batches: Iterator[pd.DataFrame], names=names, centres=centres, spreads=spreads):
            for pdf in batches:
                worst = np.zeros(len(pdf))
                own, wide, labels = np.stack(pdf.centre.to_numpy()), pdf.spread.to_numpy(), pdf.label.to_numpy()
                for at in range(0, len(pdf), CENTRE_ROWS):
                    some = slice(at, at + CENTRE_ROWS)
                    gap = np.sqrt(((own[some, None, :] - centres[None, :, :]) ** 2).sum(-1))
                    far = (gap > 0) & (labels[some, None] != names[None, :])
                    ratio = np.where(far, (spreads[None, :] + wide[some, None]) / np.where(far, gap, 1.0), 0.0)
                    worst[some] = ratio.max(axis=1)
                yield pd.DataFrame({"label": pdf.label, "worst": worst})

        if rows:
            parts.append(profile.select("label", "centre", "spread").mapInPandas(compare, "label bigint, worst double"))
    return reduce(DataFrame.unionByName, parts).groupBy("label").agg(F.max("worst").alias("worst"))


def cluster_quality(df: DataFrame, label: str = "cluster", features: str = "features") -> DataFrame:
    """Cluster and noise counts, Calinski-Harabasz and Davies-Bouldin scores, one row.

    Two passes over the rows: group moments, then the mean distance to the own
    centre.  Scores are NULL with fewer than two clusters.
    """
    rows = df.select(F.col(label).cast("bigint").alias("label"), F.col(features).alias("features"))
    moments = rows.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        Summarizer.mean(F.col("features")).alias("m"),
        Summarizer.variance(F.col("features")).alias("v"),
    )
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)
    centres = cut_lineage(
        moments.select(
            "label",
            "n",
            vector_to_array("m").alias("centre"),
            F.when(F.col("n") > 1, total(vector_to_array("v")) * (F.col("n") - 1)).otherwise(0.0).alias("within"),
        )
    )
    away = total(F.zip_with(vector_to_array("features"), F.col("centre"), lambda a, b: (a - b) * (a - b)))
    spread = (
        rows.join(centres.select("label", "centre"), "label")
        .groupBy("label")
        .agg(F.avg(F.sqrt(away)).alias("spread"))
    )
    davies = _worst_overlap(centres.join(spread, "label")).agg(F.avg("worst")).scalar()
    counts = scalars(
        centres,
        n=F.sum("n"),
        labels=F.count(F.lit(1)),
        noise=F.coalesce(F.sum(F.when(F.col("label") == -1, F.col("n"))), F.lit(0)),
        clusters=F.count_if(F.col("label") != -1),
        within=F.sum("within"),
    )
    # sum of n_c * (c - mean)^2: the summarizer divides it by W - W2/W for weights n_c
    scatter = total(vector_to_array(Summarizer.variance(array_to_vector(F.col("centre")), F.col("n").cast("double"))))
    weight = F.sum("n") - F.sum(F.col("n") * F.col("n")) / F.sum("n")
    overall = centres.agg((scatter * weight).alias("between"))
    between = F.col("between")
    k = counts["labels"]
    valid = (counts["clusters"] >= 2) & (counts["n"] > counts["clusters"])
    return overall.select(
        counts["clusters"].alias("n_clusters"),
        counts["noise"].alias("n_noise"),
        F.when(valid, (between / (k - 1)) / (counts["within"] / (counts["n"] - k))).alias("calinski_harabasz"),
        F.when(valid, davies).alias("davies_bouldin"),
    )


def silhouette(df: DataFrame, label: str = "cluster", features: str = "features") -> float | None:
    """Mean silhouette over squared Euclidean distances: one pass and the cluster moments."""
    rows = df.select(F.col(label).cast("int").alias("label"), F.col(features).alias("features"))
    if rows.select("label").distinct().count() < 2:
        return None
    relabelled = rows.withColumn("label", F.col("label").cast("double"))
    return ClusteringEvaluator(predictionCol="label", distanceMeasure="squaredEuclidean").evaluate(relabelled)


def name_segments(df: DataFrame, label: str = "cluster") -> DataFrame:
    """Profile and name of each cluster against the overall means.

    Dear and well rated is premium, cheap is discount, much reviewed is popular,
    anything else is standard.
    """
    overall = scalars(df, p=F.avg("price"), r=F.avg("rating"), v=F.avg("reviews_count"))
    profile = df.groupBy(label).agg(
        F.count(F.lit(1)).alias("size"),
        F.avg("price").alias("avg_price"),
        F.avg("rating").alias("avg_rating"),
        F.avg("reviews_count").alias("avg_reviews"),
    )
    name = (
        F.when(F.col("avg_reviews") > overall["v"] * 1.1, "popular")
        .when((F.col("avg_price") > overall["p"]) & (F.col("avg_rating") >= overall["r"]), "premium")
        .when(F.col("avg_price") < overall["p"], "discount")
        .otherwise("standard")
    )
    return profile.withColumn("segment", name)
