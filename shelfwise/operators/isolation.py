"""Isolation forest: rows that few random cuts set apart.

Every tree is grown on a sample of its own, drawn by hash and of documented size; all trees together are a bounded set
of arrays, whatever the table's size.  All rows are then scored in one pass over the trees, many rows at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TREES, SAMPLE = 100, 256
EULER = 0.5772156649015329


class Tree(NamedTuple):
    """Nodes in arrays: the feature to cut (-1 in a leaf), the cut, the children, and a leaf's depth with its rest."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray


def expected_depth(n: int) -> float:
    """Mean depth of a failed search in a random binary tree of ``n`` rows: what a leaf of ``n`` rows still adds."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2.0 * (np.log(n - 1) + EULER) - 2.0 * (n - 1) / n


def grow(points: np.ndarray, rng: np.random.Generator) -> Tree:
    """Cut at random places along random features that still vary, down to the mean depth of the sample's size."""
    limit = int(np.ceil(np.log2(max(len(points), 2))))
    nodes: list[list[float]] = []

    def node(rows: np.ndarray, depth: int) -> int:
        place = len(nodes)
        nodes.append([-1, 0.0, -1, -1, depth + expected_depth(len(rows))])
        own = points[rows]
        low, high = (own.min(0), own.max(0)) if len(rows) else (np.zeros(0), np.zeros(0))
        vary = np.flatnonzero(high > low)
        if depth < limit and len(vary):
            f = int(rng.choice(vary))
            cut = float(rng.uniform(low[f], high[f]))
            cut = cut if cut < high[f] else float(low[f])  # both sides get rows
            below = own[:, f] <= cut
            nodes[place][:4] = [f, cut, node(rows[below], depth + 1), node(rows[~below], depth + 1)]
        return place

    node(np.arange(len(points)), 0)
    feature, cut, left, right, depth = (np.array(c) for c in zip(*nodes))
    return Tree(feature.astype(int), cut.astype(float), left.astype(int), right.astype(int), depth.astype(float))


def depths(tree: Tree, points: np.ndarray) -> np.ndarray:
    """Depth at which every point ends; all points go down a level at a time."""
    at = np.zeros(len(points), dtype=int)
    rows = np.arange(len(points))
    while True:
        inner = rows[tree.feature[at] >= 0]
        if not len(inner):
            return tree.depth[at]
        here = at[inner]
        below = points[inner, tree.feature[here]] <= tree.cut[here]
        at[inner] = np.where(below, tree.left[here], tree.right[here])


def fit_isolation(
    df: DataFrame, key: str, features: Sequence[str], trees: int = TREES, sample: int = SAMPLE, seed: int = 42
) -> tuple[list[Tree], int]:
    """Trees and the size of their samples; a null feature counts as 0.

    The driver holds ``trees * sample`` rows: those with the smallest hashes of key and seed, dealt to the trees in
    that order, so no two trees share a row while there are enough.  A smaller table is dealt anew for every tree.
    """
    columns = [F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features]
    drawn = df.select(F.xxhash64(F.col(key).cast("string"), F.lit(seed)).alias("_h"), *columns)
    rows = drawn.orderBy("_h", *features).limit(trees * sample).select(*features).collect()
    points = np.array([list(r) for r in rows], dtype=float).reshape(-1, len(features))
    rng = np.random.default_rng(seed)
    size = min(sample, len(points))
    if len(points) >= trees * size:
        parts = [points[i * size : (i + 1) * size] for i in range(trees)]
    else:
        parts = [points[rng.permutation(len(points))[:size]] for _ in range(trees)]
    return [grow(p, rng) for p in parts], size


def isolation_scores(df: DataFrame, key: str, features: Sequence[str], forest: list[Tree], size: int) -> DataFrame:
    """(key, score): 2 to the minus mean depth over the mean depth of the sample size; near 1 for lonely rows."""
    rows = df.select(key, *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f"_f{i}") for i, f in enumerate(features)])
    shared = df.sparkSession.sparkContext.broadcast([tuple(t) for t in forest])
    usual, width = expected_depth(size) or 1.0, len(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Tree(*t) for t in shared.value]
        for part in batches:
            points = np.column_stack([part.column(1 + i).to_numpy() for i in range(width)])
            mean = sum(depths(t, points) for t in own) / len(own)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(2.0 ** (-mean / usual))], names=[key, "score"])

    return rows.mapInArrow(run, f"`{key}` {rows.schema[0].dataType.simpleString()}, score double")


def isolation_outliers(
    df: DataFrame, key: str, features: Sequence[str], contamination_score: float = 0.6, trees: int = TREES, sample: int = SAMPLE, seed: int = 42
) -> DataFrame:
    """Every row's score and whether it reaches ``contamination_score``; an empty table gives an empty result."""
    forest, size = fit_isolation(df, key, features, trees, sample, seed)
    if not size:
        return df.select(key, F.lit(0.0).alias("score"), F.lit(False).alias("is_outlier"))
    scored = isolation_scores(df, key, features, forest, size)
    return scored.withColumn("is_outlier", F.col("score") >= contamination_score)
