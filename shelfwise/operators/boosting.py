"""Gradient boosting with second-order gain on binned features.

Features are cut into at most ``BINS`` bins, and equal binned rows of one label are one weighted row.  A tree is grown a
level at a time from sums of gradients and hessians per node, feature and bin; the gain is regularised.  While the
distinct weighted rows are at most ``few``, the driver sums them itself; beyond that every level of a round is one Spark
job for the trees of all outputs, which sums inside the tasks.  Both grow the same trees.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.session import cut_lineage

BINS, FEW = 64, 100_000
WRITTEN, TASK_ROWS = 10, 4_000_000  # rounds between written margins; rows that a task is to hold at most
ROUNDS, DEPTH, RATE = 100, 6, 0.1
RIDGE, LEAST_HESSIAN, LEAST_GAIN = 1.0, 1.0, 1e-6


class Tree(NamedTuple):
    """Nodes in lists: the feature to cut (-1 in a leaf), the last bin that goes left, the children, the leaf's value."""

    feature: list[int]
    bin: list[int]
    left: list[int]
    right: list[int]
    value: list[float]


def ends(tree: Tree, bins: np.ndarray) -> np.ndarray:
    """The node at which every binned row ends."""
    feature, cut, left, right = (np.array(c) for c in tree[:4])
    at, rows = np.zeros(len(bins), dtype=int), np.arange(len(bins))
    while len(inner := rows[feature[at] >= 0]):
        here = at[inner]
        at[inner] = np.where(bins[inner, feature[here]] <= cut[here], left[here], right[here])
    return at


def gradients(task: str, y: np.ndarray, margin: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the loss by the ``k``-th margin."""
    if task == "squared":
        return margin[:, 0] - y, np.ones(len(y))
    if task == "binary":
        p = 1.0 / (1.0 + np.exp(-margin[:, 0]))
        return p - y, np.maximum(p * (1 - p), 1e-16)
    e = np.exp(margin - margin.max(axis=1, keepdims=True))
    p = e[:, k] / e.sum(axis=1)
    return p - (y == k), np.maximum(2 * p * (1 - p), 1e-16)


def sums(bins: np.ndarray, g: np.ndarray, h: np.ndarray, node: np.ndarray, nodes: int, width: int) -> np.ndarray:
    """(nodes, features, bins, 2): gradients and hessians; rows whose ``node`` is negative are left out."""
    own = node >= 0
    bins, g, h, node = bins[own], g[own], h[own], node[own]
    out = np.empty((nodes, bins.shape[1], width, 2))
    for f in range(bins.shape[1]):
        place = node * width + bins[:, f]
        for j, v in enumerate((g, h)):
            out[:, f, :, j] = np.bincount(place, v, minlength=nodes * width).reshape(nodes, width)
    return out


def places(tree: Tree, bins: np.ndarray, front: list[int]) -> np.ndarray:
    """Position in ``front`` of the node every row ends at, -1 elsewhere."""
    lookup = np.full(len(tree.feature), -1)
    lookup[front] = np.arange(len(front))
    return lookup[ends(tree, bins)]


class Held:
    """The weighted rows in the driver."""

    def __init__(self, bins: np.ndarray, y: np.ndarray, w: np.ndarray, task: str, base: np.ndarray):
        self.bins, self.y, self.w, self.task = bins, y, w, task
        self.margin = np.tile(base, (len(y), 1))

    def histograms(self, trees: list[Tree], fronts: list[list[int]], width: int) -> list[np.ndarray]:
        return block_sums(self.task, self.bins, self.y, self.w, self.margin, trees, fronts, width)

    def add(self, trees: list[Tree]) -> None:
        for k, t in enumerate(trees):
            self.margin[:, k] += np.array(t.value)[ends(t, self.bins)]


def block_sums(
    task: str, bins: np.ndarray, y: np.ndarray, w: np.ndarray, margin: np.ndarray,
    trees: list[Tree], fronts: list[list[int]], width: int,
) -> list[np.ndarray]:
    """The sums of the front nodes of every output's tree."""
    out = []
    for k, (tree, front) in enumerate(zip(trees, fronts)):
        if not front:
            out.append(np.zeros((0, bins.shape[1], width, 2)))
            continue
        g, h = gradients(task, y, margin, k)
        out.append(sums(bins, g * w, h * w, places(tree, bins, front), len(front), width))
    return out


BLOCK = "n int, bins binary, y binary, w binary, margin binary"


def to_block(bins: np.ndarray, y: np.ndarray, w: np.ndarray, margin: np.ndarray) -> pa.RecordBatch:
    cells = [bins.astype(np.int32), y.astype(float), w.astype(float), margin.astype(float)]
    columns = [pa.array([len(y)], pa.int32()), *[pa.array([c.tobytes()], pa.binary()) for c in cells]]
    return pa.RecordBatch.from_arrays(columns, names=["n", "bins", "y", "w", "margin"])


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    for part in batches:
        for i in range(part.num_rows):
            n, *cells = (c[i] for c in part.columns)
            bins, y, w, margin = (np.frombuffer(c.as_buffer(), t) for c, t in zip(cells, (np.int32, float, float, float)))
            yield bins.reshape(n.as_py(), -1), y, w, margin.reshape(n.as_py(), -1)


class Spread:
    """The weighted rows as a table of blocks: some thousand rows each, packed as plain arrays.

    A level of all trees of a round is one job.  A task hands back the sums over its rows, whose size does not depend on
    them.  Margins stay with their rows: the table of the next round is made from the last one's and kept by the
    executors; every few rounds it is written to the checkpoint folder, from where a lost part is made again.
    """

    def __init__(self, rows: DataFrame, task: str, base: np.ndarray):
        self.task, self.round, self.kept = task, 0, []
        start = [float(b) for b in base]

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in batches:
                if part.num_rows:
                    bins = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                    y, w = (part.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
                    yield to_block(bins, y, w, np.tile(start, (part.num_rows, 1)))

        self.d = rows.select(F.size("bins")).first()[0]
        width = max(rows.sparkSession.sparkContext.defaultParallelism, rows.count() // TASK_ROWS + 1)
        self.rows = cut_lineage(rows.select("bins", "y", "w").coalesce(width).mapInArrow(pack, BLOCK))

    def histograms(self, trees: list[Tree], fronts: list[list[int]], width: int) -> list[np.ndarray]:
        task, shapes = self.task, [(len(f), self.d, width, 2) for f in fronts]
        plain = [tuple(t) for t in trees]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, total = [Tree(*t) for t in plain], [np.zeros(s) for s in shapes]
            for bins, y, w, margin in blocks_of(batches):
                for all_, some in zip(total, block_sums(task, bins, y, w, margin, own, fronts, width)):
                    all_ += some
            yield pa.RecordBatch.from_arrays([pa.array([t.tobytes() for t in total], pa.binary()), pa.array(range(len(total)), pa.int32())], names=["sums", "k"])

        out = [np.zeros(s) for s in shapes]
        for r in self.rows.mapInArrow(run, "sums binary, k int").collect():
            out[r["k"]] += np.frombuffer(r["sums"]).reshape(shapes[r["k"]])
        return out

    def add(self, trees: list[Tree]) -> None:
        plain = [tuple(t) for t in trees]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for bins, y, w, margin in blocks_of(batches):
                margin = margin.copy()
                for k, t in enumerate(plain):
                    margin[:, k] += np.array(t[4])[ends(Tree(*t), bins)]
                yield to_block(bins, y, w, margin)

        self.round += 1
        after = self.rows.mapInArrow(run, BLOCK)
        if self.round % WRITTEN:
            self.rows = after.persist()
            self.kept.append(self.rows)
            for old in self.kept[:-2]:  # the last one is still needed to make this one
                old.unpersist()
            self.kept = self.kept[-2:]
        else:
            self.rows = cut_lineage(after)
            self.release()

    def release(self) -> None:
        for old in self.kept:
            old.unpersist()
        self.kept = []


def best_cut(hist: np.ndarray) -> tuple[float, int, int]:
    """(gain, feature, bin) of the best cut of one node's (features, bins, 2) sums; the first of equal ones."""
    left = hist.cumsum(axis=1)[:, :-1]
    total = hist[0].sum(axis=0)
    right = total - left
    score = lambda s: s[..., 0] ** 2 / (s[..., 1] + RIDGE)
    gain = 0.5 * (score(left) + score(right) - score(total))
    gain = np.where((left[..., 1] >= LEAST_HESSIAN) & (right[..., 1] >= LEAST_HESSIAN), gain, -np.inf)
    if not gain.size:
        return -np.inf, 0, 0
    at = int(gain.argmax())
    return float(gain.flat[at]), *divmod(at, gain.shape[1])


def grow(rows: Held | Spread, outputs: int, width: int, depth: int = DEPTH, rate: float = RATE) -> list[Tree]:
    """The trees of one round, one per output, grown side by side."""
    trees = [Tree([-1], [0], [-1], [-1], [0.0]) for _ in range(outputs)]
    fronts = [[0] for _ in trees]
    for _ in range(depth):
        found = rows.histograms(trees, fronts, width)
        fronts = [_grown(tree, front, hist, rate) for tree, front, hist in zip(trees, fronts, found)]
        if not any(fronts):
            break
    return trees


def _grown(tree: Tree, front: list[int], hist: np.ndarray, rate: float) -> list[int]:
    """Cuts the front nodes by their sums; the new nodes are the next front."""
    following = []
    for n, node in enumerate(front):
        if node == 0:
            total = hist[n, 0].sum(axis=0)
            tree.value[0] = float(-rate * total[0] / (total[1] + RIDGE))
        gain, f, b = best_cut(hist[n])
        if gain <= LEAST_GAIN:
            continue
        left = hist[n, f, : b + 1].sum(axis=0)
        tree.feature[node], tree.bin[node] = f, b
        tree.left[node], tree.right[node] = len(tree.feature), len(tree.feature) + 1
        for s in (left, hist[n, f].sum(axis=0) - left):
            following.append(len(tree.feature))
            for column, v in zip(tree, (-1, 0, -1, -1, float(-rate * s[0] / (s[1] + RIDGE)))):
                column.append(v)
    return following


class Boosted(NamedTuple):
    """A fitted model: feature names, bin edges, base margins, trees per round and output, and the task."""

    features: list[str]
    edges: list[list[float]]
    base: list[float]
    rounds: list[list[Tree]]
    task: str

    def margins(self, values: np.ndarray) -> np.ndarray:
        bins = np.stack([np.searchsorted(e, values[:, i], side="left") for i, e in enumerate(self.edges)], axis=1)
        out = np.tile(np.array(self.base), (len(values), 1))
        for trees in self.rounds:
            for k, t in enumerate(trees):
                out[:, k] += np.array(t.value)[ends(t, bins)]
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """``prediction``, and for classes ``probability``; a null feature counts as 0."""
        plain = tuple(self)

        @F.pandas_udf("array<double>")
        def found(*columns: pd.Series) -> pd.Series:
            model = Boosted(*plain)
            margin = model.margins(np.column_stack([c.to_numpy(dtype=float) for c in columns]))
            if model.task == "binary":
                p = 1.0 / (1.0 + np.exp(-margin[:, 0]))
                margin = np.column_stack([1 - p, p])
            elif model.task == "softmax":
                e = np.exp(margin - margin.max(axis=1, keepdims=True))
                margin = e / e.sum(axis=1, keepdims=True)
            return pd.Series(list(margin))

        out = df.withColumn("_found", found(*[_number(f) for f in self.features]))
        if self.task == "squared":
            return out.withColumn("prediction", F.col("_found")[0]).drop("_found")
        top = (F.array_position("_found", F.array_max("_found")) - 1).cast("double")
        return out.withColumns({"probability": array_to_vector("_found"), "prediction": top}).drop("_found")


def _number(name: str) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def bin_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Upper edges of all bins but the last, at approximate quantiles of the feature."""
    shares = [i / bins for i in range(1, bins)]
    row = df.agg(*[F.percentile_approx(_number(f), shares, 100_000).alias(f"e{i}") for i, f in enumerate(features)]).first()
    tops = df.agg(*[F.max(_number(f)).alias(f"m{i}") for i, f in enumerate(features)]).first()
    return [sorted({float(e) for e in row[i] or [] if e < tops[i]}) for i in range(len(features))]


def fit_boosted(
    train: DataFrame, features: Sequence[str], task: str, classes: int = 2, label: str = "label",
    rounds: int = ROUNDS, depth: int = DEPTH, rate: float = RATE, few: int = FEW,
) -> Boosted:
    """Fit ``binary`` (labels 0 and 1), ``softmax`` (labels 0 to ``classes`` - 1) or ``squared`` (regression)."""
    edges = bin_edges(train, features)
    place = lambda f, e: F.size(F.filter(F.lit(e), lambda v: v < _number(f))) if e else F.lit(0)
    binned = train.select(F.array(*[place(f, e) for f, e in zip(features, edges)]).alias("bins"), F.col(label).cast("double").alias("y"))
    rows = cut_lineage(binned.groupBy("bins", "y").agg(F.count(F.lit(1)).cast("double").alias("w")))
    outputs = classes if task == "softmax" else 1
    base = np.zeros(outputs)
    if task == "squared":
        base[:] = rows.agg(F.sum(F.col("y") * F.col("w")) / F.sum("w")).first()[0] or 0.0
    width = max((len(e) for e in edges), default=0) + 1
    if rows.count() <= few:
        kept = rows.orderBy("bins", "y").collect()
        bins = np.array([r["bins"] for r in kept], dtype=int).reshape(-1, len(features))
        state = Held(bins, np.array([r["y"] for r in kept]), np.array([r["w"] for r in kept]), task, base)
    else:
        state = Spread(rows, task, base)
    out = []
    for _ in range(rounds):
        trees = grow(state, outputs, width, depth, rate)
        state.add(trees)
        out.append(trees)
    if isinstance(state, Spread):
        state.release()
    return Boosted(list(features), edges, [float(b) for b in base], out, task)
