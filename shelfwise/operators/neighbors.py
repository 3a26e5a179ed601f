"""Exact density clustering on a grid that adapts to crowded cells.

Cells are narrow enough that any two points of one cell are neighbours, so a
cell with ``min_samples`` rows is dense without comparing anything inside it.
Equal points are one weighted point.  With up to four features points lie in
regions of equal size and are compared in small tiles inside tasks; with more,
by blocks.  Boxes with many distinct points are split in halves again and again
where a pair of boxes is undecided by its smallest and largest distance.  No
step lists the pairs of points, and every join key meets a bounded number of rows.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from shelfwise.functions.ordering import number_rows
from shelfwise.session import broadcast_if_small, cut_lineage, shuffled

LEAF = 32
GRID_DIMENSIONS = 4  # of more features the first four find the boxes to compare; boxes and distances take all
MAX_LEVELS = 48
BLOCK, SLICE, TOGETHER = 1024, 256, 8  # points of a block and rows compared at a time; blocks of a cell that share a task
BLOCK_DIMENSIONS = 3  # features whose grid says which blocks meet
REGIONS, FEWEST, MOST = 256, 1024, 1 << 16  # regions of a table, and bounds on the points of one
CUTS = 64  # slices that one feature may be cut into at a time
AT_ONCE = 16  # times ``MOST`` points that a task holds beside those of its region
TILE, ROW = 32, 1024  # points of a tile inside a region; points compared with a tile at a time


def _sum(parts) -> Column:
    return reduce(lambda a, b: a + b, parts)


def _cols(prefix: str, d: int, suffix: str = "") -> list[Column]:
    return [F.col(f"{prefix}{i}{suffix}") for i in range(d)]


def _squared(a: Sequence[Column], b: Sequence[Column]) -> Column:
    return _sum((x - y) * (x - y) for x, y in zip(a, b))


def _gap(alo, ahi, blo, bhi) -> Column:
    """Smallest squared distance between two boxes."""
    gaps = [F.greatest(bl - ah, al - bh, F.lit(0.0)) for al, ah, bl, bh in zip(alo, ahi, blo, bhi)]
    return _sum(g * g for g in gaps)


def _reach(alo, ahi, blo, bhi) -> Column:
    """Largest squared distance between two boxes."""
    spans = [F.greatest(bh - al, ah - bl) for al, ah, bl, bh in zip(alo, ahi, blo, bhi)]
    return _sum(s * s for s in spans)


def spread(df: DataFrame) -> DataFrame:
    """Even partitions in the session's shuffle width: what follows multiplies the rows.

    A fixed number keeps the adaptive planner from merging small-looking partitions.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


class EpsGrid:
    """Weighted distinct points of a table and the search for neighbours within ``eps``.

    Coordinates stay in plain columns (``f0``, ``f1``, ...), so distances compile
    to short arithmetic.  A level-0 box is so narrow that its points are neighbours,
    whatever the number of features.  With up to four of them its near boxes are
    listed; with more they are met through a coarse grid of the first four, whose
    cells are at least ``eps`` wide.  Deeper levels halve a box along all features.
    """

    def __init__(self, df: DataFrame, key: str, features: Sequence[str], eps: float):
        self.d = len(features)
        self.g = min(self.d, GRID_DIMENSIONS)
        self.key, self.features, self.eps2 = key, list(features), eps * eps
        self.side = eps / math.sqrt(self.d) * (1 - 1e-9)
        self.f = [f"f{i}" for i in range(self.d)]
        # rows are matched on their coordinates later, so both uses must see the same numbers
        coordinates = [F.col(n).cast("double").alias(f) for n, f in zip(self.features, self.f)]
        self.rows = cut_lineage(df.select(key, *coordinates))
        distinct = self.rows.groupBy(*self.f).agg(F.count(F.lit(1)).cast("bigint").alias("w"), F.min(key).alias("pt"))
        self.points = cut_lineage(spread(distinct.select("pt", "w", *self.f)))

    def node(self, level: int) -> Column:
        """Box of a point at a level: the level followed by its grid coordinates."""
        scale = F.lit(float(2**level))
        places = [F.floor(x / F.lit(self.side) * scale) for x in _cols("f", self.d)]
        return F.array(F.lit(level).cast("bigint"), *places)

    def bounds(self) -> list[Column]:
        low = [F.min(f).alias(f"lo{i}") for i, f in enumerate(self.f)]
        return low + [F.max(f).alias(f"hi{i}") for i, f in enumerate(self.f)]

    def offsets(self) -> list[tuple[int, ...]]:
        r = math.ceil(math.sqrt(self.d))
        steps = itertools.product(range(-r, r + 1), repeat=self.d)
        return [o for o in steps if sum(max(abs(x) - 1, 0) ** 2 for x in o) <= self.d]

    def met(self, cells: DataFrame, cell: str, roots: DataFrame, node: str, once: bool = False) -> DataFrame:
        """Level-0 boxes beside the level-0 boxes that may be near them; ``once`` lists a pair of different boxes once."""
        if self.d <= GRID_DIMENSIONS:
            near = [o for o in self.offsets() if not once or o > (0,) * self.d]
            moves = ", ".join(f"array(0L, {', '.join(f'{x}L' for x in o)})" for o in near)
            shifted = F.expr(f"explode(transform(array({moves}), o -> zip_with({cell}, o, (a, b) -> a + b)))")
            return cells.withColumn(node, shifted).join(roots, node)
        wide = F.lit(math.ceil(math.sqrt(self.d) * (1 + 1e-6)) + 1)
        coarse = lambda c: F.array(*[F.floor(F.col(c)[i + 1] / wide) for i in range(self.g)])
        moves = ", ".join(f"array({', '.join(f'{x}L' for x in o)})" for o in itertools.product((-1, 0, 1), repeat=self.g))
        around = cells.withColumn("_near", coarse(cell)).withColumn(
            "_near", F.expr(f"explode(transform(array({moves}), o -> zip_with(_near, o, (a, b) -> a + b)))")
        )
        found = around.join(roots.withColumn("_near", coarse(node)), "_near").drop("_near")
        return found.where(F.col(cell) < F.col(node)) if once else found

    def build(self, points: DataFrame) -> tuple[DataFrame, int]:
        """Boxes of all levels with weight and bounds; leaves also carry their points."""
        parts, pending, level = [], points.select("w", *self.f), 0
        while True:
            keyed = pending.withColumn("node", self.node(level))
            boxes = cut_lineage(
                keyed.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("w"), *self.bounds())
            )
            last = level >= MAX_LEVELS
            crowded = F.lit(False) if last else F.col("n") > LEAF
            leaves = boxes.where(~crowded).select("node")
            held = (
                keyed.join(leaves, "node", "left_semi")
                .groupBy("node")
                .agg(F.collect_list(F.struct("w", *self.f)).alias("pts"))
            )
            half = [F.floor(F.col("node")[i + 1] / F.lit(2.0)) for i in range(self.d)]
            up = F.array(F.col("node")[0] - 1, *half)
            parts.append(boxes.join(held, "node", "left").withColumn("parent", up).drop("n"))
            level += 1
            if last or boxes.where(crowded).isEmpty():
                break
            pending = cut_lineage(keyed.join(boxes.where(crowded).select("node"), "node", "left_semi").drop("node"))
        return cut_lineage(reduce(DataFrame.unionByName, parts)), level

    def boxes_near(self, probes: DataFrame, tree: DataFrame) -> DataFrame:
        """Level-0 boxes that can hold a neighbour of some probe, per probe cell: (cell, node, ...)."""
        cells = spread(probes.groupBy("cell").agg(*[b.alias(f"c_{i}") for i, b in enumerate(self.bounds())]))
        roots = tree.where(F.col("node")[0] == 0).drop("parent")
        corners = _cols("c_", 2 * self.d)
        gap = _gap(corners[: self.d], corners[self.d :], _cols("lo", self.d), _cols("hi", self.d))
        return self.met(cells, "cell", roots, "node").where(gap <= self.eps2).drop(*[f"c_{i}" for i in range(2 * self.d)])

    def blocks(self, points: DataFrame, names: Sequence[str]) -> DataFrame:
        """Points in blocks of about ``BLOCK`` by their cell in a grid of the first features, ``eps`` wide."""
        wide = F.lit(math.sqrt(self.eps2) * (1 + 1e-9))
        place = lambda c: F.floor(F.least(F.greatest(F.col(c) / wide, F.lit(-1e15)), F.lit(1e15)))
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in self.f])
        placed = points.where(whole).withColumn("at", F.array(*[place(c) for c in self.f[:BLOCK_DIMENSIONS]]))
        sizes = placed.groupBy("at").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
        dealt = placed.join(sizes, "at").withColumn("part", F.pmod(F.xxhash64(*self.f), F.col("parts")))
        return dealt.groupBy("at", "part", "parts").agg(F.collect_list(F.struct(*names, *self.f)).alias("block"))

    def blocks_met(self, probes: DataFrame, own: str, points: DataFrame, other: str) -> DataFrame:
        """Blocks of neighbouring cells side by side: (probes, block), with columns ``own`` and ``other`` in front."""
        dealt = self.blocks(points, [other]).withColumn("group", F.floor(F.col("part") / TOGETHER))
        groups = dealt.groupBy("at").agg(F.max("group").alias("last"))
        moves = ", ".join(f"array({', '.join(f'{x}L' for x in o)})" for o in itertools.product((-1, 0, 1), repeat=BLOCK_DIMENSIONS))
        around = self.blocks(probes, [own]).select(F.col("block").alias("probes"), F.expr(f"explode(transform(array({moves}), o -> zip_with(at, o, (a, b) -> a + b)))").alias("at"))
        around = around.join(groups, "at").withColumn("group", F.explode(F.sequence(F.lit(0).cast("bigint"), "last"))).drop("last")
        width = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        met = around.repartition(width, "at", "group").join(dealt.select("at", "group", "block").repartition(width, "at", "group"), ["at", "group"])
        return met.select("probes", "block")

    def compared(self):
        """Function from Arrow batches of met blocks to (own, other, rows of own, rows of other, within eps) by slices."""
        eps2, reach, key, d = self.eps2, math.sqrt(self.eps2) * (1 + 1e-9), min(BLOCK_DIMENSIONS, self.d - 1), self.d

        def columns(cells: pa.Array) -> tuple[pa.Array, np.ndarray]:
            first, *rest = cells.flatten()
            return first, np.array([c.to_numpy(zero_copy_only=False) for c in rest])

        def pairs(batches: Iterator[pa.RecordBatch]):
            for part in batches:
                for i in range(part.num_rows):
                    (own, p), (other, q) = (columns(part.column(c)[i].values) for c in (0, 1))
                    order, behind = np.argsort(p[key], kind="stable"), np.argsort(q[key], kind="stable")
                    p, q = p[:, order], q[:, behind]
                    for at in range(0, p.shape[1], SLICE):
                        x = p[:, at : at + SLICE]
                        lo, hi = np.searchsorted(q[key], x[key, 0] - reach, "left"), np.searchsorted(q[key], x[key, -1] + reach, "right")
                        if lo < hi:
                            gap = np.zeros((x.shape[1], hi - lo))
                            for j in range(d):
                                step = np.subtract.outer(x[j], q[j, lo:hi])
                                step *= step
                                gap += step
                            yield own, other, order[at : at + SLICE], behind[lo:hi], gap <= eps2

        return pairs

    def weights_direct(self, probes: DataFrame, points: DataFrame, value: str = "w") -> DataFrame:
        """Weight of ``points`` within eps of each probe: (pt, hits), by comparing blocks of neighbouring cells.

        A pair of blocks is compared inside a task, so no pair of points is ever a row.  With another ``value`` than the
        weight, ``hits`` is its least one within eps.
        """
        kind, pairs, least = self.points.schema["pt"].dataType.simpleString(), self.compared(), value != "w"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for own, other, rows, behind, near in pairs(batches):
                some = np.flatnonzero(near.any(axis=1))
                v = other.to_numpy(zero_copy_only=False).astype(np.int64)[behind]
                hits = np.where(near[some], v, np.iinfo(np.int64).max).min(axis=1) if least and len(some) else near[some] @ v
                yield pa.RecordBatch.from_arrays([own.take(pa.array(rows[some])), pa.array(hits.astype(np.int64))], names=["pt", "hits"])

        found = self.blocks_met(probes, "pt", points, value).mapInArrow(run, f"pt {kind}, hits bigint")
        return found.groupBy("pt").agg((F.min if least else F.sum)("hits").alias("hits"))

    def edges_direct(self, cores: DataFrame) -> DataFrame:
        """Edges (a, b) between the names of points: enough of them to connect what lies within eps of each other.

        A task keeps a forest of the names it has met and tells its edges, not the links it has found.
        """
        kind, pairs = cores.schema["name"].dataType.simpleString(), self.compared()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            root: dict = {}

            def find(x):
                while root.setdefault(x, x) != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for own, other, rows, behind, near in pairs(batches):
                far = len(rows)
                label = np.where(near.any(axis=1), np.arange(far), far)
                while True:  # the least row of ``own`` that every row of either side is connected to
                    beside = np.where(near, label[:, None], far).min(axis=0)
                    after = np.minimum(label, np.where(near, beside, far).min(axis=1))
                    after = np.append(after, far)[after]
                    if (after == label).all():
                        break
                    label = after
                mine, theirs = own.take(pa.array(rows)).to_pylist(), other.take(pa.array(behind)).to_pylist()
                for names, labels in ((mine, label), (theirs, beside)):
                    for i in np.flatnonzero(labels < far):
                        a, b = find(names[i]), find(mine[labels[i]])
                        if a != b:
                            root[max(a, b)] = min(a, b)
            told = [(x, find(x)) for x in list(root) if find(x) != x]
            columns = [pa.array([e[i] for e in told], batch_type) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

        batch_type = to_arrow_type(cores.schema["name"].dataType)
        return self.blocks_met(cores, "name", cores, "name").mapInArrow(run, f"a {kind}, b {kind}")

    def regions(self, points: DataFrame) -> DataFrame:
        """Points with the number of their ``region``: boxes of about equal numbers of points, cut feature by feature.

        A table has some ``REGIONS`` of them until one would hold more than ``MOST`` points, so what regions tell each other
        grows with the points.  Points with a null or non-finite coordinate have no neighbours and are left out.
        """
        finite = reduce(lambda a, b: a & b, [F.abs(F.col(f)) < float("inf") for f in self.f])
        dealt = cut_lineage(points.where(finite).withColumn("region", F.lit(0).cast("bigint")))
        most = min(max(math.ceil(dealt.count() / REGIONS), FEWEST), MOST)
        cuts, largest = [k / CUTS for k in range(1, CUTS)], None
        while True:
            for i, f in enumerate(self.f):
                left, room = self.d - i, F.ceil((F.max(f) - F.min(f)) / F.lit(math.sqrt(self.eps2)))
                slices = F.ceil(F.pow(F.count(F.lit(1)) / most, F.lit(1 / left)))
                # a feature that eps spans is cut last, where nothing else is left
                slices = slices if left == 1 else F.least(slices, F.greatest(room, F.lit(1)))
                at = dealt.groupBy("region").agg(F.percentile_approx(f, cuts).alias("_at"), slices.alias("_slices"))
                behind = F.size(F.expr(f"filter(_at, x -> x < {f})"))
                place = F.floor(behind * F.least("_slices", F.lit(CUTS)) / CUTS)
                placed = dealt.join(broadcast_if_small(at), "region").withColumn("region", F.xxhash64("region", place))
                dealt = placed.drop("_at", "_slices")
            dealt = cut_lineage(dealt)
            before, largest = largest, dealt.groupBy("region").count().agg(F.max("count")).first()[0]
            if largest is None or largest <= 2 * most or largest == before:
                return dealt

    def weights_within(self, probes: DataFrame, points: DataFrame, value: str = "w") -> DataFrame:
        """Weight of ``points`` within eps of each probe, both in regions: (pt, hits).

        A region that lies within eps of another as a whole counts as one number.  Of the others each point goes once to
        every region it may reach, where a task compares tiles of few points and opens only those that the sphere cuts.
        With another ``value`` than the weight, ``hits`` is its least one within eps.
        """
        least = value != "w"
        lo, hi = _cols("lo", self.d), _cols("hi", self.d)
        total = F.min(value) if least else F.sum(value)
        # joined on a written column, so that the join is an equal one
        other = cut_lineage(points.groupBy("region").agg(F.count(F.lit(1)).alias("n"), total.alias("total"), *self.bounds()).withColumn("all", F.lit(1)))
        own = [b.alias(f"a_{i}") for i, b in enumerate(self.bounds())]
        around = cut_lineage(probes.groupBy(F.col("region").alias("own")).agg(*own).withColumn("all", F.lit(1)))
        alo, ahi = _cols("a_", 2 * self.d)[: self.d], _cols("a_", 2 * self.d)[self.d :]
        pairs = around.join(shuffled(other), "all").where(_gap(alo, ahi, lo, hi) <= self.eps2)
        pairs = cut_lineage(pairs.withColumn("inside", _reach(alo, ahi, lo, hi) <= self.eps2).drop("all", *[f"{s}{i}" for s in ("lo", "hi") for i in range(self.d)]))
        earlier = Window.partitionBy("own").orderBy("region").rowsBetween(Window.unboundedPreceding, -1)
        dealt = F.floor(F.coalesce(F.sum("n").over(earlier), F.lit(0)) / (AT_ONCE * MOST))
        cut = broadcast_if_small(pairs.where(~F.col("inside")).withColumn("deal", dealt).drop("n", "total", "inside"))
        width = 4 * int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        f = _cols("f", self.d)
        reaching = points.select("region", F.col(value).cast("bigint").alias("v"), *self.f).join(cut, "region")
        reaching = reaching.where(_gap(f, f, alo, ahi) <= self.eps2).select("own", "deal", "v", *self.f)
        asked = probes.select("pt", *[F.col(c).alias(f"own_{c}") for c in self.f], F.col("region").alias("own")).join(broadcast_if_small(cut.select("own", "deal").distinct()), "own")
        asked, reaching = (side.repartition(width, "own", "deal").groupBy("own", "deal") for side in (asked, reaching))
        kind = probes.schema["pt"].dataType.simpleString()
        found = asked.cogroup(reaching).applyInArrow(self.tiles_compared(least), f"pt {kind}, hits bigint")
        whole = pairs.where("inside").groupBy(F.col("own").alias("region")).agg((F.min if least else F.sum)("total").cast("bigint").alias("hits"))
        found = found.unionByName(probes.select("pt", "region").join(shuffled(whole), "region").select("pt", "hits"))
        return found.groupBy("pt").agg((F.min if least else F.sum)("hits").alias("hits"))

    def tiles_compared(self, least: bool):
        """Function from the probes of a region and the points that may reach it to (pt, hits)."""
        eps2, d, names = self.eps2, self.d, list(self.f)

        def tiles(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Order of points by tiles that follow each other, and where each tile starts."""
            n = x.shape[1]
            at, order = np.zeros(n, dtype=np.int64), np.arange(n)
            for i in range(d):
                order = np.lexsort((x[i], at))
                starts = np.flatnonzero(np.diff(at[order], prepend=-1))
                sizes = np.diff(starts, append=n)
                pieces = np.ceil((sizes / TILE) ** (1 / (d - i))).astype(np.int64)
                rank = np.arange(n) - np.repeat(starts, sizes)
                before = np.repeat(np.cumsum(pieces) - pieces, sizes)
                at = np.empty(n, dtype=np.int64)
                at[order] = before + rank * np.repeat(pieces, sizes) // np.repeat(sizes, sizes)
            order = np.argsort(at, kind="stable")
            return order, np.flatnonzero(np.diff(at[order], prepend=-1))

        def held(table: pa.Table, prefix: str) -> tuple[np.ndarray, ...]:
            x = np.array([table.column(prefix + c).to_numpy() for c in names])
            order, starts = tiles(x)
            x = np.ascontiguousarray(x[:, order])
            return x, order, np.append(starts, len(order)), np.minimum.reduceat(x, starts, axis=1), np.maximum.reduceat(x, starts, axis=1)

        def run(own: pa.Table, other: pa.Table) -> pa.Table:
            ids = own.column("pt").combine_chunks()
            if not own.num_rows or not other.num_rows:
                return pa.table({"pt": ids.slice(0, 0), "hits": pa.array([], pa.int64())})
            p, order, bounds, plo, phi = held(own, "own_")
            q, behind, places, qlo, qhi = held(other, "")
            v = other.column("v").to_numpy()[behind]
            none = np.iinfo(np.int64).max if least else 0
            totals = (np.minimum if least else np.add).reduceat(v, places[:-1])
            sizes, weights = np.diff(places), v if least else v.astype(np.float64)
            hits = np.full(len(order), none)
            buffers = [np.empty(TILE * ROW, dtype=kind) for kind in (float, bool, bool, float)]
            for t in range(len(bounds) - 1):
                gap = reach = 0.0
                for j in range(d):
                    over, under = qlo[j] - phi[j, t], plo[j, t] - qhi[j]
                    apart = np.maximum(np.maximum(over, under), 0.0)
                    gap = gap + apart * apart
                    span = np.maximum(qhi[j] - plo[j, t], phi[j, t] - qlo[j])
                    reach = reach + span * span
                inside = reach <= eps2
                x = p[:, bounds[t] : bounds[t + 1]]
                mine = np.full(x.shape[1], none)
                if inside.any():
                    mine[:] = totals[inside].min() if least else totals[inside].sum()
                opened = np.flatnonzero((gap <= eps2) & ~inside)
                if len(opened):
                    n = sizes[opened]
                    rows = np.arange(n.sum()) + np.repeat(places[opened] - (np.cumsum(n) - n), n)
                    y, u = q[:, rows], weights[rows]
                    # squared distances as one product, seen from the middle of the tile; what rounding may turn is done again
                    middle = (plo[:, t] / 2 + phi[:, t] / 2)[:, None]
                    from_x, from_y = x - middle, y - middle
                    x2, y2 = (from_x * from_x).sum(axis=0), (from_y * from_y).sum(axis=0)
                    doubt = 1e-13 * (x2.max() + y2.max() + eps2)
                    least_sure, most_near = (eps2 - doubt, eps2 + doubt) if doubt < eps2 else (np.nan, np.nan)
                    one = np.column_stack([from_x.T, x2, np.ones(len(x2))])
                    two = np.vstack([-2 * from_y, np.ones(len(y2)), y2])
                    for at in range(0, len(rows), ROW):
                        part = two[:, at : at + ROW]
                        shape = (len(one), part.shape[1])
                        gaps, near, far, share = (buffer[: shape[0] * shape[1]].reshape(shape) for buffer in buffers)
                        np.matmul(one, part, out=gaps)
                        np.less_equal(gaps, least_sure, out=near)
                        np.greater(gaps, most_near, out=far)
                        if np.count_nonzero(near) + np.count_nonzero(far) < gaps.size:
                            i, k = np.nonzero(~(near | far))
                            square = 0.0
                            for j in range(d):
                                step = x[j, i] - y[j, at + k]
                                square = square + step * step
                            near[i, k] = square <= eps2
                        if least:
                            mine = np.minimum(mine, np.where(near, u[at : at + ROW], none).min(axis=1))
                        else:
                            np.copyto(share, near)
                            mine += (share @ u[at : at + ROW]).astype(np.int64)
                hits[bounds[t] : bounds[t + 1]] = mine
            some = np.flatnonzero(hits < none if least else hits > 0)
            return pa.table({"pt": ids.take(pa.array(order[some])), "hits": pa.array(hits[some])})

        return run

    def weights_near(self, probes: DataFrame, tree: DataFrame, depth: int) -> DataFrame:
        """Weight within eps of each probe point of many features: (pt, hits).

        The near boxes of a point are too many to list: the points of uncrowded level-0 boxes are compared by blocks, and
        only crowded boxes are met and opened.
        """
        plain = (F.col("node")[0] == 0) & F.col("pts").isNotNull()
        points = tree.where(plain).select(F.explode("pts").alias("p")).select("p.*")
        direct = self.weights_direct(probes, points)
        if depth == 1:
            return direct
        crowded = self.weights_listed(probes, tree.where(~plain), depth, ("pt",))
        return direct.unionByName(crowded).groupBy("pt").agg(F.sum("hits").alias("hits"))

    def weights_listed(self, probes: DataFrame, tree: DataFrame, depth: int, per: Sequence[str]) -> DataFrame:
        """Weight within eps of each probe point, or per level-0 box too (``per`` with ``cell``), by boxes met, settled and opened."""
        probes = probes.withColumn("cell", self.node(0)).select("pt", *self.f, "cell")
        # written first, so that both sides are plain shuffles and the probes of a crowded cell can be split
        near = cut_lineage(self.boxes_near(probes, tree))
        met = probes.join(near, "cell").withColumn("cell", F.col("node"))
        f, lo, hi = _cols("f", self.d), _cols("lo", self.d), _cols("hi", self.d)
        settled = []
        for level in range(depth):
            met = met.where(_gap(f, f, lo, hi) <= self.eps2)
            inside = _reach(f, f, lo, hi) <= self.eps2
            done = inside | F.col("pts").isNotNull()
            # a box that lies within eps counts as one point on the spot, a leaf by its few points
            counted = F.when(inside, F.array(F.struct("w", *self.f))).otherwise(F.col("pts"))
            points = met.where(done).select("pt", *self.f, "cell", F.explode(counted).alias("p"))
            near = points.where(_squared([F.col(f"p.{c}") for c in self.f], f) <= self.eps2)
            settled.append(near.select(*per, F.col("p.w").alias("hits")))
            if level + 1 < depth:
                opened = met.where(~done).select("pt", *self.f, "cell", F.col("node").alias("parent"))
                met = cut_lineage(opened).join(tree, "parent").drop("parent")
        return reduce(DataFrame.unionByName, settled).groupBy(*per).agg(F.sum("hits").alias("hits"))

    def cells_near(self, points: DataFrame) -> DataFrame:
        """Pairs of different level-0 boxes whose bounds are within eps: (a0, b0, linked).

        ``linked`` says that their outermost points are near enough; if they are not, other points may be.
        """
        place = F.struct(*self.f)
        ends = F.array(*[pick(place, f) for f in self.f for pick in (F.min_by, F.max_by)])
        cells = cut_lineage(points.groupBy("cell").agg(*self.bounds(), F.array_distinct(ends).alias("ends")))
        keys = spread(cells.select("cell"))
        met = self.met(keys.select(F.col("cell").alias("a0")), "a0", keys.select(F.col("cell").alias("b0")), "b0", once=True)

        def side(s: str) -> DataFrame:
            return shuffled(cells.select(F.col("cell").alias(f"{s}0"), *[F.col(c).alias(f"{c}_{s}") for c in cells.columns if c != "cell"]))

        box = [_cols(c, self.d, s) for s in ("_a", "_b") for c in ("lo", "hi")]
        met = met.join(side("a"), "a0").join(side("b"), "b0").where(_gap(*box) <= self.eps2)
        near = F.exists(
            "ends_a",
            lambda p: F.exists("ends_b", lambda q: _squared([p[c] for c in self.f], [q[c] for c in self.f]) <= self.eps2),
        )
        return cut_lineage(met.select("a0", "b0", near.alias("linked")))

    def linked_boxes(self, tree: DataFrame, depth: int, front: DataFrame | None = None) -> DataFrame:
        """Pairs of different level-0 boxes that hold points within eps of each other: of those with a crowded box, or of ``front``."""
        if front is None:
            top = tree.where(F.col("node")[0] == 0)
            dense = spread(top.where(F.col("pts").isNull()).select(F.col("node").alias("a0")))
            front = self.met(dense, "a0", spread(top.select("node")).select(F.col("node").alias("b0")), "b0").where("a0 <> b0")
        front = front.select("a0", "b0", F.col("a0").alias("na"), F.col("b0").alias("nb"))
        below = tree.select(F.col("parent").alias("up"), "node").where(F.col("node")[0] > 0)
        step = below.unionByName(tree.where(F.col("pts").isNotNull()).select(F.col("node").alias("up"), "node"))

        def side(s: str) -> DataFrame:
            return tree.select(*[F.col(c).alias(f"{c}_{s}") for c in tree.columns if c not in ("w", "parent")])

        box = [_cols(c, self.d, s) for s in ("_a", "_b") for c in ("lo", "hi")]
        found = []
        for level in range(depth):
            met = front.join(side("a"), F.col("na") == F.col("node_a")).join(side("b"), F.col("nb") == F.col("node_b"))
            met = met.where(_gap(*box) <= self.eps2)
            near = F.exists(
                "pts_a",
                lambda p: F.exists(
                    "pts_b", lambda q: _squared([p[c] for c in self.f], [q[c] for c in self.f]) <= self.eps2
                ),
            )
            both = F.col("pts_a").isNotNull() & F.col("pts_b").isNotNull()
            verdict = F.when(_reach(*box) <= self.eps2, True).when(both, near)
            met = cut_lineage(met.select("a0", "b0", "na", "nb", verdict.alias("linked")))
            linked = met.where("linked").select("a0", "b0").distinct()
            found.append(linked)
            if level + 1 < depth:
                front = (
                    met.where(F.col("linked").isNull())
                    .join(linked, ["a0", "b0"], "left_anti")
                    .join(step.select(F.col("up").alias("na"), F.col("node").alias("ca")), "na")
                    .join(step.select(F.col("up").alias("nb"), F.col("node").alias("cb")), "nb")
                    .select("a0", "b0", F.col("ca").alias("na"), F.col("cb").alias("nb"))
                )
        return reduce(DataFrame.unionByName, found).distinct()

    def to_rows(self, per_point: DataFrame) -> DataFrame:
        """Spread a result per distinct point back over the original rows."""
        placed = self.points.select("pt", *self.f).join(per_point, "pt").drop("pt")
        return self.rows.join(placed, self.f).drop(*self.f)


def eps_neighbors(
    df: DataFrame, key: str, features: Sequence[str], eps: float = 0.5, min_samples: int = 5
) -> DataFrame:
    """Number of rows within ``eps`` of each row (itself included) and whether that makes it a core."""
    grid = EpsGrid(df, key, features, eps)
    if grid.d > GRID_DIMENSIONS:
        counts = grid.weights_near(grid.points, *grid.build(grid.points))
    else:
        points = grid.regions(grid.points)
        counts = grid.weights_within(points, points)
    counts = counts.withColumnRenamed("hits", "n_neighbors")
    return grid.to_rows(counts.withColumn("is_core", F.col("n_neighbors") >= min_samples))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest member of the component of every node that has an edge: (node, root).

    Alternates hooking larger and smaller neighbours onto the local minimum,
    which needs few rounds even for long chains.  Each round is checkpointed.
    """
    pairs = cut_lineage(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    )

    def mark(df: DataFrame) -> tuple:
        row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(row)

    state = mark(pairs)
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(shuffled(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hooked = large.join(shuffled(low), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = hooked.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        pairs = cut_lineage(small)
        now = mark(pairs)
        if now == state:
            break
        state = now
    roots = pairs.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _named(pairs: DataFrame, names: DataFrame) -> DataFrame:
    """Pairs of boxes (a0, b0) as edges (a, b) between their names."""
    a, b = (names.select(F.col("cell").alias(f"{s}0"), F.col("name").alias(s)) for s in "ab")
    return pairs.join(shuffled(a), "a0").join(shuffled(b), "b0").select("a", "b")


def _rooted(names: DataFrame, edges: DataFrame) -> DataFrame:
    """The least name that edges connect to the name of each cell: (cell, root)."""
    found = names.join(shuffled(connected_components(edges)), F.col("name") == F.col("node"), "left")
    return found.select("cell", F.coalesce("root", "name").alias("root"))


def dbscan(
    df: DataFrame, key: str, features: Sequence[str], eps: float = 0.5, min_samples: int = 5
) -> DataFrame:
    """Cluster per row, numbered by smallest core id; -1 is noise.

    A border row joins the lowest-numbered cluster it touches.  Takes any number
    of features.
    """
    grid = EpsGrid(df, key, features, eps)
    wide = grid.d > GRID_DIMENSIONS
    points = (grid.points if wide else grid.regions(grid.points)).withColumn("cell", grid.node(0))
    cells = points.groupBy("cell").agg(F.sum("w").alias("cell_w"), *grid.bounds())
    diagonal = _squared(_cols("hi", grid.d), _cols("lo", grid.d))
    dense = cells.where((F.col("cell_w") >= min_samples) & (diagonal <= grid.eps2)).select("cell")
    sure = points.join(dense, "cell", "left_semi")
    unsure = points.join(dense, "cell", "left_anti")
    counts = grid.weights_near(unsure, *grid.build(grid.points)) if wide else grid.weights_within(unsure, points)
    cores = sure.unionByName(unsure.join(counts.where(F.col("hits") >= min_samples), "pt", "left_semi"), allowMissingColumns=True)
    cores = cut_lineage(cores.select("pt", "w", *grid.f, "cell", *([] if wide else ["region"])))
    if cores.isEmpty():
        return df.select(key, F.lit(-1).alias("cluster"))

    names = cores.groupBy("cell").agg(F.min("pt").alias("name"))
    if wide:
        core_tree, core_depth = grid.build(cores)
        plain = (F.col("node")[0] == 0) & F.col("pts").isNotNull()
        loose = cores.join(core_tree.where(plain).select(F.col("node").alias("cell")), "cell", "left_semi")
        edges = grid.edges_direct(loose.join(names, "cell").where("name is not null"))
        if core_depth > 1:
            links = grid.linked_boxes(core_tree, core_depth)
            edges = edges.unionByName(_named(links, names))
        rooted = _rooted(names, edges)
    else:
        pairs = grid.cells_near(cores)
        rooted = cut_lineage(_rooted(names, _named(pairs.where("linked"), names)))
        # cells that other cells connect need no link of their own
        root = lambda c: rooted.select(F.col("cell").alias(c), F.col("root").alias(f"{c}_root"))
        apart = pairs.where(~F.col("linked")).join(shuffled(root("a0")), "a0").join(shuffled(root("b0")), "b0")
        apart = cut_lineage(apart.where("a0_root <> b0_root").select("a0", "b0"))
        if not apart.isEmpty():
            open_cells = apart.select(F.col("a0").alias("cell")).union(apart.select("b0")).distinct()
            tree, depth = grid.build(cores.join(open_cells, "cell", "left_semi"))
            links = grid.linked_boxes(tree, depth, front=apart)
            names = rooted.select("cell", F.col("root").alias("name"))
            rooted = _rooted(names, _named(links, names))
    numbered = number_rows(rooted.select("root").distinct(), [F.col("root")], name="cluster").drop("_total")
    cell_cluster = cut_lineage(rooted.join(numbered, "root").select("cell", F.col("cluster").cast("int").alias("cluster")))

    labelled = cores.join(cell_cluster, "cell")
    core_labels = labelled.select("pt", "cluster")
    outside = unsure.join(cores, "pt", "left_anti")
    if wide:
        border = grid.weights_direct(outside, loose.join(cell_cluster, "cell"), "cluster")
        border = border.select("pt", F.col("hits").cast("int").alias("cluster"))
        if core_depth > 1:
            listed = grid.weights_listed(outside, core_tree.where(~plain), core_depth, ("pt", "cell"))
            border = border.unionByName(listed.where(F.col("hits") > 0).join(cell_cluster, "cell").select("pt", "cluster"))
            border = border.groupBy("pt").agg(F.min("cluster").alias("cluster"))
    else:
        border = grid.weights_within(outside, labelled, "cluster").select("pt", F.col("hits").cast("int").alias("cluster"))
    labels = grid.points.select("pt").join(core_labels.unionByName(border), "pt", "left")
    return grid.to_rows(labels.select("pt", F.coalesce("cluster", F.lit(-1)).alias("cluster")))
