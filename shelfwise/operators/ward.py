"""Ward clustering of any number of points by merging mutual nearest clusters.

Ward's cost never falls when two clusters merge: what a merged cluster costs to join to a third is at least the lesser of
what its halves cost.  So all merges up to a cost ``t`` can be done before any dearer one, clusters that are each other's
cheapest partner can merge in any order, and after a merge only the partners of the two halves have to be looked at
again.

Clusters are dealt into regions of about ``region`` clusters.  A task gets a region and, frozen, the clusters around it
that one of its own may cost at most the region's ``t`` to join.  It merges its own, cheapest pair first; a cluster whose
cheapest partner is frozen waits, and so does one whose cheapest partner waits.  What frozen clusters do meanwhile can
only make them dearer, so all merges done are mutual ones.  The next pass cuts the regions elsewhere, and what fits one
region is merged in one task down to ``limit`` clusters, which the driver merges.

Where a pass makes no headway, phases with a growing ``t`` list the pairs up to ``t`` by a grid once; rounds inside a
phase merge all mutual pairs and bring the list up to date by joins, and the last few pairs (``few``) are merged in the
driver.  Every way is the exact method, so the three numbers move work, not results.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.neighbors import connected_components
from shelfwise.session import cut_lineage, shuffled

LIMIT = 1000
FEW = 50_000
GRID_DIMENSIONS = 4  # of more features the grid takes the first four; costs take all
GROWTH = 4.0  # of ``t`` from phase to phase
CROWD = 64  # clusters per grid cell that the first ``t`` aims at
REGION = 20_000  # clusters that a task is to merge
AROUND = 4  # times as many that it gets at most with those around
SAMPLE = 20_000  # clusters that the cuts between regions are taken from
CANDIDATES = 32  # pairs a cluster that a task compares at first
HEADWAY = 0.9  # a pass of the regions is to leave this share of the clusters at most


class Ward(NamedTuple):
    """``labels``: point and cluster.  ``merges``: clusters ``a`` and ``b`` (into the smaller) with their ``cost``."""

    labels: DataFrame
    merges: DataFrame


def chain_merges(centres: np.ndarray, weights: np.ndarray) -> list[tuple[int, int, float]]:
    """All Ward merges of a small weighted point set as (kept, absorbed, cost), by nearest-neighbour chains."""
    centres, weights = centres.astype(float).copy(), weights.astype(float).copy()
    alive = np.ones(len(centres), dtype=bool)
    chain, out = [], []
    for _ in range(len(centres) - 1):
        while True:
            if not chain:
                chain.append(int(alive.argmax()))
            last = chain[-1]
            gap = ((centres - centres[last]) ** 2).sum(1)
            cost = np.where(alive, gap * weights * weights[last] / (weights + weights[last]), np.inf)
            cost[last] = np.inf
            near = int(cost.argmin())
            if len(chain) > 1 and cost[chain[-2]] <= cost[near]:
                near = chain[-2]  # on ties the chain must not run in circles
            if len(chain) > 1 and near == chain[-2]:
                break
            chain.append(near)
        a, b = sorted(chain[-2:])
        del chain[-2:]
        out.append((a, b, float(cost[near])))
        centres[a] = (weights[a] * centres[a] + weights[b] * centres[b]) / (weights[a] + weights[b])
        weights[a] += weights[b]
        alive[b] = False
    return out


def merge_pairs(
    nodes: dict[object, tuple[float, tuple[float, ...]]],
    pairs: list[tuple[object, object, float]],
    t: float,
    held: set | None = None,
    most: int | None = None,
) -> list[tuple[object, object, float]]:
    """Merges (kept, absorbed, cost) of all pairs up to ``t``, cheapest first; ``nodes`` is brought up to date.

    A node in ``held`` does not merge, and who has it as the cheapest partner is ``held`` from then on.  Ends after
    ``most`` merges.
    """
    held = set() if held is None else held
    heap = [(cost, 0, 0, a, b) for a, b, cost in pairs]
    heapq.heapify(heap)
    near: dict[object, set] = {}
    for a, b, _ in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    age = dict.fromkeys(near, 0)
    out = []
    while heap and (most is None or len(out) < most):
        cost, age_a, age_b, a, b = heapq.heappop(heap)
        if a not in age or b not in age or (age[a], age[b]) != (age_a, age_b):
            continue
        if a in held or b in held:
            held.add(a)
            held.add(b)
            continue
        out.append((a, b, cost))
        (wa, xa), (wb, xb) = nodes[a], nodes.pop(b)
        w = wa + wb
        x = tuple((wa * p + wb * q) / w for p, q in zip(xa, xb))
        nodes[a] = (w, x)
        del age[b]
        age[a] += 1
        own = (near[a] | near.pop(b)) - {a, b}
        near[a] = set()
        for c in own:
            near[c] -= {a, b}
            wc, xc = nodes[c]
            cost = sum((p - q) * (p - q) for p, q in zip(x, xc)) * w * wc / (w + wc)
            if cost <= t:
                near[a].add(c)
                near[c].add(a)
                p, q = (a, c) if a < c else (c, a)
                heapq.heappush(heap, (cost, age[p], age[q], p, q))
    return out


def near_pairs(
    x: np.ndarray, w: np.ndarray, t: float, free: np.ndarray, most: float = math.inf
) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(i, j, cost) with i < j of all pairs up to ``t`` that have a ``free`` node; None if more than ``most`` pairs would
    have to be compared.  A pair meets in the grid of its lighter one's weight class."""
    size, g, met = np.floor(np.log2(w)).astype(int), min(x.shape[1], GRID_DIMENSIONS), 0
    primes = np.array([73856093, 19349663, 83492791, 49979687][:g], dtype=np.int64)
    low, out = x[:, :g].min(0), [(np.empty(0, dtype=int), np.empty(0, dtype=int), np.empty(0))]
    for s in np.unique(size):
        ys = np.flatnonzero(size >= s)
        cell = np.floor((x[ys, :g] - low) / (math.sqrt(2.0 * t / 2.0**s) * (1 + 1e-9))).astype(np.int64)
        key, light = (cell * primes).sum(1), size[ys] == s
        for asks, given in ((light & free[ys], np.arange(len(ys))), (light & ~free[ys], np.flatnonzero(free[ys]))):
            ask = np.flatnonzero(asks)
            given = given[np.argsort(key[given], kind="stable")]
            there = key[given]
            for move in map(np.array, itertools.product((-1, 0, 1), repeat=g)):
                wanted = key[ask] + (move * primes).sum()
                begin, end = np.searchsorted(there, wanted), np.searchsorted(there, wanted, "right")
                met += int((end - begin).sum())
                if met > most:
                    return None
                some = np.flatnonzero(end > begin)
                for part in np.array_split(some, 1 + int((end - begin).sum()) // 1_000_000):
                    n = (end - begin)[part]
                    p = np.repeat(ask[part], n)
                    q = given[np.repeat(begin[part] - np.cumsum(n) + n, n) + np.arange(n.sum())]
                    i, j = ys[p], ys[q]
                    gap = sum((x[i, c] - x[j, c]) ** 2 for c in range(x.shape[1]))
                    cost = gap * w[i] * w[j] / (w[i] + w[j])
                    once = (size[i] < size[j]) | (free[i] & (~free[j] | (i < j)))
                    keep = np.flatnonzero(once & (cost <= t))
                    keep = keep[(cell[p[keep]] + move == cell[q[keep]]).all(1)]  # not of other cells with the same key
                    out.append((i[keep], j[keep], cost[keep]))
    i, j, cost = (np.concatenate(column) for column in zip(*out))
    return np.minimum(i, j), np.maximum(i, j), cost


def merge_region(x: np.ndarray, w: np.ndarray, own: np.ndarray, t: float, least: int) -> list[tuple[int, int, float]]:
    """Merges (kept, absorbed, cost) of ``own`` nodes up to ``t`` that no other node can forestall, till ``least`` are left.

    ``x`` and ``w`` are brought up to date.  All nodes that are not ``own`` are taken as they are, all others unknown are
    dearer than ``t`` for every own one.
    """
    nodes = {i: (weight, tuple(at)) for i, (weight, at) in enumerate(zip(w.tolist(), x.tolist()))}
    held = set(np.flatnonzero(~own).tolist())
    free, alive, left, alone = own.copy(), np.ones(len(w), dtype=bool), int(own.sum()), bool(own.all())
    out: list[tuple[int, int, float]] = []
    end = min(t, float(((x.max(0) - x.min(0)) ** 2).sum() * w.sum()))
    now, low = end, end * 2.0**-160
    while end > 0 and free.any() and left > least:
        at = np.flatnonzero(alive)
        # at first as many pairs as are soon compared; after a step the clusters lie wide enough for the next
        most = CANDIDATES * len(at) if now > low and not out else math.inf if alone or now <= low else 16 * CANDIDATES * len(at)
        pairs = near_pairs(x[at], w[at], now, free[at], most)
        if pairs is None:
            if out:
                break
            now /= 16.0
            continue
        listed = list(zip(at[pairs[0]].tolist(), at[pairs[1]].tolist(), pairs[2].tolist()))
        found = merge_pairs(nodes, listed, now, held, left - least)
        for a, b, _ in found:
            alive[b] = False
        for a in {a for a, _, _ in found} & nodes.keys():
            w[a], x[a] = nodes[a]
        out += found
        left -= len(found)
        free[list(held)] = False
        free &= alive
        if now >= end:
            break
        now = min(now * GROWTH, end)
    return out


def cut_tree(x: np.ndarray, number: int, share: float) -> tuple | None:
    """Cuts of the space into about ``number`` parts: None, or (feature, value, cuts up to the value, cuts above)."""
    if number < 2 or len(x) < 2:
        return None
    best = None
    for c in np.argsort(-(x.max(0) - x.min(0)), kind="stable"):
        value = np.quantile(x[:, c], share, method="lower")
        for at in (value, np.nextafter(value, -np.inf)):
            below = float((x[:, c] <= at).mean())
            if 0 < below < 1 and (best is None or abs(below - share) < best[0] - 0.2):
                best = (abs(below - share), int(c), float(at), below)
    if best is None:
        return None
    _, c, at, below = best
    first = min(max(1, round(number * below)), number - 1)
    under = x[:, c] <= at
    return c, at, cut_tree(x[under], first, share), cut_tree(x[~under], number - first, share)


def regions_of(tree: tuple | None, x: np.ndarray) -> np.ndarray:
    """Number of the part of ``cut_tree`` that each row lies in."""
    out, leaves = np.zeros(len(x), dtype=np.int32), itertools.count()

    def walk(node: tuple | None, rows: np.ndarray) -> None:
        if node is None:
            out[rows] = next(leaves)
            return
        under = x[rows, node[0]] <= node[1]
        walk(node[2], rows[under])
        walk(node[3], rows[~under])

    walk(tree, np.arange(len(x)))
    return out


class Region(NamedTuple):
    """A region: its own clusters' boxes by weight class (class, lower and upper corner), and its ``t``."""

    number: int
    sizes: np.ndarray
    low: np.ndarray
    high: np.ndarray
    t: float


def seen_by(region: Region, x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Rows that a cluster of ``region`` may join for at most its ``t``."""
    out, light = np.zeros(len(x), dtype=bool), 2.0 ** region.sizes.min()
    reach = region.t * (1 / w.min() + 1 / light)
    apart = np.maximum(0.0, np.maximum(region.low.min(0) - x.max(0), x.min(0) - region.high.max(0)))
    if (apart**2).sum() > reach * (1 + 1e-9):
        return out
    for s, low, high in zip(region.sizes, region.low, region.high):
        gap = (np.maximum(0.0, np.maximum(low - x, x - high)) ** 2).sum(1)
        out |= gap <= region.t * (1 / w + 0.5**s) * (1 + 1e-9)
    return out


class Merger:
    """The state of the merging: clusters (id, w, m, f0, f1, ...) where ``id`` is the smallest of their points."""

    def __init__(self, nodes: DataFrame, d: int):
        self.nodes, self.d, self.f = nodes, d, [f"f{i}" for i in range(d)]
        self.merges: list[DataFrame] = []

    def cost(self, a: str, b: str) -> Column:
        wa, wb = F.col(f"{a}.w"), F.col(f"{b}.w")
        gap = reduce(lambda x, y: x + y, [(F.col(f"{a}.{c}") - F.col(f"{b}.{c}")) * (F.col(f"{a}.{c}") - F.col(f"{b}.{c}")) for c in self.f])
        return gap * wa * wb / (wa + wb)

    def side(self, t: float, size: Column) -> Column:
        """Cell width for clusters of weight class ``size`` (2^size and more): no dearer pair than ``t`` is farther."""
        return F.sqrt(F.lit(2.0 * t) / F.pow(F.lit(2.0), size)) * (1 + 1e-9)

    def first_threshold(self) -> float:
        """The largest ``t`` of a series at which no grid cell is crowded."""
        spans = self.nodes.agg(*[(F.max(c) - F.min(c)).alias(c) for c in self.f]).first()
        t = max(sum(float(x or 0) ** 2 for x in spans), 1e-300)
        size = F.floor(F.log2("w"))
        low = t * 2.0**-80
        while t > low:
            cells = [F.floor(F.col(c) / self.side(t, size)).alias(f"c{i}") for i, c in enumerate(self.f[:GRID_DIMENSIONS])]
            most = self.nodes.groupBy(size.alias("size"), *cells).count().agg(F.max("count")).first()[0]
            if most <= CROWD:
                break
            t /= 16.0
        return t

    def pairs(self, t: float) -> DataFrame:
        """All pairs of clusters that cost at most ``t``: (a, b, cost) with a < b.

        A pair meets in the grid of its lighter one's weight class; heavier clusters stand in the grids of all lighter
        classes that there are.
        """
        nodes = self.nodes.withColumn("size", F.floor(F.log2("w")).cast("int"))
        g = min(self.d, GRID_DIMENSIONS)
        place = lambda level: [F.floor(F.col(c) / self.side(t, F.col(level))).alias(f"c{i}") for i, c in enumerate(self.f[:g])]
        own = nodes.select(F.col("size").alias("level"), F.struct("id", "w", "size", *self.f).alias("x"), *place("size"))
        levels = sorted(r[0] for r in nodes.select("size").distinct().collect())  # at most 63 classes
        spread = F.explode(F.filter(F.array(*[F.lit(s) for s in levels]), lambda s: s <= F.col("size"))).alias("level")
        all_ = nodes.select("*", spread).select("level", F.struct("id", "w", "size", *self.f).alias("y"), *place("level"))
        moves = F.array(*[F.struct(*[F.lit(o).alias(f"o{i}") for i, o in enumerate(m)]) for m in itertools.product((-1, 0, 1), repeat=g)])
        around = own.withColumn("o", F.explode(moves)).select(
            "level", "x", *[(F.col(f"c{i}") + F.col(f"o.o{i}")).alias(f"c{i}") for i in range(g)]
        )
        once = (F.col("x.size") < F.col("y.size")) | ((F.col("x.size") == F.col("y.size")) & (F.col("x.id") < F.col("y.id")))
        met = around.join(shuffled(all_), ["level", *[f"c{i}" for i in range(g)]]).where(once)
        found = met.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"), self.cost("x", "y").alias("cost"))
        return found.where(F.col("cost") <= t)

    def costed(self, ends: DataFrame, t: float) -> DataFrame:
        """(a, b) pairs of living clusters with their cost, if that is at most ``t``."""
        side = lambda s: self.nodes.select(F.col("id").alias(s), F.struct("w", *self.f).alias(f"_{s}"))
        met = ends.join(shuffled(side("a")), "a").join(shuffled(side("b")), "b")
        return met.select("a", "b", self.cost("_a", "_b").alias("cost")).where(F.col("cost") <= t)

    def round(self, edges: DataFrame, t: float) -> DataFrame:
        """Merge all mutual cheapest pairs; returns the pairs that are left, brought up to date."""
        # equal costs are ranked by a hash: by ids, long rows of equal gaps would merge one pair a round
        rank = F.struct("cost", F.xxhash64("a", "b").alias("tie"), "a", "b")
        ends = edges.select(F.explode(F.array("a", "b")).alias("id"), rank.alias("edge"))
        best = ends.groupBy("id").agg(F.min("edge").alias("edge"))
        mutual = best.groupBy("edge").count().where(F.col("count") == 2)
        merges = cut_lineage(mutual.select("edge.a", "edge.b", "edge.cost"))
        self.merges.append(merges.withColumn("place", F.lit(len(self.merges))))
        renamed = merges.select(F.col("b").alias("id"), F.col("a").alias("into"))
        touched = merges.select(F.col("a").alias("id"), F.col("a").alias("into")).unionByName(renamed)
        moved = self.nodes.join(shuffled(touched), "id", "left").withColumn("id", F.coalesce("into", "id"))
        means = [(F.sum(F.col("w") * F.col(c)) / F.sum("w")).alias(c) for c in self.f]
        fused = moved.where("into is not null").groupBy("id").agg(F.sum("w").alias("w"), *means)
        rest = moved.where("into is null").select("id", "w", *self.f)
        self.nodes = cut_lineage(rest.unionByName(fused.select("id", "w", *self.f)))
        at = lambda s: touched.select(F.col("id").alias(s), F.col("into").alias(f"{s}_into"))
        moved = edges.join(shuffled(at("a")), "a", "left").join(shuffled(at("b")), "b", "left")
        same = moved.where("a_into is null and b_into is null").select("a", "b", "cost")
        a, b = F.coalesce("a_into", "a"), F.coalesce("b_into", "b")
        changed = moved.where("a_into is not null or b_into is not null").select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        changed = changed.where("a <> b").distinct()
        return cut_lineage(same.unionByName(self.costed(changed, t)))

    def cuts(self, count: int, most: int, turn: int) -> tuple | None:
        """Cuts of the clusters into regions of about ``most``, other ones every ``turn``."""
        if count <= most:
            return None
        few = self.nodes.where(F.pmod(F.xxhash64("id", F.lit(turn)), F.lit(-(-count // SAMPLE))) == 0).select(*self.f)
        x = np.array([tuple(r) for r in few.collect()], dtype=float).reshape(-1, self.d)
        return cut_tree(x, -(-count // most), (0.5, 0.38, 0.62)[turn % 3])

    def merge_regions(self, count: int, most: int, least: int, turn: int) -> int:
        """One pass: merge what regions of about ``most`` clusters can settle alone; returns how many clusters are left.

        A region's ``t`` comes from its extent and is lowered until it sees no more than ``AROUND`` times as many.
        """
        tree, d, f = self.cuts(count, most, turn), self.d, self.f
        kind = self.nodes.schema["id"].dataType.simpleString()
        numbers = lambda part: np.stack([part.column(c).to_numpy(zero_copy_only=False) for c in f], 1)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in batches:
                yield part.append_column("region", pa.array(regions_of(tree, numbers(part)), pa.int32()))

        placed = self.nodes.select("id", "w", *f).mapInArrow(place, f"id {kind}, w double, {''.join(f'{c} double, ' for c in f)}region int")
        regions: dict[int, Region] = {}
        if tree is not None:
            placed = cut_lineage(placed)
            bounds = [a(c) for a in (F.min, F.max) for c in f]
            boxes = placed.groupBy("region", F.floor(F.log2("w")).cast("int").alias("size")).agg(F.count(F.lit(1)), F.sum("w"), *bounds).collect()
            for r in sorted({b[0] for b in boxes}):
                own = [b for b in boxes if b[0] == r]
                low, high = (np.array([b[i : i + d] for b in own], dtype=float) for i in (4, 4 + d))
                side = (high.max(0) - low.min(0))[high.max(0) > low.min(0)]
                width = float(np.exp(np.log(side).mean())) if len(side) else 0.0
                weight = sum(b[3] for b in own) / sum(b[2] for b in own)
                regions[r] = Region(r, np.array([b[1] for b in own]), low, high, (width / 8) ** 2 * weight / 2)
            regions = self.narrowed(placed, regions, most)

        def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in batches:
                yield part.append_column("own", pa.array(np.ones(part.num_rows, dtype=bool)))
                if part.num_rows:
                    x, w, at = numbers(part), part.column("w").to_numpy(), part.column("region").to_numpy()
                    for region in regions.values():
                        rows = np.flatnonzero(seen_by(region, x, w) & (at != region.number))
                        if len(rows):
                            seen = part.take(pa.array(rows))
                            seen = seen.set_column(seen.schema.get_field_index("region"), "region", pa.array(np.full(len(rows), region.number), pa.int32()))
                            yield seen.append_column("own", pa.array(np.zeros(len(rows), dtype=bool)))

        def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            table = table.take(pc.sort_indices(table, sort_keys=[("id", "ascending")])).combine_chunks()
            ids, x, w = table.column("id"), numbers(table), table.column("w").to_numpy().copy()
            own, t = table.column("own").to_numpy(), math.inf if tree is None else regions[key[0].as_py()].t
            found = merge_region(x, w, own, t, least if tree is None else 1)
            a, b = (np.array([m[i] for m in found], dtype=np.int64) for i in (0, 1))
            left = own.copy()
            left[b] = False
            left = np.flatnonzero(left)
            none = lambda n, kind: pa.nulls(n, kind)
            parts = [
                [ids.take(pa.array(left)), none(len(left), ids.type), none(len(left), pa.float64()), pa.array(np.full(len(left), -1), pa.int32()), pa.array(w[left])],
                [ids.take(pa.array(a)), ids.take(pa.array(b)), pa.array([m[2] for m in found], pa.float64()), pa.array(np.arange(len(found)), pa.int32()), none(len(found), pa.float64())],
            ]
            parts[0] += [pa.array(x[left, i]) for i in range(d)]
            parts[1] += [none(len(found), pa.float64())] * d
            names = ["a", "b", "cost", "place", "w", *f]
            return pa.concat_tables([pa.Table.from_arrays(p, names=names) for p in parts])

        given = placed.mapInArrow(around, f"id {kind}, w double, {''.join(f'{c} double, ' for c in f)}region int, own boolean")
        given = given.repartition(3 * max(1, len(regions)), "region")
        done = given.groupBy("region").applyInArrow(merge, f"a {kind}, b {kind}, cost double, place int, w double, {', '.join(f'{c} double' for c in f)}")
        done = cut_lineage(done)
        self.merges.append(done.where("place >= 0").select("a", "b", "cost", "place"))
        self.nodes = done.where("place < 0").select(F.col("a").alias("id"), "w", *f)
        return self.nodes.count()

    def narrowed(self, placed: DataFrame, regions: dict[int, Region], most: int) -> dict[int, Region]:
        """``regions`` with ``t`` lowered where a task would get too many clusters around its own."""
        f, open_ = self.f, dict(regions)
        while open_:

            def count(batches: Iterator[pa.RecordBatch], open_=open_) -> Iterator[pa.RecordBatch]:
                seen = dict.fromkeys(open_, 0)
                for part in batches:
                    if part.num_rows:
                        x = np.stack([part.column(c).to_numpy(zero_copy_only=False) for c in f], 1)
                        w = part.column("w").to_numpy()
                        for r, region in open_.items():
                            seen[r] += int(seen_by(region, x, w).sum())
                yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int32()), pa.array(list(seen.values()), pa.int64())], names=["region", "n"])

            found = placed.mapInArrow(count, "region int, n bigint").groupBy("region").agg(F.sum("n")).collect()
            open_ = {r: open_[r]._replace(t=open_[r].t / 4.0) for r, n in found if n > AROUND * most and open_[r].t > 1e-300}
            regions = regions | open_
        return regions

    def finish(self, edges: DataFrame, t: float) -> None:
        """Merge the last pairs of a phase, at most ``few``, in the driver."""
        spark = edges.sparkSession
        ids = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        near = self.nodes.join(shuffled(ids), "id", "left_semi").collect()
        nodes = {r["id"]: (r["w"], tuple(r[c] for c in self.f)) for r in near}
        merges = merge_pairs(nodes, [(r["a"], r["b"], r["cost"]) for r in edges.select("a", "b", "cost").collect()], t)
        placed = [(*m, len(self.merges) + i) for i, m in enumerate(merges)]
        self.merges.append(spark.createDataFrame(placed, edges.select("a", "b", "cost", F.lit(0).alias("place")).schema))
        schema = self.nodes.select("id", "w", *self.f).schema
        new = spark.createDataFrame([(i, w, *x) for i, (w, x) in nodes.items()], schema)
        self.nodes = cut_lineage(self.nodes.join(shuffled(ids), "id", "left_anti").unionByName(new))


def ward(
    vectors: DataFrame, key: str, k: int = 5, features: str = "features", limit: int = LIMIT, few: int = FEW, region: int = REGION
) -> Ward:
    """Exact Ward clusters of the rows, numbered by their smallest key, and all merges behind them.

    Equal vectors are one point with their number as weight.  With fewer distinct points than ``k`` every point is its
    own cluster.  Merges of equal cost are taken in no stated order.  An empty table gives empty results.
    """
    rows = cut_lineage(vectors.select(F.col(key).alias("_key"), vector_to_array(features).alias("_x")))
    points = cut_lineage(rows.groupBy("_x").agg(F.count(F.lit(1)).cast("double").alias("w"), F.min("_key").alias("id")))
    spark, head = rows.sparkSession, points.select(F.size("_x")).first()
    fields = f"a {points.schema['id'].dataType.simpleString()}, b {points.schema['id'].dataType.simpleString()}, cost double"
    if head is None:
        return Ward(rows.select(F.col("_key").alias(key), F.lit(0).alias("cluster")), spark.createDataFrame([], fields))
    d = head[0]
    state = Merger(cut_lineage(points.select("id", "w", *[F.col("_x")[i].alias(f"f{i}") for i in range(d)])), d)
    t, count, least = None, state.nodes.count(), max(limit, k)
    steps: list[DataFrame] = []  # merges of every pass and phase: a cluster's later merges have later places
    ordered = lambda merges: merges.withColumn("step", F.lit(len(steps)))
    while count > least:
        before, state.merges = count, []
        count = state.merge_regions(count, region, least, len(steps))
        if count < before:
            steps.append(ordered(state.merges[0]))
        if count <= max(least, HEADWAY * before):
            continue
        t = state.first_threshold() if t is None else t * GROWTH
        state.merges = []
        edges = cut_lineage(state.pairs(t))
        while (pairs := edges.count()) > few:
            edges = state.round(edges, t)
        if pairs:
            state.finish(edges, t)
        if state.merges:
            steps.append(cut_lineage(ordered(reduce(DataFrame.unionByName, state.merges))))
            count = state.nodes.count()
    left = state.nodes.orderBy("id").collect()  # at most ``limit`` clusters
    names = [r["id"] for r in left]
    last = chain_merges(np.array([[r[c] for c in state.f] for r in left]), np.array([r["w"] for r in left]))
    found = spark.createDataFrame([(names[a], names[b], c, i) for i, (a, b, c) in enumerate(last)], f"{fields}, place int")
    merges = cut_lineage(reduce(DataFrame.unionByName, [*steps, ordered(found)]))
    # without the k - 1 dearest merges, later ones first among equals, the rest joins k clusters
    dearest = merges.orderBy(F.desc("cost"), F.desc("step"), F.desc("place"), "a", "b").limit(max(0, k - 1)).select("a", "b")
    roots = connected_components(merges.join(shuffled(dearest), ["a", "b"], "left_anti")).withColumnRenamed("node", "id")
    placed = points.join(shuffled(roots), "id", "left").select("_x", F.coalesce("root", "id").alias("root"))
    placed = cut_lineage(placed)
    order = {r[0]: i for i, r in enumerate(placed.select("root").distinct().orderBy("root").limit(k).collect())}
    numbers = spark.createDataFrame(list(order.items()), f"root {points.schema['id'].dataType.simpleString()}, cluster int")
    labels = rows.join(shuffled(placed), "_x").join(F.broadcast(numbers), "root").select(F.col("_key").alias(key), "cluster")
    return Ward(labels, merges.select("a", "b", "cost"))
