"""Near-duplicate vectors by Euclidean p-stable hashing and exact cosine.

On unit vectors a cosine is a distance, so Gaussian projections, shifted and cut into cells of one width, put near
vectors into the same cell; several projections make a table's bucket and several tables make up for near misses.
Equal vectors are one node with a weight.  Buckets of any size are compared whole: a large one is dealt into blocks
of bounded size, and pairs of blocks are compared by a matrix product that gives back counts and spanning links only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import batch, local_roots, mix
from shelfwise.operators.neighbors import connected_components
from shelfwise.session import cut_lineage

BLOCK = 512  # vectors of a bucket that one comparison takes from each side; more blocks, never fewer rows


def unit_vectors(column: pa.Array) -> list[bytes | None]:
    """Unit vectors as double-precision bytes; None for null, zero, or with a null or non-finite component."""
    out: list[bytes | None] = []
    for v in column.to_pylist():
        if not v or any(x is None for x in v):
            out.append(None)
            continue
        a = np.asarray(v, dtype=np.float64)
        with np.errstate(over="ignore", invalid="ignore"):
            top = np.abs(a).max()
            if not np.isfinite(top) or top == 0:
                out.append(None)
                continue
            a = a / top
            out.append((a / np.sqrt((a * a).sum()) + 0.0).tobytes())
    return out


def _normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        unit = pa.array(unit_vectors(part.column(1)), pa.binary())
        yield pa.RecordBatch.from_arrays([part.column(0), unit], names=["id", "unit"])


def _signatures(tables: int, projections: int, width: float, seed: int):
    schema = pa.schema([("node", pa.int64()), ("unit", pa.binary()), ("weight", pa.int64()), ("cells", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[int, tuple] = {}
        for part in batches:
            units, cells = part.column("unit").to_pylist(), []
            for u in units:
                v = np.frombuffer(u)
                if len(v) not in drawn:
                    rng = np.random.default_rng([seed, len(v)])
                    drawn[len(v)] = (
                        rng.standard_normal((tables * projections, len(v))),
                        rng.uniform(0, width, tables * projections),
                    )
                lines, shift = drawn[len(v)]
                cell = np.floor((lines @ v + shift) / width).astype(np.int64).view(np.uint64)
                key = np.full(tables, len(v), dtype=np.uint64)
                for c in cell.reshape(tables, projections).T:
                    key = mix(key, c)
                cells.append(key.tobytes())
            weight = part.column("weight").to_pylist()
            yield batch(schema, node=part.column("node").to_pylist(), unit=units, weight=weight, cells=cells)

    return run


def _explode_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("node", pa.int64()), ("tab", pa.int32()), ("cell", pa.int64())])
    for part in batches:
        cells = np.array([np.frombuffer(c, dtype=np.int64) for c in part.column("cells").to_pylist()])
        node = part.column("node").to_numpy()
        if not len(node):
            continue
        tables = cells.shape[1]
        yield batch(
            schema, node=np.repeat(node, tables), tab=np.tile(np.arange(tables), len(node)), cell=cells.reshape(-1)
        )


def _compare(threshold: float):
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def settle(rows: list[dict]) -> pa.RecordBatch | None:
        """All pairs of one pair of blocks: each link counts in the first table that has both in one bucket."""
        tab, low, high = rows[0]["tab"], rows[0]["low"], rows[0]["high"]
        side = np.array([r["block"] for r in rows])
        unit = np.array([np.frombuffer(r["unit"]) for r in rows])
        near = unit @ unit.T >= threshold
        np.fill_diagonal(near, False)
        if low != high:
            near &= side[:, None] != side[None, :]
        if not near.any():
            return None
        cells = np.array([np.frombuffer(r["cells"], dtype=np.int64) for r in rows])
        counted = near.copy()
        for t in range(tab):
            counted &= cells[:, t][:, None] != cells[:, t][None, :]
        weight = np.array([r["weight"] for r in rows], dtype=np.float64)
        links, roots = (counted @ weight).astype(np.int64), local_roots(near)
        node = np.array([r["node"] for r in rows])
        told = near.any(axis=1)
        return batch(schema, node=node[told], links=links[told], root=node[roots[told]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for part in batches:
            for row in part.to_pylist():
                own = (row["tab"], row["cell"], row["low"], row["high"])
                if own != key and held:
                    if len(held) > 1 and (found := settle(held)) is not None:
                        yield found
                    held = []
                key = own
                held.append(row)
        if len(held) > 1 and (found := settle(held)) is not None:
            yield found

    return run


def link_vectors(
    vectors: DataFrame,
    threshold: float = 0.95,
    tables: int = 32,
    projections: int = 8,
    width: float = 1.2,
    seed: int = 7,
    block: int = BLOCK,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Per input row: the id, ``n_links`` (other rows linked directly), ``component_id`` and ``kept``.

    Two rows link if their cosine, in double precision, is at least ``threshold``; every link is checked exactly.  At
    the threshold itself a pair meets in one of the tables with probability 0.99 at the default parameters.  A null or
    zero vector, one with a null or non-finite component, and one of another dimension link with nothing (of their
    own dimension only).  ``component_id`` is the smallest id reachable; ``kept`` says that it is the row's own id.
    Repeated rows are rows like any other and link with each other; a row without id is linked and not kept; an empty
    table gives an empty result; other columns are not read.
    """
    source = vectors.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{vector_col}`").alias("_v"))
    id_type = source.schema["_id"].dataType.simpleString()
    rows = cut_lineage(source.mapInArrow(_normalise, f"id {id_type}, unit binary"))
    reps = rows.where("unit is not null").groupBy("unit").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("weight"))
    reps = cut_lineage(reps).withColumn("node", F.monotonically_increasing_id())
    signed = cut_lineage(
        reps.select("node", "unit", "weight").mapInArrow(
            _signatures(tables, projections, width, seed), "node long, unit binary, weight long, cells binary"
        )
    )
    spread = signed.select("node", "cells").mapInArrow(_explode_cells, "node long, tab int, cell long")
    shared = spread.groupBy("tab", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = spread.join(shared, ["tab", "cell"]).withColumn("k", F.ceil(F.col("n") / F.lit(block)).cast("int"))
    met = met.withColumn("block", F.pmod(F.xxhash64("node", "tab"), F.col("k")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("k") - 1))
    met = met.select("tab", "cell", "node", "block", other.alias("other")).select(
        "tab", "cell", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node"
    )
    dealt = met.join(signed, "node").repartition("tab", "cell", "low", "high")
    dealt = dealt.sortWithinPartitions("tab", "cell", "low", "high")
    found = cut_lineage(dealt.mapInArrow(_compare(threshold), "node long, links long, root long"))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    placed = (
        reps.join(counts, "node", "left")
        .join(roots, "node", "left")
        .select("unit", "least", "weight", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root"))
    )
    heads = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = placed.join(heads, "root").select(
        F.col("unit").alias("u"), "component_id", (F.col("links") + F.col("weight") - 1).alias("n_links")
    )
    out = rows.join(placed, rows.unit == placed.u, "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
