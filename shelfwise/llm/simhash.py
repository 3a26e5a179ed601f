"""SimHash near-duplicates: exact search within a few bits, compared on vertical bit planes.

Every text gets a 64-bit fingerprint.  Equal fingerprints fall together first, so only distinct ones are compared.
Pigeonhole tables bring fingerprints within the radius into a common bucket; a bucket that is too large is divided
again on the bits it does not share, so every bucket is bounded and no pair is lost.  Inside buckets the fingerprints
stand as bit planes, and biased carry-save counters update the distances of 64 pairs per machine word.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import as_bytes, batch, digits, keyed, local_roots, pieces
from shelfwise.operators.neighbors import connected_components
from shelfwise.session import cut_lineage

BITS = 64
BUCKET = 2048  # a larger bucket is divided; never cut
SEED = 42


def fingerprint(text: bytes, shingle: int) -> int:
    """Majority bits of the XXH64 of the word shingles, A-Z lower-cased; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    flat, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[: n - 1].tolist()]
    ends = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        hashes = [digest(flat[s:e], SEED) for s, e in zip(starts[at : at + (1 << 16)], ends[at : at + (1 << 16)])]
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _fp) per row; a null text counts as empty."""
    rows = keyed(docs, id_col, text_col)
    key = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            found = pa.array([fingerprint(t, shingle) for t in as_bytes(part.column(1))], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), found], names=["_id", "_fp"])

    return rows.mapInArrow(run, f"_id {key}, _fp long")


def within(block: np.ndarray, radius: int) -> np.ndarray:
    """Which of the fingerprints in ``block`` (unsigned) lie within ``radius`` bits of each other, as a matrix."""
    g = len(block)
    width = -(-g // 64) * 64
    bits = np.zeros((BITS, width), dtype=np.uint8)
    bits[:, :g] = np.unpackbits(block.astype("<u8").view(np.uint8).reshape(g, 8), axis=1, bitorder="little").T
    planes = np.packbits(bits, axis=1, bitorder="little").view("<u8")
    full = ~np.uint64(0)
    valid = np.zeros(width, dtype=np.uint8)
    valid[:g] = 1
    padding = ~np.packbits(valid, bitorder="little").view("<u8")
    levels = max(1, radius.bit_length())
    start = (1 << levels) - radius - 1  # the counters overflow at radius + 1 differing bits
    rows = np.arange(g)
    over = np.tile(padding, (g, 1))
    over[rows, rows // 64] |= np.uint64(1) << (rows % 64).astype(np.uint64)
    counters = [np.full_like(over, full if start >> k & 1 else 0) for k in range(levels)]
    for plane in range(BITS):
        mine = np.where(block[rows] >> np.uint64(plane) & np.uint64(1), full, np.uint64(0))
        carry = planes[plane][None, :] ^ mine[:, None]
        for counter in counters:
            counter ^= carry
            carry &= ~counter  # it was one and became zero: carried on
        over |= carry
        if plane % 8 == 7:
            alive = (over != full).any(axis=1)
            if not alive.all():  # everything in the row is beyond the radius: abandoned
                rows, over, counters = rows[alive], over[alive], [c[alive] for c in counters]
                if not len(rows):
                    break
    near = np.zeros((g, g), dtype=bool)
    if len(rows):
        near[rows] = np.unpackbits((~over).view(np.uint8), axis=1, bitorder="little")[:, :g].astype(bool)
    return near


def _links(radius: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def settle(values: np.ndarray) -> pa.RecordBatch:
        block = np.unique(values).view(np.uint64)
        roots = local_roots(within(block, radius))
        moved = np.flatnonzero(roots != np.arange(len(block)))
        signed = block.view(np.int64)
        return batch(schema, a=signed[moved], b=signed[roots[moved]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket; whole buckets are settled together, several small ones at a time."""
        held = np.empty((3, 0), dtype=np.int64)
        for part in batches:
            rows = np.stack([part.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "key", "fp")])
            held = np.concatenate([held, rows], axis=1)
            new = np.flatnonzero((held[:2, 1:] != held[:2, :-1]).any(axis=0)) + 1
            done = 0
            while len(new := new[new > done]) and held.shape[1] - done > BUCKET:
                fit = new[new <= done + BUCKET]
                cut = int(fit[-1] if len(fit) else new[0])
                yield settle(held[2, done:cut])
                done = cut
            held = held[:, done:]
        new = [0, *(np.flatnonzero((held[:2, 1:] != held[:2, :-1]).any(axis=0)) + 1).tolist(), held.shape[1]]
        done = 0
        for here, after in zip(new[1:], [*new[2:], None]):
            if after is None or after - done > BUCKET:
                if here > done:
                    yield settle(held[2, done:here])
                done = here

    return run


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _parts(positions: list[int], count: int) -> list[int]:
    """The bit positions dealt to ``count`` masks of equal width, in order."""
    edges = [len(positions) * i // count for i in range(count + 1)]
    return [sum(1 << p for p in positions[a:b]) for a, b in zip(edges, edges[1:])]


def links_within(fps: DataFrame, radius: int, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that connect all distinct ``fp`` within ``radius`` bits, directly or through others.

    Of ``radius`` + 2 blocks of bits two must agree, so each pair of blocks is a table.  A bucket of more than
    ``bucket`` fingerprints is divided: of the bits it leaves open, one of ``radius`` + 1 parts must agree too.  A
    bucket of at most 10 open bits is bounded by itself.
    """
    spark = fps.sparkSession
    masks = [a | b for a, b in combinations(_parts(list(range(BITS)), radius + 2), 2)]
    rows, found = fps.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask")), []
    while True:
        rows = rows.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
        sizes = rows.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        rows = cut_lineage(rows.join(sizes, ["mask", "key"]))
        narrow = [m for m in masks if BITS - m.bit_count() > 10]
        large = (F.col("n") > bucket) & F.col("mask").isin([_signed(m) for m in narrow])
        found.append(rows.where(~large))
        rows = rows.where(large)
        if not narrow or rows.isEmpty():
            break
        finer = {}
        for m in narrow:
            open_bits = [p for p in range(BITS) if not m >> p & 1]
            finer[m] = sorted({m | part for part in _parts(open_bits, radius + 1)})
        choice = F.create_map(
            *[x for m, f in finer.items() for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(v)) for v in f]))]
        )
        masks = sorted({v for f in finer.values() for v in f})
        rows = rows.select("fp", F.explode(F.element_at(choice, F.col("mask"))).alias("mask")).distinct()
    found = [f.repartition("mask", "key").sortWithinPartitions("mask", "key").select("mask", "key", "fp") for f in found]
    out = [f.mapInArrow(_links(radius), "a long, b long") for f in found]
    links = out[0]
    for more in out[1:]:
        links = links.unionByName(more)
    return links if out else spark.createDataFrame([], "a long, b long")


def simhash_groups(
    docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: the id, ``fingerprint`` (16 hex digits) and ``component_id``.

    ``component_id`` is the smallest id reachable over fingerprints at most ``radius`` bits apart.  A null or empty
    text has fingerprint zero and is linked like any other; a repeated row is one more member of its group; a row
    without id keeps its group's smallest id; an empty table gives an empty result; other columns are not read.
    """
    rows = cut_lineage(fingerprints(docs, shingle, id_col, text_col))
    reps = cut_lineage(rows.groupBy(F.col("_fp").alias("fp")).agg(F.min("_id").alias("least")))
    roots = connected_components(links_within(reps.select("fp"), radius))
    placed = reps.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    placed = placed.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    heads = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(heads, "root").select("fp", "component_id")
    return rows.join(named, rows._fp == named.fp).select(
        F.col("_id").alias(id_col), F.expr(digits("_fp")).alias("fingerprint"), "component_id"
    )
