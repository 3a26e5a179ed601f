"""Best-fit packing of tokenised documents with dominance reduction.

Only lengths matter for packing, and there are at most ``capacity`` of them, so the instance is its length histogram:
a table of bounded size however many documents there are.  On it, sets that provably belong to some best packing are
fixed for good (Martello and Toth's dominance), the remainder goes through best fit in decreasing length, whole runs
of equal pieces at a time, and the plan is a list of placements: pieces with these ranks within their length go to
these sequences.  Spark numbers the pieces within their length and looks each up in the plan.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.ordering import number_rows
from shelfwise.llm.common import keyed, pieces
from shelfwise.llm.tokens import WordEncoder
from shelfwise.session import cut_lineage


class Plan:
    """Placements (length, first rank, count, pieces per sequence, first sequence, offset) and sequences in use."""

    def __init__(self):
        self.rows: list[tuple[int, int, int, int, int, int]] = []
        self.taken: dict[int, int] = {}
        self.sequences = 0

    def put(self, length: int, count: int, each: int, sequence: int, offset: int) -> None:
        """``count`` pieces, ``each`` of them side by side in every sequence from ``sequence`` on."""
        rank = self.taken.get(length, 0)
        self.rows.append((length, rank, count, each, sequence, offset))
        self.taken[length] = rank + count

    def fix(self, lengths: list[int], times: int) -> None:
        """``times`` new sequences that hold just these lengths."""
        offset = 0
        for length in lengths:
            self.put(length, times, 1, self.sequences, offset)
            offset += length
        self.sequences += times


def reduce_dominated(left: dict[int, int], capacity: int, plan: Plan) -> dict[int, int]:
    """Fix dominating sets while there are any; returns what remains.

    For the largest piece: it stands alone if not even the smallest other piece fits beside it; a partner that fills
    the sequence exactly dominates every other set; if no two others fit beside it, the largest that fits dominates;
    and so does a partner at least as long as any two others that fit together, if no three others do.  The rules are
    tried for every length from the largest down, as each holds whatever the other pieces are.  Each use takes all
    pieces of one length, so the plan gets at most three rows per length, however many pieces there are.
    """
    left = {k: v for k, v in left.items() if v}
    lengths = sorted(left)

    def take(which: list[int], times: int) -> None:
        plan.fix(which, times)
        for k in which:
            left[k] -= times
            if not left[k]:
                lengths.pop(bisect_left(lengths, k))
                del left[k]

    def smallest(big: int, n: int) -> list[int]:
        """Up to ``n`` smallest pieces besides one of ``big``."""
        out: list[int] = []
        for k in lengths[: n + 1]:
            out += [k] * min(n, left[k] - (k == big))
        return out[:n]

    def longest_pair(big: int, room: int) -> int:
        """Length of the longest two others that fit together."""
        best, low, high = 0, 0, bisect_left(lengths, room) - 1
        others = lambda i: left[lengths[i]] - (lengths[i] == big)
        while low <= high:
            pair = lengths[low] + lengths[high]
            if pair > room or not others(high):
                high -= 1
            elif not others(low) or (low == high and others(low) < 2):
                low += 1
            else:
                best = max(best, pair)
                low += 1
        return best

    def fixed(big: int) -> bool:
        room, low = capacity - big, smallest(big, 3)
        if not low or low[0] > room:
            take([big], left[big] if not low or big > room else 1)
            return True
        if left.get(room, 0) - (room == big) > 0:
            take([big, room], left[big] // 2 if room == big else min(left[big], left[room]))
            return True
        spot = bisect_left(lengths, room + 1) - 1
        if lengths[spot] == big and left[big] < 2:
            spot -= 1
        partner = lengths[spot]
        if len(low) > 1 and low[0] + low[1] <= room:
            if len(low) == 3 and sum(low) <= room or partner < longest_pair(big, room):
                return False
        # without these pieces fewer others fit, so the rule holds again as long as both lengths last
        take([big, partner], left[big] // 2 if partner == big else min(left[big], left[partner]))
        return True

    changed = True
    while changed:
        changed = False
        for big in sorted(left, reverse=True):
            while left.get(big) and fixed(big):
                changed = True
    return left


def best_fit(left: dict[int, int], capacity: int, plan: Plan) -> None:
    """Best fit in decreasing length: each run of equal pieces goes to the fullest sequences that still hold them."""
    open_by_room: dict[int, list[tuple[int, int]]] = {}  # room: (first sequence, count)
    rooms: list[int] = []

    def opened(room: int, first: int, count: int) -> None:
        if room and count:
            if room not in open_by_room:
                open_by_room[room] = []
                insort(rooms, room)
            open_by_room[room].append((first, count))

    for length in sorted(left, reverse=True):
        count = left[length]
        while count and (spot := bisect_left(rooms, length)) < len(rooms):
            room = rooms[spot]
            first, many = open_by_room[room].pop()
            if not open_by_room[room]:
                del open_by_room[room]
                rooms.pop(spot)
            each = min(room // length, count)  # a sequence that took one is the fullest: it takes the next too
            full = min(many, count // each)
            plan.put(length, full * each, each, first, capacity - room)
            opened(room - each * length, first, full)
            opened(room, first + full, many - full)
            count -= full * each
        if count:
            each = min(capacity // length, count)
            full, rest = divmod(count, each)
            plan.put(length, full * each, each, plan.sequences, 0)
            opened(capacity - each * length, plan.sequences, full)
            plan.sequences += full
            if rest:
                plan.put(length, rest, rest, plan.sequences, 0)
                opened(capacity - rest * length, plan.sequences, 1)
                plan.sequences += 1


def plan_packing(histogram: dict[int, int], capacity: int) -> Plan:
    plan = Plan()
    best_fit(reduce_dominated(histogram, capacity, plan), capacity, plan)
    return plan


def cut_pieces(
    docs: DataFrame, tokenizer: str, capacity: int, end_id: int | None, id_col: str, text_col: str
) -> DataFrame:
    """Pieces of every document: (_id, piece, start, length, ids_crc32)."""
    rows = keyed(docs, id_col, text_col)
    key = rows.schema["_id"].dataType.simpleString()
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer)
        for part in pieces(batches, 500):
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(encoder.batch(part.column(1))):
                ids += end
                for k, at in enumerate(range(0, len(ids) // 4, capacity)):
                    own = ids[4 * at : 4 * (at + capacity)]
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(len(own) // 4)
                    crc.append(zlib.crc32(own))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    *[pa.array(x, pa.int64()) for x in (start, length, crc)],
                ],
                names=["_id", "piece", "start", "length", "ids_crc32"],
            )

    return rows.mapInArrow(run, f"_id {key}, piece int, start long, length long, ids_crc32 long")


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 4096,
    end_id: int | None = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per piece: the id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and ``offset``.

    Documents are tokenised whole and closed with ``end_id``; only documents over ``capacity`` are cut, at multiples
    of it.  A null or empty text is just ``end_id`` (no piece at all if that is None).  Repeated rows and rows without
    id are documents like any other; pieces of equal length are interchangeable; an empty table gives an empty result;
    other columns are not read.  The driver holds the length histogram and the plan, bounded by ``capacity``.
    """
    spark = docs.sparkSession
    cut = cut_lineage(cut_pieces(docs, tokenizer, capacity, end_id, id_col, text_col))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = np.array(sorted(plan_packing(histogram, capacity).rows), dtype=np.int64).reshape(-1, 6)
    shared = spark.sparkContext.broadcast(plan)
    ranked = number_rows(cut, [F.col("_id"), F.col("piece"), F.col("ids_crc32"), F.col("start")], ["length"], "_rank")
    names = ["_id", "piece", "start", "length", "ids_crc32"]
    key = cut.schema["_id"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = shared.value
        keys = rows[:, 0] << 44 | rows[:, 1]  # sorted by length, then first rank
        for part in batches:
            length, rank = part.column("length").to_numpy(), part.column("_rank").to_numpy()
            at = rows[np.searchsorted(keys, length << 44 | rank, side="right") - 1]
            nth = rank - at[:, 1]
            yield pa.RecordBatch.from_arrays(
                [part.column(n) for n in names]
                + [pa.array(at[:, 4] + nth // at[:, 3]), pa.array(at[:, 5] + nth % at[:, 3] * length)],
                names=[*names, "sequence_id", "offset"],
            )

    out = ranked.select(*names, F.col("_rank").cast("long")).mapInArrow(
        place,
        f"_id {key}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
    return out.withColumnRenamed("_id", id_col)
