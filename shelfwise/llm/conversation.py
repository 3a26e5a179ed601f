"""Repair of conversation structure by weighted interval parsing.

A repaired conversation is nothing, or an optional system turn and then user and assistant in turn.  The repair grammar
is in Chomsky normal form: a symbol ``X(p, q)`` stands for rows whose edits lead from state ``p`` to state ``q`` (start,
after system, after user, after assistant); ``X(p, q) -> X(p, r) X(r, q)`` joins neighbouring spans, a row alone is kept,
given another role or deleted, and every span is closed under insertions at both of its sides.  A cell holds the least
(cost, audit), the audit being the edits' letters.  Equal costs never leave one audit a prefix of another, as whatever
follows would be insertions and cost more, so the least of joined audits is the join of the least ones.

Rows are classified, numbered and cut into blocks by Spark.  A block of at most 16 rows is parsed bottom-up by span
length; up to 16 neighbouring blocks are then the leaves of the same parse on the next level, until a conversation is
one cell.  So no task ever holds more than 16 leaves of a conversation, however long it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.ordering import number_rows
from shelfwise.llm.common import pieces, written
from shelfwise.session import broadcast_if_small

BLOCK = 16
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
FROM = {"s": (START,), "u": (START, SYSTEM, ASSISTANT), "a": (USER,)}
TO = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
CELLS = [(0, 0), (0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 2), (3, 3)]
INDEX = {pair: i for i, pair in enumerate(CELLS)}
RULES = [[(INDEX[p, r], INDEX[r, q]) for r in range(4) if (p, r) in INDEX and (r, q) in INDEX] for p, q in CELLS]
LEGAL = {"su", "ua", "au"}
# letters of edits, in ASCII order: D delete, I insert, K keep, L keep a system turn (shown as K), R give a new role
MEMO = 100_000  # parsed blocks remembered per task; when full it starts anew, which changes no result

Cell = list  # per pair of CELLS: (cost, audit) or None


def joined(left: Cell, right: Cell, best: Cell) -> None:
    """Improve ``best`` by all joins of two neighbouring spans."""
    for i, rules in enumerate(RULES):
        now = best[i]
        for a, b in rules:
            x, y = left[a], right[b]
            if x is None or y is None:
                continue
            cost = x[0] + y[0]
            if now is None or cost < now[0]:
                now = (cost, x[1] + y[1])
            elif cost == now[0]:
                now = min(now, (cost, x[1] + y[1]))
        best[i] = now


def insertions() -> Cell:
    """Cells of the empty span: nothing, or the fewest inserted turns."""
    out: Cell = [(0, "") if p == q else None for p, q in CELLS]
    for (p, q), times in {(0, 2): 1, (0, 3): 2, (1, 2): 1, (1, 3): 2, (2, 3): 1, (3, 2): 1}.items():
        out[INDEX[p, q]] = (INSERT * times, "I" * times)
    return out


def row_cell(symbol: str) -> Cell:
    """A row: ``suao`` by its role, upper case if truncated, ``1234`` if it has to go; closed under insertions."""
    out: Cell = [(DELETE, "D") if p == q else None for p, q in CELLS]
    if not symbol.isdigit():
        more = TRUNCATED if symbol.isupper() else 0
        edits = [(r, REROLE + more, "R") for r in "ua"]
        if symbol.lower() in TO:
            edits.append((symbol.lower(), more, "L" if symbol.lower() == "s" else "K"))
        for role, cost, letter in edits:
            for p in FROM[role]:
                i = INDEX[p, TO[role]]
                out[i] = min(out[i] or (cost, letter), (cost, letter))
    for pair in ((insertions(), out), (None, insertions())):
        closed: Cell = [None] * len(CELLS)
        joined(pair[0] or out, pair[1], closed)
        out = closed
    return out


def parse(leaves: list[Cell]) -> Cell:
    """The cell of all leaves together, from all their spans by growing length and all places to split a span."""
    spans = {(i, i + 1): leaf for i, leaf in enumerate(leaves)}
    for size in range(2, len(leaves) + 1):
        for i in range(len(leaves) - size + 1):
            best: Cell = [None] * len(CELLS)
            for k in range(i + 1, i + size):
                joined(spans[i, k], spans[k, i + size], best)
            spans[i, i + size] = best
    return spans[0, len(leaves)]


def breaks(roles: str) -> int:
    """Neighbouring roles that must not follow each other."""
    return sum(a + b not in LEGAL for a, b in zip(roles, roles[1:]))


PLAIN = str.maketrans("SUAO1234", "suaosuao")
PARSED = "cells array<struct<cost:long,audit:string>>, ends string, illegal long"
CELL = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))


def _shown(cell: Cell) -> list[dict | None]:
    return [None if x is None else {"cost": x[0], "audit": x[1]} for x in cell]


def _read(cell: list[dict | None]) -> Cell:
    return [None if x is None else (x["cost"], x["audit"]) for x in cell]


def _out(part: pa.RecordBatch, kept: list[str], found: list[tuple[list, str, int]]) -> pa.RecordBatch:
    cells, ends, illegal = zip(*found) if found else ([], [], [])
    columns = [pa.array(cells, CELL), pa.array(ends, pa.string()), pa.array(illegal, pa.int64())]
    return pa.RecordBatch.from_arrays([part.column(n) for n in kept] + columns, [*kept, "cells", "ends", "illegal"])


KEPT = ["_conv", "_total", "block"]


def parse_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of every block of symbols; equal blocks are parsed once."""
    leaf: dict[str, Cell] = {}
    memo: dict[str, tuple[list, str, int]] = {}
    for part in pieces(batches, 2000):
        found = []
        for symbols in part.column("symbols").to_pylist():
            if symbols not in memo:
                for c in symbols:
                    if c not in leaf:
                        leaf[c] = row_cell(c)
                if len(memo) >= MEMO:
                    memo.clear()
                roles = symbols.translate(PLAIN)
                memo[symbols] = (_shown(parse([leaf[c] for c in symbols])), roles[0] + roles[-1], breaks(roles))
            found.append(memo[symbols])
        yield _out(part, KEPT, found)


def parse_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of every group of neighbouring spans."""
    for part in pieces(batches, 16):
        found = []
        for spans in part.column("spans").to_pylist():
            spans.sort(key=lambda s: s["block"])
            ends = [s["ends"] for s in spans]
            illegal = sum(s["illegal"] for s in spans) + sum(a[1] + b[0] not in LEGAL for a, b in zip(ends, ends[1:]))
            found.append((_shown(parse([_read(s["cells"]) for s in spans])), ends[0][0] + ends[-1][1], illegal))
        yield _out(part, KEPT, found)


def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cost and audit of whole conversations: everything deleted, or an end after an assistant turn."""
    for part in batches:
        best = []
        for cells in part.column("cells").to_pylist():
            best.append(min((c["cost"], c["audit"]) for c in (cells[INDEX[0, 0]], cells[INDEX[0, 3]]) if c))
        columns = [pa.array([c for c, _ in best], pa.int64()), pa.array([a for _, a in best], pa.string())]
        yield pa.RecordBatch.from_arrays(
            [part.column("_conv"), part.column("illegal"), *columns], ["_conv", "illegal", "cost", "edits"]
        )


def survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per turn of the repaired conversation: its place, the row it comes from, and its role if that is new."""
    for part in pieces(batches, 200, 1_000_000):
        for i, edits in enumerate(part.column("edits").to_pylist()):
            letters = np.frombuffer(edits.encode(), dtype="S1")
            source = np.cumsum(letters != b"I") - 1
            stays = letters != b"D"
            place = np.cumsum(stays) - 1 - ("L" in edits)
            new = (letters == b"I") | (letters == b"R")
            roles = np.where(new, np.where(place % 2, "assistant", "user"), None)
            n = int(stays.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("_conv").take(pa.array(np.repeat(i, n), pa.int64())),
                    pa.array(np.arange(n, dtype=np.int64)),
                    pa.array(np.where(letters == b"I", -1, source)[stays], pa.int64()),
                    pa.array(roles[stays], pa.string()),
                    pa.array(np.where(letters == b"L", b"K", letters)[stays].astype("U1"), pa.string()),
                ],
                names=["_conv", "place", "pos", "new_role", "edit"],
            )


class Repair(NamedTuple):
    """``report``: a row per conversation.  ``turns``: a row per turn of the repaired conversations."""

    report: DataFrame
    turns: DataFrame


def repair_conversations(rows: DataFrame, conversations: DataFrame | None = None, id_col: str = "conv_id") -> Repair:
    """Find the faults of every conversation and repair its structure at the least cost.

    Reads the columns ``id_col``, ``turn``, ``role`` and ``text``; a null role or text is one space, a null id is a
    conversation of its own.  Rows go by turn, nulls first; rows of one turn by role and a digest of the text, so
    repeated rows stand together.  A row's first fault counts: blank (only 0x20 and 0x09-0x0D), duplicate (role and text stood before in
    the conversation), truncated (its last other character is none of ``.!?``).

    ``report``: the id, ``gaps`` (turns missing between the least and the greatest), ``blank``, ``duplicate``,
    ``truncated``, ``illegal`` (neighbours whose roles do not begin with su, ua or au), ``cost``, ``audit``.  A
    conversation of ``conversations`` (a table with the id) without rows has zeros and an empty audit.
    ``turns``: the id, ``place`` from 0, ``role``, ``text``, ``edit`` (K, R or I).  Ties between repairs of equal cost
    go to the least audit.  Empty tables give empty results; other columns are not read.
    """
    some = rows.select(
        F.col(f"`{id_col}`").alias("_conv"),
        F.col("turn").alias("_turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("_role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("_text"),
    )
    tag = F.unhex(F.md5(F.concat(F.length("_role").cast("string"), F.lit(":"), "_role", "_text").cast("binary")))
    first = F.substring("_role", 1, 1)
    slim = some.select(
        "_conv",
        "_turn",
        "_role",
        tag.alias("_tag"),
        F.when(first.isin("s", "u", "a"), first).otherwise("o").alias("_kind"),
        (~F.col("_text").rlike(r"[^\x20\x09-\x0D]")).alias("_blank"),
        (~F.col("_text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("_cut"),
    )
    order = [F.col("_turn").asc_nulls_first(), F.col("_role"), F.col("_tag")]
    numbered = number_rows(slim, order, ["_conv"], "pos")
    numbered = numbered.withColumns({n: F.col(n).cast("long") for n in ("pos", "_total")})
    seen = numbered.groupBy("_conv", "_tag").agg(F.min("pos").alias("_first"), F.count(F.lit(1)).alias("_times"))
    seen = broadcast_if_small(seen.where("_times > 1").select(F.col("_conv").alias("_c"), F.col("_tag").alias("_t"), "_first"))
    match = numbered["_conv"].eqNullSafe(seen["_c"]) & (numbered["_tag"] == seen["_t"])
    again = F.coalesce(F.col("pos") > F.col("_first"), F.lit(False))
    fault = F.when(F.col("_blank"), "blank").when(again, "duplicate").when(F.col("_cut"), "truncated")
    judged = numbered.join(seen, match, "left").withColumn("_fault", fault)
    symbol = (
        F.when(F.col("_fault").isin("blank", "duplicate"), F.translate("_kind", "suao", "1234"))
        .when(F.col("_fault") == "truncated", F.upper("_kind"))
        .otherwise(F.col("_kind"))
    )
    judged = written(judged.select("_conv", "_turn", "_tag", "pos", "_total", "_fault", symbol.alias("_symbol")), "turns")

    def tally(which: str):
        return F.count_if(F.col("_fault") == which).alias(which)

    span = F.max("_turn") - F.min("_turn") + 1 - F.count_distinct("_turn")
    counts = judged.groupBy("_conv").agg(
        F.coalesce(span, F.lit(0)).cast("long").alias("gaps"), tally("blank"), tally("duplicate"), tally("truncated")
    )

    key = some.schema["_conv"].dataType.simpleString()
    fields = f"_conv {key}, _total long, block long, {PARSED}"
    listed = F.array_sort(F.collect_list(F.struct("pos", "_symbol")))
    blocks = judged.groupBy("_conv", "_total", F.floor(F.col("pos") / BLOCK).alias("block")).agg(
        F.array_join(F.transform(listed, lambda s: s["_symbol"]), "").alias("symbols")
    )
    level = blocks.mapInArrow(parse_blocks, fields)
    most = judged.agg(F.max("_total")).first()[0] or 0
    done, size = [], BLOCK
    while size < most:
        level = written(level, "spans")
        done.append(level.where(F.col("_total") <= size))
        open_ = level.where(F.col("_total") > size)
        spans = F.collect_list(F.struct("block", "cells", "ends", "illegal")).alias("spans")
        grouped = open_.groupBy("_conv", "_total", F.floor(F.col("block") / BLOCK).alias("block")).agg(spans)
        level, size = grouped.mapInArrow(parse_level, fields), size * BLOCK
    for part in done:
        level = level.unionByName(part)
    found = written(level.mapInArrow(roots, f"_conv {key}, illegal long, cost long, edits string"), "repairs")

    shown = found.withColumn("audit", F.translate("edits", "L", "K")).drop("edits")
    report = counts.join(shown.withColumnRenamed("_conv", "_c"), F.col("_conv").eqNullSafe(F.col("_c"))).drop("_c")
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    if conversations is not None:
        every = conversations.select(F.col(f"`{id_col}`").alias("_every")).distinct()
        report = every.join(report, F.col("_every").eqNullSafe(F.col("_conv")), "left").drop("_conv")
        report = report.withColumnRenamed("_every", "_conv")
    report = report.select(
        F.col("_conv").alias(id_col),
        *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in names],
        F.coalesce("audit", F.lit("")).alias("audit"),
    )

    places = found.where("edits <> ''").mapInArrow(
        survivors, f"_conv {key}, place long, pos long, new_role string, edit string"
    )
    source = judged.select(F.col("_conv").alias("_c"), F.col("pos").alias("_p"), "_tag")
    placed = places.join(source, F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("pos") == F.col("_p")), "left")
    placed = placed.select("_conv", "place", "new_role", "edit", "_tag")
    texts = some.select(F.col("_conv").alias("_c"), tag.alias("_t"), "_role", "_text").groupBy("_c", "_t")
    texts = texts.agg(F.first(F.struct("_role", "_text")).alias("_row"))
    turns = placed.join(texts, F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_tag") == F.col("_t")), "left")
    turns = turns.select(
        F.col("_conv").alias(id_col),
        "place",
        F.coalesce("new_role", "_row._role").alias("role"),
        F.coalesce("_row._text", F.lit("")).alias("text"),
        "edit",
    )
    return Repair(report, turns)
