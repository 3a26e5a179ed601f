"""Token-id files with constant-time access by document key.

A file set is a Parquet table with one row per shard, in ascending key order.  A shard holds raw little-endian ids of
whole documents one after another, the documents' keys and boundaries in that order, and an index: a minimal perfect
hash of the distinct keys (hash and displace) whose slots give the place and number of the key's documents, with a
stored 32-bit fingerprint that tells foreign keys apart.  A lookup hashes the key, compares one fingerprint and one key,
and cuts the ids out of the payload.  Spark writes and reads the rows, so any file system it knows will do.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.ordering import running_totals
from shelfwise.llm.common import mix, pieces
from shelfwise.llm.tokens import WordEncoder

SHARD_BYTES = 4_000_000  # a shard ends with the document that reaches this; a longer document fills one of its own
WHOLE_NUMBERS = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
SHARD = (
    "part int, seq int, first_key long, last_key long, n_docs int, n_ids long, width int,"
    " keys binary, bounds binary, displace binary, slots binary, prints binary, places binary, payload binary"
)
MARK, PRINT = np.uint64(0x51AFD7ED558CCD25), np.uint64(0xA24BAED4963EE407)


def _spots(keys: np.ndarray, displacement: np.ndarray | int, size: int) -> np.ndarray:
    return (mix(keys, np.asarray(displacement).astype(np.uint64) + MARK) % np.uint64(size)).astype(np.int64)


def _prints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, np.full(len(keys), PRINT)) >> np.uint64(32)).astype("<u4")


def _buckets(keys: np.ndarray, count: int) -> np.ndarray:
    return (mix(keys, keys) % np.uint64(count)).astype(np.int64)


def build_index(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(displacement per bucket, slot of every key) for distinct unsigned keys; every slot is used once.

    Large buckets first, each takes the first displacement that throws all its keys on free slots; a bucket of one
    key is sent to a free slot by number, stored as a negative displacement.
    """
    n = len(keys)
    count = max(1, -(-n // 4))
    bucket = _buckets(keys, count)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=count)
    ends = np.cumsum(sizes)
    displacement, slot, free = np.zeros(count, dtype="<i4"), np.empty(n, dtype=np.int64), np.ones(n, dtype=bool)
    single = []
    for b in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[b])
        if size == 0:
            break
        mine = order[ends[b] - size : ends[b]]
        if size == 1:
            single.append((b, int(mine[0])))
            continue
        tries = 0
        while True:
            trial = np.arange(tries, tries + 32)
            spots = _spots(np.tile(keys[mine], (32, 1)), trial[:, None], n)
            good = free[spots].all(axis=1)
            if size > 1:
                ranked = np.sort(spots, axis=1)
                good &= (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
            if good.any():
                hit = int(good.argmax())
                displacement[b], slot[mine] = tries + hit, spots[hit]
                free[spots[hit]] = False
                break
            tries += 32
    for (b, key), spot in zip(single, np.flatnonzero(free).tolist()):
        displacement[b], slot[key] = -spot - 1, spot
    return displacement, slot


def find_slots(keys: np.ndarray, displacement: np.ndarray, size: int) -> np.ndarray:
    """The slot of every key; for a foreign key any slot."""
    d = displacement[_buckets(keys, len(displacement))]
    return np.where(d < 0, -d - 1, _spots(keys, np.maximum(d, 0), size))


def _shard(part: int, seq: int, keys: list[int], docs: list[bytes], width: int) -> dict:
    ids = [np.frombuffer(d, dtype="<u4") for d in docs]
    bounds = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype("<i8")
    every = np.array(keys, dtype=np.int64)
    places = np.argsort(every, kind="stable").astype("<i4")  # documents of one key side by side
    distinct, first, times = np.unique(every[places], return_index=True, return_counts=True)
    own = distinct.view(np.uint64)
    displacement, slot = build_index(own)
    slots, prints = np.empty((len(own), 2), dtype="<i4"), np.empty(len(own), dtype="<u4")
    slots[slot], prints[slot] = np.stack([first, times], axis=1), _prints(own)
    if (np.diff(places) == 1).all():
        places = places[:0]  # the documents' own order
    return {
        "part": part, "seq": seq, "first_key": int(every.min()), "last_key": int(every.max()), "n_docs": len(docs),
        "n_ids": int(bounds[-1]), "width": width, "keys": every.astype("<i8").tobytes(), "bounds": bounds.tobytes(),
        "displace": displacement.tobytes(), "slots": slots.tobytes(), "prints": prints.tobytes(),
        "places": places.tobytes(), "payload": np.concatenate(ids).astype(f"<u{width}").tobytes(),
    }


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode whole texts, close each with ``end_id``, and write the shards in ascending key order.

    The key of a whole-number id is the id; of another id, its 64-bit hash (the order is still by id).  A null or
    empty text is ``end_id`` alone.  A null id comes first, under the hash of null; rows with equal ids are separate
    documents side by side, ordered by a hash of their text.  Ids are stored in 2 bytes where the vocabulary allows.
    An empty table gives a file set without shards; other columns are not read.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    number = isinstance(rows.schema["_id"].dataType, WHOLE_NUMBERS)
    key = F.coalesce(F.col("_id").cast("long"), F.xxhash64("_id")) if number else F.xxhash64("_id")
    rows = rows.select("_id", F.xxhash64("_text").alias("_tag"), key.alias("_key"), "_text")
    rows = rows.repartitionByRange("_id", "_tag").sortWithinPartitions("_id", "_tag").select("_key", "_text")
    schema = T._parse_datatype_string(SHARD)
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = WordEncoder(tokenizer), TaskContext.get().partitionId()
        width = 2 if max(end_id + 1, encoder.tokenizer.get_vocab_size()) <= 1 << 16 else 4
        end, seq, held, keys, found = int(end_id).to_bytes(4, "little"), 0, 0, [], []
        arrow = pa.schema(
            [(n, pa.binary() if t == "binary" else pa.int64() if t == "bigint" else pa.int32()) for n, t in kinds]
        )

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([_shard(part, seq, keys, found, width)], schema=arrow)

        for some in pieces(batches, 500):
            for k, ids in zip(some.column(0).to_pylist(), encoder.batch(some.column(1))):
                ids += end
                keys.append(k)
                found.append(ids)
                held += len(ids)
                if held >= SHARD_BYTES:
                    yield row()
                    seq, held, keys, found = seq + 1, 0, [], []
        if keys:
            yield row()

    kinds = [(n, schema[n].dataType.simpleString()) for n in names]
    rows.mapInArrow(run, SHARD).write.option("compression", "zstd").parquet(path)


def _entries(shard: dict, keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``wanted``, document) of all documents with these keys; foreign keys find nothing."""
    slots, prints = np.frombuffer(shard["slots"], "<i4").reshape(-1, 2), np.frombuffer(shard["prints"], "<u4")
    places = np.frombuffer(shard["places"], "<i4")
    own = wanted.astype(np.int64).view(np.uint64)
    slot = find_slots(own, np.frombuffer(shard["displace"], "<i4"), len(slots))
    asked = np.flatnonzero(prints[slot] == _prints(own))
    first, times = slots[slot[asked]].T
    sure = keys[places[first] if len(places) else first] == wanted[asked]
    asked, first, times = asked[sure], first[sure], times[sure]
    at = np.repeat(first - np.concatenate([[0], np.cumsum(times)[:-1]]) if len(first) else first, times) + np.arange(times.sum())
    return np.repeat(asked, times), places[at] if len(places) else at


def _documents(batches: Iterator[pa.RecordBatch], wanted: np.ndarray | None, with_ids: bool):
    for some in batches:
        for i in range(some.num_rows):
            shard = some.slice(i, 1).to_pylist()[0]
            ids, bounds = np.frombuffer(shard["payload"], dtype=f"<u{shard['width']}"), np.frombuffer(shard["bounds"], "<i8")
            keys = np.frombuffer(shard["keys"], "<i8")
            if wanted is None:
                ask = np.unique(keys)
            else:
                ask = wanted[np.searchsorted(wanted, shard["first_key"]) : np.searchsorted(wanted, shard["last_key"], "right")]
            position, doc = _entries(shard, keys, ask)
            raw = [ids[a:b].astype("<u4").tobytes() for a, b in zip(bounds[doc].tolist(), bounds[doc + 1].tolist())]
            n = len(doc)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ask[position], pa.int64()),
                    pa.array(np.full(n, shard["part"]), pa.int32()),
                    pa.array(np.full(n, shard["seq"]), pa.int32()),
                    pa.array(bounds[doc], pa.int64()),
                    pa.array(bounds[doc + 1] - bounds[doc], pa.int64()),
                    pa.array([zlib.crc32(r) for r in raw], pa.int64()),
                    pa.array(raw if with_ids else [None] * n, pa.binary()),
                ],
                names=["key", "part", "seq", "local_start", "n_tokens", "ids_crc32", "ids"],
            )


ENTRY = "key long, part int, seq int, local_start long, n_tokens long, ids_crc32 long, ids binary"


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Every document: ``key``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``, ``ids``.

    Each is found through its shard's index.  ``ids`` are little-endian unsigned 32-bit, null unless asked for.
    """
    shards = spark.read.parquet(path)
    found = shards.mapInArrow(lambda batches: _documents(batches, None, with_ids), ENTRY)
    sizes = running_totals(shards.select("part", "seq", "n_ids"), [F.col("part"), F.col("seq")], ["n_ids"])
    sizes = sizes.select("part", "seq", F.col("n_ids_before").cast("long").alias("before"))
    out = found.join(sizes, ["part", "seq"])
    return out.select("key", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32", "ids")


def lookup(spark: SparkSession, path: str, keys: list[int]) -> DataFrame:
    """The documents of the given keys, ``ids`` included, from only those shards whose key range holds one of them.

    The ranges are read without the payloads; shards ordered by a whole-number id have ranges that meet at most at
    their ends, so a key opens one shard, or the few that its copies fill.
    """
    wanted = np.unique(np.array(keys, dtype=np.int64))
    shards = spark.read.parquet(path)

    def holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batches:
            low, high = some.column("first_key").to_numpy(), some.column("last_key").to_numpy()
            held = np.searchsorted(wanted, low) < np.searchsorted(wanted, high, side="right")
            yield some.select(["part", "seq"]).filter(pa.array(held))

    places = shards.select("part", "seq", "first_key", "last_key").mapInArrow(holding, "part int, seq int")
    found = places.collect()  # at most a few rows per key
    match = F.lit(False)
    by_part: dict[int, list[int]] = {}
    for row in found:
        by_part.setdefault(row["part"], []).append(row["seq"])
    for part, seqs in sorted(by_part.items()):
        match |= (F.col("part") == part) & F.col("seq").isin(seqs)
    return shards.where(match).mapInArrow(lambda batches: _documents(batches, wanted, True), ENTRY)
