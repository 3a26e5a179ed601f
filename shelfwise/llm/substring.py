"""Removal of repeated word windows, found level by level at doubling lengths.

Level one looks at windows of half the length.  It need not look at all of them: every full window picks the one of
its halves-to-be with the smallest hash, so two equal full windows pick the same words at the same place, and only
about one half window in six is ever sent (a seed).  Seeds that occur once die.  Those that occur again are extended
to the full length: a seed's stretch is the run of full windows that picked it.  Equal stretches are settled as one;
only stretches that share a seed but differ are compared window by window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.ordering import number_rows
from shelfwise.llm.common import as_bytes, batch, keyed, mix, pieces, written


def rolling(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` consecutive word hashes, by doubling."""
    if len(words) < length:
        return words[:0]
    size, found = 1, words
    while 2 * size <= length:
        found, size = mix(found[:-size], found[size:]), 2 * size
    rest = length - size
    return mix(found[: len(found) - rest], found[rest:]) if rest else found


def stretches(words: list[bytes], window: int, seed: int) -> dict[str, np.ndarray]:
    """Runs of full windows that picked the same seed: seed hash, stretch hash, first window, number of windows."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    whole, seeds = rolling(hashes, window), rolling(hashes, seed)
    choices = np.lib.stride_tricks.sliding_window_view(seeds, window - seed + 1)
    picked = choices.argmin(axis=1) + np.arange(len(whole))
    first = np.concatenate([[0], np.flatnonzero(np.diff(picked)) + 1])
    last = np.concatenate([first[1:], [len(whole)]]) - 1
    place = picked[first]
    shape = ((last - first) << 20 | (place - first)).astype(np.uint64)
    stretch = mix(mix(whole[first], whole[last]), shape)
    return {"seed": seeds[place], "stretch": stretch, "start": first, "n": last - first + 1, "whole": whole}


def _occurrences(window: int, seed: int, only_seeds: bool):
    fields = [("seed", pa.int64())]
    if not only_seeds:
        fields += [("stretch", pa.int64()), ("key", pa.int64()), ("start", pa.int32()), ("n", pa.int32())]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, 500):
            out: dict[str, list] = {name: [] for name, _ in fields}
            for key, text in zip(part.column(0).to_pylist(), as_bytes(part.column(1))):
                words = text.split()
                if len(words) < window:
                    continue
                found = stretches(words, window, seed)
                out["seed"].append(found["seed"].view(np.int64))
                if not only_seeds:
                    out["stretch"].append(found["stretch"].view(np.int64))
                    out["key"].append(np.full(len(found["seed"]), key))
                    out["start"].append(found["start"].astype(np.int32))
                    out["n"].append(found["n"].astype(np.int32))
            if out["seed"]:
                yield batch(schema, **{k: np.concatenate(v) for k, v in out.items()})

    return run


def _windows(window: int):
    """Every full window of the given stretches."""
    schema = pa.schema([("seed", pa.int64()), ("whole", pa.int64()), ("key", pa.int64()), ("start", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, 200):
            out: dict[str, list] = {f.name: [] for f in schema}
            for key, text, spans in zip(part.column(0).to_pylist(), as_bytes(part.column(1)), part.column(2).to_pylist()):
                words = text.split()
                whole = rolling(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)), window)
                for s in spans:
                    at = np.arange(s["start"], s["start"] + s["n"])
                    out["seed"].append(np.full(len(at), s["seed"]))
                    out["whole"].append(whole[at].view(np.int64))
                    out["key"].append(np.full(len(at), key))
                    out["start"].append(at.astype(np.int32))
            if out["seed"]:
                yield batch(schema, **{k: np.concatenate(v) for k, v in out.items()})

    return run


def _removed(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, 200):
            totals, gone, kept, spans = [], [], [], []
            for text, covers in zip(as_bytes(part.column(1)), part.column(2).to_pylist()):
                words = text.split()
                totals.append(len(words))
                if not covers:
                    gone.append(0)
                    kept.append(b" ".join(words))
                    spans.append([])
                    continue
                edges = np.zeros(len(words) + 1, dtype=np.int64)
                start = np.array([c["start"] for c in covers])
                np.add.at(edges, start, 1)
                np.add.at(edges, start + np.array([c["n"] for c in covers]) - 1 + window, -1)
                out = np.cumsum(edges)[:-1] > 0
                turns = np.flatnonzero(np.diff(np.concatenate([[0], out, [0]]).astype(np.int8))).reshape(-1, 2)
                gone.append(int(out.sum()))
                kept.append(b" ".join([words[i] for i in np.flatnonzero(~out).tolist()]))
                spans.append([{"start": int(a), "end": int(b)} for a, b in turns])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(totals, pa.int64()),
                    pa.array(gone, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                ],
                names=["_id", "n_words", "n_removed", "kept_text", "removed"],
            )

    return run


def _with_keys(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """(_id, _text, key), and whether a key can repeat; ``key`` orders documents: the id where it is a unique number."""
    rows = keyed(docs, id_col, text_col)
    if isinstance(rows.schema["_id"].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        size = rows.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("_id").alias("ids")).first()
        if size["n"] == size["ids"]:
            return rows.withColumn("key", F.col("_id").cast("long")), False
    tagged = rows.withColumn("_tag", F.xxhash64("_text"))
    keys = number_rows(tagged.select("_id", "_tag").distinct(), [F.col("_id"), F.col("_tag")], (), "key")
    keys = keys.select(F.col("_id").alias("_kid"), F.col("_tag").alias("_ktag"), F.col("key").cast("long"))
    match = tagged._id.eqNullSafe(keys._kid) & (tagged._tag == keys._ktag)
    return tagged.join(keys, match).select("_id", "_text", "key"), True


def drop_repeated_windows(
    docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per input row: the id, ``n_words``, ``n_removed``, ``kept_text`` and the ``removed`` word spans.

    A word goes if a window of ``window`` words that covers it also starts earlier: in a document with a smaller id,
    or earlier in the same one.  Windows are judged on the input.  Words are runs of bytes other than space and
    0x09-0x0D.  A null text has no words; a document shorter than the window keeps all of them.  A null id comes
    before all others; rows that share an id are ordered by a hash of their text, and wholly equal rows are one
    document with the same result in each row.  An empty table gives an empty result; other columns are not read.
    """
    seed = max(1, window // 2)
    rows, repeated = _with_keys(docs, id_col, text_col)
    texts = rows.select("key", "_text")
    once = texts.dropDuplicates(["key"]) if repeated else texts
    # what a join needs of an aggregate is written first: then both of its sides are plain shuffles, and the planner
    # can split the partition of a hot seed
    seeds = once.mapInArrow(_occurrences(window, seed, True), "seed long").groupBy("seed")
    again = written(seeds.agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("seed"), "again")
    fields = "seed long, stretch long, key long, start int, n int"
    alive = written(
        once.mapInArrow(_occurrences(window, seed, False), fields).join(again, "seed", "left_semi"), "seeds"
    )
    place = F.struct("key", "start")
    firsts = written(
        alive.groupBy("seed", "stretch").agg(
            F.min(place).alias("first"), F.first("n").alias("n"), F.count(F.lit(1)).alias("times")
        ),
        "stretches",
    )
    later = (
        alive.join(written(firsts.where("times > 1").select("seed", "stretch", "first"), "repeated"), ["seed", "stretch"])
        .where((F.col("key") != F.col("first.key")) | (F.col("start") != F.col("first.start")))
        .select("key", "start", "n")
    )
    kinds = firsts.groupBy("seed").agg(F.count(F.lit(1)).alias("kinds"))
    shared = written(kinds.where("kinds > 1").select("seed"), "shared")
    unlike = (
        firsts.join(shared, "seed", "left_semi")
        .select(F.col("first.key").alias("key"), F.struct("seed", F.col("first.start").alias("start"), "n").alias("s"))
        .groupBy("key")
        .agg(F.collect_list("s").alias("spans"))
    )
    fields = "seed long, whole long, key long, start int"
    extended = written(
        once.join(unlike, "key").select("key", "_text", "spans").mapInArrow(_windows(window), fields), "windows"
    )
    earliest = extended.groupBy("seed", "whole").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times"))
    earliest = written(earliest.where("times > 1").select("seed", "whole", "first"), "earliest")
    single = (
        extended.join(earliest, ["seed", "whole"])
        .where((F.col("key") != F.col("first.key")) | (F.col("start") != F.col("first.start")))
        .select("key", "start", F.lit(1).alias("n"))
    )
    covers = later.unionByName(single).groupBy("key").agg(F.collect_list(F.struct("start", "n")).alias("covers"))
    id_type = rows.schema["_id"].dataType.simpleString()
    out = "n_words long, n_removed long, kept_text string, removed array<struct<start:int,end:int>>"
    return (
        rows.join(covers, "key", "left")
        .select("_id", "_text", "covers")
        .mapInArrow(_removed(window), f"_id {id_type}, {out}")
        .withColumnRenamed("_id", id_col)
    )
