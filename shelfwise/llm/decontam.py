"""Benchmark decontamination in DataFrame functions alone: SimHash of item-sized windows, then exact similarity.

A window that reaches the similarity shares nearly all shingles with its item, so among any few consecutive shingles
of it one is shared; the stride follows from the items.  In documents that show a shared shingle at that stride all
shingles are looked up, and every item-sized window with as many shared ones as the similarity asks for is proposed,
in whatever order the item's parts stand.  Proposed windows get a SimHash, and an index over Hamming blocks of the items' fingerprints
gives every item of that size within the radius; weighted shingle similarity then decides exactly.
"""

from __future__ import annotations

from itertools import combinations
from math import floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import keyed, written
from shelfwise.session import cut_lineage, shuffled

BITS = 64
BROADCAST_WORDS = 200_000  # a benchmark of more words, or of more than a hundredth as many items, is joined by shuffle


def word_array(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def bound(value: Column, use) -> Column:
    """``use(v)`` with ``value`` computed once per row, also where ``use`` needs it in an inner function."""
    return F.element_at(F.transform(F.array(value), use), 1)


def shingle_hash(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(words, at + k) for k in range(size)])


def all_hashes(words: Column, size: int) -> Column:
    """Hashes of all shingles of ``size`` words; of fewer words, one hash of what there is."""
    last = F.greatest(F.size(words) - size, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: shingle_hash(words, i, size))


def simhash(hashes: Column) -> Column:
    """Bits set in more than half of the hashes."""

    def bit(acc: Column, b: Column) -> Column:
        ones = F.aggregate(hashes, F.lit(0), lambda n, h: n + F.getbit(h, b).cast("int"))
        return F.when(2 * ones > F.size(hashes), acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), b))).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("long"), bit)


def weighted_similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard of two shingle lists, a shingle's weight being how often it stands in the list."""
    times = lambda xs, x: F.size(F.filter(xs, lambda y: y == x))
    shared = F.aggregate(
        F.array_intersect(a, b), F.lit(0), lambda n, x: n + F.least(times(a, x), times(b, x))
    )
    return shared / (F.size(a) + F.size(b) - shared)


def shingle_texts(words: Column, size: int) -> Column:
    last = F.greatest(F.size(words) - size, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(words, i + 1, size), " "))


def missing_share(similarity: float) -> float:
    """The largest share of a similar enough window's shingles that its item does not hold."""
    return 1 - 2 * similarity / (1 + similarity)


def full_windows(places: Column, size: Column, n: Column, shingles: Column, least: Column) -> Column:
    """Starts of all windows of ``n`` among ``size`` words that cover ``least`` of the sorted ``places`` or more."""

    def starts(k: Column) -> Column:
        low = F.greatest(F.get(places, k + least - 1) - shingles + 1, F.lit(0))
        high = F.least(F.get(places, k), size - n)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    firsts = F.sequence(F.lit(0), F.size(places) - least)
    found = F.when(F.size(places) >= least, F.array_distinct(F.flatten(F.transform(firsts, starts))))
    return F.when(size < n, F.array(F.lit(0))).otherwise(found)


def stride_for(shingles: int, similarity: float) -> int:
    """The widest stride at which a similar enough window of ``shingles`` shingles still shows a shared one."""
    missing = floor(shingles * missing_share(similarity) + 1e-9)
    return max(t for t in range(1, shingles + 1) if t == 1 or shingles // t > missing)


def _sampled(size: int, stride: int):
    """Every ``stride``-th shingle of a word list: place, hash and the list's size."""

    def hashes(words: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(words) - size, F.lit(stride))
        one = lambda i: F.struct(
            i.alias("i"), shingle_hash(words, i, size).alias("h"), F.size(words).alias("size")
        )
        return F.when(F.size(words) >= size, F.transform(places, one))

    return hashes


def _blocks(count: int) -> list[tuple[int, int]]:
    """(shift, width) of ``count`` blocks that cover all bits."""
    edges = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _block_values(fp: Column, count: int) -> list[Column]:
    return [
        F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1)).cast("int")
        for shift, width in _blocks(count)
    ]


def hamming_index(items: DataFrame, radius: int, count: int) -> DataFrame:
    """Every item under all block values a fingerprint within ``radius`` bits can have in at least one block.

    With ``count`` blocks one of them differs in at most ``radius // count`` bits, so those neighbours are listed.
    """
    near = radius // count
    entries = []
    for j, ((_, width), value) in enumerate(zip(_blocks(count), _block_values(F.col("item_fp"), count))):
        flips = [sum(1 << p for p in c) for k in range(near + 1) for c in combinations(range(width), k)]
        # one lambda over a constant list: an expression per flip would make a method whose compiling fills the driver's memory
        values = F.transform(F.array(*map(F.lit, flips)), lambda f: value.bitwiseXOR(f))  # noqa: B023
        entries.append(F.struct(F.lit(j).alias("block"), values.alias("values")))
    listed = items.withColumn("e", F.explode(F.array(*entries)))
    return listed.select("*", F.col("e.block").alias("block"), F.explode("e.values").alias("value")).drop("e")


def benchmark_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = 0.8,
    shingle: int = 5,
    radius: int = 20,
    blocks: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per document and item it contains: ids, ``start_word``, ``n_words``, ``distance``, ``similarity``.

    A document contains an item if any window of the item's number of words has a
    fingerprint within ``radius`` bits of the item's and a weighted shingle similarity of at least ``similarity``;
    of several windows the most similar, then the first, is given.  Words are lower-cased runs of letters and digits;
    an item of fewer than ``shingle`` words is one shingle.  Null or wordless texts and items match nothing; a
    document shorter than the item is compared whole.  Repeated rows give their rows once per distinct id and window;
    rows that share an id are one document; a null id is reported as null.  Empty tables give an empty result; other
    columns are not read.
    """
    spark = docs.sparkSession
    rows = keyed(docs, id_col, text_col)
    items = benchmark.select(F.col(f"`{item_col}`").alias("item"), word_array(F.col(f"`{item_text_col}`")).alias("iw"))
    items = cut_lineage(items.where(F.size("iw") > 0).withColumn("n", F.size("iw")))
    length = F.least(F.col("n"), F.lit(shingle))
    sizes = items.groupBy(length.alias("size")).agg(F.min("n"), F.collect_set(F.col("n")).alias("ns")).collect()
    total = items.agg(F.count(F.lit(1)).alias("items"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    small = total["words"] <= BROADCAST_WORDS and total["items"] <= BROADCAST_WORDS // 100
    met, lookups, indexed = [], [], []
    for row in sizes:  # at most ``shingle`` different lengths
        size = row["size"]
        own = items.where(length == size)
        stride = min(stride_for(n - size + 1, similarity) for n in row["ns"])
        hashed = cut_lineage(own.select("n", F.explode(all_hashes(F.col("iw"), size)).alias("h")).distinct())
        hashes = hashed.select("h").distinct()
        seen = rows.select("_id", F.explode(bound(word_array(F.col("_text")), _sampled(size, stride))).alias("s"))
        met.append(seen.select("_id", "s.h").join(F.broadcast(hashes) if small else hashes, "h", "left_semi").select("_id"))
        lookups.append((size, F.broadcast(hashed) if small else hashed))
        fp = bound(all_hashes(F.col("iw"), size), simhash)
        indexed.append(own.select("item", "n", "iw", fp.alias("item_fp")))
    id_type = rows.schema["_id"].dataType.simpleString()
    result = f"`{id_col}` {id_type}, `{item_col}` {items.schema['item'].dataType.simpleString()}"
    result += ", start_word int, n_words int, distance int, similarity double"
    if not met:
        return spark.createDataFrame([], result)
    some, index = met[0], indexed[0]
    for m, x in zip(met[1:], indexed[1:]):
        some, index = some.unionByName(m), index.unionByName(x)
    some = some.distinct().withColumnRenamed("_id", "_w")
    near_texts = written(rows.join(some, F.col("_id").eqNullSafe(F.col("_w")), "left_semi"), "met")
    proposals = None
    for size, hashed in lookups:
        every = near_texts.select("_id", F.explode(bound(word_array(F.col("_text")), _sampled(size, 1))).alias("s"))
        shared = every.select("_id", "s.i", "s.h", "s.size").join(hashed, "h")
        placed = shared.groupBy("_id", "size", "n").agg(F.sort_array(F.collect_set("i")).alias("places"))
        shingles = F.col("n") - size + 1
        least = shingles - F.floor(shingles * missing_share(similarity) + 1e-9).cast("int")
        starts = bound(F.col("places"), lambda p: full_windows(p, F.col("size"), F.col("n"), F.col("m"), F.col("least")))
        placed = placed.withColumn("m", shingles).withColumn("least", least).select("_id", "n", F.explode(starts).alias("start"))
        placed = placed.select("_id", F.struct("start", "n").alias("w"))
        proposals = placed if proposals is None else proposals.unionByName(placed)
    wanted = proposals.groupBy("_id").agg(F.collect_set("w").alias("ws"))
    texts = near_texts.join(wanted.withColumnRenamed("_id", "_w"), F.col("_id").eqNullSafe(F.col("_w")))
    windows = texts.select(
        "_id",
        F.explode(
            bound(
                word_array(F.col("_text")),
                lambda w: F.transform(
                    F.col("ws"),
                    lambda s: F.struct(s["start"].alias("start"), s["n"].alias("n"), F.slice(w, s["start"] + 1, s["n"]).alias("words")),
                ),
            )
        ).alias("s"),
    ).select("_id", "s.start", "s.n", F.array_join("s.words", " ").alias("window"))
    windows = cut_lineage(windows)
    # equal windows are judged once, however many documents share them
    alike = windows.select("n", "window").distinct().withColumn("ww", F.split("window", " "))
    fp = F.lit(None).cast("long")
    for row in sizes:
        size = row["size"]
        own = bound(all_hashes(F.col("ww"), size), simhash)
        fp = F.when(F.least(F.col("n"), F.lit(shingle)) == size, own).otherwise(fp)
    alike = cut_lineage(alike.withColumn("fp", fp).drop("ww"))
    # some 300 rows an item: joined by shuffle, as a broadcast would lie whole in the driver's memory
    listed = shuffled(hamming_index(index.select("item", "n", "item_fp"), radius, blocks))
    probes = alike.select("n", "fp").distinct().select(
        "n",
        "fp",
        F.posexplode(F.array(*_block_values(F.col("fp"), blocks))).alias("block", "value"),
    )
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    near = probes.join(listed, ["n", "block", "value"]).withColumn("distance", distance).where(F.col("distance") <= radius)
    near = near.select("n", "fp", "item", "distance").distinct()
    near = alike.join(near, ["n", "fp"]).select("n", "window", "item", "distance")
    words = index.select("item", "iw")
    judged = near.join(F.broadcast(words) if small else words, "item")
    own = theirs = F.array().cast("array<string>")
    for row in sizes:
        here = F.least(F.col("n"), F.lit(shingle)) == row["size"]
        own = F.when(here, shingle_texts(F.col("ww"), row["size"])).otherwise(own)
        theirs = F.when(here, shingle_texts(F.col("iw"), row["size"])).otherwise(theirs)
    judged = judged.withColumn("ww", F.split("window", " "))
    judged = judged.select("n", "window", "item", "distance", own.alias("own"), theirs.alias("theirs"))
    scored = bound(F.col("own"), lambda a: bound(F.col("theirs"), lambda b: weighted_similarity(a, b)))
    judged = judged.select("n", "window", "item", "distance", scored.alias("similarity"))
    judged = judged.where(F.col("similarity") >= similarity)
    found = windows.join(judged, ["n", "window"])
    best = F.min(F.struct((-F.col("similarity")).alias("s"), "start", "n", "distance"))
    return found.groupBy("_id", "item").agg(best.alias("b")).select(
        F.col("_id").alias(id_col),
        F.col("item").alias(item_col),
        F.col("b.start").alias("start_word"),
        F.col("b.n").alias("n_words"),
        F.col("b.distance").cast("int").alias("distance"),
        (-F.col("b.s")).alias("similarity"),
    )
