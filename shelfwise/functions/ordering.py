"""Positions, running totals, neighbours and exact quantiles without a one-task sort.

A window without a partition, or one partitioned by a column with a hot value,
sends all of those rows to one task.  The helpers here range-partition the rows
on the full sort key (so a hot value is spread over many partitions), write that
layout once, and add per-partition offsets.  The offset table has one row per
(partition, key) pair that really meets, never one per row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import broadcast_if_small, cut_lineage

_ROW_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the row index in its low 33 bits


def _laid_out(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    ordered = cut_lineage(df.orderBy(*[F.col(k) for k in keys], *order_by))
    return ordered.withColumns(
        {
            "_pid": F.spark_partition_id(),
            "_idx": F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)),
        }
    )


def _attach(rows: DataFrame, offsets: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = offsets.select(
        F.col("_pid").alias("_opid"),
        *[F.col(k).alias(f"_o_{k}") for k in keys],
        *[c for c in offsets.columns if c not in ("_pid", *keys)],
    )
    match = F.col("_pid") == F.col("_opid")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    return rows.join(broadcast_if_small(renamed), match).drop("_opid", *[f"_o_{k}" for k in keys])


def number_rows(
    df: DataFrame, order_by: Sequence[Column], keys: Sequence[str] = (), name: str = "position"
) -> DataFrame:
    """Add the 0-based position of each row within ``keys``; ``order_by`` must be total.

    Also adds ``_total``, the number of rows of the key.
    """
    rows = _laid_out(df, keys, order_by)
    earlier = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_pid", *keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_idx").alias("_first"))
        .withColumn("_skip", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn("_total", F.sum("_n").over(Window.partitionBy(*keys)))
        .drop("_n")
    )
    return (
        _attach(rows, offsets, keys)
        .withColumn(name, F.col("_idx") - F.col("_first") + F.col("_skip"))
        .drop("_pid", "_idx", "_first", "_skip")
    )


def running_totals(
    df: DataFrame, order_by: Sequence[Column], values: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Add ``<value>_before`` (sum over earlier rows of the key) and ``<value>_total``."""
    rows = _laid_out(df, keys, order_by)
    earlier = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = rows.groupBy("_pid", *keys).agg(*[F.sum(v).alias(f"_s_{v}") for v in values])
    offsets = offsets.withColumns(
        {f"_skip_{v}": F.coalesce(F.sum(f"_s_{v}").over(earlier), F.lit(0)) for v in values}
        | {f"{v}_total": F.sum(f"_s_{v}").over(whole) for v in values}
    ).drop(*[f"_s_{v}" for v in values])
    inside = Window.partitionBy("_pid", *keys).orderBy("_idx").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({f"_in_{v}": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values})
    out = _attach(rows, offsets, keys)
    out = out.withColumns({f"{v}_before": F.col(f"_in_{v}") + F.col(f"_skip_{v}") for v in values})
    return out.drop("_pid", "_idx", *[f"_in_{v}" for v in values], *[f"_skip_{v}" for v in values])


def previous_values(
    df: DataFrame, order_by: Sequence[Column], values: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Add ``<value>_previous``: the value of the row before, within ``keys``; null in the first row of a key.

    ``order_by`` must be total.  Every range partition hands the last row of each of its keys on to the next one that
    has rows of the key, so a long series is spread over many tasks.
    """
    rows = _laid_out(df, keys, order_by)
    whole = F.struct(*values)
    boundary = rows.groupBy("_pid", *keys).agg(F.max_by(whole, "_idx").alias("_end"))
    handed = F.lag("_end").over(Window.partitionBy(*keys).orderBy("_pid"))
    boundary = boundary.withColumn("_handed", handed).drop("_end")
    inside = F.lag(whole).over(Window.partitionBy("_pid", *keys).orderBy("_idx"))
    out = _attach(rows.withColumn("_before", inside), boundary, keys)
    out = out.withColumn("_before", F.coalesce("_before", "_handed"))
    return out.withColumns({f"{v}_previous": F.col(f"_before.{v}") for v in values}).drop("_pid", "_idx", "_before", "_handed")


BUCKETS = 2048  # per target and pass
LISTED = 4096  # values of a target's last bucket that are listed at once


def select_ranks(df: DataFrame, value: str, targets: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``targets`` (keys, rank, lo, hi, n) with the ``found`` value at each 0-based rank, by narrowing histograms.

    A pass counts a target's values in equal buckets between its bounds, the bounds themselves in buckets of their own,
    and goes on with the bucket that holds the rank and that bucket's true least and greatest value, until these are
    equal or few enough values are left to be listed.  Rows are neither sorted nor shuffled, only partial counts are.
    """
    open_ = targets.withColumn("before", F.lit(0).cast("long"))
    renamed = {k: f"_k{i}" for i, k in enumerate(keys)}
    match = [F.col(k).eqNullSafe(F.col(r)) for k, r in renamed.items()]
    done = []

    def inside(part: DataFrame) -> DataFrame:
        part = broadcast_if_small(part.select(*[F.col(k).alias(r) for k, r in renamed.items()], "rank", "lo", "hi", "before"))
        met = df.join(part, match or F.lit(True)).where(F.col(value).between(F.col("lo"), F.col("hi")))
        return met.drop(*renamed.values())

    while True:
        open_ = cut_lineage(open_)
        single, few = F.col("lo") == F.col("hi"), F.col("n") <= LISTED
        done.append(open_.where(single).select(*keys, "rank", F.col("lo").alias("found")))
        short = open_.where(~single & few)
        if not short.isEmpty():
            listed = inside(short).groupBy(*keys, "rank", "before").agg(F.sort_array(F.collect_list(value)).alias("values"))
            at = F.get("values", (F.col("rank") - F.col("before")).cast("int"))
            done.append(listed.select(*keys, "rank", at.alias("found")))
        open_ = open_.where(~single & ~few)
        if open_.isEmpty():
            return reduce(DataFrame.unionByName, done)
        share = F.nanvl((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")), F.lit(0.0))
        middle = F.least(F.greatest(F.floor(share * (BUCKETS - 2)) + 1, F.lit(1)), F.lit(BUCKETS - 2))
        bucket = F.when(F.col(value) == F.col("lo"), 0).when(F.col(value) == F.col("hi"), BUCKETS - 1).otherwise(middle)
        counted = inside(open_).groupBy(*keys, "rank", "before", bucket.cast("int").alias("bucket")).agg(
            F.count(F.lit(1)).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")
        )
        earlier = Window.partitionBy(*keys, "rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        start = F.col("before") + F.coalesce(F.sum("n").over(earlier), F.lit(0))  # at most BUCKETS rows a window
        counted = counted.withColumn("before", start)
        open_ = counted.where((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("n"))).drop("bucket")


def quantiles(
    df: DataFrame,
    value: str,
    probabilities: dict[str, float],
    keys: Sequence[str] = (),
    approximate: bool = False,
    accuracy: int = 100_000,
) -> DataFrame:
    """Exact linear-interpolated quantiles per key, as one column per named probability.

    Values are selected by their rank without sorting the rows.  ``approximate`` swaps in the mergeable sketch.  Nulls
    are left out; keys without values do not appear; without keys an empty input gives nulls.
    """
    present = df.where(F.col(value).isNotNull())
    if approximate:
        return present.groupBy(*keys).agg(
            *[F.percentile_approx(value, p, accuracy).alias(n) for n, p in probabilities.items()]
        )
    present = cut_lineage(present.select(*keys, F.col(value).cast("double").alias("_v")))
    sizes = present.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    sizes = cut_lineage(sizes.withColumn("_all", F.lit(0)))
    places = {name: (F.col("n") - 1) * F.lit(float(p)) for name, p in probabilities.items()}
    ranks = F.array_distinct(F.array(*[f(h).cast("long") for h in places.values() for f in (F.floor, F.ceil)]))
    found = select_ranks(present, "_v", sizes.where("n > 0").withColumn("rank", F.explode(ranks)), keys)
    values = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "found"))).alias("_values"))
    values = values.withColumn("_all", F.lit(0))  # written on both sides, so that without keys it is a plain join too
    match = [sizes[k].eqNullSafe(values[k]) for k in keys] or sizes["_all"] == values["_all"]
    joined = sizes.join(broadcast_if_small(values), match, "left")
    out = []
    for name, h in places.items():
        low, high = (F.element_at("_values", f(h).cast("long")) for f in (F.floor, F.ceil))
        out.append((low + (high - low) * (h - F.floor(h))).alias(name))
    return joined.select(*[sizes[k] for k in keys], *out)
