"""Overview numbers, distributions and event-log aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.ordering import quantiles
from shelfwise.operators.prep import scalars

# fixed values: upper edges of scrape and training times in seconds
DURATION_EDGES = (0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0, 60.0)
TRAINING_EDGES = (1.0, 5.0, 10.0, 30.0, 60.0, 120.0, 300.0)


def overview_kpis(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("products"),
        F.avg("price").alias("avg_price"),
        F.avg("rating").alias("avg_rating"),
        F.sum("reviews_count").alias("total_reviews"),
        F.count_distinct("category").alias("categories"),
        (F.avg(F.when(F.col("availability"), 1.0).otherwise(0.0)) * 100).alias("pct_available"),
    )


def category_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("category").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "category")


def catalog_profile(df: DataFrame) -> DataFrame:
    """Per category: count, range and mean of positive prices, range of positive ratings."""
    price = F.when(F.col("price") > 0, F.col("price"))
    rating = F.when(F.col("rating") > 0, F.col("rating"))
    return df.groupBy("category").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        F.avg(price).alias("avg_price"),
        F.min(rating).alias("min_rating"),
        F.max(rating).alias("max_rating"),
    )


def category_stats(df: DataFrame) -> DataFrame:
    return (
        df.where(F.col("category").isNotNull())
        .groupBy("category")
        .agg(
            F.count("price").alias("n"),
            F.avg("price").alias("avg_price"),
            F.avg("rating").alias("avg_rating"),
            F.sum("reviews_count").alias("total_reviews"),
        )
    )


def category_movers(
    df: DataFrame,
    rising_share: float = 1.3,
    rising_rating: float = 4.2,
    declining_share: float = 0.6,
    declining_rating: float = 3.5,
    n: int = 6,
) -> DataFrame:
    """Rising and declining categories, at most ``n`` of each in alphabetical order."""
    stats = category_stats(df)
    mean = scalars(stats, m=F.avg("n"))["m"]
    rising = (F.col("n") > mean * rising_share) | (F.col("avg_rating") > rising_rating)
    declining = (F.col("n") < mean * declining_share) & (F.col("avg_rating") < declining_rating)

    def side(condition: Column, name: str) -> DataFrame:
        picked = stats.where(condition).orderBy("category").limit(n)
        return picked.select(F.lit(name).alias("direction"), "category", "n")

    return side(rising, "rising").unionByName(side(declining, "declining"))


def rating_stats(df: DataFrame, decimals: int = 2) -> DataFrame:
    return df.agg(
        F.count("rating").alias("n"),
        F.round(F.avg("rating"), decimals).alias("avg_rating"),
        F.round(F.min("rating"), decimals).alias("min_rating"),
        F.round(F.max("rating"), decimals).alias("max_rating"),
    )


def rating_bands(df: DataFrame) -> DataFrame:
    # fixed values: the three band names
    band = F.when(F.col("rating") < 3, "bas (<3)").when(F.col("rating") < 4, "moyen (3-4)").otherwise("haut (4-5)")
    return df.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"))


def category_list(df: DataFrame) -> DataFrame:
    return df.where(F.col("category").isNotNull()).select("category").distinct().orderBy("category")


def price_quantiles(df: DataFrame, approximate: bool = False) -> DataFrame:
    wanted = {"p25": 0.25, "median": 0.5, "p75": 0.75}
    return quantiles(df, "price", wanted, approximate=approximate)


def cluster_stats(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per cluster; label -1 is noise."""
    return df.groupBy(F.col(label).alias("cluster")).agg(
        F.count(F.lit(1)).alias("size"), (F.col(label) == -1).alias("is_noise")
    )


def tally(df: DataFrame, keys: Sequence[str], **conditions: Column) -> DataFrame:
    """Row count plus one conditional count per named condition."""
    counts = [F.count_if(c).alias(n) for n, c in conditions.items()]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *counts)


def entity_health(df: DataFrame, entity: str, ts: str, as_of: Column, timeout_seconds: float) -> DataFrame:
    """Last sign of life per entity and its state against a silence limit."""
    silence = F.unix_micros(as_of) - F.unix_micros(F.col("last_seen"))
    state = F.when(silence <= F.lit(int(timeout_seconds * 1_000_000)), "online").otherwise("offline")
    return df.groupBy(entity).agg(F.max(ts).alias("last_seen")).withColumn("state", state)


def alive_entities(
    df: DataFrame, entity: str, platform: str, ts: str, tie: str, wanted: str, generic: str, timeout_seconds: float
) -> DataFrame:
    """Entities heard of within the limit whose last platform is the wanted or the generic one."""
    now = scalars(df, now=F.max(ts))["now"]
    last = F.max(F.struct(F.col(ts), F.col(tie), F.col(platform).alias("p")))
    latest = df.groupBy(entity).agg(last.alias("_l")).select(entity, F.col(f"_l.{ts}").alias("last_seen"), F.col("_l.p").alias("platform"))
    recent = F.unix_micros(now) - F.unix_micros("last_seen") <= F.lit(int(timeout_seconds * 1_000_000))
    return latest.where(recent & F.col("platform").isin(wanted, generic))


def duration_histogram(
    df: DataFrame, value: str, edges: Sequence[float], keys: Sequence[str] = ()
) -> DataFrame:
    """Cumulative counts per upper edge, with +Inf, sum and count, from one conditional aggregate."""
    agg = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        *[F.count_if(F.col(value) <= e).alias(f"_b{i}") for i, e in enumerate(edges)],
        F.count(F.lit(1)).alias("total_count"),
        F.sum(value).alias("total_sum"),
    )
    buckets = [F.struct(F.lit(str(e)).alias("le"), F.col(f"_b{i}").alias("n")) for i, e in enumerate(edges)]
    buckets.append(F.struct(F.lit("+Inf").alias("le"), F.col("total_count").alias("n")))
    return agg.select(*keys, F.explode(F.array(*buckets)).alias("b"), "total_count", "total_sum").select(
        *keys, "b.le", "b.n", "total_count", "total_sum"
    )


def latest_gauges(df: DataFrame, metric: str, value: str, ts: str, tie: str) -> DataFrame:
    """Most recent value per metric."""
    newest = F.max(F.struct(F.col(ts), F.col(tie), F.col(value).alias("v")))
    return df.groupBy(F.col(metric).alias("metric")).agg(newest.alias("m")).select(
        "metric", F.col("m.v").alias("value"), F.col(f"m.{ts}").alias(ts)
    )


def task_outcomes(
    df: DataFrame,
    task: str,
    status: str,
    ts: str,
    tie: str,
    max_retries: int = 3,
    timeout_seconds: float = 300.0,
) -> DataFrame:
    """Final state per task: last status, failures so far and whether it outlived the time limit.

    A task is ``completed``, ``failed`` or open by its last record; more failures
    than ``max_retries`` make it failed for good, and an open task whose span
    exceeds the limit is a timeout.
    """
    last = F.max(F.struct(F.col(ts), F.col(tie), F.col(status).alias("s")))
    agg = df.groupBy(task).agg(
        last.alias("_l"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        F.count_if(F.col(status) == "failed").alias("failures"),
    )
    span = (F.unix_micros("last_ts") - F.unix_micros("first_ts")) / F.lit(1_000_000.0)
    agg = agg.withColumns({"last_status": F.col("_l.s"), "duration_seconds": span})
    outcome = (
        F.when(F.col("last_status") == "completed", "completed")
        .when(F.col("failures") > max_retries, "failed")
        .when(F.col("last_status") == "failed", "retrying")
        .when(F.col("duration_seconds") > timeout_seconds, "timeout")
        .otherwise(F.col("last_status"))
    )
    return agg.withColumns(
        {"retries": F.least(F.col("failures"), F.lit(max_retries)), "outcome": outcome}
    ).drop("_l")


def durations(df: DataFrame, task: str, ts: str) -> DataFrame:
    return df.groupBy(task).agg(
        F.min(ts).alias("started_at"),
        F.max(ts).alias("completed_at"),
        ((F.unix_micros(F.max(ts)) - F.unix_micros(F.min(ts))) / F.lit(1_000_000.0)).alias("seconds"),
    )


def tumbling_counts(df: DataFrame, ts: str, key: str, width: str = "5 minutes") -> DataFrame:
    return (
        df.groupBy(F.window(ts, width).alias("w"), key)
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
        .select(F.col("w.start").alias("window_start"), key, "n", "total")
    )


def sessions(df: DataFrame, entity: str, ts: str, gap_seconds: int) -> DataFrame:
    """Activity runs per entity, split where the silence reaches ``gap_seconds``.

    Rows are first collapsed to one per (entity, slot) with slots as wide as the
    gap: two rows of one slot can never be split.  The window then sees at most
    one row per slot, however many rows a busy entity has.
    """
    gap = gap_seconds * 1_000_000
    slots = (
        df.withColumn("_us", F.unix_micros(ts))
        .groupBy(entity, (F.col("_us") - F.pmod("_us", F.lit(gap))).alias("_slot"))
        .agg(F.min("_us").alias("_a"), F.max("_us").alias("_b"), F.count(F.lit(1)).alias("_n"))
    )
    w = Window.partitionBy(entity).orderBy("_slot")
    starts = F.when(F.col("_a") - F.lag("_b").over(w) < gap, 0).otherwise(1)
    numbered = slots.withColumn("_new", starts).withColumn("session", F.sum("_new").over(w))
    return numbered.groupBy(entity, "session").agg(
        F.timestamp_micros(F.min("_a")).alias("started_at"),
        F.timestamp_micros(F.max("_b")).alias("ended_at"),
        F.sum("_n").alias("n"),
    )
