"""Keyed combination of product tables: de-duplication, upsert, lookup, union, candidates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.session import cut_lineage

# fixed values: the columns an update may overwrite, in the full and the reduced form
FULL_UPDATE = (
    "name",
    "description",
    "category",
    "price",
    "availability",
    "quantity",
    "rating",
    "reviews_count",
    "images",
    "tags",
)
REDUCED_UPDATE = ("name", "description", "category", "price", "availability", "rating", "reviews_count")


def dedupe_latest(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """Last row per key.  A partial maximum leaves one row per key and task before the shuffle."""
    rest = [c for c in df.columns if c not in (key, *order_by)]
    newest = F.max_by(F.struct(*order_by, *rest), F.struct(*order_by))
    return df.groupBy(key).agg(newest.alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in df.columns if c != key])


def one_per_key(df: DataFrame, key: str, order_by: Sequence[str] = ()) -> DataFrame:
    """The last row per key by ``order_by`` and, among equals, by all other columns."""
    rest = [c for c in df.columns if c not in (key, *order_by)]
    return dedupe_latest(df, key, [*order_by, *rest]) if rest or order_by else df.distinct()


def upsert(
    stored: DataFrame,
    incoming: DataFrame,
    update: Sequence[str] = FULL_UPDATE,
    order_by: Sequence[str] = (),
    now: Column | None = None,
    source_url: str | None = None,
    key: str = "product_id",
) -> DataFrame:
    """Insert new keys, overwrite only the ``update`` columns of known ones.

    ``order_by`` ranks several incoming rows of one key; the last one wins.  Without it the greatest row by all its
    columns wins, so that a key never ends in two rows.
    """
    now = F.current_timestamp() if now is None else now
    incoming = one_per_key(incoming, key, order_by)
    columns = stored.columns
    fresh = incoming.select(*[F.col(c).alias(f"_in_{c}") if c in incoming.columns else F.lit(None).alias(f"_in_{c}") for c in columns])
    both = stored.join(fresh, F.col(key) == F.col(f"_in_{key}"), "full_outer")
    known, given = F.col(key).isNotNull(), F.col(f"_in_{key}").isNotNull()

    def merged(c: str) -> Column:
        new, old = F.col(f"_in_{c}"), F.col(c)
        if c == key:
            return F.coalesce(old, new)
        if c == "updated_at":
            return F.when(given, now).otherwise(old)
        if c == "created_at":
            return F.when(known, old).otherwise(now)
        if c == "source_url":
            return F.when(known, old).otherwise(F.coalesce(new, F.lit(source_url)))
        if c == "currency":
            return F.when(known, old).otherwise(F.coalesce(new, F.lit("USD")))
        if c in update:
            return F.when(given, new).otherwise(old)
        return F.when(known, old).otherwise(new)

    return both.select(*[merged(c).alias(c) for c in columns])


def rating_backfill(stored: DataFrame, raw: DataFrame, key: str = "product_id") -> DataFrame:
    """Take rating and reviews from ``raw`` where the stored rating is NULL or 0 or reviews are NULL."""
    lookup = raw.select(F.col(key), F.col("rating").alias("_rating"), F.col("reviews_count").alias("_reviews"))
    weak = F.col("rating").isNull() | (F.col("rating") == 0) | F.col("reviews_count").isNull()
    use = weak & F.col("_rating").isNotNull()
    return (
        stored.join(lookup, key, "left")
        .withColumn("backfilled", use)
        .withColumns(
            {
                "rating": F.when(use, F.col("_rating")).otherwise(F.col("rating")),
                "reviews_count": F.when(use, F.coalesce("_reviews", F.lit(0))).otherwise(F.col("reviews_count")),
            }
        )
        .drop("_rating", "_reviews")
    )


def unmatched_ids(stored: DataFrame, raw: DataFrame, key: str = "product_id") -> DataFrame:
    return stored.join(raw, key, "left_anti").select(key)


def union_sources(**sources: DataFrame) -> DataFrame:
    """Append several sources by column name, tagged with where each row came from."""
    tagged = [df.withColumn("source", F.lit(name)) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def best_candidate(tasks: DataFrame, agents: DataFrame) -> DataFrame:
    """Least loaded agent per task among those of its platform and the generic ones.

    ``tasks(task_id, platform)``, ``agents(agent_id, platform, current_load, max_load)``.
    The best agent is found per platform first, so a task meets at most one
    platform row and the one generic row; no task x agent pairs arise.
    """
    ratio = F.col("current_load") / F.greatest(F.col("max_load"), F.lit(1))
    offers = agents.groupBy("platform").agg(F.min(F.struct(ratio.alias("load"), F.col("agent_id"))).alias("offer"))
    offers = cut_lineage(offers)  # one row per platform, read twice
    generic = offers.where(F.col("platform") == "generic").select("offer").scalar()
    own = offers.where(F.col("platform") != "generic")
    return (
        tasks.join(own, "platform", "left")
        .withColumn("_best", F.coalesce(F.least(F.col("offer"), generic), F.col("offer"), generic))
        .select(*tasks.columns, F.col("_best.agent_id").alias("agent_id"), F.col("_best.load").alias("load"))
    )


def assemble_results(tasks: DataFrame, completed: DataFrame, failed: DataFrame) -> DataFrame:
    """Status, agent, duration and error per task: completed first, then failed, else as it stands."""
    done = completed.select(
        "task_id",
        F.col("assigned_to").alias("_done_by"),
        (F.col("completed_at") - F.col("started_at")).alias("duration"),
    )
    lost = failed.select("task_id", F.col("assigned_to").alias("_lost_by"), F.col("error").alias("_error"), F.lit(True).alias("_lost"))
    done = done.withColumn("_done", F.lit(True))
    status = F.when(F.col("_done"), "completed").when(F.col("_lost"), "failed").otherwise(F.col("status"))
    return (
        tasks.select("task_id", "url", "platform", "status")
        .join(done, "task_id", "left")
        .join(lost, "task_id", "left")
        .select(
            "task_id",
            "url",
            "platform",
            status.alias("status"),
            "duration",
            F.when(F.col("_done"), F.col("_done_by")).otherwise(F.col("_lost_by")).alias("agent"),
            F.when(F.col("_done").isNull(), F.col("_error")).alias("error"),
        )
    )
