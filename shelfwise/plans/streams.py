"""Queries that run the streaming operators over the event files to the end."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.plans.catalog import table
from shelfwise.plans.events import COUNTS_SQL, SILENCE, naive
from shelfwise.plans.registry import query
from shelfwise.session import scratch_path
from shelfwise.sources.store import ProductStore
from shelfwise.streaming import events as streaming
from shelfwise.streaming import keyed


def event_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    stream = streaming.read_table_stream(spark, f"{sf_dir}/events.parquet", schema)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query("stream_activity_counts", COUNTS_SQL)
def stream_activity_counts(spark, sf):
    counts = streaming.activity_counts(event_stream(spark, sf))
    done = streaming.run_updates(counts, ["window_start", "event_type"], scratch_path(spark, "activity"))
    return done.select(naive("window_start"), "event_type", "n", F.round("total", 2).alias("total"))


@query("stream_deliver_once", "SELECT event_id, user_id, event_type FROM events")
def stream_deliver_once(spark, sf):
    twice = event_stream(spark, sf).unionByName(event_stream(spark, sf))
    once = streaming.deliver_once(twice, within="60 days").select("event_id", "user_id", "event_type")
    path = scratch_path(spark, "once")
    return streaming.run_available(once, f"{path}/rows", f"{path}/state")


@query("stream_collect", "SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_retailprice AS price FROM part")
def stream_collect(spark, sf):
    schema = table(spark, sf, "part").schema
    parts = streaming.read_table_stream(spark, f"{sf}/part.parquet", schema).select(
        F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("price")
    )
    path = scratch_path(spark, "collect")
    shop = ProductStore(spark, f"{path}/products")
    streaming.collect_products(parts, shop, f"{path}/state", available_now=True).awaitTermination()
    return shop.read().select("product_id", "name", "price")


@query(
    "stream_liveness",
    f"""WITH beats AS (
      SELECT CAST(user_id AS VARCHAR) AS entity, epoch_us(ts) // 1000 AS ms,
             lag(epoch_us(ts) // 1000) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events),
    ends AS (SELECT entity, max(ms) + {SILENCE * 1000} AS at_ms FROM beats GROUP BY entity)
    SELECT entity, ms AS at_ms, 'online' AS state FROM beats WHERE before IS NULL OR ms - before > {SILENCE * 1000}
    UNION ALL SELECT entity, before + {SILENCE * 1000}, 'offline' FROM beats WHERE ms - before > {SILENCE * 1000}
    UNION ALL SELECT entity, at_ms, 'offline' FROM ends WHERE at_ms <= epoch_us((SELECT max(ts) FROM events)) // 1000""",
)
def stream_liveness(spark, sf):
    changes = streaming.with_state_provider(
        spark, lambda s: streaming.liveness(event_stream(s, sf), "user_id", silence_seconds=SILENCE), scratch_path(spark, "alive")
    )
    return changes.select("entity", "at_ms", "state")


FLUSH, WAIT = 5, 86400  # events of a user are hours apart: a day stands for the 30 seconds of a collector
MS = "epoch_us(ts) // 1000"


@query(
    "stream_flushes",
    f"""WITH RECURSIVE r AS (SELECT user_id, event_id, {MS} AS ms, row_number() OVER (PARTITION BY user_id ORDER BY {MS}, CAST(event_id AS VARCHAR)) AS i FROM events),
    walk AS (
      SELECT user_id, i, ms, ms AS first, 1 AS held, 0 AS flush FROM r WHERE i = 1
      UNION ALL
      SELECT r.user_id, r.i, r.ms, CASE WHEN w.held = {FLUSH} OR r.ms - w.first >= {WAIT * 1000} THEN r.ms ELSE w.first END,
        CASE WHEN w.held = {FLUSH} OR r.ms - w.first >= {WAIT * 1000} THEN 1 ELSE w.held + 1 END,
        w.flush + CASE WHEN w.held = {FLUSH} OR r.ms - w.first >= {WAIT * 1000} THEN 1 ELSE 0 END
      FROM walk w JOIN r ON r.user_id = w.user_id AND r.i = w.i + 1),
    flushes AS (SELECT user_id, flush, count(*) AS n, min(first) AS first, max(ms) AS last FROM walk GROUP BY 1, 2)
    SELECT CAST(user_id AS VARCHAR) AS source, CAST(flush AS BIGINT) AS flush, CASE WHEN n = {FLUSH} THEN 'count' ELSE 'time' END AS reason,
      CASE WHEN n = {FLUSH} THEN last ELSE first + {WAIT * 1000} END AS at_ms, n
    FROM flushes WHERE n = {FLUSH} OR first + {WAIT * 1000} <= (SELECT max({MS}) FROM events)""",
)
def stream_flushes(spark, sf):
    """Buffers of users, flushed when five events are held or the first has waited a day."""
    rows = streaming.with_state_provider(
        spark, lambda s: keyed.buffered(event_stream(s, sf), "user_id", "ts", "event_id", FLUSH, WAIT), scratch_path(spark, "flushes")
    )
    return rows.groupBy("source", "flush", "reason", "at_ms").agg(F.count(F.lit(1)).alias("n"))


@query(
    "live_messages",
    f"""WITH m AS (SELECT *, {MS} AS ms, event_id + CASE WHEN event_id % 7 = 0 THEN 500 ELSE 0 END AS arrival FROM events)
    SELECT event_id, coalesce(ms < max(ms) OVER (PARTITION BY user_id ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 60000, false) AS expired FROM m""",
)
def live_messages(spark, sf):
    """Every seventh event arrives 500 places late; what is then over a minute behind its user's newest has expired."""

    def build(session):
        events = event_stream(session, sf)
        late = F.col("event_id") + F.when(F.col("event_id") % 7 == 0, 500).otherwise(0)
        # two places share a number where a late event meets a punctual one: the smaller id goes first
        return keyed.split_expired(events.withColumn("arrival", late * 1_000_000_000 + F.col("event_id")), "user_id", "ts", "event_id", "arrival")

    found = streaming.with_state_provider(spark, build, scratch_path(spark, "live"))
    return found.select(F.col("message").cast("long").alias("event_id"), "expired")


STEP = SILENCE * 1000


@query(
    "stream_lifecycle",
    f"""WITH RECURSIVE t AS (SELECT concat_ws('-', CAST(user_id AS VARCHAR), CAST(epoch_us(ts) // 432000000000 AS VARCHAR)) AS task, {MS} AS ms, event_id,
        CASE WHEN event_type IN ('view', 'click') THEN 'started' WHEN event_type = 'purchase' THEN 'completed' WHEN event_type = 'error' THEN 'failed' END AS ev FROM events),
    r AS (SELECT *, row_number() OVER (PARTITION BY task ORDER BY ms, event_id) AS i FROM t),
    last AS (SELECT task, max(i) AS n FROM r GROUP BY task),
    walk AS (
      SELECT task, CAST(0 AS BIGINT) AS i, 0 AS attempt, CAST(NULL AS BIGINT) AS started, false AS over, CAST([] AS STRUCT(attempt INTEGER, at_ms BIGINT, state VARCHAR)[]) AS told FROM last
      UNION ALL
      SELECT task, i, attempt + CASE WHEN goes THEN 1 ELSE 0 END,
        CASE WHEN goes THEN ms WHEN ends OR late THEN NULL ELSE started END,
        spent OR (ends AND (ev = 'completed' OR attempt > 3)),
        list_concat(list_concat(
          CASE WHEN late THEN [{{'attempt': attempt, 'at_ms': started + {STEP}, 'state': 'timeout'}}, {{'attempt': attempt, 'at_ms': started + {STEP}, 'state': CASE WHEN attempt > 3 THEN 'given up' ELSE 'retrying' END}}] ELSE [] END,
          CASE WHEN goes THEN [{{'attempt': attempt + 1, 'at_ms': ms, 'state': 'running'}}] ELSE [] END),
          CASE WHEN ends AND ev = 'completed' THEN [{{'attempt': attempt, 'at_ms': ms, 'state': 'completed'}}]
               WHEN ends THEN [{{'attempt': attempt, 'at_ms': ms, 'state': 'failed'}}, {{'attempt': attempt, 'at_ms': ms, 'state': CASE WHEN attempt > 3 THEN 'given up' ELSE 'retrying' END}}] ELSE [] END)
      FROM (SELECT *, NOT spent AND coalesce(ev = 'started', false) AND (started IS NULL OR late) AS goes,
              NOT spent AND coalesce(ev IN ('completed', 'failed'), false) AND started IS NOT NULL AND NOT late AS ends
            FROM (SELECT *, over OR (late AND attempt > 3) AS spent
                  FROM (SELECT w.task, r.i, w.attempt, w.started, w.over, r.ms, r.ev, coalesce(NOT w.over AND r.ms >= w.started + {STEP}, false) AS late
                        FROM walk w JOIN r ON r.task = w.task AND r.i = w.i + 1)))),
    ends AS (SELECT w.* FROM walk w JOIN last USING (task) WHERE i = n AND NOT over AND started + {STEP} <= (SELECT max({MS}) FROM events)),
    rows AS (SELECT task, unnest(told) AS x FROM walk
      UNION ALL SELECT task, {{'attempt': attempt, 'at_ms': started + {STEP}, 'state': 'timeout'}} FROM ends
      UNION ALL SELECT task, {{'attempt': attempt, 'at_ms': started + {STEP}, 'state': CASE WHEN attempt > 3 THEN 'given up' ELSE 'retrying' END}} FROM ends)
    SELECT task, x.attempt AS attempt, x.at_ms AS at_ms, x.state AS state FROM rows""",
)
def stream_lifecycle(spark, sf):
    """Attempts of a user's tasks of five days: views and clicks start one, purchases complete it, errors fail it."""
    event = F.when(F.col("event_type").isin("view", "click"), "started").when(F.col("event_type") == "purchase", "completed").when(F.col("event_type") == "error", "failed")

    def build(session):
        events = event_stream(session, sf)
        span = F.floor(F.unix_micros("ts") / F.lit(432_000_000_000)).cast("string")
        events = events.withColumn("task", F.concat_ws("-", F.col("user_id").cast("string"), span))
        return keyed.lifecycle(events, "task", "ts", event, "event_id", timeout_seconds=SILENCE)

    return streaming.with_state_provider(spark, build, scratch_path(spark, "lifecycle")).select("task", "attempt", "at_ms", "state")
