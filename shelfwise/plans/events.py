"""Queries over the event log, conversations and embeddings labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions.columns import json_slice
from shelfwise.operators import aggregate, scoring
from shelfwise.operators.aggregate import DURATION_EDGES, TRAINING_EDGES
from shelfwise.plans.catalog import PRODUCTS_SQL, events, held, products, table
from shelfwise.plans.products import FULL_SCORE, SCORED, _score_sql
from shelfwise.plans.registry import query

SILENCE = 21600
SESSION_GAP = 21600

STATUS = {"purchase": "completed", "error": "failed", "view": "running", "click": "assigned", "signup": "pending"}
STATUS_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATUS.items()) + " END"


def task_log(spark, sf_dir):
    """Events as a task log: one task per user and day, the event type as its status."""
    return events(spark, sf_dir).select(
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")).alias("task_id"),
        F.expr(STATUS_SQL).alias("status"),
        "ts",
        "event_id",
        "user_id",
        "value",
    )


TASKS_SQL = f"""WITH tasks AS (SELECT concat_ws('-', CAST(user_id AS VARCHAR), strftime(ts, '%Y%m%d')) AS task_id,
  {STATUS_SQL} AS status, ts, event_id, user_id, value FROM events)
"""


def naive(c: str):
    return F.col(c).cast("timestamp_ntz").alias(c)


@query("json_slice", """SELECT event_id, regexp_extract(props, '\\{.*\\}', 0, 's') AS slice, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def json_slice_query(spark, sf):
    ev = table(spark, sf, "events").select("event_id", json_slice("props").alias("slice"))
    return ev.withColumn("k", F.get_json_object("slice", "$.k").cast("int"))


@query(
    "alive_entities",
    f"""WITH l AS (SELECT user_id, max(ts) AS last_seen, arg_max(event_type, (ts, event_id)) AS platform FROM events GROUP BY user_id)
    SELECT user_id, last_seen, platform FROM l WHERE epoch_us((SELECT max(ts) FROM events)) - epoch_us(last_seen) <= {SILENCE * 1_000_000} AND platform IN ('purchase', 'signup')""",
)
def alive_entities(spark, sf):
    alive = aggregate.alive_entities(events(spark, sf), "user_id", "event_type", "ts", "event_id", "purchase", "signup", SILENCE)
    return alive.select("user_id", naive("last_seen"), "platform")


@query(
    "run_summary",
    """SELECT count(*) AS n, count(*) FILTER (WHERE event_type = 'view') AS dispatched, count(*) FILTER (WHERE event_type = 'purchase') AS completed,
      count(*) FILTER (WHERE event_type = 'error') AS failed, count(*) FILTER (WHERE event_type = 'signup') AS retried, count(*) FILTER (WHERE event_type = 'click') AS active FROM events""",
)
def run_summary(spark, sf):
    kind = F.col("event_type")
    return aggregate.tally(
        events(spark, sf), [], dispatched=kind == "view", completed=kind == "purchase", failed=kind == "error",
        retried=kind == "signup", active=kind == "click",
    )


@query(
    "entity_stats",
    """SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type = 'purchase') AS completed, count(*) FILTER (WHERE event_type = 'error') AS failed,
      round(count(*) FILTER (WHERE event_type = 'click') / CAST(count(*) AS DOUBLE) * 100, 4) AS load_pct FROM events GROUP BY user_id""",
)
def entity_stats(spark, sf):
    kind = F.col("event_type")
    stats = aggregate.tally(
        events(spark, sf), ["user_id"], completed=kind == "purchase", failed=kind == "error", active=kind == "click"
    )
    return stats.withColumn("load_pct", F.round(F.col("active") / F.col("n") * 100, 4)).drop("active")


@query(
    "entity_health",
    f"""SELECT user_id, max(ts) AS last_seen, CASE WHEN epoch_us((SELECT max(ts) FROM events)) - epoch_us(max(ts)) <= {SILENCE * 1_000_000} THEN 'online' ELSE 'offline' END AS state
    FROM events GROUP BY user_id""",
)
def entity_health(spark, sf):
    ev = events(spark, sf)
    now = ev.agg(F.max("ts")).scalar()
    return aggregate.entity_health(ev, "user_id", "ts", now, SILENCE).select("user_id", naive("last_seen"), "state")


@query("event_counters", "SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2")
def event_counters(spark, sf):
    return aggregate.tally(events(spark, sf).withColumn("day", F.to_date("ts")), ["event_type", "day"])


def _histogram_sql(edges) -> str:
    listed = ", ".join(f"'{e}'" for e in edges)
    return f"""WITH e AS (SELECT unnest([{listed}, '+Inf']) AS le),
    h AS (SELECT event_type, le, count(*) FILTER (WHERE value <= CASE WHEN le = '+Inf' THEN CAST('inf' AS DOUBLE) ELSE CAST(le AS DOUBLE) END) AS n,
      count(*) AS total_count, sum(value) AS s FROM events, e WHERE value IS NOT NULL GROUP BY 1, 2)
    SELECT event_type, le, n, total_count, round(s, 2) AS total_sum FROM h"""


def _histogram(spark, sf, edges):
    histogram = aggregate.duration_histogram(events(spark, sf), "value", edges, ["event_type"])
    return histogram.withColumn("total_sum", F.round("total_sum", 2))


@query("duration_histogram", _histogram_sql(DURATION_EDGES))
def duration_histogram(spark, sf):
    return _histogram(spark, sf, DURATION_EDGES)


@query("training_histogram", _histogram_sql(TRAINING_EDGES))
def training_histogram(spark, sf):
    return _histogram(spark, sf, TRAINING_EDGES)


@query(
    "latest_gauges",
    PRODUCTS_SQL + _score_sql() + f""", t AS (SELECT product_id, round({FULL_SCORE}, 4) AS sc FROM parts ORDER BY sc DESC, product_id LIMIT 10)
    SELECT event_type AS metric, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1
    UNION ALL SELECT 'top_k_mean_score', round(avg(sc), 6) FROM t UNION ALL SELECT 'products_stored', CAST(count(*) AS DOUBLE) FROM products""",
)
def latest_gauges(spark, sf):
    catalog = held(products(spark, sf), *SCORED)
    gauges = aggregate.latest_gauges(events(spark, sf), "event_type", "value", "ts", "event_id").select("metric", "value")
    mean = scoring.top_k(catalog).agg(F.round(F.avg("_score"), 6).alias("value"))
    stored = catalog.agg(F.count(F.lit(1)).cast("double").alias("value"))
    return gauges.unionByName(mean.select(F.lit("top_k_mean_score").alias("metric"), "value")).unionByName(
        stored.select(F.lit("products_stored").alias("metric"), "value")
    )


@query(
    "durations",
    TASKS_SQL + "SELECT task_id, min(ts) AS started_at, max(ts) AS completed_at, (epoch_us(max(ts)) - epoch_us(min(ts))) / CAST(1000000 AS DOUBLE) AS seconds FROM tasks GROUP BY task_id",
)
def durations(spark, sf):
    return aggregate.durations(task_log(spark, sf), "task_id", "ts").select("task_id", naive("started_at"), naive("completed_at"), "seconds")


@query(
    "task_outcomes",
    TASKS_SQL + """, a AS (SELECT task_id, arg_max(status, (ts, event_id)) AS last_status, count(*) FILTER (WHERE status = 'failed') AS failures,
      (epoch_us(max(ts)) - epoch_us(min(ts))) / CAST(1000000 AS DOUBLE) AS duration_seconds FROM tasks GROUP BY task_id)
    SELECT task_id, last_status, failures, least(failures, 3) AS retries, duration_seconds, CASE WHEN last_status = 'completed' THEN 'completed' WHEN failures > 3 THEN 'failed'
      WHEN last_status = 'failed' THEN 'retrying' WHEN duration_seconds > 300 THEN 'timeout' ELSE last_status END AS outcome FROM a""",
)
def task_outcomes(spark, sf):
    done = aggregate.task_outcomes(task_log(spark, sf), "task_id", "status", "ts", "event_id")
    return done.select("task_id", "last_status", "failures", F.col("retries").cast("bigint").alias("retries"), "duration_seconds", "outcome")


COUNTS_SQL = "SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2"


@query("tumbling_counts", COUNTS_SQL)
def tumbling_counts(spark, sf):
    counts = aggregate.tumbling_counts(events(spark, sf), "ts", "event_type")
    return counts.select(naive("window_start"), "event_type", "n", F.round("total", 2).alias("total"))


SESSIONS_SQL = f"""WITH o AS (SELECT user_id, ts, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) < {SESSION_GAP * 1_000_000} THEN 0 ELSE 1 END AS fresh
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS no FROM o),
sessions AS (SELECT user_id, CAST(no AS BIGINT) AS session, min(ts) AS started_at, max(ts) AS ended_at, count(*) AS n FROM s GROUP BY 1, 2)
"""


@query("sessions", SESSIONS_SQL + "SELECT * FROM sessions")
def sessions(spark, sf):
    runs = aggregate.sessions(events(spark, sf), "user_id", "ts", SESSION_GAP)
    return runs.select("user_id", "session", naive("started_at"), naive("ended_at"), "n")


@query(
    "recent_turns",
    "SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM conversations) WHERE rn <= 6",
)
def recent_turns(spark, sf):
    turns = table(spark, sf, "conversations")
    return scoring.top_per_key(turns, [F.desc("turn")], 6, ["conv_id"]).select("conv_id", "turn", "role", "text")


@query("cluster_stats", "SELECT label AS cluster, count(*) AS size, label = -1 AS is_noise FROM embeddings GROUP BY label")
def cluster_stats(spark, sf):
    return aggregate.cluster_stats(table(spark, sf, "embeddings").select("label"))
