import glob
import os
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import tables
from shelfwise.schema import PRODUCT_SCHEMA
from shelfwise.plans import all_queries
from shelfwise.sources.store import ProductStore
from shelfwise.streaming import events as streaming
from shelfwise.streaming import keyed

START = datetime(2024, 1, 1)
QUERIES = all_queries()[0]
SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double"


def land(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def log(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = [(i, START + timedelta(seconds=40 * i), i % 3, "view" if i % 2 else "click", float(i)) for i in range(60)]
    for part in (rows[:20], rows[20:40], rows[40:]):
        land(spark, path, part)
    return path, rows


def stream(spark, path):
    return streaming.read_stream(spark, path, SCHEMA, files_per_batch=1)


def test_collection_equals_batch_upsert(spark, tmp_path):
    now = F.lit(datetime(2024, 2, 2))
    rows = [(str(i % 7), f"n{i}", float(i), START + timedelta(hours=i)) for i in range(30)]
    source = str(tmp_path / "in")
    schema = "product_id string, name string, price double, scraped_at timestamp"
    for part in (rows[:12], rows[12:20], rows[20:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
    shop = ProductStore(spark, str(tmp_path / "shop"))
    landed = streaming.read_stream(spark, source, schema)
    streaming.collect_products(landed, shop, str(tmp_path / "state"), order_by=["scraped_at"], now=now, available_now=True).awaitTermination()
    want = tables.upsert(spark.createDataFrame([], PRODUCT_SCHEMA), spark.createDataFrame(rows, schema), order_by=["scraped_at"], now=now)
    assert sorted(map(str, shop.read().collect())) == sorted(map(str, want.collect()))


def test_second_run_takes_only_new_files(spark, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    shop = ProductStore(spark, str(tmp_path / "shop"))

    def run():
        landed = streaming.read_stream(spark, source, "product_id string, price double")
        query = streaming.collect_products(landed, shop, state, available_now=True)
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    spark.createDataFrame([("1", 1.0)], "product_id string, price double").write.mode("append").parquet(source)
    assert run() == 1
    spark.createDataFrame([("2", 2.0)], "product_id string, price double").write.mode("append").parquet(source)
    assert run() == 1
    assert {r.product_id for r in shop.read().collect()} == {"1", "2"}


def test_counts_equal_batch(spark, log, tmp_path):
    path, _ = log
    got = streaming.run_updates(streaming.activity_counts(stream(spark, path), late="1 hour"), ["window_start", "event_type"], str(tmp_path / "counts"))
    batch = spark.read.schema(SCHEMA).parquet(path)
    want = batch.groupBy(F.window("ts", "5 minutes").start.alias("window_start"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_delivered_twice_stored_once(spark, log, tmp_path):
    path, rows = log
    land(spark, path, rows[50:])
    once = streaming.deliver_once(stream(spark, path))
    got = streaming.run_available(once, str(tmp_path / "rows"), str(tmp_path / "state"))
    assert sorted(r.event_id for r in got.collect()) == list(range(60))


def cut(spark, path, rows, sizes):
    """Land the rows in files of these sizes, one batch each, in order."""
    at = 0
    for n, size in enumerate(sizes):
        land(spark, path, rows[at : at + size])
        at += size
        for f in glob.glob(f"{path}/part-*"):
            if os.path.getmtime(f) > 1_700_001_000:
                os.utime(f, (1_700_000_000 + n, 1_700_000_000 + n))
    assert at == len(rows)


def seconds(*parts):
    """Rows (id, ts, user, type, value) of (user, seconds, type) entries in time order."""
    return [(i, START + timedelta(seconds=s), u, kind, 1.0) for i, (s, u, kind) in enumerate(sorted(parts))]


def since_start(at_ms):
    return at_ms / 1000 - START.timestamp()


@pytest.mark.parametrize("cuts", [[156], [30, 100, 20, 6], [1, 154, 1]])
def test_flush_by_count_or_time(spark, tmp_path, cuts):
    path = str(tmp_path / "log")
    burst = [(i / 100, u, "view") for u, n in ((1, 49), (2, 50), (3, 51)) for i in range(n)]
    rows = seconds(*burst, (0.0, 4, "view"), (29.0, 4, "view"), (40.0, 4, "view"), (45.0, 4, "view"), (3600.0, 5, "view"), (7200.0, 5, "view"))
    cut(spark, path, rows, cuts)
    found = streaming.with_state_provider(spark, lambda s: keyed.buffered(stream(s, path), "user_id", "ts", "event_id"), str(tmp_path / "out"))
    got = sorted((r.source, r.flush, r.reason, r.n) for r in found.groupBy("source", "flush", "reason").agg(F.count("*").alias("n")).collect())
    assert got == [("1", 0, "time", 49), ("2", 0, "count", 50), ("3", 0, "count", 50), ("3", 1, "time", 1), ("4", 0, "time", 2), ("4", 1, "time", 2), ("5", 0, "time", 1)]
    at = {(r.source, r.flush): since_start(r.at_ms) for r in found.collect()}
    assert at["1", 0] == 30 and at["2", 0] == pytest.approx(0.49, abs=1e-3) and at["4", 1] == 70


def test_flushes_are_told_again_after_a_failed_store(spark, tmp_path):
    path, state = str(tmp_path / "log"), str(tmp_path / "state")
    cut(spark, path, seconds(*[(i, 1, "view") for i in range(5)], (100, 2, "view"), (200, 2, "view")), [3, 4])
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", streaming.STATE_PROVIDER)
    stored, down = [], [True]

    def store(batch, number):
        rows = batch.collect()
        if rows and down[0]:
            raise RuntimeError("store is down")
        stored.extend((r.source, r.flush, r.item) for r in rows)

    def run():
        flushes = keyed.buffered(stream(session, path), "user_id", "ts", "event_id", limit=4)
        query = flushes.writeStream.foreachBatch(store).option("checkpointLocation", state).trigger(availableNow=True).start()
        query.awaitTermination()

    with pytest.raises(Exception, match="store is down"):
        run()
    down[0] = False
    run()
    assert sorted(stored) == [("1", 0, "0"), ("1", 0, "1"), ("1", 0, "2"), ("1", 0, "3"), ("1", 1, "4"), ("2", 0, "5")]


@pytest.mark.parametrize("cuts", [[6], [2, 2, 2]])
def test_expired_messages_are_kept_apart(spark, tmp_path, cuts):
    path = str(tmp_path / "log")
    times = [0, 100, 39, 41, 200, 139]
    rows = [(i, START + timedelta(seconds=t), 1, "m", 1.0) for i, t in enumerate(times)]
    cut(spark, path, rows, cuts)
    found = streaming.with_state_provider(spark, lambda s: keyed.split_expired(stream(s, path), "user_id", "ts", "event_id", "event_id"), str(tmp_path / "out"))
    assert {int(r.message): r.expired for r in found.collect()} == {0: False, 1: False, 2: True, 3: False, 4: False, 5: True}


@pytest.mark.parametrize("cuts", [[14], [3, 4, 7], [13, 1]])
def test_lifecycle_of_tasks(spark, tmp_path, cuts):
    path = str(tmp_path / "log")
    rows = seconds(
        (0, 1, "started"), (10, 1, "started"), (299, 1, "completed"), (400, 1, "started"),
        (0, 2, "started"), (20, 2, "failed"), (30, 2, "started"), (500, 2, "failed"), (600, 2, "started"),
        (700, 2, "failed"), (800, 2, "started"), (5000, 2, "started"), (0, 3, "failed"), (9000, 4, "started"),
    )
    cut(spark, path, rows, cuts)
    found = streaming.with_state_provider(spark, lambda s: keyed.lifecycle(stream(s, path), "user_id", "ts", F.col("event_type"), "event_id"), str(tmp_path / "out"))
    got = sorted((r.task, r.attempt, since_start(r.at_ms), r.state) for r in found.collect())
    assert got == sorted(
        [
            ("1", 1, 0, "running"), ("1", 1, 299, "completed"),
            ("2", 1, 0, "running"), ("2", 1, 20, "failed"), ("2", 1, 20, "retrying"),
            ("2", 2, 30, "running"), ("2", 2, 330, "timeout"), ("2", 2, 330, "retrying"),
            ("2", 3, 600, "running"), ("2", 3, 700, "failed"), ("2", 3, 700, "retrying"),
            ("2", 4, 800, "running"), ("2", 4, 1100, "timeout"), ("2", 4, 1100, "given up"), ("4", 1, 9000, "running"),
        ]
    )


def calls(processor, *args):
    """Calls into the state that a bucket's rows cost, counted on a stand-in for the handle."""
    count, box = [0], {}

    class Value:
        def exists(self):
            count[0] += 1
            return "v" in box

        def get(self):
            count[0] += 1
            return box["v"]

        def update(self, v):
            count[0] += 1
            box["v"] = v

    class Handle:
        def getValueState(self, *_):
            return Value()

        def listTimers(self):
            count[0] += 1
            return iter([])

        def registerTimer(self, _):
            count[0] += 1

    own = processor(*args)
    own.init(Handle())
    return own, count


def test_state_calls_do_not_grow_with_the_keys():
    for n in (10, 1000):
        rows = pd.DataFrame({"source": [f"s{i}" for i in range(n)], "item": "x", "ts_ms": range(n)})
        own, count = calls(keyed.FlushBuffer, 5, 1000)
        assert list(own.handleInputRows((0,), iter([rows]), None)) == [] and count[0] == 4
        tasks = pd.DataFrame({"task": [f"s{i}" for i in range(n)], "event": "started", "arrival": 0, "ts_ms": range(n)})
        own, count = calls(keyed.Lifecycle, 1000, 3)
        assert len(pd.concat(own.handleInputRows((0,), iter([tasks]), None))) == n and count[0] == 4


def test_sessions(spark, tmp_path):
    path = str(tmp_path / "log")
    times = [0, 10, 20, 200, 205]
    land(spark, path, [(i, START + timedelta(minutes=m), 1, "view", 1.0) for i, m in enumerate(times)])
    land(spark, path, [(99, START + timedelta(days=2), 2, "view", 1.0)])
    got = streaming.run_available(streaming.activity_sessions(stream(spark, path)), str(tmp_path / "rows"), str(tmp_path / "state"))
    assert sorted(r.n for r in got.where("user_id = 1").collect()) == [2, 3]


def test_liveness(spark, tmp_path):
    path = str(tmp_path / "log")
    land(spark, path, [(1, START, 1, "beat", 1.0), (2, START, 2, "beat", 1.0)])
    land(spark, path, [(3, START + timedelta(seconds=60), 2, "beat", 1.0), (4, START + timedelta(seconds=140), 3, "beat", 1.0)])
    changes = streaming.with_state_provider(spark, lambda s: streaming.liveness(stream(s, path), "user_id", silence_seconds=90), str(tmp_path / "out"))
    last = {r.entity: r.state for r in changes.groupBy("entity").agg(F.max_by("state", "at_ms").alias("state")).collect()}
    assert last == {"1": "offline", "2": "online", "3": "online"}


@pytest.mark.parametrize("cuts", [[5], [1, 1, 1, 1, 1], [2, 3], [1, 4]])
def test_every_silence_is_told_however_batches_are_cut(spark, tmp_path, cuts):
    path, beats, at = str(tmp_path / "log"), [0, 30, 3600, 3700, 18000], 0
    for n, size in enumerate(cuts):
        land(spark, path, [(at + i, START + timedelta(seconds=beats[at + i]), 1, "beat", 1.0) for i in range(size)])
        at += size
        for f in glob.glob(f"{path}/part-*"):
            if os.path.getmtime(f) > 1_700_001_000:
                os.utime(f, (1_700_000_000 + n, 1_700_000_000 + n))
    changes = streaming.with_state_provider(spark, lambda s: streaming.liveness(stream(s, path), "user_id", silence_seconds=90), str(tmp_path / "out"))
    first = int(START.timestamp() * 1000)
    got = sorted(((r.at_ms - first) // 1000, r.state) for r in changes.collect())
    assert got == [(0, "online"), (120, "offline"), (3600, "online"), (3690, "offline"), (3700, "online"), (3790, "offline"), (18000, "online")]


def test_queries_read_folder_tables(spark, tmp_path):
    source = "/root/testdata/sf0.001"
    for name in ("events", "part"):
        spark.read.parquet(f"{source}/{name}.parquet").repartition(5).write.parquet(str(tmp_path / f"{name}.parquet"))
    for name in ("stream_activity_counts", "stream_deliver_once", "stream_collect", "stream_liveness", "stream_flushes", "stream_lifecycle"):
        run = QUERIES[name]
        assert sorted(map(str, run(spark, str(tmp_path)).collect())) == sorted(map(str, run(spark, source).collect())), name
