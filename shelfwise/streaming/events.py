"""Streaming counterparts: collection, liveness, activity counts, sessions, incremental loads."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from shelfwise.sources.store import ProductStore

FLUSH_SECONDS = 30
SILENCE_SECONDS = 90
STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int | None = None, pattern: str | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def read_table_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """Stream a table stored as a folder of files, or as one file (by its folder and name)."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    status = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(where)
    if status.isDirectory():
        return read_stream(spark, path, schema, fmt, files_per_batch)
    return read_stream(spark, where.getParent().toString(), schema, fmt, files_per_batch, where.getName())


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Process everything that is there now into a table folder and read it back."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    spark = stream.sparkSession
    return spark.read.schema(stream.schema).parquet(path)


def collect_products(
    stream: DataFrame,
    store: ProductStore,
    checkpoint: str,
    order_by=(),
    now: Column | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Upsert each micro-batch into the store, every 30 seconds or over what is there.

    A failed batch is run again from the checkpoint; the upsert makes that harmless.
    """

    def flush(batch: DataFrame, _: int) -> None:
        store.upsert(batch, order_by, now)

    writer = stream.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{FLUSH_SECONDS} seconds"}
    return writer.trigger(**trigger).start()


def deliver_once(stream: DataFrame, key: str = "event_id", ts: str = "ts", within: str = "1 day") -> DataFrame:
    return stream.withWatermark(ts, within).dropDuplicatesWithinWatermark([key])


def activity_counts(stream: DataFrame, ts: str = "ts", key: str = "event_type", width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    return (
        stream.withWatermark(ts, late)
        .groupBy(F.window(ts, width), key)
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
        .select(F.col("window.start").alias("window_start"), key, "n", "total")
    )


def activity_sessions(stream: DataFrame, entity: str = "user_id", ts: str = "ts", gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    return (
        stream.withWatermark(ts, late)
        .groupBy(F.session_window(ts, gap), entity)
        .agg(F.count(F.lit(1)).alias("n"), F.max(ts).alias("ended_at"))
        .select(entity, F.col("session_window.start").alias("started_at"), "ended_at", "n")
    )


class Liveness(StatefulProcessor):
    """Announces an entity as online on its first sign of life and offline after a silence.

    The beats of a call are walked in time order from the last one known, so every silence between them is told
    however the stream is cut into batches.
    """

    def __init__(self, silence_seconds: int = SILENCE_SECONDS):
        self.silence_ms = silence_seconds * 1000

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "last_ms bigint, online boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        beats = pd.concat([pdf["ts_ms"] for pdf in rows]).sort_values().to_numpy()
        last, online = self.seen.get() if self.seen.exists() else (None, False)
        steps = np.diff(beats, prepend=beats[0] if last is None else last)
        after = np.maximum(beats, beats[0] if last is None else last)
        wakes = steps > self.silence_ms
        wakes[0] |= not online
        slept = (steps > self.silence_ms) & (np.arange(len(beats)) > 0)
        slept[0] = online and steps[0] > self.silence_ms
        asleep = (beats - steps + self.silence_ms)[slept]
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        last = int(after[-1])
        self.handle.registerTimer(last + self.silence_ms)
        self.seen.update((last, True))
        at = np.concatenate([asleep, beats[wakes]])
        state = np.array(["offline"] * len(asleep) + ["online"] * int(wakes.sum()))
        order = np.argsort(at, kind="stable")
        if len(at):
            yield pd.DataFrame({"entity": key[0], "at_ms": at[order], "state": state[order]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last = self.seen.get()[0]
        self.seen.update((last, False))
        yield pd.DataFrame({"entity": [key[0]], "at_ms": [last + self.silence_ms], "state": ["offline"]})

    def close(self) -> None:
        pass


def liveness(stream: DataFrame, entity: str, ts: str = "ts", silence_seconds: int = SILENCE_SECONDS, late: str = "0 seconds") -> DataFrame:
    """Online/offline changes per entity on event time: (entity, at_ms, state).

    State per entity is one timestamp, so a busy entity costs no more than a quiet one.
    """
    beats = stream.withWatermark(ts, late).select(
        F.col(entity).cast("string").alias("entity"), F.col(ts), F.unix_millis(ts).alias("ts_ms")
    )
    return beats.groupBy("entity").transformWithStateInPandas(
        statefulProcessor=Liveness(silence_seconds),
        outputStructType="entity string, at_ms bigint, state string",
        outputMode="Append",
        timeMode="EventTime",
    )


def run_updates(stream: DataFrame, keys: list[str], root: str) -> DataFrame:
    """Run an aggregation to the end, keeping the last value of every group.

    Each micro-batch writes its changed groups to a folder of its own, so a
    repeated batch replaces itself; reading takes the newest batch per group.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/rows/batch={number}")

    query = (
        stream.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", f"{root}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    rows = stream.sparkSession.read.parquet(f"{root}/rows")
    rest = [c for c in stream.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.col("batch"))
    return rows.groupBy(*keys).agg(newest.alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def with_state_provider(spark: SparkSession, build, root: str) -> DataFrame:
    """Run a stateful stream to the end under the state store it needs, in a session of its own."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER)
    stream = build(session)
    run_available(stream, f"{root}/rows", f"{root}/state")
    return spark.read.schema(stream.schema).parquet(f"{root}/rows")
