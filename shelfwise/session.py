"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql.functions import broadcast

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "shelfwise", **overrides: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Folder that every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="shelfwise-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the checkpoint root."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


SMALL_ROWS = 100_000


def broadcast_if_small(df, limit: int = SMALL_ROWS):
    """``df`` written once, and marked for broadcast if it has at most ``limit`` rows; joined by shuffle otherwise."""
    df = cut_lineage(df)
    return broadcast(df) if df.count() <= limit else df


def shuffled(df):
    """``df`` for a join by shuffle whatever its size: loops of joins would leave their small sides, a page of memory
    each, with the driver."""
    return df.hint("merge")


def cut_lineage(df):
    """Materialise ``df`` reliably; the copy survives the loss of executors."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()
