"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# AQE re-plans joins from measured sizes, splits skewed partitions and sizes shuffle partitions, so
# the partition count below is only the starting width.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # The JVM never compiles methods above 8,000 bytes of bytecode. Wide projections would run
    # interpreted beyond that; below it Spark splits them instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Recording the Python line of every expression doubles the time it takes to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Streaming state on local disk rather than on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app: str = "deskwise", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def session_zone(spark: SparkSession, zone: str = "UTC"):
    """The session's time zone, for as long as something eager runs in it."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for written intermediates, under the folder all executors share.

    The cluster names it in ``spark.checkpoint.dir``; only a local session without one (tests, a
    laptop) gets a temporary folder. Elsewhere every executor would write to its own disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="deskwise-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
