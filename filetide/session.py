"""Session settings the engine relies on, and where it may write scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Buckets are UTC calendar units; INT96 timestamps would carry no min/max for row-group skipping.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("filetide")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Recording the Python line of every column expression costs more than small queries do.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` for tables a job writes on the way. Only a session
    on one machine may go without that setting, as in tests; it then gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        if not context._jsc.sc().getCheckpointDir().isDefined():
            context.setCheckpointDir(tempfile.mkdtemp(prefix="filetide-"))
        base = context._jsc.sc().getCheckpointDir().get()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
