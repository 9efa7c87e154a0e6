"""Small raw rows and messages for tests."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from filetide.operators.normalize import normalize_records
from filetide.storage.tables import as_raw, with_version

MESSAGES = "source_exchange string, body string, recv_time timestamp"


def record(filename="/store/run17/hits.dat", read=100, **changes):
    return {
        "@timestamp": "2026-03-22T12:00:00Z", "start_time": 1774174500, "end_time": 1774174590,
        "serverID": "node-17", "server_hostname": "disk-17.example.net", "server_ip": "2001:db8:17::5",
        "vo": "astro", "filename": filename, "filesize": 7340032, "read": read, **changes}


def messages(spark, records, received="2026-03-22 13:00:00", source="main"):
    rows = [(source, r if isinstance(r, str) or r is None else json.dumps(r), received) for r in records]
    return spark.createDataFrame(rows, "source_exchange string, body string, recv_time string").withColumn(
        "recv_time", F.col("recv_time").cast("timestamp"))


def raw(spark, records, version="2026-03-22 13:00:00", **options):
    rows = normalize_records(messages(spark, records, **options))
    return as_raw(with_version(rows, F.lit(version).cast("timestamp")))


def plan(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
