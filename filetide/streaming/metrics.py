"""What the pipeline did, as tables: counts per batch and source, and a commit latency histogram."""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from filetide.storage.layout import table_path, voided

BATCHES, COMMITS = "batch_metrics", "commits"
# Upper bounds in seconds, twelve buckets doubling from 5 ms.
LATENCY_BOUNDS = [0.005 * 2**i for i in range(12)]

_BATCHES = T.StructType([
    T.StructField("source_exchange", T.StringType()), T.StructField("messages", T.LongType()),
    T.StructField("parse_errors", T.LongType()), T.StructField("rows_inserted", T.LongType()),
    T.StructField("quarantined", T.LongType()), T.StructField("batch_id", T.LongType())])
_COMMITS = T.StructType([
    T.StructField("latency_seconds", T.DoubleType()), T.StructField("committed", T.BooleanType()),
    T.StructField("batch_id", T.LongType())])


class Watch(StreamingQueryListener):
    """What streams report while they run: of each micro-batch the messages and parse errors it observed and how
    long it took, and of each stream that ended why it failed, if it did. Add it with
    ``spark.streams.addListener``; the last ``keep`` reports are held."""

    def __init__(self, observed: str = "messages", keep: int = 1000):
        self.observed = observed
        self.batches: deque[dict] = deque(maxlen=keep)
        self.ended: deque[dict] = deque(maxlen=keep)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(self.observed)
        if seen is not None:
            self.batches.append({"run": str(progress.runId), "batch": progress.batchId, "seconds": progress.batchDuration / 1000,
                                 "messages": seen["messages"], "parse_errors": seen["parse_errors"]})

    def onQueryTerminated(self, event) -> None:
        self.ended.append({"run": str(event.runId), "error": event.exception})


def batch_metrics(batch: DataFrame, batch_id: int) -> DataFrame:
    """Messages, parse errors, stored and quarantined rows of one batch, by source. Every message
    is stored, and every one that did not parse is quarantined too."""
    bad = F.count_if("parse_error")
    rows = F.count(F.lit(1))
    return batch.groupBy("source_exchange").agg(
        rows.alias("messages"), bad.alias("parse_errors"), rows.alias("rows_inserted"),
        bad.alias("quarantined")).withColumn("batch_id", F.lit(batch_id).cast("bigint"))


def record_batch(batch: DataFrame, batch_id: int, root: str) -> None:
    (batch_metrics(batch, batch_id).coalesce(1).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
     .parquet(table_path(root, BATCHES)))


def record_commit(spark: SparkSession, batch_id: int, root: str, latency: float, committed: bool) -> None:
    """A committed batch is recorded once however often it is replayed; failures add up."""
    row = spark.range(1, numPartitions=1).select(
        F.lit(float(latency)).alias("latency_seconds"), F.lit(committed).alias("committed"),
        F.lit(batch_id).cast("bigint").alias("batch_id"))
    writer = row.write.partitionBy("committed", "batch_id")
    if committed:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.parquet(table_path(root, COMMITS))


def read_batches(spark: SparkSession, root: str) -> DataFrame:
    """Without the batches whose numbers were given up; their messages come again under others."""
    void = [F.lit(n) for n in sorted(voided(spark, root))]
    return spark.read.schema(_BATCHES).parquet(table_path(root, BATCHES)).filter(~F.col("batch_id").isin(void))


def read_commits(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(_COMMITS).parquet(table_path(root, COMMITS))


def counters(batches: DataFrame, commits: DataFrame) -> DataFrame:
    """One row: the running totals over all batches."""
    outcomes = commits.select(
        F.col("committed").cast("bigint").alias("batches_committed"),
        (~F.col("committed")).cast("bigint").alias("insert_failures"))
    both = batches.drop("source_exchange", "batch_id").unionByName(outcomes, allowMissingColumns=True)
    return both.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in both.columns])


def latency_histogram(latencies: DataFrame, column: str = "latency_seconds") -> DataFrame:
    """Cumulative counts per upper bound, the last one unbounded, in one pass over the rows."""
    bounds = [*LATENCY_BOUNDS, float("inf")]
    counted = latencies.agg(*[
        F.count_if(F.col(column) <= F.lit(le)).alias(f"_{i}") for i, le in enumerate(bounds)])
    buckets = F.array(*[
        F.struct(F.lit(le).alias("le"), F.col(f"_{i}").alias("count")) for i, le in enumerate(bounds)])
    return counted.select(F.inline(buckets))
