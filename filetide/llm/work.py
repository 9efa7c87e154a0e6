"""Tables that a job writes on the way, in the folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

DELIVERY_S = 0.3


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; set only where the session has none and runs on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(os.path.join(tempfile.gettempdir(), "llm-shared"))
    return context._jsc.sc().getCheckpointDir().get()


def keep(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once as Parquet and reads it back: a cut in the lineage that survives lost executors."""
    spark = df.sparkSession
    path = f"{application_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    # Nothing refers to the job's shuffles any more, once its last events have been delivered; Spark's
    # cleaner drops their files when the driver has collected its garbage, which may be long after
    # disks are full.
    time.sleep(DELIVERY_S)
    spark.sparkContext._jvm.System.gc()
    kept = spark.read.schema(df.schema).parquet(path)
    kept.kept_at = path
    return kept


def forget(*tables: DataFrame) -> None:
    """Deletes tables that ``keep`` wrote and that nothing will read again."""
    for table in tables:
        _delete(table.sparkSession, table.kept_at)


def application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Deletes every table of this application; call it when its results have been stored elsewhere."""
    _delete(spark, application_folder(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
