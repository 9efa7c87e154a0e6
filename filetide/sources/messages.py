"""Message streams: bodies tagged with the source they came from and when they arrived."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filetide.schema import ENVELOPE


def read_messages(spark: SparkSession, path: str, file_format: str = "json",
                  schema: T.StructType = ENVELOPE, max_files: int | None = None,
                  source: str | None = None) -> DataFrame:
    """An unbounded stream of message files.

    ``max_files`` bounds what one micro-batch takes in. With ``file_format="text"`` every line is
    a body, ``source`` names its origin and the micro-batch time is its arrival.
    """
    reader = spark.readStream.format(file_format)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if file_format != "text":
        return reader.schema(schema).load(path)
    return reader.load(path).select(
        F.lit(source or "").alias("source_exchange"), F.col("value").alias("body"),
        F.current_timestamp().alias("recv_time"))


def allowed_names(names: str | list[str]) -> list[str]:
    """Source names from a list or comma-separated text; blanks are trimmed and dropped."""
    given = names.split(",") if isinstance(names, str) else names
    kept = [n.strip() for n in given if n.strip()]
    if not kept:
        raise ValueError("at least one source name is required")
    return kept


def union_sources(sources: dict[str, DataFrame], allow: str | list[str]) -> DataFrame:
    """The allowed sources as one frame, each row tagged with its source's name."""
    names = allowed_names(allow)
    missing = [n for n in names if n not in sources]
    if missing:
        raise ValueError(f"unknown sources: {', '.join(missing)}")
    tagged = [sources[n].withColumn("source_exchange", F.lit(n)) for n in dict.fromkeys(names)]
    return reduce(DataFrame.unionByName, tagged)
