"""What readers can skip: the row groups of stored files and the ranges their footers state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filetide.storage import layout

GROUPS = "file string, row_group int, rows long, bytes long, lows map<string,string>, highs map<string,string>"


def ranges_of(columns: list[str]):
    """What a task does with the paths it gets: reads footer by footer, keeping none."""
    wanted = list(columns)

    def read(batches):
        import re

        import pyarrow as pa
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        def said(value):
            return None if value is None else str(value.timestamp()) if hasattr(value, "timestamp") else str(value)

        for batch in batches:
            for path in batch.column("path").to_pylist():
                files, inner = pafs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", path))
                footer = pq.ParquetFile(inner, filesystem=files).metadata
                rows = []
                for number in range(footer.num_row_groups):
                    group = footer.row_group(number)
                    # Asked for its schema, a footer refers to itself and stays in memory with those read after it.
                    at = at if number else {group.column(i).path_in_schema: i for i in range(footer.num_columns)}
                    stated = {c: group.column(at[c]).statistics for c in wanted if c in at}
                    stated = {c: s for c, s in stated.items() if s is not None and s.has_min_max}
                    rows.append((path, number, group.num_rows, group.total_byte_size,
                                 [(c, said(s.min)) for c, s in stated.items()], [(c, said(s.max)) for c, s in stated.items()]))
                ranges = pa.map_(pa.string(), pa.string())
                kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), ranges, ranges]
                names = ["file", "row_group", "rows", "bytes", "lows", "highs"]
                yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return read


def row_groups(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """One row for each row group of the Parquet files below ``path``, with the least and greatest values that
    its footer states for ``columns``, times as seconds since 1970. Footers are read in tasks, a file each."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
        "recursiveFileLookup", "true").load(path).select("path")
    return files.mapInArrow(ranges_of(columns), GROUPS)


def may_hold_text(column: str, value: str) -> Column:
    """Whether a row group may hold ``column`` = ``value``."""
    return (F.coalesce(F.col("lows")[column], F.lit(value)) <= value) & (F.coalesce(F.col("highs")[column], F.lit(value)) >= value)


def may_hold_time(column: str, start: float, end: float) -> Column:
    """Whether a row group may hold a time from ``start`` to before ``end``, in seconds since 1970."""
    low, high = (F.col(x)[column].cast("double") for x in ("lows", "highs"))
    return F.coalesce(low < end, F.lit(True)) & F.coalesce(high >= start, F.lit(True))


def skipping(groups: DataFrame, wanted: Column) -> DataFrame:
    """One row: row groups and rows in all, and those that a reader with this filter must read."""
    return groups.agg(F.count(F.lit(1)).alias("row_groups"), F.count_if(wanted).alias("row_groups_read"),
                      F.sum("rows").alias("rows"), F.coalesce(F.sum(F.when(wanted, F.col("rows"))), F.lit(0)).alias("rows_read"))


def raw_row_groups(spark: SparkSession, root: str, columns: list[str]) -> DataFrame:
    return row_groups(spark, layout.raw_path(root), columns)
