"""Tables of parquet files in day partitions that many micro-batches append to.

Below its day, a row lives in ``merged=0/batch_id=N`` (written by batch N) or
``merged=1/batch_id=N`` (one result standing for every batch up to N of that day). A reader takes,
per day, the highest merged result and the batches after it. So a replayed batch replaces itself,
or is ignored once merged; and publishing a merged day needs no lock: it appears as one new
directory, whose predecessors are removed afterwards.

Rollups have a third kind: a row in ``merged=2/batch_id=N`` stands for every state of its own group, and
of no other, up to batch N. It is written where a batch revised events that had been counted. Rows that
count no event only say that the batch has been seen. Numbers under ``_void`` were given up by their jobs:
what was written under them is not read.
"""

from __future__ import annotations

from collections import defaultdict
from datetime import date
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filetide.operators.rollup import RollupSpec, state
from filetide.schema import RAW_TABLE

RAW = "raw"
RAW_DAY = "event_date"
ROLLUP_DAY = "bucket_date"

ADDED, MERGED, REPLACED = 0, 1, 2


class Part(NamedTuple):
    day: date
    merged: int
    batch_id: int
    path: str


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def rollup_schema(spec: RollupSpec) -> T.StructType:
    fields = [T.StructField(spec.time, T.TimestampType() if spec.grain == "hour" else T.DateType())]
    fields += [T.StructField(d, T.StringType()) for d in spec.dims]
    fields.append(T.StructField(state(spec.count), T.LongType()))
    fields += [T.StructField(state(m), T.DecimalType(38, 0)) for m in spec.sums]
    fields += [T.StructField(state(m), T.BinaryType()) for m in spec.distinct]
    fields += [T.StructField(ROLLUP_DAY, T.DateType()), T.StructField("merged", T.IntegerType()),
               T.StructField("batch_id", T.LongType())]
    return T.StructType(fields)


def filesystem(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def day_path(path: str, day_column: str, day: date) -> str:
    return f"{path}/{day_column}={day.isoformat()}"


def stored_days(spark: SparkSession, path: str, day_column: str, start: date | None = None,
                end: date | None = None) -> list[date]:
    """Days from ``start`` to ``end``, both included, that have a folder; their contents are not listed."""
    fs, target = filesystem(spark, f"{path}/{day_column}=*")
    days = [date.fromisoformat(s.getPath().getName().split("=", 1)[1]) for s in fs.globStatus(target) or []]
    return sorted(d for d in days if (start is None or d >= start) and (end is None or d <= end))


def parts(spark: SparkSession, path: str, day_column: str, days=None) -> list[Part]:
    """Partition directories, of all or some days: as many as the days times their open batches."""
    folders = [f"{path}/{day_column}=*"] if days is None else [
        day_path(path, day_column, d) for d in sorted(days)]
    found = []
    for folder in folders:
        fs, target = filesystem(spark, f"{folder}/merged=*/batch_id=*")
        for status in fs.globStatus(target) or []:
            where = status.getPath().toString()
            day, merged, batch = (piece.split("=", 1)[1] for piece in where.split("/")[-3:])
            found.append(Part(date.fromisoformat(day), int(merged), int(batch), where))
    return found


def delete(spark: SparkSession, path: str) -> None:
    fs, target = filesystem(spark, path)
    fs.delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = filesystem(spark, path)
    return fs.exists(target)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = filesystem(spark, path)
    fs.mkdirs(target)


def merged_through(found: list[Part]) -> dict[date, int]:
    """Per day with a merged result, the last batch it covers."""
    through: dict[date, int] = {}
    for part in found:
        if part.merged == MERGED:
            through[part.day] = max(part.batch_id, through.get(part.day, part.batch_id))
    return through


def latest_batches(found: list[Part]) -> dict[date, int]:
    latest: dict[date, int] = defaultdict(lambda: -1)
    for part in found:
        latest[part.day] = max(part.batch_id, latest[part.day])
    return dict(latest)


def built_through(found: list[Part]) -> dict[date, int]:
    """Per day the last batch that a rollup has taken in as a whole."""
    return latest_batches([p for p in found if p.merged != REPLACED])


def by_day(values: dict[date, int], day_column: str) -> Column:
    """A batch number per day as a lookup on the partition column; NULL for other days."""
    if not values:
        return F.lit(None).cast("bigint")
    lookup = F.create_map(*[
        F.lit(x) for day, batch in sorted(values.items()) for x in (day, batch)])
    return F.try_element_at(lookup, F.col(day_column)).cast("bigint")


def voided(spark: SparkSession, root: str) -> set[int]:
    """Batch numbers that were given up."""
    fs, target = filesystem(spark, f"{root}/_void/*")
    return {int(s.getPath().getName().split("-", 1)[0]) for s in fs.globStatus(target) or []}


def read_shown(spark: SparkSession, path: str, schema: T.StructType, shown: list[Part]) -> DataFrame:
    """The rows of some directories of one table."""
    if not shown:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*[p.path for p in shown])


def in_files(rows: DataFrame) -> bool:
    """Whether rows come from files, which have places, and not from an empty table."""
    try:
        rows.select("_metadata.row_index")
    except AnalysisException:
        return False
    return True


def read_parts(spark: SparkSession, root: str, name: str, schema: T.StructType, day_column: str,
               days=None) -> DataFrame:
    """The rows a reader should see, of all days or only of ``days``, whose folders alone are
    listed then. Directories that a merged result replaces are left out by name."""
    path = table_path(root, name)
    return read_shown(spark, path, schema, visible(_living(spark, root, parts(spark, path, day_column, days))))


def _living(spark: SparkSession, root: str, found: list[Part]) -> list[Part]:
    void = voided(spark, root)
    return [p for p in found if p.batch_id not in void]


def visible(found: list[Part]) -> list[Part]:
    """Per day the highest merged result and the batches after it."""
    through = merged_through(found)
    return [p for p in found if p.day not in through or p.batch_id > through[p.day]
            or (p.merged == MERGED and p.batch_id == through[p.day])]


def write_parts(df: DataFrame, path: str, day_column: str, batch_id, merged: int = 0,
                order: list | None = None, options: dict[str, str] | None = None) -> None:
    """Replaces this batch's directories in every day it touches, and no others.

    Rebalancing by day writes few files per day and splits a day that holds most of the rows.
    """
    batch = F.lit(batch_id) if isinstance(batch_id, int) else batch_id
    placed = df.withColumn("merged", F.lit(merged)).withColumn("batch_id", batch.cast("bigint"))
    placed = placed.hint("rebalance", F.col(day_column))
    # Sorted rows give row groups narrow ranges, which time and host filters skip by.
    placed = placed.sortWithinPartitions(day_column, *(order or []))
    (placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("parquet.bloom.filter.enabled#vo", "true")
     .option("parquet.bloom.filter.expected.ndv#vo", "10000")
     .option("parquet.bloom.filter.enabled#source_exchange", "true")
     .option("parquet.bloom.filter.expected.ndv#source_exchange", "1000")
     .options(**(options or {})).partitionBy(day_column, "merged", "batch_id").parquet(path))


def vacuum(spark: SparkSession, path: str, day_column: str, days=None) -> list[str]:
    """Removes the directories that merged results replace, and those of numbers that were given up."""
    found = parts(spark, path, day_column, days)
    shown = set(visible(_living(spark, path.rsplit("/", 1)[0], found)))
    stale = [p.path for p in found if p not in shown]
    for where in stale:
        delete(spark, where)
    return stale


def expired_through(spark: SparkSession, root: str) -> date | None:
    """The last day up to which raw rows have been dropped."""
    fs, target = filesystem(spark, f"{root}/_expired/through=*")
    days = [date.fromisoformat(s.getPath().getName().split("=", 1)[1]) for s in fs.globStatus(target) or []]
    return max(days, default=None)


def note_expiry(spark: SparkSession, root: str, day: date) -> None:
    """Written before rows are dropped, so that no rebuild takes what is left for the whole."""
    before = expired_through(spark, root)
    if before is None or day > before:
        make_folder(spark, f"{root}/_expired/through={day.isoformat()}")
        if before is not None:
            delete(spark, f"{root}/_expired/through={before.isoformat()}")


def raw_path(root: str) -> str:
    return table_path(root, RAW)


def raw_parts(spark: SparkSession, root: str, days=None, hidden: bool = False) -> list[Part]:
    found = parts(spark, raw_path(root), RAW_DAY, days)
    return found if hidden else _living(spark, root, found)


def read_raw_parts(spark: SparkSession, root: str, days=None) -> DataFrame:
    return read_parts(spark, root, RAW, RAW_TABLE, RAW_DAY, days)


def rollup_parts(spark: SparkSession, root: str, spec: RollupSpec, days=None) -> list[Part]:
    return _living(spark, root, parts(spark, table_path(root, spec.name), ROLLUP_DAY, days))


def read_rollup_parts(spark: SparkSession, root: str, spec: RollupSpec, days=None,
                      through: dict[date, int] | None = None) -> DataFrame:
    """The states a reader should see; with ``through``, as they were after these batches."""
    found = rollup_parts(spark, root, spec, days)
    if through is not None:
        found = [p for p in found if p.batch_id <= through.get(p.day, -1)]
    built = built_through(found)
    # What replaces groups counts from the moment its batch has been published as a whole.
    shown = visible([p for p in found if p.merged != REPLACED or p.batch_id <= built.get(p.day, -1)])
    path, schema = table_path(root, spec.name), rollup_schema(spec)
    revised = {p.day for p in shown if p.merged == REPLACED}
    rows = read_shown(spark, path, schema, [p for p in shown if p.day not in revised])
    if revised:
        rows = rows.union(without_replaced(
            read_shown(spark, path, schema, [p for p in shown if p.day in revised]), [ROLLUP_DAY, *spec.keys]))
    return rows.filter(F.col(state(spec.count)) != 0)


def without_replaced(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` of a rollup without those that a later row of their group stands for."""
    last = rows.filter(F.col("merged") == REPLACED).groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.max("batch_id").alias("_last"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    stands = F.col("_last").isNull() | (F.col("batch_id") > F.col("_last")) | (
        (F.col("batch_id") == F.col("_last")) & (F.col("merged") == REPLACED))
    return rows.join(last, same, "left").filter(stands).select(*rows.columns)
