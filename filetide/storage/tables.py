"""Writing, creating and compacting the stored tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filetide.functions import columns as C
from filetide.operators.dedup import latest_in_files
from filetide.operators.rollup import DAILY, HOURLY, RollupSpec, merge_states, state
from filetide.schema import EVENT_KEY, RAW_TABLE, VERSION
from filetide.session import prepare
from filetide.storage import layout
from filetide.storage.numbers import settled

QUARANTINE = "quarantine"


class TooManyDays(ValueError):
    """A batch touches more days than a single write may."""


def with_version(df: DataFrame, version=None) -> DataFrame:
    """Stamps the write time, the version that dedup prefers. On a stream it is one value per
    micro-batch, fixed in the stream's own plan so that a retried task stamps the same."""
    stamp = F.current_timestamp() if version is None else version
    return df.withColumn(VERSION, C.milliseconds(stamp))


def as_raw(df: DataFrame) -> DataFrame:
    """Normalised, versioned rows with the table's own columns filled in."""
    if "parse_error" not in df.columns:
        df = df.withColumn("parse_error", F.lit(False))
    if "body_hash" not in df.columns:
        df = df.withColumn("body_hash", C.body_hash("raw_json"))
    df = df.withColumn(layout.RAW_DAY, F.to_date("event_time"))
    partitions = {"merged", "batch_id"}
    return df.select(*[name for name in RAW_TABLE.names if name not in partitions])


def touched_days(df: DataFrame, day_column: str = layout.RAW_DAY,
                 limit: int | None = None) -> list[date]:
    """Distinct days of a batch; with a ``limit``, more are refused, and no more than that read back."""
    distinct = df.select(day_column).distinct()
    days = [row[0] for row in (distinct if limit is None else distinct.limit(limit + 1)).collect()]
    if limit is not None and len(days) > limit:
        raise TooManyDays(f"batch touches more than {limit} days")
    return sorted(days)


def raw_order() -> list:
    """Hours apart, so that a reader of some hours skips the rest of a day; within them by server and time."""
    return [F.date_trunc("hour", F.col("event_time")), *EVENT_KEY]


def append_raw(df: DataFrame, root: str, batch_id: int, options: dict[str, str] | None = None) -> None:
    """Writes one batch of raw rows; writing the same batch again replaces it. ``options`` are the writer's."""
    prepare(df.sparkSession)
    layout.write_parts(as_raw(df), layout.raw_path(root), layout.RAW_DAY, batch_id, order=raw_order(), options=options)


def append_rollup(states: DataFrame, root: str, spec: RollupSpec, batch_id, merged: int = 0) -> None:
    """Writes states of ``spec``, grouped by day as well; the same batch again replaces itself."""
    prepare(states.sparkSession)
    layout.write_parts(states, layout.table_path(root, spec.name), layout.ROLLUP_DAY, batch_id,
                       merged, order=spec.keys)


def write_quarantine(df: DataFrame, root: str, batch_id: int) -> None:
    """Copies rows that did not parse to a side table; the raw table keeps them too."""
    bad = as_raw(df).filter("parse_error").select(
        "source_exchange", "raw_json", VERSION, "event_time", layout.RAW_DAY)
    layout.write_parts(bad, layout.table_path(root, QUARANTINE), layout.RAW_DAY, batch_id)


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    shape = T.StructType([f for f in RAW_TABLE if f.name in (
        "source_exchange", "raw_json", VERSION, "event_time", layout.RAW_DAY, "merged", "batch_id")])
    return layout.read_parts(spark, root, QUARANTINE, shape, layout.RAW_DAY)


def write_bucketed(df: DataFrame, path: str, table: str, buckets: int) -> None:
    """All copies of an event in one bucket, so dedup needs no exchange.

    Only for tables without hot events: a bucket is read by one task.
    """
    (as_raw(df).write.mode("overwrite").option("path", path).format("parquet")
     .bucketBy(buckets, "event_id").sortBy(*EVENT_KEY).saveAsTable(table))


def ensure_tables(spark: SparkSession, root: str, database: str = "filetide",
                  specs: tuple[RollupSpec, ...] = (HOURLY, DAILY)) -> list[str]:
    """Registers the database, a table of all files of each stored table (``raw_files``) with the days
    now stored, and a view by its plain name that shows what a reader sees: per day the highest merged
    result and the batches after it. Calling it again brings the days up to date."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    wanted = [(layout.RAW, RAW_TABLE, layout.RAW_DAY)]
    wanted += [(s.name, layout.rollup_schema(s), layout.ROLLUP_DAY) for s in specs]
    names = []
    for name, schema, day in wanted:
        layout.make_folder(spark, layout.table_path(root, name))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        files = f"`{database}`.`{name}_files`"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {files} ({columns}) USING parquet "
            f"PARTITIONED BY (`{day}`, merged, batch_id) LOCATION '{layout.table_path(root, name)}'")
        spark.sql(f"MSCK REPAIR TABLE {files} SYNC PARTITIONS")
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS " + _reader_sql(
            files, day, next((s for s in specs if s.name == name), None), layout.voided(spark, root)))
        names.append(f"{database}.{name}")
    return names


def _reader_sql(files: str, day: str, spec: RollupSpec | None, void: set[int]) -> str:
    """What a reader sees, in SQL: ``spec`` is that of a rollup, whose groups may have been replaced."""
    living = f"(SELECT * FROM {files} WHERE batch_id NOT IN ({', '.join(map(str, sorted(void)))}))" if void else files
    of_day = (f"(SELECT `{day}` AS d, max(CASE WHEN merged = 1 THEN batch_id END) AS through, "
              f"max(CASE WHEN merged <> 2 THEN batch_id END) AS built FROM {living} GROUP BY `{day}`)")
    rows = (f"SELECT f.* FROM {living} f JOIN {of_day} m ON f.`{day}` = m.d", "WHERE (m.through IS NULL OR "
            "f.batch_id > m.through OR (f.merged = 1 AND f.batch_id = m.through))")
    if spec is None:
        return " ".join(rows)
    keys = [day, *spec.keys]
    named = ", ".join(f"x.`{k}`" for k in keys)
    last = (f"(SELECT {named}, max(x.batch_id) AS last FROM {living} x JOIN {of_day} y ON x.`{day}` = y.d "
            f"WHERE x.merged = 2 AND x.batch_id <= y.built AND (y.through IS NULL OR x.batch_id > y.through) GROUP BY {named})")
    same = " AND ".join(f"f.`{k}` <=> r.`{k}`" for k in keys)
    return (f"{rows[0]} LEFT JOIN {last} r ON {same} {rows[1]} AND (f.merged <> 2 OR f.batch_id <= m.built) AND "
            f"(r.last IS NULL OR f.batch_id > r.last OR (f.batch_id = r.last AND f.merged = 2)) "
            f"AND f.`{state(spec.count)}` <> 0")


def _open_days(found: list[layout.Part], settled: int | None) -> dict[date, int]:
    """Last batch, up to ``settled``, of each day that is not a single merged result already."""
    shown = [p for p in layout.visible(found) if settled is None or p.batch_id <= settled]
    latest = layout.latest_batches(shown)
    return {d: n for d, n in latest.items() if any(p.day == d and p.merged != layout.MERGED for p in shown)}


def _compact(rows: DataFrame, path: str, day_column: str, days: dict[date, int], shrink, order,
             clean: bool, listed) -> list[date]:
    """Rewrites the days as merged results in one job, then removes what they replace."""
    if days:
        # Batches that arrive after the days were listed stay for the next time.
        known = rows.filter(F.col("batch_id") <= layout.by_day(days, day_column))
        one = shrink(known).drop("merged", "batch_id")
        layout.write_parts(one, path, day_column, layout.by_day(days, day_column), merged=1, order=order)
    if clean:  # also what an earlier run left behind, on days that need no rewriting now
        layout.vacuum(rows.sparkSession, path, day_column, listed)
    return sorted(days)


def compact_raw(spark: SparkSession, root: str, days=None, clean: bool = True) -> list[date]:
    """Collapses duplicates and small files, day by day; days already compact are left alone, and so
    are late rows of days that have expired, whose batches the rollups count one by one.

    ``clean=False`` leaves the replaced directories to a later ``layout.vacuum``, for readers that
    are still using them.
    """
    prepare(spark)
    horizon = layout.expired_through(spark, root)
    found = [p for p in layout.raw_parts(spark, root, days) if horizon is None or p.day > horizon]
    chosen = _open_days(found, settled(spark, root))
    return _compact(layout.read_raw_parts(spark, root, chosen), layout.raw_path(root),
                    layout.RAW_DAY, chosen, latest_in_files, raw_order(), clean, days)


def compact_rollup(spark: SparkSession, root: str, spec: RollupSpec, days=None, clean: bool = True) -> list[date]:
    """Merges the state rows that share a key, day by day. No query changes its answer."""
    prepare(spark)

    def merge(rows: DataFrame) -> DataFrame:
        return merge_states(rows, [*spec.keys, layout.ROLLUP_DAY], spec)

    found = layout.rollup_parts(spark, root, spec, days)
    # Late batches of expired days must stay apart from what is not yet known to be counted.
    chosen = _open_days(found, settled(spark, root))
    return _compact(layout.read_rollup_parts(spark, root, spec, chosen, chosen),
                    layout.table_path(root, spec.name), layout.ROLLUP_DAY, chosen, merge,
                    spec.keys, clean, days)
