"""Duplicates: keep the latest copy of each event, report copies, drop recent ones in flight."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filetide.schema import EVENT_KEY, VERSION

# Narrow columns that order copies with equal versions the same way on every run.
TIEBREAK = ["body_hash", "source_exchange"]


def _present(df: DataFrame, names) -> list[str]:
    return [n for n in names if n in df.columns]


def dedup_latest(df: DataFrame, keys=EVENT_KEY, version: str = VERSION, tiebreak=TIEBREAK, within=()) -> DataFrame:
    """One row per key, the one with the highest version.

    Asking a window for row 1 lets Spark keep a single candidate per key in every input task
    before it shuffles, so a key with very many copies never gathers in one place. Columns ``within``
    must follow from the keys; rows that are dealt by some of them and of the keys already stay where they are.
    """
    # The day follows from the event time; naming it lets day filters pass below the window.
    day = _present(df, ["event_date"]) if "event_time" in keys else []
    newest = Window.partitionBy(*within, *day, *keys).orderBy(
        F.col(version).desc(), *[F.col(c).desc() for c in _present(df, tiebreak)])
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def latest_in_files(df: DataFrame, keys=EVENT_KEY, version: str = VERSION, tiebreak=TIEBREAK) -> DataFrame:
    """``dedup_latest`` for rows read from files, whose wide columns stay out of the comparison.

    Only keys, versions and the places of rows are aggregated. Keys with several copies come back with the
    place of their latest one; that is a short list where copies are few, and then no row of the wide table
    moves at all. A row without a copy is looked up and found missing.
    """
    day = _present(df, ["event_date"]) if "event_time" in keys else []
    order = [version, *_present(df, tiebreak), "_file", "_row"]
    placed = df.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
    copied = placed.groupBy(*day, *keys).agg(
        F.count(F.lit(1)).alias("_copies"), F.max(F.struct(*order)).alias("_latest")).filter("_copies > 1")
    chosen = placed.join(copied.drop("_copies"), [*day, *keys], "left")
    latest = (F.col("_file") == F.col("_latest._file")) & (F.col("_row") == F.col("_latest._row"))
    return chosen.filter(F.col("_latest").isNull() | latest).select(*df.columns)


def duplicate_report(df: DataFrame, keys=EVENT_KEY) -> DataFrame:
    """Keys that occur more than once, with the number of copies."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def excess_by_source(df: DataFrame, keys=EVENT_KEY, version: str = VERSION, tiebreak=TIEBREAK) -> DataFrame:
    """Rows per source, rows that survive dedup, and the excess between the two."""
    # Each key's copies by source, with the best of each source: one pass, and no row for a copy.
    best = F.max(F.struct(*[F.col(c) for c in (version, *_present(df, tiebreak))]))
    by_source = df.groupBy(*keys, "source_exchange").agg(F.count(F.lit(1)).alias("copies"), best.alias("best"))
    of_key = by_source.groupBy(*keys).agg(
        F.max(F.struct("best", "source_exchange"))["source_exchange"].alias("winner"),
        F.collect_list(F.struct("source_exchange", "copies")).alias("sources"))
    each = of_key.select("winner", F.inline("sources"))
    return each.groupBy("source_exchange").agg(
        F.sum("copies").alias("rows"), F.count_if(F.col("winner").eqNullSafe(F.col("source_exchange"))).alias("final_rows")
    ).select("source_exchange", "rows", "final_rows", (F.col("rows") - F.col("final_rows")).alias("excess"))


def drop_recent_duplicates(stream: DataFrame, horizon: str, keys=EVENT_KEY, time: str = "event_time") -> DataFrame:
    """Drops later copies seen within ``horizon`` of the first, with bounded state.

    A cheap first line only: it keeps the first copy, whereas ``dedup_latest`` keeps the latest.
    """
    return stream.withWatermark(time, horizon).dropDuplicatesWithinWatermark(list(keys))


def count_by(df: DataFrame, *cols: str, name: str = "rows") -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))
