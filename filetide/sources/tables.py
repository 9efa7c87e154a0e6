"""Reading the stored tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filetide.operators.dedup import latest_in_files
from filetide.operators.rollup import HOURLY, RollupSpec
from filetide.storage import layout
from filetide.storage.retention import RAW_DAYS, unexpired_raw, unexpired_rollup


def _since_until(df: DataFrame, time: str, day: str, start, end, same_day: bool = True) -> DataFrame:
    """``start <= time < end``, said of the partition day as well so that days are pruned. A week
    or month begins on or before the day its states are kept under, so only ``start`` prunes."""
    for bound, is_start in ((start, True), (end, False)):
        if bound is None:
            continue
        at = datetime.fromisoformat(bound) if isinstance(bound, str) else bound
        value = F.lit(at.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
        date = F.lit(at.strftime("%Y-%m-%d")).cast("date")
        if is_start:
            df = df.filter((F.col(time) >= value) & (F.col(day) >= date))
        else:
            df = df.filter(F.col(time) < value)
            df = df.filter(F.col(day) <= date) if same_day else df
    return df


def _days(spark: SparkSession, path: str, day: str, start, end):
    """The stored days a bounded read may need, None if it is unbounded."""
    if start is None and end is None:
        return None
    bounds = [datetime.fromisoformat(x) if isinstance(x, str) else x for x in (start, end)]
    return layout.stored_days(spark, path, day, *[x.date() if x is not None else None for x in bounds])


def read_raw(spark: SparkSession, root: str, start=None, end=None, as_of=None, keep_days: int = RAW_DAYS) -> DataFrame:
    """Raw rows as stored, copies included; with ``as_of``, without those expired by then."""
    rows = layout.read_raw_parts(spark, root, _days(spark, layout.raw_path(root), layout.RAW_DAY, start, end))
    rows = _since_until(rows, "event_time", layout.RAW_DAY, start, end)
    return rows if as_of is None else unexpired_raw(rows, as_of, keep_days)


def raw_view(spark: SparkSession, root: str, final: bool = True, start=None, end=None, as_of=None) -> DataFrame:
    """Raw rows, by default the latest copy of each event. Time bounds apply before dedup, which
    is safe because all copies share the time; any other filter belongs after it."""
    rows = read_raw(spark, root, start, end, as_of)
    return latest_in_files(rows) if final and layout.in_files(rows) else rows


def read_rollup(spark: SparkSession, root: str, spec: RollupSpec = HOURLY, start=None, end=None,
                as_of=None) -> DataFrame:
    """States of a rollup; with ``as_of``, without the buckets expired by then."""
    same_day = spec.grain in ("hour", "day")
    days = _days(spark, layout.table_path(root, spec.name), layout.ROLLUP_DAY, start, end if same_day else None)
    rows = _since_until(layout.read_rollup_parts(spark, root, spec, days), spec.time, layout.ROLLUP_DAY,
                        start, end, same_day)
    return rows if as_of is None else unexpired_rollup(rows, spec, as_of)
