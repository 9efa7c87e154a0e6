"""Expiry: whole days are dropped from storage, the boundary day is cut by a filter."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filetide.operators.rollup import RollupSpec
from filetide.storage import layout

RAW_DAYS = 60
ROLLUP_YEARS = 2


def _moment(as_of) -> datetime:
    return datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of


def _at(as_of):
    return F.lit(_moment(as_of).strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def unexpired_raw(df: DataFrame, as_of, days: int = RAW_DAYS) -> DataFrame:
    """Rows whose whole second plus ``days`` lies after ``as_of``."""
    expires = F.date_trunc("second", "event_time") + F.make_dt_interval(F.lit(days))
    kept = df.filter(expires > _at(as_of))
    if layout.RAW_DAY in df.columns:
        oldest = (_moment(as_of) - timedelta(days=days)).date()
        kept = kept.filter(F.col(layout.RAW_DAY) >= F.lit(oldest))
    return kept


def unexpired_rollup(df: DataFrame, spec: RollupSpec, as_of, years: int = ROLLUP_YEARS) -> DataFrame:
    """Buckets whose start plus ``years`` calendar years lies after ``as_of``."""
    expires = F.col(spec.time).cast("timestamp") + F.make_ym_interval(F.lit(years))
    return df.filter(expires > _at(as_of))


def add_years(day: date, years: int) -> date:
    try:
        return day.replace(year=day.year + years)
    except ValueError:  # 29 February
        return day.replace(year=day.year + years, day=28)


def _drop_days(spark: SparkSession, path: str, day_column: str, expired, note=None) -> list[date]:
    gone = [day for day in layout.stored_days(spark, path, day_column) if expired(day)]
    if gone and note is not None:
        note(gone[-1])
    for day in gone:
        layout.delete(spark, f"{path}/{day_column}={day.isoformat()}")
    return gone


def expire_raw(spark: SparkSession, root: str, as_of, days: int = RAW_DAYS) -> list[date]:
    """Drops the days all of whose rows have expired; returns them. Rollups of these days are no
    longer rebuilt: rows that still arrive for them are added to what is there."""
    now = _moment(as_of)

    def expired(day: date) -> bool:
        return datetime.combine(day, time(23, 59, 59)) + timedelta(days=days) <= now

    return _drop_days(spark, layout.raw_path(root), layout.RAW_DAY, expired,
                      lambda day: layout.note_expiry(spark, root, day))


def expire_rollup(spark: SparkSession, root: str, spec: RollupSpec, as_of,
                  years: int = ROLLUP_YEARS) -> list[date]:
    """Drops the days all of whose buckets have expired; returns them."""
    now = _moment(as_of)
    last_bucket = time(23) if spec.grain == "hour" else time()

    def expired(day: date) -> bool:
        return datetime.combine(add_years(day, years), last_bucket) <= now

    return _drop_days(spark, layout.table_path(root, spec.name), layout.ROLLUP_DAY, expired)
