"""The accounting questions, asked of rollup states or raw rows.

``as_of`` stands for the present, so that answers can be reproduced. Windows run from ``as_of``
minus their length up to, but not including, ``as_of``. Every sort before a limit ends in columns
that make it total.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetide.functions.fields import json_text
from filetide.operators.dedup import count_by, dedup_latest
from filetide.operators.rollup import DAILY, HOURLY, totals
from filetide.schema import EVENT_KEY


def moment(as_of: datetime | str) -> datetime:
    return datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of


def _at(when: datetime):
    return F.lit(when.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def _day(when: datetime):
    return F.lit(when.strftime("%Y-%m-%d")).cast("date")


def _between(df: DataFrame, time: str, start: datetime, end: datetime, strict: bool = False,
             partition: str | None = None) -> DataFrame:
    lower = F.col(time) > _at(start) if strict else F.col(time) >= _at(start)
    df = df.filter(lower & (F.col(time) < _at(end)))
    if partition in df.columns:
        df = df.filter(F.col(partition).between(_day(start), _day(end)))
    return df


def _hours(states: DataFrame, as_of, days: int) -> DataFrame:
    end = moment(as_of)
    return _between(states, "hour", end - timedelta(days=days), end, partition="bucket_date")


def _days(states: DataFrame, as_of, days: int) -> DataFrame:
    """Whole days from ``days`` before the day of ``as_of`` to the last one begun before it."""
    start = moment(as_of) - timedelta(days=days)
    end = moment(as_of) - timedelta(microseconds=1)
    states = states.filter((F.col("day") >= _day(start)) & (F.col("day") <= _day(end)))
    if "bucket_date" in states.columns:
        states = states.filter(F.col("bucket_date").between(_day(start), _day(end)))
    return states


def _rows(raw: DataFrame, as_of, window: timedelta, strict: bool = False) -> DataFrame:
    end = moment(as_of)
    return _between(raw, "event_time", end - window, end, strict, partition="event_date")


def usage_by_vo(hourly: DataFrame, as_of, days: int = 7) -> DataFrame:
    measures = ["bytes_read", "bytes_written", "events", "unique_files"]
    return totals(_hours(hourly, as_of, days), ["vo"], HOURLY, measures).orderBy(
        F.desc("bytes_read"), "vo")


def server_series(hourly: DataFrame, host: str, as_of, days: int = 2) -> DataFrame:
    one = _hours(hourly, as_of, days).filter(F.col("server_hostname") == host)
    return totals(one, ["hour"], HOURLY, ["bytes_read"]).orderBy("hour")


def top_servers(daily: DataFrame, as_of, days: int = 30, n: int = 20) -> DataFrame:
    return totals(_days(daily, as_of, days), ["server_hostname"], DAILY,
                  ["unique_files", "bytes_read"]).orderBy(
        F.desc("unique_files"), F.desc("bytes_read"), "server_hostname").limit(n)


def split_by_source_operation(daily: DataFrame, as_of) -> DataFrame:
    yesterday = moment(as_of) - timedelta(days=1)
    one = daily.filter(F.col("day") == _day(yesterday))
    if "bucket_date" in daily.columns:
        one = one.filter(F.col("bucket_date") == _day(yesterday))
    return totals(one, ["source_exchange", "operation"], DAILY, ["events", "bytes_read"]).orderBy(
        F.desc("events"), "source_exchange", "operation")


def top_directories(daily: DataFrame, as_of, days: int = 7, n: int = 50) -> DataFrame:
    return totals(_days(daily, as_of, days), ["dirname1", "dirname2"], DAILY,
                  ["bytes_read", "events", "unique_files"]).orderBy(
        F.desc("bytes_read"), "dirname1", "dirname2").limit(n)


def raw_spot_check(raw: DataFrame, vo: str, as_of, hours: int = 1, n: int = 100) -> DataFrame:
    """Newest rows of one vo. Duplicates collapse first, so the filter sees only the winners."""
    latest = dedup_latest(_rows(raw, as_of, timedelta(hours=hours)))
    return latest.filter(F.col("vo") == vo).orderBy(F.desc("event_time"), "event_id").limit(n).select(
        "event_time", "server_hostname", "vo", "filename", "read", "write")


def recover_field(raw: DataFrame, source: str, key: str, as_of, hours: int = 1, n: int = 50,
                  name: str | None = None) -> DataFrame:
    """A field that has no column, from the preserved bodies of one source."""
    some = _rows(raw, as_of, timedelta(hours=hours)).filter(F.col("source_exchange") == source)
    return some.orderBy("event_time", "event_id", F.desc("ingest_time")).limit(n).select(
        "event_time", "source_exchange", json_text(F.col("raw_json"), key).alias(name or key))


def count_by_source(raw: DataFrame, as_of, hours: int = 1) -> DataFrame:
    """Rows as stored, duplicates included, after (not at) the lower bound."""
    return count_by(_rows(raw, as_of, timedelta(hours=hours), strict=True), "source_exchange")


def count_final(raw: DataFrame) -> DataFrame:
    """Distinct events, counted without choosing a copy of each."""
    return raw.select(*EVENT_KEY).distinct().agg(F.count(F.lit(1)).alias("rows"))
