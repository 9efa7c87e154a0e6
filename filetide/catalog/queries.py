"""Every operator as a query over the bundled tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filetide import fixtures as X
from filetide.functions import columns as C
from filetide.functions import states as S
from filetide.functions.fields import json_string, json_text
from filetide.operators import dedup as D
from filetide.operators import normalize as N
from filetide.operators import rollup as R
from filetide.plans import usage as U
from filetide.schema import LAYOUT
from filetide.session import prepare, workspace
from filetide.sources.messages import read_messages, union_sources
from filetide.sources.tables import raw_view, read_raw, read_rollup
from filetide.storage import footers, layout, tables
from filetide.streaming import maintain, metrics
from filetide.streaming.ingest import commit_batch, store_batch, write_raw
from filetide.streaming.upkeep import upkeep

FILES_PER_BATCH = 64
ROWS_A_SMALL_FILE = 50_000

_built: dict[tuple[str, str, str], str] = {}
_last_first_delivery: dict[str, int] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[str], None]) -> str:
    """A stored table set that several read-only queries share; built once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        root = workspace(prepare(spark), name)
        build(root)
        _built[key] = root
    return _built[key]


def _ntz(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the bundled tables have them."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if f.dataType.typeName() == "timestamp" else F.col(f.name) for f in df.schema])


def _raw(spark, sf_dir):
    return X.access_records(spark, sf_dir)


def _delivery():
    return ((F.unix_seconds("ingest_time") - F.unix_seconds("event_time")) / 60).cast("int").alias("delivery")


def _hourly(spark, sf_dir, final=True):
    raw = _raw(spark, sf_dir)
    return R.rollup_latest(raw, R.HOURLY, _parts(spark, sf_dir)) if final else R.rollup(raw, R.HOURLY)


def _daily(spark, sf_dir):
    return R.rollup_latest(_raw(spark, sf_dir), R.DAILY, _parts(spark, sf_dir))


def _parts(spark, sf_dir) -> int:
    return X.tasks(X.table(spark, sf_dir, "lineitem").count())


# Stored tables

def _append_all(spark, sf_dir, root):
    with X.events_at_hand(spark, sf_dir):
        for number, batch in X.event_batches(X.event_records(spark, sf_dir)):
            tables.append_raw(batch, root, number)


def _stored(spark, sf_dir) -> str:
    return _once(spark, sf_dir, "stored", lambda root: _append_all(spark, sf_dir, root))


def _own_copy(spark, sf_dir, name) -> str:
    root = workspace(prepare(spark), name)
    _append_all(spark, sf_dir, root)
    return root


def _maintained(spark, sf_dir, mode, root) -> None:
    """Stores and maintains batch by batch; batches one and three arrive twice."""
    with X.events_at_hand(spark, sf_dir):
        batches = X.event_batches(X.event_records(spark, sf_dir))
        for number in (0, 1, 1, 2, 3, 3):
            tables.append_raw(batches[number][1], root, number)
            maintain.maintain_rollups(read_raw(spark, root).filter(F.col("batch_id") == number), number, root, mode)


def _as_inserted(spark, sf_dir) -> str:
    return _once(spark, sf_dir, "as_inserted",
                 lambda root: _maintained(spark, sf_dir, maintain.AS_INSERTED, root))


def _exact(spark, sf_dir) -> str:
    return _once(spark, sf_dir, "exact", lambda root: _maintained(spark, sf_dir, maintain.EXACT, root))


def _streamed(spark, sf_dir) -> str:
    """The ingest job run twice on one checkpoint: first deliveries, then second deliveries."""
    def build(root):
        for delivery in (1, 2):
            X.land_messages(spark, sf_dir, f"{root}/landing", delivery)
            stream = read_messages(spark, f"{root}/landing", max_files=FILES_PER_BATCH)
            write_raw(stream, root, f"{root}/checkpoint", {"availableNow": True}).awaitTermination()
            if delivery == 1:
                last = metrics.read_commits(spark, root).agg(F.max("batch_id")).first()[0]
                _last_first_delivery[root] = last

    return _once(spark, sf_dir, "streamed", build)


def _second_delivery(root):
    return F.col("batch_id") > _last_first_delivery[root]


def _states(spark, root, spec) -> DataFrame:
    return _ntz(R.totals(read_rollup(spark, root, spec), spec.keys, spec))


# Sources

def src1_read_messages(spark, sf_dir):
    root = workspace(prepare(spark), "messages")
    for delivery in (1, 2):
        X.land_messages(spark, sf_dir, f"{root}/landing", delivery)
    stream = read_messages(spark, f"{root}/landing", max_files=FILES_PER_BATCH)
    (stream.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
     .trigger(availableNow=True).start(f"{root}/read")).awaitTermination()
    return _ntz(spark.read.parquet(f"{root}/read").groupBy("source_exchange").agg(
        F.count(F.lit(1)).alias("messages"), F.min("recv_time").alias("first_time"),
        F.max("recv_time").alias("last_time")))


def src1_message_bodies(spark, sf_dir):
    """Every message as read back from landed files: source, whole body and arrival."""
    root = workspace(prepare(spark), "bodies")
    for delivery in (1, 2):
        X.land_messages(spark, sf_dir, f"{root}/landing", delivery)
    stream = read_messages(spark, f"{root}/landing", max_files=FILES_PER_BATCH)
    (stream.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
     .trigger(availableNow=True).start(f"{root}/read")).awaitTermination()
    return _ntz(spark.read.parquet(f"{root}/read").select("source_exchange", "body", "recv_time"))


def src2_union_sources(spark, sf_dir):
    rows = _raw(spark, sf_dir).select("event_id", "vo", "source_exchange")
    sources = {n: rows.filter(F.col("source_exchange") == n).drop("source_exchange")
               for n in ("primary", "secondary")}
    sources["unused"] = rows.drop("source_exchange")
    return union_sources(sources, " primary, secondary ,")


def src3_read_raw(spark, sf_dir):
    rows = read_raw(spark, _stored(spark, sf_dir), "2024-01-05 06:00:00", "2024-01-20 18:30:00")
    return _ntz(rows.select("event_time", "event_id", "vo", "read", "write"))


def src4_read_rollup(spark, sf_dir):
    states = read_rollup(spark, _exact(spark, sf_dir), R.HOURLY, "2024-01-05 06:00:00", "2024-01-20 18:00:00")
    return _ntz(R.totals(states, R.HOURLY.keys))


# Parse and normalise

def _parsed(spark, sf_dir):
    return N.parse_records(X.access_messages(spark, sf_dir))


def nrm1_parse_records(spark, sf_dir):
    keys = ["filename", "vo", "end_time", "read", "read_operations", "read_vector_count_average", "ipv6"]
    return _ntz(_parsed(spark, sf_dir).select(
        "recv_time", "source_exchange", *[F.col("record")[k].alias(k) for k in keys]))


def nrm2_parse_errors(spark, sf_dir):
    empty = F.col("record").isNull() & (F.length("body") > 0)
    return _parsed(spark, sf_dir).groupBy("source_exchange", "parse_error").agg(
        F.count(F.lit(1)).alias("messages"), F.count_if(empty).alias("empty_records"))


def nrm3_event_time(spark, sf_dir):
    """Each fallback in turn, chosen by the line number in the file name."""
    raw = _raw(spark, sf_dir)
    line = F.split(F.element_at(F.split("filename", "/"), -1), "-")[1].cast("int") % 4
    absent = F.lit(0).cast("bigint")
    time = C.event_time(
        F.when(line == 0, F.col("event_time")),
        F.when(line <= 1, F.unix_seconds("end_time")).otherwise(absent),
        F.when(line <= 2, F.unix_seconds("start_time")).otherwise(absent),
        F.col("ingest_time"))
    return _ntz(raw.select(F.col("ingest_time").alias("recv_time"), "filename", time.alias("event_time")))


def nrm4_project_layout(spark, sf_dir):
    wide = N.normalize_records(X.access_messages(spark, sf_dir))
    names = ["event_time", "event_id", "source_exchange", "parse_error", "server_id", "server_hostname",
             "server", "site", "user", "vo", "filename", "dirname1", "dirname2", "logical_dirname",
             "token_groups", "filesize", "read", "write", "readv"]
    return _ntz(wide.select(*names))


def nrm4_whole_layout(spark, sf_dir):
    """All columns of the event messages, those that a message does not mention included."""
    wide = N.normalize_records(X.event_messages(spark, sf_dir).drop("delivery"))
    return _ntz(wide.select(*LAYOUT.names, "parse_error"))


def nrm5_unix_time(spark, sf_dir):
    seconds = F.unix_seconds("event_time")
    return _ntz(_raw(spark, sf_dir).select(
        "event_id", _delivery(), C.unix_time(seconds).alias("end_time"),
        C.unix_time(seconds - 100).alias("start_time"), C.unix_time(-seconds).alias("negative")))


def nrm6_unsigned_ranges(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "event_id", _delivery(), "read_operations", "operation_time", "read_vector_count_min", "filesize")


def nrm7_flags(spark, sf_dir):
    return _raw(spark, sf_dir).select("event_id", _delivery(), "has_file_close_msg", "ipv6")


def nrm8_server_ip(spark, sf_dir):
    return _raw(spark, sf_dir).select("event_id", _delivery(), "server_ip")


def nrm9_event_id(spark, sf_dir):
    rows = N.with_event_id(_raw(spark, sf_dir).drop("event_id"))
    return _ntz(rows.select("filename", _delivery(), "event_time", "event_id"))


def nrm10_operation(spark, sf_dir):
    return N.with_operation(_raw(spark, sf_dir)).groupBy("operation").agg(
        F.count(F.lit(1)).alias("events"), F.sum("write").alias("bytes_written"))


def nrm11_buckets(spark, sf_dir):
    return _ntz(N.with_buckets(_raw(spark, sf_dir)).select(
        "event_id", _delivery(), "hour", "day", "partition_day", "partition_month"))


def nrm12_json_string(spark, sf_dir):
    rows = json_string(_raw(spark, sf_dir), "raw_json", "file_path")
    return json_string(rows, "raw_json", "filesize", "filesize_text").select(
        "event_id", _delivery(), "file_path", "filesize_text")


# Dedup

def ddp1_dedup_latest(spark, sf_dir):
    return _ntz(D.dedup_latest(_raw(spark, sf_dir)).select("event_id", "vo", "ingest_time"))


def ddp2_raw_view(spark, sf_dir):
    rows = raw_view(spark, _stored(spark, sf_dir), final=True).filter(F.col("vo") == "view")
    return _ntz(rows.select("event_id", "event_time", "vo"))


def ddp3_compact_raw(spark, sf_dir):
    root = _own_copy(spark, sf_dir, "compact")
    tables.compact_raw(spark, root)
    return read_raw(spark, root).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("events"))


def ddp4_drop_recent_duplicates(spark, sf_dir):
    root = workspace(prepare(spark), "recent")
    X.event_records(spark, sf_dir).select(*D.EVENT_KEY).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{root}/in").schema).parquet(f"{root}/in")
    once = D.drop_recent_duplicates(stream, "40 days")
    (once.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
     .trigger(availableNow=True).start(f"{root}/out")).awaitTermination()
    return _ntz(spark.read.parquet(f"{root}/out"))


def ddp4_by_arrival(spark, sf_dir):
    """State that is evicted between micro-batches: copies within two hours of an event's first arrival go,
    those after that come back. Half of the events arrive at first, the others five hours later; every
    fifth of both comes again, an hour and six hours after the start."""
    root = workspace(prepare(spark), "arrivals")
    first = X.event_records(spark, sf_dir).filter("delivery = 1").drop("delivery", "ingest_time")
    number = F.col("server_id").cast("long")
    arrivals = [(0, number % 2 == 0), (1, number % 10 == 0), (5, number % 2 == 1), (6, number % 5 == 0)]
    columns = ["recv_time", "event_time", "event_id", "server_hostname", "vo", "filename", "read", "write", "raw_json"]
    start = F.timestamp_seconds(F.lit(1_706_745_600))
    for hours, some in arrivals:
        sent = first.filter(some).withColumn("recv_time", start + F.make_dt_interval(F.lit(0), F.lit(hours)))
        sent.select(*columns).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(sent.select(*columns).schema).parquet(f"{root}/in")
        once = D.drop_recent_duplicates(stream, "2 hours", time="recv_time")
        (once.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
         .trigger(availableNow=True).start(f"{root}/out")).awaitTermination()
    return _ntz(spark.read.parquet(f"{root}/out").withColumn("raw_json", json_text(F.col("raw_json"), "serverID")))


def ddp5_duplicate_report(spark, sf_dir):
    return _ntz(D.duplicate_report(_raw(spark, sf_dir)))


def ddp5_excess_by_source(spark, sf_dir):
    return D.excess_by_source(_raw(spark, sf_dir))


# Sinks, layout, retention

def snk1_write_raw(spark, sf_dir):
    return D.count_by(read_raw(spark, _streamed(spark, sf_dir)), "event_date", "source_exchange", "parse_error")


def snk2_replayed_batches(spark, sf_dir):
    root = workspace(prepare(spark), "replayed")
    batches = X.event_batches(X.event_records(spark, sf_dir))
    for number in (0, 1, 2, 1, 3, 3, 0):
        tables.append_raw(batches[number][1], root, number)
    return read_raw(spark, root).groupBy("event_date", "vo").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("read").alias("bytes_read"))


def snk3_later_copy_wins(spark, sf_dir):
    root = _streamed(spark, sf_dir)
    rows = raw_view(spark, root).filter(~F.col("parse_error"))
    return rows.agg(F.count(F.lit(1)).alias("events"),
                    F.count_if(_second_delivery(root)).alias("from_second_delivery"))


def snk4_sorted_layout(spark, sf_dir):
    rows = read_raw(spark, _stored(spark, sf_dir), start="2024-01-10 00:00:00")
    return _ntz(rows.filter((F.col("server_hostname") == "srv-3") & (F.col("vo") == "click"))
                .select("event_time", "event_id", "vo"))


def snk4_row_groups(spark, sf_dir):
    """All events as one day of small row groups, stored as batches are and in no order: whether a reader of one
    hour skips most of them."""
    root = workspace(prepare(spark), "groups")
    # A footer names every column of every row group, and is read as a whole: files of so many rows keep it small.
    small = {"parquet.block.size": "8192", "maxRecordsPerFile": str(ROWS_A_SMALL_FILE)}
    hour = 1_706_745_600 + 12 * 3600
    rows = X.event_records(spark, sf_dir).drop("delivery").withColumn("event_time", F.timestamp_seconds(
        1_706_745_600 + F.pmod(F.unix_millis("event_time"), F.lit(86_400_000)) / 1000))
    tables.append_raw(rows, root, 0, small)
    unordered = tables.as_raw(rows).repartition(F.xxhash64("event_id", "ingest_time")).sortWithinPartitions(F.md5("event_id"))
    unordered.write.options(**small).parquet(f"{root}/unordered")
    found = None
    for name, path in (("stored", layout.raw_path(root)), ("unordered", f"{root}/unordered")):
        groups = footers.row_groups(spark, path, ["event_time", "server_hostname"])
        one = footers.skipping(groups, footers.may_hold_time("event_time", hour, hour + 3600)).select(
            F.lit(name).alias("layout"), "rows", (F.col("row_groups_read") * 2 < F.col("row_groups")).alias("most_skipped"))
        found = one if found is None else found.union(one)
    return found


def snk5_bucketed_dedup(spark, sf_dir):
    root = workspace(prepare(spark), "bucketed")
    table = "filetide_" + root.rsplit("-", 1)[-1]
    tables.write_bucketed(X.event_records(spark, sf_dir), root, table, 8)
    return _ntz(D.dedup_latest(spark.table(table)).select("event_id", "event_time", "vo"))


def snk6_quarantine(spark, sf_dir):
    return D.count_by(tables.read_quarantine(spark, _streamed(spark, sf_dir)), "source_exchange", "event_date")


def _over_many_days(spark, sf_dir, spans, apart):
    """The events in so many copies of their thirty days, ``apart`` days from one another, from the year 1250 on."""
    number = F.pmod(F.hash("event_id"), F.lit(spans))
    days = F.lit(86400).cast("bigint") * (number * apart - 282000)
    return X.event_records(spark, sf_dir).drop("delivery").withColumn(
        "event_time", F.timestamp_seconds(F.unix_seconds("event_time") + days))


def snk7_many_days(spark, sf_dir):
    """One batch of some thousand days between the years 1250 and 9000, of which every row is stored."""
    root = workspace(prepare(spark), "days")
    commit_batch(_over_many_days(spark, sf_dir, 150, 19000), 0, root, mode=None)
    stored = read_raw(spark, root)
    return stored.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("events"),
                      F.sum("read").alias("bytes_read"), (F.count_distinct("event_date") > 100).alias("many_days"),
                      F.count_if(F.to_date("event_time") != F.col("event_date")).alias("misplaced"))


def _catalog_counts(spark, root, step, database):
    tables.ensure_tables(spark, root, database)
    raw = spark.table(f"{database}.raw").agg(F.count(F.lit(1)).alias("n")).withColumn("of", F.lit("raw"))
    hourly = spark.table(f"{database}.rollup_hourly").agg(
        F.sum("events_state").cast("bigint").alias("n")).withColumn("of", F.lit("rollup"))
    return raw.unionByName(hourly).withColumn("step", F.lit(step))


def snk8_ensure_tables(spark, sf_dir):
    """What the catalog counts after refreshes, after an interrupted compaction and after a whole one."""
    root = _own_copy(spark, sf_dir, "catalog")
    database = "filetide_" + root.rsplit("-", 1)[-1]
    maintain.refresh(spark, root)
    days = layout.stored_days(spark, layout.raw_path(root), layout.RAW_DAY)
    maintain.refresh(spark, root, days[:5])
    found = [_kept(_catalog_counts(spark, root, "refreshed", database), root, 1)]
    tables.compact_raw(spark, root, clean=False)
    found.append(_kept(_catalog_counts(spark, root, "interrupted", database), root, 2))
    tables.compact_raw(spark, root)
    tables.compact_rollup(spark, root, R.HOURLY)
    found.append(_catalog_counts(spark, root, "compacted", database))
    return found[0].union(found[1]).union(found[2])


def _kept(df, root, number):
    """A result as it is now, before the tables change again."""
    df.write.parquet(f"{root}/_results/{number}")
    return df.sparkSession.read.parquet(f"{root}/_results/{number}")


def snk9_two_jobs(spark, sf_dir):
    """Two ingest jobs on one table, each stopped and started again without any argument."""
    root = workspace(prepare(spark), "jobs")
    for delivery in (1, 2):
        for job in ("a", "b"):
            X.land_messages(spark, sf_dir, f"{root}/landing-{job}", delivery)
            stream = read_messages(spark, f"{root}/landing-{job}", max_files=FILES_PER_BATCH)
            write_raw(stream, root, f"{root}/checkpoint-{job}", {"availableNow": True}, mode=None).awaitTermination()
    return D.count_by(read_raw(spark, root), "event_date", "source_exchange")


class _Lost(Exception):
    """The driver is gone."""


def _dying(at):
    def step(name):
        if name == at:
            raise _Lost(name)

    return step


def snk10_lost_drivers(spark, sf_dir):
    """Exact usage after jobs that were lost at each step of a batch: six come back and do it again, one never
    does, and its messages go to another job."""
    root = workspace(prepare(spark), "lost")
    rows = X.event_records(spark, sf_dir)
    job = F.pmod(F.xxhash64("event_id", "delivery"), F.lit(8))
    share = lambda n: rows.filter(job == n).drop("delivery")
    steps = ["marked", "claimed", "noted", "written", "stored", "counted"]
    with X.events_at_hand(spark, sf_dir):
        for n, step in enumerate([*steps, "written", None]):
            try:
                store_batch(share(n), 0, root, f"{root}/checkpoint-{n}", _dying(step), refresh_every=3)
            except _Lost:
                if n < len(steps):
                    store_batch(share(n), 0, root, f"{root}/checkpoint-{n}", refresh_every=3)
        upkeep(spark, root, X.AS_OF, raw_days=100_000, rollup_years=1000, lease_seconds=-1)
        store_batch(share(len(steps)), 1, root, f"{root}/checkpoint-{len(steps) + 1}")
    return _ntz(R.totals(read_rollup(spark, root), ["hour", "vo"], R.HOURLY))


def _after_upkeep(spark, sf_dir, as_of, days):
    root = _own_copy(spark, sf_dir, "expired")
    upkeep(spark, root, as_of, specs=(R.HOURLY,), raw_days=days)
    return root


def ret1_expire_raw(spark, sf_dir):
    """What is stored after upkeep: the boundary day is still whole, a reader hides its expired part."""
    as_of = "2024-03-11 12:00:00"
    root = _after_upkeep(spark, sf_dir, as_of, 60)
    stored = D.count_by(read_raw(spark, root), "event_date", name="stored")
    shown = D.count_by(read_raw(spark, root, as_of=as_of), "event_date", name="shown")
    return stored.join(shown, "event_date", "left")


def ret2_expire_rollup(spark, sf_dir):
    as_of = "2026-01-15 06:00:00"
    root = _after_upkeep(spark, sf_dir, as_of, 100_000)
    stored = R.totals(read_rollup(spark, root, R.HOURLY), ["hour"], R.HOURLY, ["events"])
    shown = read_rollup(spark, root, R.HOURLY, as_of=as_of).select("hour").distinct().withColumn("shown", F.lit(True))
    return _ntz(stored.join(shown, "hour", "left").select("hour", "events", F.coalesce("shown", F.lit(False)).alias("shown")))


def _late(spark, sf_dir, again) -> DataFrame:
    """Rows arrive for days whose raw rows have been rolled up and dropped."""
    root = _own_copy(spark, sf_dir, "late")
    upkeep(spark, root, "2024-03-11 12:00:00")
    late = X.event_records(spark, sf_dir).filter(F.col("event_time") < "2024-01-09 00:00:00")
    late = D.dedup_latest(late).withColumn("event_id", F.reverse("event_id"))
    tables.append_raw(late, root, 50)
    again(spark, root)
    again(spark, root)
    return _ntz(R.totals(read_rollup(spark, root), ["hour"], R.HOURLY, ["events"]))


def ret4_late_refresh(spark, sf_dir):
    return _late(spark, sf_dir, maintain.refresh)


def ret4_late_backfill(spark, sf_dir):
    return _late(spark, sf_dir, lambda spark, root: maintain.backfill(spark, root, R.HOURLY))


def ret3_longer_retention(spark, sf_dir):
    return D.count_by(read_raw(spark, _after_upkeep(spark, sf_dir, "2024-04-04 18:00:00", 90)), "event_date")


# Aggregation and rollups

def agg1_hourly_rollup(spark, sf_dir):
    return _ntz(R.finalize(_hourly(spark, sf_dir)))


def agg1_hourly_as_inserted(spark, sf_dir):
    return _ntz(R.finalize(_hourly(spark, sf_dir, final=False)))


def agg2_daily_rollup(spark, sf_dir):
    return R.finalize(_daily(spark, sf_dir), R.DAILY)


HOURLY_BY_SERVER = R.RollupSpec("rollup_hourly_server", "hour", ("server_hostname", "operation"))
DAILY_BY_VO = R.RollupSpec("rollup_daily_vo", "day", ("vo", "source_exchange"))


def agg1_hourly_by_server(spark, sf_dir):
    """Groups of several events, some of them copies."""
    return _ntz(R.finalize(R.rollup(D.dedup_latest(X.event_records(spark, sf_dir)), HOURLY_BY_SERVER), HOURLY_BY_SERVER))


def agg2_daily_by_vo(spark, sf_dir):
    """Groups of many events, which a revised copy leaves or enters."""
    return R.finalize(R.rollup(D.dedup_latest(X.event_records(spark, sf_dir)), DAILY_BY_VO), DAILY_BY_VO)


def agg3_count_states(spark, sf_dir):
    states = N.with_operation(_raw(spark, sf_dir)).groupBy("vo", "operation", "server_hostname").agg(
        S.count_state().alias("state"))
    return states.groupBy("vo", "operation").agg(S.final_number(S.count_merge("state")).alias("events"))


def agg4_sum_states(spark, sf_dir):
    states = _raw(spark, sf_dir).groupBy("server_hostname", "vo").agg(
        S.sum_state("read").alias("r"), S.sum_state("write").alias("w"))
    return states.groupBy("server_hostname").agg(
        S.final_number(S.sum_merge("r")).alias("bytes_read"),
        S.final_number(S.sum_merge("w")).alias("bytes_written"))


def agg5_distinct_states(spark, sf_dir):
    states = _raw(spark, sf_dir).groupBy("vo", "server_hostname").agg(S.uniq_state("filename").alias("u"))
    return states.groupBy("vo").agg(S.final_uniq(S.uniq_merge("u")).alias("unique_files"))


def agg5_exact_distincts(spark, sf_dir):
    """Different files per vo and day from rollups that batches keep exact, however many files there are."""
    root = workspace(prepare(spark), "names")
    names = R.names_of(R.HOURLY)
    for number, batch in X.event_batches(X.event_records(spark, sf_dir)):
        tables.append_raw(batch, root, number)
        maintain.refresh(spark, root, specs=(R.HOURLY, names))
    with_day = lambda spec: read_rollup(spark, root, spec).withColumn("day", F.col(layout.ROLLUP_DAY))
    return R.exact_totals(with_day(R.HOURLY), with_day(names), ["vo", "day"])


def agg6_incremental(spark, sf_dir):
    return _states(spark, _as_inserted(spark, sf_dir), R.HOURLY)


def agg6_incremental_daily(spark, sf_dir):
    return _states(spark, _as_inserted(spark, sf_dir), R.DAILY)


def agg7_exact(spark, sf_dir):
    return _states(spark, _exact(spark, sf_dir), R.HOURLY)


def agg7_exact_daily(spark, sf_dir):
    return _states(spark, _exact(spark, sf_dir), R.DAILY)


def agg7_many_days(spark, sf_dir):
    """Exact usage after one batch of a hundred and fifty days over seven thousand years."""
    root = workspace(prepare(spark), "days")
    commit_batch(_over_many_days(spark, sf_dir, 5, 707000), 0, root)
    return R.totals(read_rollup(spark, root, R.DAILY), ["vo"], R.DAILY, ["events", "bytes_read", "bytes_written"])


def agg8_compact_rollup(spark, sf_dir):
    root = workspace(prepare(spark), "compact")
    _maintained(spark, sf_dir, maintain.AS_INSERTED, root)
    tables.compact_rollup(spark, root, R.HOURLY)
    return _ntz(R.finalize(read_rollup(spark, root, R.HOURLY)).drop("bucket_date", "merged", "batch_id"))


WEEKLY = R.RollupSpec("rollup_weekly", "week", ("server_hostname", "vo"))
WEEKLY_BY_SITE = R.RollupSpec("rollup_weekly_site", "week", ("vo", "site"),
                              sums={"bytes_stored": "filesize"}, distinct={"unique_users": "user"})


def agg9_backfill(spark, sf_dir):
    root = _own_copy(spark, sf_dir, "backfill")
    maintain.backfill(spark, root, WEEKLY, date(2024, 1, 1), date(2024, 1, 16))
    maintain.backfill(spark, root, WEEKLY, date(2024, 1, 16))
    return R.totals(read_rollup(spark, root, WEEKLY), WEEKLY.keys, WEEKLY)


def agg10_weekly_by_site(spark, sf_dir):
    return R.finalize(R.rollup(D.dedup_latest(_raw(spark, sf_dir)), WEEKLY_BY_SITE), WEEKLY_BY_SITE)


def agg11_count_by(spark, sf_dir):
    return D.count_by(_raw(spark, sf_dir), "source_exchange", "vo")


# Read queries

def q1_usage_by_vo(spark, sf_dir):
    return U.usage_by_vo(_hourly(spark, sf_dir), X.AS_OF)


def q1_usage_by_vo_as_inserted(spark, sf_dir):
    return U.usage_by_vo(_hourly(spark, sf_dir, final=False), X.AS_OF)


def q2_server_series(spark, sf_dir):
    return _ntz(U.server_series(_hourly(spark, sf_dir), "Supplier#000000001", X.AS_OF, days=60))


def q3_top_servers(spark, sf_dir):
    return U.top_servers(_daily(spark, sf_dir), X.AS_OF)


def q4_split_by_source_operation(spark, sf_dir):
    return U.split_by_source_operation(_daily(spark, sf_dir), X.AS_OF)


def q5_top_directories(spark, sf_dir):
    return U.top_directories(_daily(spark, sf_dir), X.AS_OF)


def q6_raw_spot_check(spark, sf_dir):
    return _ntz(U.raw_spot_check(_raw(spark, sf_dir), "BUILDING", X.AS_OF, hours=24))


def q7_recover_field(spark, sf_dir):
    return _ntz(U.recover_field(_raw(spark, sf_dir), "secondary", "file_path", X.AS_OF, hours=24,
                                name="cache_file_path"))


def q8_count_by_source(spark, sf_dir):
    return U.count_by_source(_raw(spark, sf_dir), X.AS_OF)


def q9_count_final(spark, sf_dir):
    return U.count_final(_raw(spark, sf_dir))


# The same questions asked of what batches have stored and maintained: only the days in question are read.

STORED_AS_OF = "2024-01-25 12:00:00"


def stored_rollup(spark, sf_dir, spec, days):
    """The states of a rollup since some days before the day of ``STORED_AS_OF``."""
    end = datetime.fromisoformat(STORED_AS_OF)
    return read_rollup(spark, _exact(spark, sf_dir), spec, start=(end - timedelta(days=days + 1)).isoformat(" "), end=STORED_AS_OF)


def stored_raw(spark, sf_dir, hours):
    """Raw rows, copies included, of some hours before ``STORED_AS_OF``."""
    start = datetime.fromisoformat(STORED_AS_OF) - timedelta(hours=hours)
    return read_raw(spark, _exact(spark, sf_dir), start=start.isoformat(" "), end=STORED_AS_OF)


def q1_usage_by_vo_stored(spark, sf_dir):
    return U.usage_by_vo(stored_rollup(spark, sf_dir, R.HOURLY, 7), STORED_AS_OF)


def q2_server_series_stored(spark, sf_dir):
    return _ntz(U.server_series(stored_rollup(spark, sf_dir, R.HOURLY, 2), "srv-3", STORED_AS_OF))


def q3_top_servers_stored(spark, sf_dir):
    return U.top_servers(stored_rollup(spark, sf_dir, R.DAILY, 30), STORED_AS_OF)


def q4_split_by_source_operation_stored(spark, sf_dir):
    return U.split_by_source_operation(stored_rollup(spark, sf_dir, R.DAILY, 1), STORED_AS_OF)


def q5_top_directories_stored(spark, sf_dir):
    return U.top_directories(stored_rollup(spark, sf_dir, R.DAILY, 7), STORED_AS_OF)


def q6_raw_spot_check_stored(spark, sf_dir):
    return _ntz(U.raw_spot_check(stored_raw(spark, sf_dir, 24), "view", STORED_AS_OF, hours=24))


def q7_recover_field_stored(spark, sf_dir):
    return _ntz(U.recover_field(stored_raw(spark, sf_dir, 24), "stream", "dirname1", STORED_AS_OF, hours=24, name="directory"))


def q8_count_by_source_stored(spark, sf_dir):
    return U.count_by_source(stored_raw(spark, sf_dir, 24), STORED_AS_OF, hours=24)


def q9_count_final_stored(spark, sf_dir):
    return U.count_final(read_raw(spark, _exact(spark, sf_dir)))


# Pipeline metrics

def met1_batch_metrics(spark, sf_dir):
    root = _streamed(spark, sf_dir)
    delivery = F.when(_second_delivery(root), 2).otherwise(1).alias("delivery")
    return metrics.read_batches(spark, root).groupBy(delivery, "source_exchange").agg(
        *[F.sum(c).alias(c) for c in ("messages", "parse_errors", "rows_inserted", "quarantined")])


def met1_counters(spark, sf_dir):
    root = _streamed(spark, sf_dir)
    return metrics.counters(metrics.read_batches(spark, root), metrics.read_commits(spark, root)).select(
        "messages", "parse_errors", "rows_inserted", "quarantined")


def met3_outcomes(spark, sf_dir):
    """What a stream recorded that refused its first batch, for its many days, and stored it when asked again:
    counters and the histogram of its commits."""
    root = workspace(prepare(spark), "outcomes")
    for delivery, limits in ((1, (3, None)), (2, (None,))):
        X.land_messages(spark, sf_dir, f"{root}/landing", delivery)
        for limit in limits:
            stream = read_messages(spark, f"{root}/landing")  # all files of a delivery are one batch
            try:
                write_raw(stream, root, f"{root}/checkpoint", {"availableNow": True}, mode=None, max_days=limit).awaitTermination()
            except StreamingQueryException:
                if limit is None:
                    raise
    commits = metrics.read_commits(spark, root)
    timed = metrics.latency_histogram(commits.filter("committed")).filter(F.col("le") == float("inf"))
    return metrics.counters(metrics.read_batches(spark, root), commits).crossJoin(
        timed.select(F.col("count").alias("timed_commits")))


def met2_latency_histogram(spark, sf_dir):
    events = X.table(spark, sf_dir, "events")
    return metrics.latency_histogram(events.select((F.col("value") / 100.0).alias("latency_seconds")))


QUERIES = [
    src1_read_messages, src1_message_bodies, src2_union_sources, src3_read_raw, src4_read_rollup, nrm1_parse_records,
    nrm2_parse_errors, nrm3_event_time, nrm4_project_layout, nrm4_whole_layout, nrm5_unix_time, nrm6_unsigned_ranges,
    nrm7_flags, nrm8_server_ip, nrm9_event_id, nrm10_operation, nrm11_buckets, nrm12_json_string,
    ddp1_dedup_latest, ddp2_raw_view, ddp3_compact_raw, ddp4_drop_recent_duplicates, ddp4_by_arrival, ddp5_duplicate_report,
    ddp5_excess_by_source, snk1_write_raw, snk2_replayed_batches, snk3_later_copy_wins, snk4_sorted_layout, snk4_row_groups,
    snk5_bucketed_dedup, snk6_quarantine, snk7_many_days, snk8_ensure_tables, snk9_two_jobs, snk10_lost_drivers,
    ret1_expire_raw, ret2_expire_rollup, ret3_longer_retention, ret4_late_refresh, ret4_late_backfill, agg1_hourly_rollup, agg1_hourly_as_inserted,
    agg2_daily_rollup, agg1_hourly_by_server, agg2_daily_by_vo, agg3_count_states, agg4_sum_states, agg5_distinct_states, agg5_exact_distincts, agg6_incremental,
    agg6_incremental_daily, agg7_exact, agg7_exact_daily, agg7_many_days, agg8_compact_rollup, agg9_backfill,
    agg10_weekly_by_site, agg11_count_by, q1_usage_by_vo, q1_usage_by_vo_as_inserted, q2_server_series,
    q3_top_servers, q4_split_by_source_operation, q5_top_directories, q6_raw_spot_check, q7_recover_field,
    q8_count_by_source, q9_count_final, q1_usage_by_vo_stored, q2_server_series_stored, q3_top_servers_stored,
    q4_split_by_source_operation_stored, q5_top_directories_stored, q6_raw_spot_check_stored, q7_recover_field_stored,
    q8_count_by_source_stored, q9_count_final_stored, met1_batch_metrics, met1_counters, met2_latency_histogram, met3_outcomes,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {fn.__name__: fn for fn in QUERIES}
