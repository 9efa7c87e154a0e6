"""Access records made from the bundled tables: every line item is one file access.

Accesses whose order key is a multiple of ten are delivered twice, a minute apart; one in ten of
the second deliveries carries a revised vo. Messages whose order key is a multiple of 97 arrive
cut short. ``filetide/catalog/oracles.py`` says the same in SQL.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filetide.operators.normalize import record_event_id, _stored
from filetide.schema import FIELDS, LAYOUT, RECORD, TIMESTAMP_KEY
from filetide.session import prepare

AS_OF = "2001-07-01 00:00:00"
# lineitem and events may be single files of one row group, which one task would read and turn into messages alone.
# They are dealt over at least so many tasks, events over fewer while there are few, and a task gets no more rows
# than this, since what it sorts must fit it at any size.
DEALT = 32
ROWS_A_TASK, FEW_ROWS = 250_000, 4_000
TABLES = ("lineitem", "orders", "customer", "supplier", "part", "nation")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(spark: SparkSession, sf_dir: str, name: str, *keys: str, least: int = DEALT) -> DataFrame:
    """A table by hash of ``keys`` over as many tasks as its rows need; footers say how many rows there are."""
    rows = table(spark, sf_dir, name)
    return rows.repartition(tasks(rows.count(), least), *keys)


def tasks(rows: int, least: int = 1) -> int:
    """How many tasks rows are dealt over."""
    return max(least, -(-rows // ROWS_A_TASK), min(DEALT, -(-rows // FEW_ROWS)))


def dealt_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dealt(spark, sf_dir, "events", "event_id", "ts", "user_id", least=1)


@contextmanager
def events_at_hand(spark: SparkSession, sf_dir: str) -> Iterator[None]:
    """Meanwhile the events as read are kept where they were dealt to, for those who go through them several times."""
    events = dealt_events(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield
    finally:
        events.unpersist()


def _deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined tables with one row per delivery; Spark chooses the joins. Orders meet their customers, and
    suppliers their nations, before line items do: these are several times as many, and would be sorted once more.
    Parts come last, since their texts are the longest."""
    _, orders, customer, supplier, part, nation = (table(spark, sf_dir, t) for t in TABLES)
    ordered = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    supplied = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    joined = (
        dealt(spark, sf_dir, "lineitem", "l_orderkey").join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplied, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
    )
    copies = F.when(F.col("l_orderkey") % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    second = F.unix_seconds(F.col("l_shipdate").cast("timestamp")) + (F.col("l_orderkey") * 7919) % 86400
    return joined.withColumn("delivery", F.explode(copies)).withColumn(
        "event_time", F.timestamp_seconds(second))


def server_address() -> Column:
    """Five ways to write an address: IPv4, upper-case and padded IPv6, none, scoped, embedded."""
    key = F.col("l_suppkey")
    octet = (key % 256).cast("string")
    group = F.hex(key % 65536)
    return (
        F.when(key % 5 == 0, F.concat(F.lit("10.1.2."), octet))
        .when(key % 5 == 1, F.concat(F.lit("2001:0DB8:0:0:1::00"), F.lpad(F.hex(key % 256), 2, "0")))
        .when(key % 5 == 2, F.lit(""))
        .when(key % 5 == 3, F.concat(F.lit("fe80::"), group, F.lit("%eth0")))
        .otherwise(F.concat(F.lit("::FFFF:10.1.2."), octet))
    )


def _wire() -> dict[str, Column]:
    """Message values by JSON key. The counters go out of range on purpose."""
    size = F.col("l_quantity").cast("bigint") * 1048576
    written = F.col("l_returnflag") == "R"
    seconds = F.unix_seconds("event_time")
    revised = (F.col("delivery") == 2) & (F.col("l_orderkey") % 100 == 0)
    top = F.concat(F.lit("/"), F.col("p_brand"))
    directory = F.concat(top, F.lit("/"), F.col("p_type"))
    name = F.concat(directory, F.lit("/"), F.concat_ws(
        "-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey")]), F.lit(".dat"))
    quantity = F.col("l_quantity").cast("int")
    return {
        "start_time": seconds - 100,
        "end_time": seconds,
        "operation_time": (F.col("l_extendedprice") * 100000).cast("bigint") - 1000000000,
        "serverID": F.concat(F.lit("srv-"), F.col("l_suppkey").cast("string")),
        "server_hostname": F.col("s_name"),
        "server": F.concat(F.col("s_name"), F.lit(":1094")),
        "server_ip": server_address(),
        "site": F.col("n_name"),
        "user": F.col("c_name"),
        "vo": F.when(revised, F.lit("REVISED")).otherwise(F.col("c_mktsegment")),
        "filename": name,
        "dirname1": top,
        "dirname2": directory,
        "logical_dirname": directory,
        "protocol": F.lit("https"),
        "ipv6": F.col("l_linestatus") == "O",
        "filesize": size,
        "read_operations": quantity - 25,
        "read": F.when(written, F.lit(0).cast("bigint")).otherwise(size),
        "write": F.when(written, size).otherwise(F.lit(0).cast("bigint")),
        "read_vector_count_min": (quantity - 10).cast("smallint"),
        "read_vector_count_max": (quantity * 100).cast("smallint"),
        "read_vector_count_average": F.col("l_discount"),
        "HasFileCloseMsg": (quantity * 8).cast("bigint"),
    }


def _cut_short(body: str, cut: str) -> Column:
    """A body that another projection has made, so that its JSON is written once whichever part of it is taken."""
    return F.when(F.col(cut), F.substring(body, F.lit(1), F.length(body) - 20)).otherwise(F.col(body)).alias(body)


def _source() -> Column:
    return F.when(F.col("l_linestatus") == "O", F.lit("primary")).otherwise(F.lit("secondary"))


def _minutes_later(n: Column) -> Column:
    return F.timestamp_seconds(F.unix_seconds("event_time") + n * 60)


def _body(wire: dict[str, Column]) -> Column:
    """JSON of the known fields plus ``file_path``, which has no column, for one source."""
    stamp = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    extra = F.when(_source() == "secondary", wire["filename"])
    return F.to_json(F.struct(
        stamp.alias(TIMESTAMP_KEY), *[value.alias(key) for key, value in wire.items()],
        extra.alias("file_path")))


def _layout(wire: dict[str, Column]) -> dict[str, Column]:
    """Table columns of a message with these values; fields it lacks hold their zero."""
    zeros = {"string": F.lit(""), "int": F.lit(0), "bigint": F.lit(0).cast("bigint"),
             "double": F.lit(0.0), "timestamp": F.lit("1970-01-01").cast("timestamp")}
    stored = {f.name: zeros[f.dataType.simpleString()] for f in LAYOUT}
    stored["server_ip"] = F.lit("::")
    stored |= {f.column: _stored(f.rule, wire[f.key]) for f in FIELDS if f.key in wire}
    absent = {f.name: F.lit(None).cast(f.dataType) for f in RECORD if f.name not in wire}
    return stored | {"event_time": F.col("event_time"), "event_id": record_event_id(absent | wire)}


def access_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised rows with their write time, as the raw table holds them."""
    wire = _wire()
    derived = _layout(wire) | {"source_exchange": _source(), "raw_json": _body(wire)}
    return _deliveries(spark, sf_dir).select(
        *[derived[name].alias(name) for name in LAYOUT.names],
        _minutes_later(F.col("delivery")).alias("ingest_time"),
        F.lit(False).alias("parse_error"),
    )


def access_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same accesses as messages: source, body and arrival time."""
    whole = _deliveries(spark, sf_dir).select(
        _source().alias("source_exchange"), _body(_wire()).alias("body"),
        _minutes_later(F.col("delivery")).alias("recv_time"), (F.col("l_orderkey") % 97 == 0).alias("cut"))
    return whole.select("source_exchange", _cut_short("body", "cut"), "recv_time")


def _event_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    copies = F.when(key % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return dealt_events(spark, sf_dir).withColumn("delivery", F.explode(copies)).select(
        F.col("event_id").alias("number"), "delivery", "event_type", "user_id", "value", "props",
        F.date_trunc("MILLISECOND", F.col("ts").cast("timestamp")).alias("event_time"))


def _event_wire() -> dict[str, Column]:
    cents = F.round(F.col("value") * 100).cast("bigint")
    top = F.concat(F.lit("/"), F.col("event_type"))
    revised = (F.col("delivery") == 2) & (F.col("number") % 100 == 0)
    return {
        "serverID": F.col("number").cast("string"),
        "server_hostname": F.concat(F.lit("srv-"), (F.col("user_id") % 8).cast("string")),
        "vo": F.when(revised, F.lit("REVISED")).otherwise(F.col("event_type")),
        "filename": F.col("props"),
        "dirname1": top,
        "dirname2": top,
        "read": cents,
        "write": F.when(F.col("event_type") == "purchase", cents).otherwise(F.lit(0).cast("bigint")),
    }


def _event_body() -> Column:
    stamp = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return F.to_json(F.struct(
        stamp.alias(TIMESTAMP_KEY), *[v.alias(k) for k, v in _event_wire().items()]))


def _seconds_later(n: Column) -> Column:
    return F.timestamp_micros(F.unix_micros("event_time") + n * 1000000)


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as normalised rows: thirty days, redelivered like ``access_records``.
    ``delivery`` tells the copies apart."""
    derived = _layout(_event_wire()) | {
        "source_exchange": F.lit("stream"), "raw_json": _event_body()}
    return _event_deliveries(spark, sf_dir).select(
        *[derived[name].alias(name) for name in LAYOUT.names],
        _seconds_later(F.col("delivery")).alias("ingest_time"), "delivery")


def event_batches(records: DataFrame) -> list[tuple[int, DataFrame]]:
    """First deliveries in three batches by day of the month, then all second deliveries, which
    land late in every day."""
    day = F.dayofmonth("event_time")
    number = F.when(F.col("delivery") == 2, 3).when(day <= 10, 0).when(day <= 20, 1).otherwise(2)
    numbered = records.withColumn("_batch", number)
    return [(n, numbered.filter(F.col("_batch") == n).drop("_batch", "delivery")) for n in range(4)]


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as messages; every 97th is cut short. ``delivery`` tells the copies apart."""
    whole = _event_deliveries(spark, sf_dir).select(
        F.lit("stream").alias("source_exchange"), _event_body().alias("body"),
        _seconds_later(F.col("delivery")).alias("recv_time"), "delivery", (F.col("number") % 97 == 0).alias("cut"))
    return whole.select("source_exchange", _cut_short("body", "cut"), "recv_time", "delivery")


def land_messages(spark: SparkSession, sf_dir: str, path: str, delivery: int) -> None:
    """Adds one delivery of the event messages to a folder of JSON files, no more than ``DEALT`` of them."""
    messages = event_messages(spark, sf_dir).filter(F.col("delivery") == delivery).drop("delivery").coalesce(DEALT)
    (messages.write.mode("append").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").json(path))
