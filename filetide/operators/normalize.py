"""Message bodies to the wide typed layout. Nothing is dropped: a body that does not parse
becomes an all-zero record that still carries the body and a flag."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filetide.functions import columns as C
from filetide.functions.columns import let
from filetide.functions.addresses import canonical_ip
from filetide.functions.fields import STRICT_JSON
from filetide.schema import FIELDS, LAYOUT, RECORD, TIMESTAMP_KEY

_TEXT_KEYS = [f.key for f in FIELDS if f.wire == "string"]
_BAD = "_bad"

# The JSON reader turns a number, boolean, object or array in a text field into its JSON text.
# Only bodies with a text value of that shape get their token types checked.
_NOT_PLAIN_TEXT = (
    r"(?m)^(?:-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?$|true$|false$|\{[\"}]"
    r"|\[(?:[\]\"{\[]|true|false|null|-?\d[\d.eE+-]*[,\]]))"
)


def _read_json(body: Column, element: T.StructType) -> Column:
    """Parse the body as the only element of an array, so that anything before or after the one
    JSON value makes the whole message invalid instead of being skipped."""
    shape = T.StructType([
        T.StructField("message", T.ArrayType(element)), T.StructField(_BAD, T.StringType())])
    wrapped = F.concat(F.lit('{"message":['), body, F.lit("]}"))
    return F.from_json(wrapped, shape, {**STRICT_JSON, "columnNameOfCorruptRecord": _BAD})


def _bad_time(record: Column) -> Column:
    time = record[TIMESTAMP_KEY]
    return time.isNotNull() & C.parse_rfc3339(time).isNull()


def _suspect(record: Column) -> Column:
    texts = F.concat_ws("\n", *[record[k] for k in _TEXT_KEYS])
    return texts.rlike(_NOT_PLAIN_TEXT) | _bad_time(record)


def _usable_part(body: Column, bad_time: Column) -> Column:
    """The body without the values that do not count: text fields that hold something other than
    a string and, if the time is malformed, everything from the time on, where decoding stops.
    NULL when every value counts or the body is no JSON object."""
    values = F.from_json(body, T.MapType(T.StringType(), T.VariantType()), STRICT_JSON)
    keys = F.json_object_keys(body)
    late = F.when(bad_time, F.slice(
        keys, F.array_position(keys, TIMESTAMP_KEY).cast("int"), F.size(keys)))

    def ignored(values):
        mistyped = F.map_filter(values, lambda key, value: key.isin(_TEXT_KEYS)
                                & ~F.schema_of_variant(value).isin("STRING", "VOID"))
        return F.concat(F.map_keys(mistyped), F.coalesce(late, F.array().cast("array<string>")))

    def without(values):
        return let(ignored(values), lambda names: F.when(
            F.size(names) > 0,
            F.map_filter(values, lambda key, _: ~F.array_contains(names, key))))

    return F.to_json(let(values, without))


def parse_records(df: DataFrame, body: str = "body", observed: str | None = None,
                  only: Column | str | None = None) -> DataFrame:
    """Adds ``record`` (55 fields, NULL = absent), ``record_time`` and ``parse_error``.

    A value of the wrong type is absent and flagged while its neighbours are kept. A malformed
    time ends decoding there, so later keys are absent too. Keys match by exact case.

    Messages and parse errors are observed under the name ``observed``. Filters do not pass below an
    observation: one on parsed fields would parse every body again for each field it names. A filter on the
    messages' own columns belongs in ``only``, from where it reaches the scan.
    """
    text = F.coalesce(F.col(body), F.lit(""))
    first = F.get(F.col("_parsed")["message"], F.lit(0))
    alone = F.coalesce(F.size(F.col("_parsed")["message"]) == 1, F.lit(False))
    df = df if only is None else df.filter(only)
    parsed = df.withColumn("_parsed", _read_json(text, RECORD))
    usable = parsed.withColumn("_usable", F.when(
        alone & _suspect(first), _usable_part(text, _bad_time(first))))
    records = usable.select(
        *df.columns,
        F.when(F.col("_usable").isNotNull(), F.get(_read_json(F.col("_usable"), RECORD)["message"], F.lit(0)))
        .when(alone, first).alias("record"),
        (F.col("_parsed")[_BAD].isNotNull() | ~alone | F.col("_usable").isNotNull()).alias("parse_error"),
    ).observe(
        observed or f"parsed-{uuid.uuid4().hex[:12]}",
        F.count(F.lit(1)).alias("messages"), F.count_if("parse_error").alias("parse_errors"))
    return records.withColumn("record_time", C.parse_rfc3339(F.col("record")[TIMESTAMP_KEY]))


def _stored(rule: str, value: Column) -> Column:
    if rule == "text":
        return F.coalesce(value, F.lit(""))
    if rule == "ip":
        return canonical_ip(value)
    if rule == "flag":
        return F.coalesce(value, F.lit(False)).cast("int")
    if rule == "real":
        return F.coalesce(value, F.lit(0.0))
    number = F.coalesce(value, F.lit(0))
    if rule == "unix":
        return C.unix_time(number)
    if rule == "u8":
        return C.low_byte(number)
    bits = int(rule[1:])
    return C.unsigned(number, bits).cast("int" if bits == 16 else "bigint")


def record_event_id(record) -> Column:
    """The content id over the values as parsed, before any clamping."""
    def text(key):
        return F.coalesce(record[key], F.lit(""))

    def number(key):
        return F.coalesce(record[key], F.lit(0)).cast("bigint")

    # The hashed fields, in hashing order.
    return C.event_id(
        [text(k) for k in ("serverID", "server", "filename", "logical_dirname")],
        [number(k) for k in ("start_time", "end_time", "filesize", "read", "readv", "write",
                             "read_bytes_at_close", "write_bytes_at_close")],
    )


def project_layout(df: DataFrame, body: str = "body", received: str = "recv_time") -> DataFrame:
    """The 58 columns, in table order, plus ``parse_error`` and ``body_hash``."""
    record = F.col("record")
    derived = {
        "event_time": C.event_time(
            F.col("record_time"), record["end_time"], record["start_time"], F.col(received)),
        "event_id": record_event_id(record),
        "source_exchange": F.coalesce(F.col("source_exchange"), F.lit("")),
        "raw_json": F.coalesce(F.col(body), F.lit("")),
    }
    derived |= {f.column: _stored(f.rule, record[f.key]) for f in FIELDS}
    return df.select(
        *[derived[name].alias(name) for name in LAYOUT.names],
        F.coalesce(F.col("parse_error"), F.lit(False)).alias("parse_error"),
        C.body_hash(derived["raw_json"]).alias("body_hash"),
    )


def normalize_records(df: DataFrame, body: str = "body", received: str = "recv_time",
                      observed: str | None = None, only: Column | str | None = None) -> DataFrame:
    return project_layout(parse_records(df, body, observed, only), body, received)


def normalize_ip(df: DataFrame, column: str = "server_ip") -> DataFrame:
    return df.withColumn(column, canonical_ip(F.col(column)))


def with_operation(df: DataFrame) -> DataFrame:
    return df.withColumn("operation", C.operation())


def with_event_id(df: DataFrame) -> DataFrame:
    """The content id from table columns (equal to the parsed values unless those were clamped)."""
    return df.withColumn("event_id", C.event_id(
        [F.col(c) for c in ("server_id", "server", "filename", "logical_dirname")],
        [F.unix_seconds("start_time"), F.unix_seconds("end_time")]
        + [F.col(c) for c in ("filesize", "read", "readv", "write",
                              "read_bytes_at_close", "write_bytes_at_close")]))


def with_buckets(df: DataFrame, time: str = "event_time") -> DataFrame:
    """Hour and day buckets, and the day and month numbers the reference partitions by."""
    return (
        df.withColumn("hour", C.bucket(time, "hour"))
        .withColumn("day", C.bucket(time, "day"))
        .withColumn("partition_day", F.date_format(time, "yyyyMMdd"))
        .withColumn("partition_month", F.date_format(time, "yyyyMM"))
    )
