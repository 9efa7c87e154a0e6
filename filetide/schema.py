"""The record a message carries, and the wide table it is stored in."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T


class Field(NamedTuple):
    key: str      # JSON key in the message
    column: str   # column in the raw table
    wire: str     # type the JSON value must have
    rule: str     # conversion applied on the way into the table


# Message keys, table columns and types, in table order.
# "unix" = Unix seconds to timestamp, "u64/u32/u16" = saturating unsigned,
# "u8" = saturate to 32 bits then keep the low 8, "flag" = boolean to 0/1.
FIELDS = [
    Field("start_time", "start_time", "bigint", "unix"),
    Field("end_time", "end_time", "bigint", "unix"),
    Field("operation_time", "operation_time", "bigint", "u32"),
    Field("serverID", "server_id", "string", "text"),
    Field("server_hostname", "server_hostname", "string", "text"),
    Field("server", "server", "string", "text"),
    Field("server_ip", "server_ip", "string", "ip"),
    Field("site", "site", "string", "text"),
    Field("user", "user", "string", "text"),
    Field("user_dn", "user_dn", "string", "text"),
    Field("user_domain", "user_domain", "string", "text"),
    Field("vo", "vo", "string", "text"),
    Field("host", "host", "string", "text"),
    Field("token_subject", "token_subject", "string", "text"),
    Field("token_username", "token_username", "string", "text"),
    Field("token_org", "token_org", "string", "text"),
    Field("token_role", "token_role", "string", "text"),
    Field("token_groups", "token_groups", "string", "text"),
    Field("experiment", "experiment", "string", "text"),
    Field("activity", "activity", "string", "text"),
    Field("filename", "filename", "string", "text"),
    Field("dirname1", "dirname1", "string", "text"),
    Field("dirname2", "dirname2", "string", "text"),
    Field("logical_dirname", "logical_dirname", "string", "text"),
    Field("protocol", "protocol", "string", "text"),
    Field("appinfo", "appinfo", "string", "text"),
    Field("ipv6", "ipv6", "boolean", "flag"),
    Field("filesize", "filesize", "bigint", "u64"),
    Field("read_operations", "read_operations", "int", "u32"),
    Field("read_single_operations", "read_single_operations", "int", "u32"),
    Field("read_vector_operations", "read_vector_operations", "int", "u32"),
    Field("write_operations", "write_operations", "int", "u32"),
    Field("read", "read", "bigint", "u64"),
    Field("read_single_bytes", "read_single_bytes", "bigint", "u64"),
    Field("readv", "readv", "bigint", "u64"),
    Field("write", "write", "bigint", "u64"),
    Field("read_min", "read_min", "int", "u32"),
    Field("read_max", "read_max", "int", "u32"),
    Field("read_average", "read_average", "bigint", "u64"),
    Field("read_single_min", "read_single_min", "int", "u32"),
    Field("read_single_max", "read_single_max", "int", "u32"),
    Field("read_single_average", "read_single_average", "bigint", "u64"),
    Field("read_vector_min", "read_vector_min", "int", "u32"),
    Field("read_vector_max", "read_vector_max", "int", "u32"),
    Field("read_vector_average", "read_vector_average", "bigint", "u64"),
    Field("write_min", "write_min", "int", "u32"),
    Field("write_max", "write_max", "int", "u32"),
    Field("write_average", "write_average", "bigint", "u64"),
    Field("read_vector_count_min", "read_vector_count_min", "smallint", "u16"),
    Field("read_vector_count_max", "read_vector_count_max", "smallint", "u16"),
    Field("read_vector_count_average", "read_vector_count_average", "double", "real"),
    Field("read_bytes_at_close", "read_bytes_at_close", "bigint", "u64"),
    Field("write_bytes_at_close", "write_bytes_at_close", "bigint", "u64"),
    Field("HasFileCloseMsg", "has_file_close_msg", "bigint", "u8"),
]
TIMESTAMP_KEY = "@timestamp"

# The key that identifies one event, and the rollup dimensions.
EVENT_KEY = ["server_hostname", "event_time", "event_id"]
ROLLUP_DIMENSIONS = [
    "server_hostname", "vo", "source_exchange", "operation", "dirname1", "dirname2",
]

_STORED = {
    "unix": "timestamp", "text": "string", "ip": "string", "flag": "int", "real": "double",
    "u64": "bigint", "u32": "bigint", "u16": "int", "u8": "int",
}


_TYPES = {
    "string": T.StringType(), "boolean": T.BooleanType(), "smallint": T.ShortType(),
    "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "date": T.DateType(), "timestamp": T.TimestampType(),
}


def _struct(pairs) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# One delivered message.
ENVELOPE = _struct([("source_exchange", "string"), ("body", "string"), ("recv_time", "timestamp")])

# The 55 fields of a decoded message.
RECORD = _struct([(TIMESTAMP_KEY, "string")] + [(f.key, f.wire) for f in FIELDS])

# The 58 columns a message becomes, and the version stamped when it is written.
LAYOUT = _struct(
    [("event_time", "timestamp"), ("event_id", "string"), ("source_exchange", "string")]
    + [(f.column, _STORED[f.rule]) for f in FIELDS]
    + [("raw_json", "string")]
)
VERSION = "ingest_time"

# The raw table: layout, version, two columns of our own, and the partition columns.
PARTITIONS = [("merged", "int"), ("batch_id", "bigint")]
RAW_TABLE = _struct(
    [(f.name, f.dataType.simpleString()) for f in LAYOUT]
    + [(VERSION, "timestamp"), ("parse_error", "boolean"), ("body_hash", "bigint"),
       ("event_date", "date")]
    + PARTITIONS
)
