import hashlib
import ipaddress
import json
import struct

import pytest
from helpers import messages, plan, record
from pyspark.sql import functions as F

from filetide.functions import columns as C
from filetide.functions.addresses import canonical_ip
from filetide.functions.fields import json_text
from filetide.operators.normalize import normalize_records, parse_records
from filetide.schema import FIELDS, LAYOUT, RECORD

NOON = "2026-03-22T12:34:56.789Z"

# body -> values that count, whether it is an error
BODIES = [
    ('{"read":5,"filename":"x","write":7}', {"read": 5, "filename": "x", "write": 7}, False),
    ('{"write":7,"unknown":{"a":[1]},"read":5}', {"read": 5, "write": 7}, False),
    ('{"read":5,"filename":"x","wri', {}, True),
    ("", {}, True),
    (None, {}, True),
    ("null", {}, False),
    ("5", {}, True),
    ('[{"read":5}]', {}, True),
    ('{"read":"x","write":7}', {"write": 7}, True),
    ('{"read":3.0,"write":7}', {"write": 7}, True),
    ('{"read":"7","write":7}', {"write": 7}, True),
    ('{"read_operations":3000000000,"write":7}', {"write": 7}, True),
    ('{"read_vector_count_min":40000,"write":7}', {"write": 7}, True),
    ('{"ipv6":1,"write":7}', {"write": 7}, True),
    ('{"filename":12,"write":7}', {"write": 7}, True),
    ('{"user":true,"write":7}', {"write": 7}, True),
    ('{"filename":{"a":1},"user":"bob"}', {"user": "bob"}, True),
    ('{"token_groups":["a"],"write":7}', {"write": 7}, True),
    ('{"user":"12345","filename":"{\\"k\\": 1}","vo":"true"}',
     {"user": "12345", "filename": '{"k": 1}', "vo": "true"}, False),
    ('{"host":"[::1]"}', {"host": "[::1]"}, False),
    ('{"filename":null,"write":7}', {"write": 7}, False),
    ('{"Filename":"x","write":7}', {"write": 7}, False),
    ('{"read":5,"read":6}', {"read": 6}, False),
    ('{"read":5} x', {}, True),
    ('{"read":5}}', {}, True),
    ('{"read":5}]', {}, True),
    ('{"read":5},{"read":6}', {}, True),
    ("{'read':5}", {}, True),
    ('{"read":05}', {}, True),
    ('{"read_vector_count_average":NaN}', {}, True),
    ('{"read_vector_count_average":3}', {"read_vector_count_average": 3.0}, False),
    ('{"write":7,"@timestamp":"%s","read":5}' % NOON, {"@timestamp": NOON, "write": 7, "read": 5}, False),
    ('{"write":7,"@timestamp":"bad","read":5}', {"write": 7}, True),
    ('{"write":7,"@timestamp":"2026-03-22","read":5}', {"write": 7}, True),
    ('{"write":7,"@timestamp":"2026-13-01T00:00:00Z","read":5}', {"write": 7}, True),
    ('{"write":7,"@timestamp":12,"read":5}', {"write": 7}, True),
    ('{"write":7,"@timestamp":null,"read":5}', {"write": 7, "read": 5}, False),
]


def content_id(r):
    texts = b"".join(r.get(k, "").encode() + b"\0" for k in ("serverID", "server", "filename", "logical_dirname"))
    numbers = struct.pack("<8q", *[r.get(k, 0) for k in (
        "start_time", "end_time", "filesize", "read", "readv", "write", "read_bytes_at_close",
        "write_bytes_at_close")])
    return hashlib.sha256(texts + numbers).hexdigest()[:32]


def test_field_counts():
    assert (len(RECORD), len(LAYOUT), len(FIELDS)) == (55, 58, 54)


def test_parse_cases(spark):
    parsed = parse_records(messages(spark, [b for b, _, _ in BODIES])).collect()
    got = {r.body: ({k: v for k, v in (r.record.asDict() if r.record else {}).items() if v is not None},
                    r.parse_error) for r in parsed}
    assert got == {body: (values, error) for body, values, error in BODIES}


def test_bad_messages_are_kept(spark):
    out = normalize_records(messages(spark, ["nope", record()])).orderBy("parse_error").collect()
    assert [r.raw_json for r in out] == [json.dumps(record()), "nope"]
    assert out[1].event_id == content_id({})
    assert (out[1].filename, out[1].read, out[1].server_ip) == ("", 0, "::")
    assert str(out[1].event_time) == "2026-03-22 13:00:00"


@pytest.mark.parametrize("values", [
    {},
    {"serverID": "node-4", "filename": "/store/x", "start_time": 30, "end_time": 77, "read": 512},
    {"serverID": "node-4", "filename": "/store/x", "start_time": 30, "end_time": 77, "read": 513},
    {"serverID": "node-4", "filename": "/store/x", "start_time": 30, "end_time": 77},
    {"filename": "/store/x", "end_time": 77, "read": 512, "serverID": "node-4", "start_time": 30},
    {"serverID": "ü", "read": -6},
    {"read": -(2**63), "write": 2**63 - 1},
])
def test_event_id(spark, values):
    assert normalize_records(messages(spark, [values])).first().event_id == content_id(values)


def test_event_time_fallbacks(spark):
    cases = [
        ({"@timestamp": NOON, "end_time": 1774174590}, "2026-03-22 12:34:56.789000"),
        ({"@timestamp": "2026-03-22T17:30:00.25+05:30"}, "2026-03-22 12:00:00.250000"),
        ({"end_time": 1774174590, "start_time": 1774174500}, "2026-03-22 10:16:30"),
        ({"@timestamp": "0001-01-01T00:00:00Z", "start_time": 1774174500}, "2026-03-22 10:15:00"),
        ({"end_time": -9, "start_time": 0}, "2026-03-22 13:00:00"),
        ({"@timestamp": "1200-05-06T07:08:09Z"}, "1900-01-01 00:00:00"),
        ({"@timestamp": "9000-01-01T00:00:00Z"}, "2299-12-31 23:59:59.999000"),
        ({"end_time": 2**60}, "2299-12-31 23:59:59"),
    ]
    out = normalize_records(messages(spark, [c for c, _ in cases])).collect()
    assert {r.raw_json: str(r.event_time) for r in out} == {json.dumps(c): t for c, t in cases}


def test_column_rules(spark):
    r = {"start_time": -1, "end_time": 9 * 10**18, "operation_time": 2**32, "read_operations": -3,
         "read": -7, "write": 2**63 - 1, "read_vector_count_min": -2, "read_vector_count_max": 32767,
         "HasFileCloseMsg": 256, "ipv6": True}
    out = normalize_records(messages(spark, [r])).first()
    assert str(out.start_time) == "1970-01-01 00:00:00" and str(out.end_time) == "2299-12-31 23:59:59"
    assert (out.operation_time, out.read_operations, out.read, out.write) == (4294967295, 0, 0, 2**63 - 1)
    assert (out.read_vector_count_min, out.read_vector_count_max) == (0, 32767)
    assert (out.has_file_close_msg, out.ipv6) == (0, 1)
    flags = spark.createDataFrame([(v,) for v in (-1, 1, 255, 257, 2**32 + 5)], "v bigint")
    assert [x[0] for x in flags.select(C.low_byte("v")).collect()] == [0, 1, 255, 1, 255]


ADDRESSES = """10.0.0.1|01.2.3.4|fe80::1%eth0|x|::|::1|1::|2001:db8::1|2001:DB8:0:0:1:0:0:1|2001:db8:0:1:1:1:1:1
1:2:3:4:5:6:7:8|1:2:3:4:5:6:7::|::2:3:4:5:6:7:8|1:2:3:4::5:6:7:8|::ffff:1.2.3.4|::FFFF:0102:0304|64:ff9b::1.2.3.4
1:2:3:4:5:6:1.2.3.4|1:2:3:4:5:6:7:1.2.3.4|::1.2.3|::1.2.3.04|1.2.3.256|12345::|1::2::3|:::|:|1:|0:0:0:0:0:0:0:0
0:0:1:0:0:0:1:0|1:0:0:2:0:0:0:3|::ffff:0:0|::1.2.3.4|1.2.3.4.5| 1.2.3.4|g::1|a:0:0:b:0:0:c:d"""


def test_addresses_follow_the_standard_library(spark):
    def model(text):
        try:
            address = ipaddress.ip_address(text if "%" not in text else "")
        except ValueError:
            return "::"
        if address.version == 4:
            return f"::ffff:{text}"
        return f"::ffff:{address.ipv4_mapped}" if address.ipv4_mapped else address.compressed

    texts = ["", *ADDRESSES.replace("\n", "|").split("|")]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.c for r in df.select("t", canonical_ip(F.col("t")).alias("c")).collect()}
    assert got == {t: model(t) for t in texts}


def test_json_text(spark):
    cases = {'{"p":"a"}': "a", '{"p":1}': "", "{}": "", '{"p":null}': "", "x": "", "": "", '{"p":{"q":"a"}}': "",
             '{"p":"a\\u00e9\\n"}': "aé\n"}
    df = spark.createDataFrame([(c,) for c in cases], "b string")
    assert {r.b: r.p for r in df.select("b", json_text(F.col("b"), "p").alias("p")).collect()} == cases


def test_filter_does_not_parse_twice(spark):
    text = plan(normalize_records(messages(spark, [record()])).filter("event_id = 'x' AND read > 5"))
    assert text.index("Filter") < text.index("CollectMetrics")


def test_filters_on_messages_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "messages")
    messages(spark, [record()]).union(messages(spark, ["broken"], source="other")).write.parquet(path)
    stored = spark.read.parquet(path)
    some = normalize_records(stored, only="source_exchange = 'main' AND recv_time >= '2026-03-22'")
    assert "EqualTo(source_exchange,main)" in plan(some) and "GreaterThanOrEqual(recv_time" in plan(some)
    assert some.count() == 1 and normalize_records(stored).count() == 2
