import hashlib
import io
import random
import struct
import zipfile

import pytest

from filetide.llm import archives as A
from filetide.llm import zipped

PAGES = "page_id long, url string, html string, path string, offset int"


def odd_pages():
    rng = random.Random(3)
    texts = ["".join(rng.choice("abc <>é日") for _ in range(n)) for n in (0, 5, 999, 1000, 1500, 40_000)]
    html = [None, "", *texts, texts[3], texts[4], texts[4], texts[5], "é" * 500, "é" * 500, "e" * 999, "e" * 999,
            "x" * 1_500_000, "x" * 1_500_000, "\r\n\r\nWARC/1.1\r\n" * 200, "PK\x05\x06" * 400]
    rows = [(i, f"http://a.example/{i}?q=%20", h) for i, h in enumerate(html)]
    rows += [(3, None, texts[3]), (None, "u\r\nWARC-Type: revisit", texts[4]), (12, "http://é.example/ x", texts[5]),
             (None, None, "only nulls" * 200), (None, "u", "only nulls" * 200), rows[4], rows[13], rows[13]]
    return [(i, u, h, "p", 7) for i, u, h in rows]


def plain(rows):
    """Straight from the definition."""
    last = {}
    for page_id, _, html, *_ in rows:
        last[html or ""] = max((x for x in (last.get(html or ""), page_id) if x is not None), default=None)
    out = []
    for page_id, url, html, *_ in rows:
        payload = (html or "").encode()
        again = len(payload) >= 1000 and last[html or ""] != page_id
        out.append((page_id, url, "revisit" if again else "response", len(payload), hashlib.sha1(payload).hexdigest(),
                    last[html or ""] if again else None))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select(
        "page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to").collect()), key=repr)


@pytest.mark.parametrize("hot", [1024, 0])
def test_round_trip(spark, monkeypatch, hot):
    monkeypatch.setattr(A, "HOT", hot)  # with 0 no payload is looked up by broadcast
    rows = odd_pages()
    packages = A.write_archives(spark.createDataFrame(rows, PAGES))
    records = A.read_archives(packages, payloads=True)
    assert got(records) == plain(rows)
    for row in records.collect():
        assert (row.payload is None) == (row.record_type == "revisit")
        assert row.payload is None or hashlib.sha1(row.payload).hexdigest() == row.payload_digest
    assert packages.agg({"records": "sum"}).first()[0] == len(rows)


def test_many_packages_and_short_spans(spark, monkeypatch):
    monkeypatch.setattr(A, "SPAN_BYTES", 700)
    rows = odd_pages()
    packages = A.write_archives(spark.createDataFrame(rows, PAGES).coalesce(1), package_bytes=2000)
    assert packages.count() > 3
    assert got(A.read_archives(packages)) == plain(rows)


def test_no_pages(spark):
    packages = A.write_archives(spark.createDataFrame([], PAGES))
    assert packages.count() == 0 and A.read_archives(packages).count() == 0


def test_another_program_reads_the_packages(spark):
    rows = odd_pages()
    for row in A.write_archives(spark.createDataFrame(rows, PAGES).coalesce(1)).collect():
        with zipfile.ZipFile(row.path) as package:
            assert package.testzip() is None and package.namelist() == [A.MEMBER, A.INDEX]
            assert package.read(A.INDEX).decode().count("\n") == row.records == len(rows)


def test_packages_of_another_program_are_read(spark, tmp_path):
    ours = A.write_archives(spark.createDataFrame(odd_pages(), PAGES).coalesce(1)).collect()[0].path
    with zipfile.ZipFile(ours) as package:
        data, index = package.read(A.MEMBER), package.read(A.INDEX)
    path = str(tmp_path / "theirs.zip")
    with open(path, "wb") as file:
        file.write(b"bytes in front")
        with zipfile.ZipFile(file, "a") as package:
            package.comment = b"PK\x05\x06 is no end here" * 3
            package.writestr("datapackage.json", "{}", zipfile.ZIP_DEFLATED)
            package.writestr("archive/", "")
            package.writestr(A.MEMBER, data, zipfile.ZIP_STORED)
            package.writestr(A.INDEX, index, zipfile.ZIP_DEFLATED)
    import os

    packages = spark.createDataFrame([(path, os.path.getsize(path))], "path string, bytes long")
    assert got(A.read_archives(packages)) == plain(odd_pages())


def reader(data):
    return lambda start, length: data[start:start + length]


@pytest.mark.parametrize("front", [b"", b"x" * 77])
def test_large_form_of_the_directory(front):
    sink = io.BytesIO()
    writer = zipped.Writer(sink)
    for i in range(3):
        writer.begin(f"é{i}")
        writer.write(b"a" * i)
        writer.write(b"b" * 10)
        writer.end()
    writer.close()
    data = front + sink.getvalue()
    found = zipped.members(reader(data), len(data))
    assert [(m.name, m.size, m.packed) for m in found] == [(f"é{i}", 10 + i, 10 + i) for i in range(3)]
    assert [zipped.whole(reader(data), m) for m in found] == [b"a" * i + b"b" * 10 for i in range(3)]


def test_offsets_past_four_gigabytes():
    """A directory far into a file of which only the end exists."""
    far, name = (5 << 32) + 11, b"archive/data.warc.gz"
    extra = struct.pack("<HHQQQ", 1, 24, 7 << 32, 7 << 32, far)
    entry = zipped.CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0, 0, 0, 33, 9, 0xFFFFFFFF, 0xFFFFFFFF, len(name),
                                         len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    at = 13 << 32
    tail = entry + zipped.END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(entry), at)
    tail += zipped.LOCATOR64 + struct.pack("<IQI", 0, at + len(entry), 1)
    tail += zipped.END + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)

    def read(start, length):
        return (b"\0" * max(0, at - start) + tail[max(0, start - at):])[:length]

    assert zipped.members(read, at + len(tail)) == [zipped.Member(name.decode(), 0, far, 7 << 32, 7 << 32, 9)]


@pytest.mark.parametrize("broken", [b"", b"PK", b"no archive at all" * 9])
def test_what_is_no_archive_is_refused(broken):
    with pytest.raises(ValueError):
        zipped.members(reader(broken), len(broken))


def test_damage_is_noticed(spark, tmp_path):
    path = A.write_archives(spark.createDataFrame(odd_pages(), PAGES).coalesce(1)).collect()[0].path
    raw = A.record(1, "u", b"payload", hashlib.sha1(b"payload").digest(), None)
    assert A.parse(raw)["payload"] == b"payload"
    for damaged in (raw.replace(b"payload\r\n", b"paXload\r\n"), raw[:-1]):
        with pytest.raises(ValueError):
            A.parse(damaged)
    assert path
