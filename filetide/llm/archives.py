"""Web archives in ZIP packages: written in tasks, read back by ranges.

A package holds ``archive/data.warc.gz``, stored, with one gzip member for each WARC record, and
``indexes/index.cdxj``, stored, with one line for each record: where it begins, its length, its exact URL.
Of pages with equal payloads of at least ``LEAST_BYTES`` the one with the largest page_id is a response;
the others are revisits that refer to it and keep only the HTTP head, which states the payload's length.

Reading parses the directories at the end of a package (central and ZIP64), finds the archive members and
the indexes, and reads records by ranges of neighbouring ones, up to ``SPAN_BYTES`` each, without taking
the package apart. Every record is checked: a response against its digest.

A null html is an empty payload. A null page_id is never the largest unless all are null; rows that share
the largest page_id of their payload are all responses. A null url has no line. Packages are written under
names of their own, and only those that a finished task reports count, so a lost or repeated task leaves
nothing but files that nobody reads. Folders are any that pyarrow's file systems reach from executors.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetide.llm import zipped
from filetide.llm.work import application_folder, keep

LEAST_BYTES = 1000
PACKAGE_BYTES = 32 << 20
SPAN_BYTES = 4 << 20
HOT = 1024  # a payload that more than one in so many repeated pages has
DATE = "1970-01-01T00:00:00Z"  # pages state no time of their own
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MEMBER, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PACKAGES = "path string, bytes long, records long"
SPANS = "path string, start long, stop long, offsets array<long>, urls array<string>"
RECORDS = ("page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, "
           "refers_to long, path string, offset long")


def record(page_id, url, payload: bytes, digest: bytes, refers_to) -> bytes:
    """One WARC record; with ``refers_to`` (an id in a list) a revisit of that page."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: {_urn(page_id)}",
            f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url))
    if refers_to:
        head += [f"WARC-Refers-To: {_urn(refers_to[0])}", f"WARC-Profile: {PROFILE}"]
    head += ["WARC-Payload-Digest: sha1:" + base64.b32encode(digest).decode(),
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


def _urn(page_id) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    name = urn.strip("<>").rsplit(":", 1)[1]
    return None if name == "none" else int(name)


def parse(raw: bytes) -> dict:
    """What a record says; its payload is None in a revisit."""
    head, rest = raw.split(b"\r\n\r\n", 1)
    version, *lines = head.decode().split("\r\n")
    fields = {name.lower(): value.strip() for name, value in (line.split(":", 1) for line in lines)}
    block = rest[:int(fields["content-length"])]
    if not version.startswith("WARC/") or rest[len(block):] != b"\r\n\r\n" or len(block) != int(fields["content-length"]):
        raise ValueError("not a whole WARC record")
    http, payload = block.split(b"\r\n\r\n", 1)
    stated = next(int(line.split(b":")[1]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    digest = base64.b32decode(fields["warc-payload-digest"].split(":", 1)[1]).hex()
    revisit = fields["warc-type"] == "revisit"
    if not revisit and (len(payload) != stated or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {fields['warc-record-id']} is not the one written")
    return {"page_id": _page(fields["warc-record-id"]), "record_type": fields["warc-type"],
            "payload": None if revisit else payload, "payload_bytes": stated, "payload_digest": digest,
            "refers_to": _page(fields["warc-refers-to"]) if revisit else None}


class Package:
    """One package as it is written."""

    def __init__(self, folder: str):
        files, path = pafs.FileSystem.from_uri(folder)
        files.create_dir(path, recursive=True)
        name = f"{uuid.uuid4().hex}.zip"
        self.path = f"{folder}/{name}"
        self.sink = files.open_output_stream(f"{path}/{name}")
        self.zip, self.lines, self.offset = zipped.Writer(self.sink), [], 0
        self.zip.begin(MEMBER)

    def add(self, url, raw: bytes) -> None:
        packed = gzip.compress(raw, 1, mtime=0)
        self.lines.append(json.dumps({"url": url, "filename": posixpath.basename(MEMBER), "offset": self.offset,
                                      "length": len(packed)}, ensure_ascii=False))
        self.zip.write(packed)
        self.offset += len(packed)

    def close(self) -> tuple[str, int, int]:
        self.zip.end()
        self.zip.begin(INDEX)
        self.zip.write("".join(f"{line}\n" for line in self.lines).encode())
        self.zip.end()
        self.zip.close()
        self.sink.close()
        return self.path, self.zip.at, len(self.lines)


def with_copies(pages: DataFrame, least: int) -> DataFrame:
    """page_id, url, payload, digest, and ``last``: the largest page_id with the same payload, where there
    is another page with it. A payload that a large share of pages has is looked up without moving them."""
    html = F.coalesce("html", F.lit("")).cast("binary")
    sized = pages.select("page_id", "url", html.alias("payload")).withColumns(
        {"digest": F.sha1("payload"), "bytes": F.octet_length("payload")})
    copies = keep(sized.filter(F.col("bytes") >= least).groupBy("digest", "bytes").agg(
        F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "copies")
    repeated = copies.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    is_hot = F.col("n") * HOT > repeated  # so there are fewer than HOT of them
    hot = copies.filter(is_hot).select("digest", "bytes", F.struct("last").alias("hot"))
    rest = copies.filter(~is_hot).select(F.concat_ws("-", "digest", "bytes").alias("key"), F.struct("last").alias("rest"))
    looked = sized.join(F.broadcast(hot), ["digest", "bytes"], "left")
    settled = F.col("hot").isNotNull() | (F.col("bytes") < least)
    # What is settled is dealt evenly, under keys that are no digests.
    keyed = looked.withColumn("key", F.when(settled, F.monotonically_increasing_id().cast("string")).otherwise(
        F.concat_ws("-", "digest", "bytes")))
    found = F.coalesce("hot", "rest")
    return keyed.join(rest, "key", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(found.isNotNull() & ~found["last"].eqNullSafe(F.col("page_id")), found).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None, least: int = LEAST_BYTES,
                   package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) into packages below ``folder``; path, bytes and records of each."""
    folder = folder or f"{application_folder(pages.sparkSession)}/archives-{uuid.uuid4().hex}"

    def packages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in batches:
            for row in zip(*(batch.column(name) for name in ("page_id", "url", "payload", "digest", "refers_to"))):
                page_id, url, payload, digest, refers_to = (x.as_py() for x in row)
                package = package or Package(folder)
                refers_to = None if refers_to is None else [refers_to["last"]]
                package.add(url, record(page_id, url, payload, bytes.fromhex(digest), refers_to))
                if package.offset >= package_bytes:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        path, size, records = zip(*done) if done else ((), (), ())
        yield pa.record_batch([pa.array(path, pa.string()), pa.array(size, pa.int64()), pa.array(records, pa.int64())],
                              names=["path", "bytes", "records"])

    return keep(with_copies(pages, least).mapInArrow(packages, PACKAGES), "packages")


def _reader(path: str) -> zipped.Read:
    files, inner = pafs.FileSystem.from_uri(path)
    source = files.open_input_file(inner)

    def read(start: int, length: int) -> bytes:
        source.seek(start)
        return source.read(length)

    return read


def index(read: zipped.Read, size: int) -> Iterator[tuple[int, int, str | None]]:
    """Start, end and URL of every record that the package's indexes name, in the order of places."""
    members = zipped.members(read, size)
    starts = {}
    for member in members:
        if member.name.startswith("archive/") and not member.name.endswith("/"):
            if member.method != zipped.STORED:
                raise ValueError(f"{member.name!r} is not stored, so it has no ranges")
            starts[posixpath.basename(member.name)] = zipped.data_start(read, member)
    found = []
    for member in members:
        if member.name.startswith("indexes/") and not member.name.endswith("/"):
            data = zipped.whole(read, member)
            data = gzip.decompress(data) if member.name.endswith(".gz") else data
            for line in data.decode().split("\n"):
                if line:
                    entry = json.loads(line[line.index("{"):])
                    start = starts[entry["filename"]] + int(entry["offset"])
                    found.append((start, start + int(entry["length"]), entry.get("url")))
    yield from sorted(found, key=lambda x: x[:2])


def spans(packages: DataFrame) -> DataFrame:
    """Ranges of neighbouring records of ``packages`` (path, bytes), with where each begins."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size in zip(batch.column("path").to_pylist(), batch.column("bytes").to_pylist()):
                rows, last = [], None
                for start, stop, url in index(_reader(path), size):
                    if last is None or start != last[1] or stop - last[0] > SPAN_BYTES:
                        last = [start, stop, [], []]
                        rows.append(last)
                    last[1] = stop
                    last[2].append(start)
                    last[3].append(url)
                yield pa.record_batch([
                    pa.array([path] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                    pa.array([r[3] for r in rows], pa.list_(pa.string()))],
                    names=["path", "start", "stop", "offsets", "urls"])

    return packages.select("path", "bytes").mapInArrow(find, SPANS)


def read_archives(packages: DataFrame, payloads: bool = False) -> DataFrame:
    """Every record of ``packages`` (path, bytes): page_id, url, record_type, payload (only if asked for, and
    null in revisits), payload_bytes, payload_digest, refers_to, path, offset."""
    total, count = packages.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count(F.lit(1))).first()
    names = [part.split()[0] for part in RECORDS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for span in batch.to_pylist():
                raw = _reader(span["path"])(span["start"], span["stop"] - span["start"])
                rows = []
                for offset, stop, url in zip(span["offsets"], [*span["offsets"][1:], span["stop"]], span["urls"]):
                    found = parse(zlib.decompress(raw[offset - span["start"]:stop - span["start"]], 31))
                    found |= {"url": url, "path": span["path"], "offset": offset}
                    if not payloads:
                        found["payload"] = None
                    rows.append(found)
                yield pa.record_batch([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names=names)

    # Few rows that stand for much work: stated numbers of partitions stay as they are.
    found = spans(packages.repartition(max(1, min(count, 10_000)), "path"))
    return found.repartition(1 + total // (2 * SPAN_BYTES), "path", "start").mapInArrow(records, RECORDS)
