"""ZIP directories: written after stored members as they come, parsed from ranges of a file.

The writer only appends, so a member's size stands behind it and in the central directory, always in ZIP64
form. The reader takes both forms, comments at the end and bytes in front of the first member.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable
from typing import NamedTuple

STORED, DEFLATED = 0, 8
# Fixed values of the format.
LOCAL, DESCRIPTOR, CENTRAL = b"PK\x03\x04", b"PK\x07\x08", b"PK\x01\x02"
END, END64, LOCATOR64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
LARGE, LARGE_COUNT, ZIP64_FIELD = 0xFFFFFFFF, 0xFFFF, 1
SIZES_FOLLOW, UTF8_NAMES, NEEDS = 0x0008, 0x0800, 45
FIRST_DAY = 0x21  # 1 January 1980

Read = Callable[[int, int], bytes]


class Member(NamedTuple):
    name: str
    method: int
    header: int
    packed: int
    size: int
    crc: int


class Writer:
    """Appends stored members to ``sink`` and then their directory."""

    def __init__(self, sink):
        self.sink, self.at, self.members = sink, 0, []

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.name, self.header, self.crc, self.size = name.encode(), self.at, 0, 0
        self._put(LOCAL + struct.pack("<HHHHHIIIHH", NEEDS, SIZES_FOLLOW | UTF8_NAMES, STORED, 0, FIRST_DAY, 0, LARGE,
                                      LARGE, len(self.name), 20)
                  + self.name + struct.pack("<HHQQ", ZIP64_FIELD, 16, 0, 0))

    def write(self, data: bytes) -> None:
        self.crc = zlib.crc32(data, self.crc)
        self.size += len(data)
        self._put(data)

    def end(self) -> None:
        self._put(DESCRIPTOR + struct.pack("<IQQ", self.crc, self.size, self.size))
        self.members.append((self.name, self.header, self.size, self.crc))

    def close(self) -> None:
        start = self.at
        for name, header, size, crc in self.members:
            extra = struct.pack("<HHQQQ", ZIP64_FIELD, 24, size, size, header)
            self._put(CENTRAL + struct.pack(
                "<HHHHHHIIIHHHHHII", NEEDS, NEEDS, SIZES_FOLLOW | UTF8_NAMES, STORED, 0, FIRST_DAY, crc, LARGE, LARGE,
                len(name), len(extra), 0, 0, 0, 0, LARGE) + name + extra)
        end, count = self.at, len(self.members)
        self._put(END64 + struct.pack("<QHHIIQQQQ", 44, NEEDS, NEEDS, 0, 0, count, count, end - start, start))
        self._put(LOCATOR64 + struct.pack("<IQI", 0, end, 1))
        self._put(END + struct.pack("<HHHHIIH", 0, 0, LARGE_COUNT, LARGE_COUNT, LARGE, LARGE, 0))


def _end_record(tail: bytes) -> int:
    """Where the last end record begins whose comment reaches the end of the file."""
    at = tail.rfind(END)
    while at >= 0:
        if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            return at
        at = tail.rfind(END, 0, at)
    raise ValueError("no end of a ZIP directory")


def members(read: Read, size: int) -> list[Member]:
    """The members of an archive of ``size`` bytes, of which ``read(start, length)`` gives a range."""
    start = max(0, size - 22 - 0xFFFF - 20)
    tail = read(start, size - start)
    at = _end_record(tail)
    _, _, _, count, length, offset, _ = struct.unpack_from("<HHHHIIH", tail, at + 4)
    end = start + at
    if at >= 20 and tail[at - 20:at - 16] == LOCATOR64:
        stated = struct.unpack_from("<Q", tail, at - 12)[0]
        # With bytes in front of the archive, its own offsets are too small; the record still comes last.
        for place in dict.fromkeys((stated, end - 20 - 56)):
            record = read(place, 56) if 0 <= place <= size - 56 else b""
            if record[:4] == END64:
                break
        else:
            raise ValueError("no ZIP64 end record where its locator points")
        count, length, offset = struct.unpack_from("<QQQ", record, 32)
        end = place
    shift = end - length - offset
    if shift < 0:
        raise ValueError("a ZIP directory that does not fit its file")
    return list(_entries(read(offset + shift, length), count, shift))


def _entries(directory: bytes, count: int, shift: int):
    at = 0
    for _ in range(count):
        if directory[at:at + 4] != CENTRAL:
            raise ValueError("a ZIP directory that ends early")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        crc, packed, size, n_name, n_extra, n_comment = struct.unpack_from("<IIIHHH", directory, at + 16)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46:at + 46 + n_name]
        extra = directory[at + 46 + n_name:at + 46 + n_name + n_extra]
        size, packed, header = _wide(extra, size, packed, header)
        yield Member(name.decode("utf-8" if flags & UTF8_NAMES else "cp437"), method, header + shift, packed, size, crc)
        at += 46 + n_name + n_extra + n_comment


def _wide(extra: bytes, *values: int) -> list[int]:
    """The values, those that are too large for 32 bits from the ZIP64 field."""
    at, field = 0, b""
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == ZIP64_FIELD:
            field = extra[at + 4:at + 4 + length]
        at += 4 + length
    out, at = [], 0
    for value in values:
        if value == LARGE and at + 8 <= len(field):
            value = struct.unpack_from("<Q", field, at)[0]
            at += 8
        out.append(value)
    return out


def data_start(read: Read, member: Member) -> int:
    """Where the bytes of a member begin, behind its own header."""
    head = read(member.header, 30)
    if head[:4] != LOCAL:
        raise ValueError(f"no header of {member.name!r} where the directory points")
    n_name, n_extra = struct.unpack_from("<HH", head, 26)
    return member.header + 30 + n_name + n_extra


def whole(read: Read, member: Member) -> bytes:
    """All of a small member, checked."""
    data = read(data_start(read, member), member.packed)
    if member.method == DEFLATED:
        data = zlib.decompress(data, -15)
    elif member.method != STORED:
        raise ValueError(f"{member.name!r} is neither stored nor deflated")
    if zlib.crc32(data) != member.crc:
        raise ValueError(f"{member.name!r} is damaged")
    return data
