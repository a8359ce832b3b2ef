"""Members of a ZIP archive from its directories, by range reads; nothing is extracted."""

from __future__ import annotations

import struct
from dataclasses import dataclass

import pyarrow.fs as pafs

#: Fixed values of the format: signatures, sizes of the fixed parts, the mark for "see ZIP64", its extra field.
END, END_SIZE = b"PK\x05\x06", 22
LOCATOR, LOCATOR_SIZE = b"PK\x06\x07", 20
END64, END64_SIZE = b"PK\x06\x06", 56
ENTRY, ENTRY_SIZE = b"PK\x01\x02", 46
LOCAL, LOCAL_SIZE = b"PK\x03\x04", 30
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
ZIP64_FIELD = 1
STORED = 0
MOST_COMMENT = 0xFFFF


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header: int


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI, also in the form ``file:/...``, and the path in it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    return pafs.FileSystem.from_uri(path)


def read_range(file, start: int, size: int) -> bytes:
    file.seek(start)
    found = file.read(size)
    if len(found) < size:
        raise ValueError("the archive ends too early")
    return found


def directory(file) -> list[Member]:
    """All members, in the order of the central directory; ZIP64 records are followed."""
    total = file.size()
    tail_size = min(total, END_SIZE + MOST_COMMENT)
    tail = read_range(file, total - tail_size, tail_size)
    at = tail.rfind(END)
    while at >= 0:
        if len(tail) - at >= END_SIZE and at + END_SIZE + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no end of central directory")
    count, size, start = struct.unpack_from("<HII", tail, at + 10)
    end = total - tail_size + at
    if FULL16 == count or FULL32 in (size, start):
        locator = read_range(file, end - LOCATOR_SIZE, LOCATOR_SIZE)
        if locator[:4] != LOCATOR:
            raise ValueError("no ZIP64 locator")
        record = read_range(file, struct.unpack_from("<Q", locator, 8)[0], END64_SIZE)
        if record[:4] != END64:
            raise ValueError("no ZIP64 end of central directory")
        count, size, start = struct.unpack_from("<QQQ", record, 32)
    entries = read_range(file, start, size)
    members, at = [], 0
    for _ in range(count):
        if entries[at : at + 4] != ENTRY:
            raise ValueError("no central directory entry")
        (flags, method) = struct.unpack_from("<HH", entries, at + 8)
        packed, plain, names, extras, comment = struct.unpack_from("<IIHHH", entries, at + 20)
        header = struct.unpack_from("<I", entries, at + 42)[0]
        name_at = at + ENTRY_SIZE
        extra = entries[name_at + names : name_at + names + extras]
        wide = _zip64(extra, [plain == FULL32, packed == FULL32, header == FULL32])
        packed, header = wide[1] if packed == FULL32 else packed, wide[2] if header == FULL32 else header
        name = entries[name_at : name_at + names].decode("utf-8" if flags & 0x800 else "cp437")
        members.append(Member(name, method, packed, header))
        at = name_at + names + extras + comment
    return members


def _zip64(extra: bytes, wanted: list[bool]) -> list[int]:
    """The 64-bit numbers that stand in for full 32-bit ones, in their fixed order."""
    values, at = [0] * len(wanted), 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == ZIP64_FIELD:
            place = at + 4
            for i, want in enumerate(wanted):
                if want:
                    values[i] = struct.unpack_from("<Q", extra, place)[0]
                    place += 8
        at += 4 + size
    return values


def data_start(file, member: Member) -> int:
    """Where the bytes of a stored member begin; the local header has name and extra sizes of its own."""
    if member.method != STORED:
        raise ValueError(f"{member.name} is not stored")
    local = read_range(file, member.header, LOCAL_SIZE)
    if local[:4] != LOCAL:
        raise ValueError("no local header")
    return member.header + LOCAL_SIZE + sum(struct.unpack_from("<HH", local, 26))
