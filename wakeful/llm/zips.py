"""ZIP packages: a streaming writer of stored members and a directory reader.

The reader needs only range reads: the end record, the ZIP64 records where the
classic fields are full, the central directory, and 30 bytes of a member's local
header to know where its data begin. Nothing is extracted.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

from wakeful.llm.files import read_at

# Fixed values of the ZIP format: signatures, record layouts, full-field marks.
LOCAL = struct.Struct("<4s5H3I2H")  # PK\x03\x04
DESCRIPTOR64 = struct.Struct("<4sIQQ")  # PK\x07\x08
CENTRAL = struct.Struct("<4s6H3I5H2I")  # PK\x01\x02
END64 = struct.Struct("<4sQ2H2I4Q")  # PK\x06\x06
LOCATOR64 = struct.Struct("<4sIQI")  # PK\x06\x07
END = struct.Struct("<4s4H2IH")  # PK\x05\x06
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
STORED, DESCRIPTOR_FLAG, UTF8_FLAG, EXTRA64 = 0, 0x08, 0x800, 0x0001
EPOCH = 0x21  # 1980-01-01


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    flags: int
    crc: int
    packed: int
    size: int
    header: int  # offset of the local header


class ZipWriter:
    """Writes stored members one after another to an output stream. Sizes are unknown
    when a member begins, so they follow it in a ZIP64 descriptor; the directory uses
    ZIP64 fields where the classic ones are too small, or always with ``zip64``."""

    def __init__(self, out, zip64: bool = False):
        self.out, self.zip64, self.at = out, zip64, 0
        self.members: list[Member] = []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.name, self.header, self.crc, self.size = name, self.at, 0, 0
        raw = name.encode()
        extra = struct.pack("<HHQQ", EXTRA64, 16, 0, 0)  # room for 64-bit sizes
        flags = DESCRIPTOR_FLAG | UTF8_FLAG
        self._put(LOCAL.pack(b"PK\x03\x04", 45, flags, STORED, 0, EPOCH, 0, FULL32, FULL32, len(raw), len(extra)) + raw + extra)

    def write(self, data: bytes) -> None:
        self.crc = zlib.crc32(data, self.crc)
        self.size += len(data)
        self._put(data)

    def end(self) -> None:
        self._put(DESCRIPTOR64.pack(b"PK\x07\x08", self.crc, self.size, self.size))
        self.members.append(Member(self.name, STORED, DESCRIPTOR_FLAG | UTF8_FLAG, self.crc, self.size, self.size, self.header))

    def close(self) -> None:
        start = self.at
        for m in self.members:
            large = [v for v in (m.size, m.packed, m.header) if self.zip64 or v >= FULL32]
            extra = struct.pack(f"<HH{len(large)}Q", EXTRA64, 8 * len(large), *large) if large else b""
            size, packed, header = (FULL32 if self.zip64 or v >= FULL32 else v for v in (m.size, m.packed, m.header))
            raw = m.name.encode()
            self._put(
                CENTRAL.pack(b"PK\x01\x02", 45, 45, m.flags, m.method, 0, EPOCH, m.crc, packed, size, len(raw), len(extra), 0, 0, 0, 0, header)
                + raw
                + extra
            )
        n, length, at64 = len(self.members), self.at - start, self.at
        if self.zip64 or n >= FULL16 or length >= FULL32 or start >= FULL32:
            self._put(END64.pack(b"PK\x06\x06", END64.size - 12, 45, 45, 0, 0, n, n, length, start))
            self._put(LOCATOR64.pack(b"PK\x06\x07", 0, at64, 1))
            n, length, start = FULL16, FULL32, FULL32
        self._put(END.pack(b"PK\x05\x06", 0, 0, n, n, length, start, 0))


def _end_record(file, size: int) -> tuple[int, int, int, int]:
    """(members, directory length, directory offset, offset where the end records
    begin) from the tail of the file."""
    tail_at = max(0, size - END.size - FULL16 - LOCATOR64.size)
    tail = read_at(file, tail_at, size - tail_at)
    at = len(tail)
    while True:
        at = tail.rfind(b"PK\x05\x06", 0, at)
        if at < 0:
            raise ValueError("no ZIP end record")
        if at + END.size <= len(tail):
            fields = END.unpack_from(tail, at)
            if at + END.size + fields[7] == len(tail):
                break
    n, length, start, ends = fields[4], fields[5], fields[6], tail_at + at
    if at >= LOCATOR64.size and tail[at - LOCATOR64.size : at - LOCATOR64.size + 4] == b"PK\x06\x07":
        named = LOCATOR64.unpack_from(tail, at - LOCATOR64.size)[2]
        beside = ends - LOCATOR64.size - END64.size  # where it lies if data precede the package
        for place in (named, beside):
            if 0 <= place <= size - END64.size:
                record = END64.unpack(read_at(file, place, END64.size))
                if record[0] == b"PK\x06\x06":
                    return record[7], record[8], record[9], place
        raise ValueError("no ZIP64 end record")
    return n, length, start, ends


def directory(file, size: int) -> list[Member]:
    """Members of the package, offsets counted from the file's start (also where other
    data precede the package)."""
    n, length, start, ends = _end_record(file, size)
    shift = ends - length - start
    data = read_at(file, start + shift, length)
    members, at = [], 0
    for _ in range(n):
        f = CENTRAL.unpack_from(data, at)
        if f[0] != b"PK\x01\x02":
            raise ValueError("broken ZIP directory")
        at += CENTRAL.size
        name, extra = data[at : at + f[10]], data[at + f[10] : at + f[10] + f[11]]
        at += f[10] + f[11] + f[12]
        packed, full, header = f[8], f[9], f[16]
        k = 0
        while k + 4 <= len(extra):
            kind, held = struct.unpack_from("<HH", extra, k)
            if kind == EXTRA64:
                values = iter(struct.unpack_from(f"<{held // 8}Q", extra, k + 4))
                full = next(values) if full == FULL32 else full
                packed = next(values) if packed == FULL32 else packed
                header = next(values) if header == FULL32 else header
            k += 4 + held
        members.append(Member(name.decode("utf-8" if f[3] & UTF8_FLAG else "cp437"), f[4], f[3], f[7], packed, full, header + shift))
    return members


def data_start(file, member: Member) -> int:
    """Offset of a member's first data byte."""
    f = LOCAL.unpack(read_at(file, member.header, LOCAL.size))
    if f[0] != b"PK\x03\x04":
        raise ValueError(f"no member at {member.header}")
    return member.header + LOCAL.size + f[9] + f[10]
