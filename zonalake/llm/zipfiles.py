"""ZIP packages with stored members, written as a stream and read by ranges.

Members are never compressed by the package, so any part of one can be read by its place. Sizes,
offsets and counts are written in ZIP64 form and read in either. Fixed values of the format:
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

# Signatures and layouts of the ZIP format.
LOCAL, LOCAL_SIGN = struct.Struct("<4sHHHHHIIIHH"), b"PK\x03\x04"
ENTRY, ENTRY_SIGN = struct.Struct("<4sHHHHHHIIIHHHHHII"), b"PK\x01\x02"
END, END_SIGN = struct.Struct("<4sHHHHIIH"), b"PK\x05\x06"
END64, END64_SIGN = struct.Struct("<4sQHHIIQQQQ"), b"PK\x06\x06"
FINDER, FINDER_SIGN = struct.Struct("<4sIQI"), b"PK\x06\x07"
TRAILER, TRAILER_SIGN = struct.Struct("<4sIQQ"), b"PK\x07\x08"
EXTRA64 = 0x0001
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
SIZES_FOLLOW, UTF8_NAMES = 0x0008, 0x0800
VERSION, DOS_DATE, STORED = 45, 0x21, 0


@dataclass
class Member:
    name: str
    method: int
    crc: int
    size: int
    at: int  # of its local header


class PackageWriter:
    """Members one after the other: `begin`, `write`..., `end`, and `close` at last."""

    def __init__(self, out):
        self.out, self.at = out, 0
        self.members: list[Member] = []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.members.append(Member(name, STORED, 0, 0, self.at))
        encoded = name.encode()
        extra = struct.pack("<HHQQ", EXTRA64, 16, 0, 0)
        flags = SIZES_FOLLOW | UTF8_NAMES
        self._put(
            LOCAL.pack(LOCAL_SIGN, VERSION, flags, STORED, 0, DOS_DATE, 0, FULL32, FULL32, len(encoded), len(extra))
            + encoded
            + extra
        )

    def write(self, data: bytes) -> None:
        member = self.members[-1]
        member.crc = zlib.crc32(data, member.crc)
        member.size += len(data)
        self._put(data)

    def end(self) -> None:
        member = self.members[-1]
        self._put(TRAILER.pack(TRAILER_SIGN, member.crc, member.size, member.size))

    def close(self) -> None:
        begin = self.at
        for m in self.members:
            encoded = m.name.encode()
            extra = struct.pack("<HHQQQ", EXTRA64, 24, m.size, m.size, m.at)
            flags = SIZES_FOLLOW | UTF8_NAMES
            self._put(
                ENTRY.pack(
                    ENTRY_SIGN, VERSION, VERSION, flags, STORED, 0, DOS_DATE, m.crc, FULL32, FULL32,
                    len(encoded), len(extra), 0, 0, 0, 0, FULL32,
                )
                + encoded
                + extra
            )
        size, n, end64 = self.at - begin, len(self.members), self.at
        self._put(END64.pack(END64_SIGN, END64.size - 12, VERSION, VERSION, 0, 0, n, n, size, begin))
        self._put(FINDER.pack(FINDER_SIGN, 0, end64, 1))
        self._put(
            END.pack(END_SIGN, 0, 0, min(n, FULL16), min(n, FULL16), min(size, FULL32), FULL32, 0)
        )


class PackageReader:
    """Finds members by the directories at the end, through `read(start, length)` with `read.size`."""

    def __init__(self, read):
        self.read = read
        tail_at = max(0, read.size - END.size - FULL16)
        tail = read(tail_at, read.size - tail_at)
        place = tail.rfind(END_SIGN)
        while place >= 0 and place + END.size + END.unpack_from(tail, place)[7] != len(tail):
            place = tail.rfind(END_SIGN, 0, place)
        if place < 0:
            raise ValueError("no end of central directory")
        _, _, _, _, n, size, begin, _ = END.unpack_from(tail, place)
        end_at = tail_at + place
        if FULL16 in (n,) or FULL32 in (size, begin):
            finder = read(end_at - FINDER.size, FINDER.size) if end_at >= FINDER.size else b""
            if finder[:4] == FINDER_SIGN:
                end64 = END64.unpack(read(FINDER.unpack(finder)[2], END64.size))
                if end64[0] != END64_SIGN:
                    raise ValueError("no ZIP64 end of central directory")
                n, size, begin = end64[7], end64[8], end64[9]
        self.members = dict(self._entries(read(begin, size), n))

    def _entries(self, data: bytes, n: int):
        at = 0
        for _ in range(n):
            head = ENTRY.unpack_from(data, at)
            if head[0] != ENTRY_SIGN:
                raise ValueError("broken central directory")
            method, crc, packed, size = head[4], head[7], head[8], head[9]
            n_name, n_extra, n_note, local = head[10], head[11], head[12], head[16]
            name = data[at + ENTRY.size : at + ENTRY.size + n_name].decode()
            extra = data[at + ENTRY.size + n_name : at + ENTRY.size + n_name + n_extra]
            while len(extra) >= 4:
                kind, length = struct.unpack_from("<HH", extra)
                if kind == EXTRA64:  # holds those of the three that are full, in this order
                    wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, 4))
                    size = next(wide) if size == FULL32 else size
                    packed = next(wide) if packed == FULL32 else packed
                    local = next(wide) if local == FULL32 else local
                extra = extra[4 + length :]
            yield name, Member(name, method, crc, size, local)
            at += ENTRY.size + n_name + n_extra + n_note

    def open(self, name: str):
        """`read(start, length)` within a stored member."""
        member = self.members[name]
        if member.method != STORED:
            raise ValueError(f"{name} is not stored")
        head = LOCAL.unpack(self.read(member.at, LOCAL.size))
        begin = member.at + LOCAL.size + head[9] + head[10]

        def read(start: int, length: int) -> bytes:
            return self.read(begin + start, max(0, min(length, member.size - start)))

        read.size = member.size
        return read
