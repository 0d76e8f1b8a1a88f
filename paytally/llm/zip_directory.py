"""The directory of a ZIP package, ZIP64 included, read by ranges from the end."""

from __future__ import annotations

import struct
from dataclasses import dataclass

_END = struct.Struct("<4s4H2LH")
_END64_LOCATOR = struct.Struct("<4sLQL")
_END64 = struct.Struct("<4sQ2H2L4Q")
_ENTRY = struct.Struct("<4s6H3L5H2L")
_LOCAL = struct.Struct("<4s5H3L2H")
_TOP16, _TOP32 = 0xFFFF, 0xFFFFFFFF
_LONGEST_COMMENT = 1 << 16


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    encrypted: bool
    packed_size: int
    size: int
    header_at: int

    @property
    def is_stored(self) -> bool:
        return self.method == 0 and not self.encrypted


def read_range(source, at: int, size: int) -> bytes:
    source.seek(at)
    data = source.read(size)
    if len(data) != size:
        raise ValueError("the package ends early")
    return data


def _directory_place(source) -> tuple[int, int, int]:
    """Entries, size and start of the central directory."""
    source.seek(0, 2)
    length = source.tell()
    tail_at = max(0, length - _END.size - _LONGEST_COMMENT)
    tail = read_range(source, tail_at, length - tail_at)
    at = len(tail)
    while (at := tail.rfind(b"PK\x05\x06", 0, at)) >= 0:
        if at + _END.size <= len(tail):
            end = _END.unpack_from(tail, at)
            if at + _END.size + end[7] == len(tail):
                break
    else:
        raise ValueError("no ZIP package: it has no end record")
    entries, size, start = end[4], end[5], end[6]
    locator_at = tail_at + at - _END64_LOCATOR.size
    if locator_at >= 0:
        locator = _END64_LOCATOR.unpack(read_range(source, locator_at, _END64_LOCATOR.size))
        if locator[0] == b"PK\x06\x07":
            end64 = _END64.unpack(read_range(source, locator[2], _END64.size))
            if end64[0] != b"PK\x06\x06":
                raise ValueError("the ZIP64 locator leads nowhere")
            return end64[7], end64[8], end64[9]
    if entries == _TOP16 or size == _TOP32 or start == _TOP32:
        raise ValueError("a ZIP64 package without its locator")
    return entries, size, start


def _widened(extra: bytes, values: list[int]) -> list[int]:
    """``values`` with those that are at the 32-bit top taken from the ZIP64 field."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<2H", extra, at)
        if kind == 1:
            wide = iter(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
            return [next(wide) if v == _TOP32 else v for v in values]
        at += 4 + size
    return values


def members(source) -> list[Member]:
    """All members of an open package, from its central directory."""
    entries, size, start = _directory_place(source)
    data, at, found = read_range(source, start, size), 0, []
    for _ in range(entries):
        fields = _ENTRY.unpack_from(data, at)
        if fields[0] != b"PK\x01\x02":
            raise ValueError("the central directory is broken")
        flags, method = fields[3], fields[4]
        name_size, extra_size, comment_size = fields[10:13]
        name_at = at + _ENTRY.size
        name = data[name_at : name_at + name_size].decode("utf-8" if flags & 0x800 else "cp437")
        extra = data[name_at + name_size : name_at + name_size + extra_size]
        # Order of the ZIP64 field: size, packed size, place of the local header.
        full, packed, place = _widened(extra, [fields[9], fields[8], fields[16]])
        found.append(Member(name, method, bool(flags & 1), packed, full, place))
        at = name_at + name_size + extra_size + comment_size
    return found


def data_place(source, member: Member) -> int:
    """Where the bytes of a member begin; its local header has lengths of its own."""
    local = _LOCAL.unpack(read_range(source, member.header_at, _LOCAL.size))
    if local[0] != b"PK\x03\x04":
        raise ValueError(f"{member.name} has no local header")
    return member.header_at + _LOCAL.size + local[9] + local[10]
