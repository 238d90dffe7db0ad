"""Decoding of MessagePack messages (by the public specification), for streams that send them instead of JSON."""

from __future__ import annotations

import struct
from collections.abc import Iterator


class Truncated(ValueError):
    """The message ends before its value does."""


def _take(data: bytes, at: int, n: int) -> tuple[bytes, int]:
    if at + n > len(data):
        raise Truncated(f"{n} bytes wanted at {at} of {len(data)}")
    return data[at : at + n], at + n


def _number(data: bytes, at: int, form: str):
    raw, at = _take(data, at, struct.calcsize(form))
    return struct.unpack(form, raw)[0], at


#: First bytes of numbers with their form, and of texts, bytes, extensions, lists and maps with that of their length.
NUMBERS = {0xCA: ">f", 0xCB: ">d", 0xCC: ">B", 0xCD: ">H", 0xCE: ">I", 0xCF: ">Q", 0xD0: ">b", 0xD1: ">h", 0xD2: ">i", 0xD3: ">q"}
LENGTHS = {
    0xC4: ("bytes", ">B"), 0xC5: ("bytes", ">H"), 0xC6: ("bytes", ">I"), 0xC7: ("extension", ">B"), 0xC8: ("extension", ">H"), 0xC9: ("extension", ">I"),
    0xD9: ("text", ">B"), 0xDA: ("text", ">H"), 0xDB: ("text", ">I"), 0xDC: ("list", ">H"), 0xDD: ("list", ">I"), 0xDE: ("map", ">H"), 0xDF: ("map", ">I"),
}
FIXED = {0xC0: None, 0xC2: False, 0xC3: True}
FIXED_EXTENSIONS = {0xD4: 1, 0xD5: 2, 0xD6: 4, 0xD7: 8, 0xD8: 16}


def _value(data: bytes, at: int):
    (first,), at = _take(data, at, 1)
    if first < 0x80:
        return first, at
    if first >= 0xE0:
        return first - 256, at
    if first in FIXED:
        return FIXED[first], at
    if first in NUMBERS:
        return _number(data, at, NUMBERS[first])
    if first in FIXED_EXTENSIONS:
        kind, n = "extension", FIXED_EXTENSIONS[first]
    elif first in LENGTHS:
        kind, form = LENGTHS[first]
        n, at = _number(data, at, form)
    elif first < 0x90:
        kind, n = "map", first & 0x0F
    elif first < 0xA0:
        kind, n = "list", first & 0x0F
    elif first < 0xC0:
        kind, n = "text", first & 0x1F
    else:
        raise ValueError(f"no value begins with {first:#x}")
    if kind == "text":
        raw, at = _take(data, at, n)
        return raw.decode("utf-8", "replace"), at
    if kind == "bytes":
        return _take(data, at, n)
    if kind == "extension":
        (code,), at = _take(data, at, 1)
        raw, at = _take(data, at, n)
        return {"extension": code, "data": raw}, at
    out: list = []
    for _ in range(n if kind == "list" else 2 * n):
        value, at = _value(data, at)
        out.append(value)
    return (out, at) if kind == "list" else (dict(zip(map(str, out[0::2]), out[1::2])), at)


def decoded(data: bytes):
    """The one value that ``data`` holds; raises ValueError on anything else."""
    value, at = _value(data, 0)
    if at != len(data):
        raise ValueError(f"{len(data) - at} bytes after the value")
    return value


def all_values(data: bytes) -> Iterator:
    """Values one after another."""
    at = 0
    while at < len(data):
        value, at = _value(data, at)
        yield value
