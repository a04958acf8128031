"""EXIF blocks of image files: a kernel that walks JPEG segments and TIFF directories."""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Fixed values of the file formats: directory pointers and the tags that are read.
EXIF_POINTER, GPS_POINTER = 0x8769, 0x8825
TAKEN, SUBSECOND = 0x9003, 0x9291
LAT_REF, LAT, LON_REF, LON, ALT_REF, ALT = 1, 2, 3, 4, 5, 6
#: Bytes of a value of each TIFF type.
SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 7: 1, 9: 4, 10: 8}

RATIONAL = pa.struct([("num", pa.int64()), ("den", pa.int64())])
FIELDS = pa.struct(
    [("lat", pa.list_(RATIONAL)), ("lat_ref", pa.string()), ("lon", pa.list_(RATIONAL)), ("lon_ref", pa.string()), ("alt", RATIONAL), ("alt_ref", pa.int32()), ("taken", pa.string()), ("subsecond", pa.string()), ("has_gps", pa.bool_())]
)
DDL = (
    "struct<lat:array<struct<num:bigint,den:bigint>>,lat_ref:string,lon:array<struct<num:bigint,den:bigint>>,lon_ref:string,"
    "alt:struct<num:bigint,den:bigint>,alt_ref:int,taken:string,subsecond:string,has_gps:boolean>"
)


def tiff_block(data: bytes) -> bytes | None:
    """The TIFF block of a JPEG file's first EXIF segment, or of a TIFF file."""
    if data[:4] in (b"II*\0", b"MM\0*"):
        return data
    at = 2 if data[:2] == b"\xff\xd8" else len(data)
    while at + 4 <= len(data) and data[at] == 0xFF:
        kind, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
        if kind in (0xD9, 0xDA) or size < 2:
            break
        if kind == 0xE1 and data[at + 4 : at + 10] == b"Exif\0\0":
            return data[at + 10 : at + 2 + size]
        at += 2 + size
    return None


class Directory:
    """Values by tag of one directory; what lies outside the block is left out."""

    def __init__(self, block: bytes, order: str, at: int):
        self.values: dict[int, object] = {}
        if not 0 < at <= len(block) - 2:
            return
        (count,) = struct.unpack_from(order + "H", block, at)
        for entry in range(at + 2, min(at + 2 + 12 * count, len(block) - 11), 12):
            tag, kind, n = struct.unpack_from(order + "HHI", block, entry)
            size = SIZES.get(kind, 0) * n
            start = entry + 8 if size <= 4 else struct.unpack_from(order + "I", block, entry + 8)[0]
            if size and start + size <= len(block):
                self.values[tag] = self._value(block[start : start + size], order, kind, n)

    @staticmethod
    def _value(raw: bytes, order: str, kind: int, n: int):
        if kind in (1, 7):
            return raw
        if kind == 2:
            return raw.split(b"\0")[0].decode("utf-8", "replace")
        if kind in (5, 10):
            parts = struct.unpack(f"{order}{2 * n}{'I' if kind == 5 else 'i'}", raw)
            return [normalised(a, b) for a, b in zip(parts[::2], parts[1::2], strict=True)]
        return list(struct.unpack(f"{order}{n}{ {3: 'H', 4: 'I', 9: 'i'}[kind] }", raw))

    def number(self, tag: int) -> int | None:
        value = self.values.get(tag)
        return int(value[0]) if isinstance(value, (bytes, list)) and value and not isinstance(value[0], dict) else None

    def text(self, tag: int) -> str | None:
        value = self.values.get(tag)
        return value if isinstance(value, str) else None

    def rationals(self, tag: int) -> list[dict] | None:
        value = self.values.get(tag)
        return value if isinstance(value, list) and value and isinstance(value[0], dict) else None


def normalised(num: int, den: int) -> dict:
    """A rational in lowest terms with a positive denominator; a zero denominator stays."""
    g = math.gcd(num, den) * (-1 if den < 0 else 1) or 1
    return {"num": num // g, "den": den // g}


def fields(data: bytes | None) -> dict | None:
    """The fields of FIELDS; None without an EXIF block."""
    block = tiff_block(data or b"")
    order = {b"II*\0": "<", b"MM\0*": ">"}.get((block or b"")[:4])
    if order is None or len(block) < 8:
        return None
    root = Directory(block, order, struct.unpack_from(order + "I", block, 4)[0])
    exif, gps = (Directory(block, order, root.number(p) or 0) for p in (EXIF_POINTER, GPS_POINTER))

    def place(tag: int) -> list[dict] | None:
        parts = gps.rationals(tag)
        return parts[:3] if parts and len(parts) >= 3 else None

    alt = gps.rationals(ALT)
    return {
        "lat": place(LAT), "lat_ref": gps.text(LAT_REF), "lon": place(LON), "lon_ref": gps.text(LON_REF), "alt": alt[0] if alt else None, "alt_ref": gps.number(ALT_REF),
        "taken": exif.text(TAKEN), "subsecond": exif.text(SUBSECOND), "has_gps": bool(gps.values),
    }


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        # The block lies in the first segments, so contents go one at a time.
        found = pa.array([fields(c.as_py()) for c in batch.column("content")], FIELDS)
        names = [n for n in batch.schema.names if n != "content"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), found], names=[*names, "exif"])


def read_exif(files: DataFrame, key: str = "path") -> DataFrame:
    """(key, exif) of rows with ``content``, as the ``binaryFile`` source gives them; NULL without EXIF."""
    kind = files.schema[key].dataType.simpleString()
    return files.select(key, "content").mapInArrow(_read, f"`{key}` {kind}, exif {DDL}")
