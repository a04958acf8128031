"""Headers of image files derived from ``supplier``: EXIF blocks and packets by closed formulas of the key.

Every tenth file has its position in the packet alone, the next none at all,
and the one after that only a latitude in EXIF; byte orders, hemispheres,
altitudes, times and yaws vary or are missing by other remainders.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import exif


def _directory(order: str, entries: list[tuple[int, int, int, bytes]], at: int) -> bytes:
    """One directory at ``at`` of the block, its long values behind it."""
    head, tail = struct.pack(order + "H", len(entries)), b""
    behind = at + 2 + 12 * len(entries) + 4
    for tag, kind, n, raw in entries:
        if len(raw) <= 4:
            value = raw.ljust(4, b"\0")
        else:
            value = struct.pack(order + "I", behind + len(tail))
            tail += raw
        head += struct.pack(order + "HHI", tag, kind, n) + value
    return head + struct.pack(order + "I", 0) + tail


def header(k: int) -> bytes:
    """A JPEG file's first segments for key ``k``."""
    order = "<" if k % 2 else ">"
    text = lambda s: (2, len(s) + 1, s.encode() + b"\0")
    rationals = lambda *p: (5, len(p), struct.pack(f"{order}{2 * len(p)}I", *(x for r in p for x in r)))
    gps, own = [], []
    if k % 10 not in (7, 8):
        gps += [(exif.LAT_REF, *text("S" if k % 5 == 0 else "N")), (exif.LAT, *rationals((36 + k % 3, 1), (7 * k % 60, 1), (k * 137 % 6000 * 2, 200)))]
        if k % 10 != 9:
            gps += [(exif.LON_REF, *text("W" if k % 3 == 1 else "E")), (exif.LON, *rationals(((5 + k % 7) * 3, 3), (11 * k % 60, 1), (k * 53 % 6000, 100)))]
        gps += [(exif.ALT_REF, 1, 1, bytes([k % 6 == 0])), (exif.ALT, *rationals((k % 400 + 1, 4)))]
    if k % 11 != 5:
        stamp = f"2024:{1 + k % 12:02d}:{1 + k % 28:02d} {k % 24:02d}:{k * 7 % 60:02d}:{k * 13 % 60:02d}"
        own.append((exif.TAKEN, *text(stamp if k % 11 != 6 else stamp.replace(":", "-"))))
    if k % 3 < 2:
        own.append((exif.SUBSECOND, *text(f"{k % 1000:03d}" if k % 3 == 0 else "ab")))
    # Two pointers stand in the first directory; the others follow it.
    first = 8 + 2 + 24 + 4
    block_own = _directory(order, own, first)
    block_gps = _directory(order, gps, first + len(block_own)) if gps else b""
    pointers = [(exif.EXIF_POINTER, 4, 1, struct.pack(order + "I", first)), (exif.GPS_POINTER, 4, 1, struct.pack(order + "I", first + len(block_own) if gps else 0))]
    block = (b"II*\0" if order == "<" else b"MM\0*") + struct.pack(order + "I", 8) + _directory(order, pointers, 8) + block_own + block_gps
    names = []
    if k % 10 in (7, 9):
        names += [("GpsLatitude", f"{(k % 90) + 0.25:+.4f}"), ("GpsLongitude", f"{-(k % 180) - 0.5:+.4f}")]
    if k % 4 == 0:
        names.append(("AbsoluteAltitude", f"{k % 300 / 2:+.2f}"))
    if k % 3:
        names.append(("RelativeAltitude", f"{k % 120 + 0.5:+.2f}"))
    if k % 7 != 3:
        names.append(("GimbalYawDegree", f"{k * 13 % 3600 / 10 - 180:+.1f}"))
    packet = '<?xpacket begin="" id="x"?><x:xmpmeta ' + " ".join(f'drone-dji:{n}="{v}"' for n, v in names) + ' other:Yaw="9"/><?xpacket end="w"?>'
    segment = lambda body: b"\xff\xe1" + struct.pack(">H", len(body) + 2) + body
    return b"\xff\xd8" + segment(b"Exif\0\0" + block) + (segment(b"ns\0" + packet.encode()) if k % 13 else b"") + b"\xff\xd9"


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("image_id"), pa.array([header(k) for k in batch.column("image_id").to_pylist()], pa.binary())], names=["image_id", "content"])


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image_id, content) of every supplier."""
    keys = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").cast("long").alias("image_id"))
    return keys.mapInArrow(_headers, "image_id long, content binary")
