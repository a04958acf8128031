"""Image files: EXIF blocks, packets, decoding."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from orthoskein.plans import photos
from orthoskein.sources import exif, images, metadata


def files(spark, rows):
    return spark.createDataFrame([(k, bytearray(c) if c is not None else None) for k, c in rows], "image_id long, content binary")


def test_rationals_are_in_lowest_terms():
    assert exif.normalised(200, 400) == {"num": 1, "den": 2}
    assert exif.normalised(-3, -6) == {"num": 1, "den": 2}
    assert exif.normalised(0, 7) == {"num": 0, "den": 1}
    assert exif.normalised(5, 0) == {"num": 1, "den": 0} and exif.normalised(0, 0) == {"num": 0, "den": 0}


def test_both_byte_orders_tell_the_same():
    for k in (21, 22, 26):
        told = exif.fields(photos.header(k))
        assert told["lat"][0]["num"] == 36 + k % 3 and told["lon"][1]["num"] == 11 * k % 60 and told["has_gps"]


@pytest.mark.parametrize("data", [None, b"", b"\xff\xd8", b"\xff\xd8\xff\xe1\x00\x02", b"II*\0", b"MM\0*\xff\xff\xff\xff", b"text only", b"\xff\xd8\xff\xe1\x00\x10Exif\0\0II*\0\x08\0\0\0"])
def test_broken_files_have_no_fields(data):
    told = exif.fields(data)
    assert told is None or not told["has_gps"] and told["taken"] is None


def test_any_cut_of_a_file_is_read_without_failing():
    whole = photos.header(21)
    for end in range(0, len(whole), 3):
        exif.fields(whole[:end])
    damaged = bytearray(whole)
    for at in range(12, 120):
        damaged[at] ^= 0xFF
        exif.fields(bytes(damaged))


def test_metadata_of_odd_files(spark):
    packet = b'<?xpacket begin=""?><x drone-dji:GpsLatitude="+10.5" drone-dji:GpsLongitude="-20.25" drone-dji:RelativeAltitude="up" drone-dji:GimbalYawDegree="1" drone-dji:GimbalYawDegree="2"/><?xpacket end="w"?>'
    rows = [(1, None), (2, b""), (3, packet), (4, b"no packet GpsLatitude"), (5, b"\xff\xd8" + packet + packet.replace(b"10.5", b"99"))]
    out = {r.image_id: r for r in metadata.read_metadata(files(spark, rows), "image_id").collect()}
    assert [out[k].source for k in (1, 2, 3, 4, 5)] == [None, None, "xmp", None, "xmp"]
    assert (out[3].lat, out[3].lon, out[3].rel_alt_m, out[3].gimbal_yaw_deg) == (10.5, -20.25, None, 2.0) and out[5].lat == 10.5
    assert metadata.read_metadata(files(spark, []), "image_id").collect() == []


def test_a_zero_denominator_is_no_position(spark):
    e = F.struct(F.lit(1).alias("num"), F.lit(0).alias("den"))
    assert spark.range(1).select(metadata.degrees_of(F.array(e, e, e), F.lit("N"))).first()[0] is None


def pnm(pixels):
    """A bitmap file of 24 bits a pixel."""
    h, w, _ = pixels.shape
    rows = b"".join(pixels[y, :, ::-1].tobytes().ljust(-(-3 * w // 4) * 4, b"\0") for y in range(h - 1, -1, -1))
    return b"BM" + struct.pack("<IHHI", 54 + len(rows), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, len(rows), 2835, 2835, 0, 0) + rows


def test_images_in_the_order_of_the_list(spark, tmp_path):
    rng = np.random.default_rng(0)
    pixels = [rng.integers(0, 256, (5 + i, 7, 3), dtype=np.uint8) for i in range(3)]
    names = ["b one.bmp", "a.bmp", "c.bmp"]
    for name, p in zip(names, pixels):
        (tmp_path / name).write_bytes(pnm(p))
    got = {r.image_id: r for r in images.load_images(spark, [str(tmp_path / n) for n in names]).collect()}
    for i, p in enumerate(pixels):
        assert (got[i].rows, got[i].cols) == p.shape[:2] and bytes(got[i].rgb) == p.tobytes()
    assert images.load_images(spark, []).collect() == []
    assert images.load_image(spark, str(tmp_path / "a.bmp")).first().rows == 6
    (tmp_path / "bad.bmp").write_bytes(b"not an image")
    with pytest.raises(Exception, match="not an image"):
        images.load_images(spark, [str(tmp_path / "bad.bmp")]).collect()
