"""Image metadata from EXIF blocks and text packets: attributes, positions, altitudes, capture times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import exif


#: The packet's frame and the attributes of the camera's namespace in it.
PACKET = r"(?s)<\?xpacket begin=.*?<\?xpacket end=.*?\?>"
CAMERA_ATTRIBUTE = r'drone-dji:(\w+)="([^"]*)"'


def attributes(packet: Column, pattern: str = r'([A-Za-z][\w:.-]*)="([^"]*)"') -> Column:
    """All ``name="value"`` attributes as a map; the last of equal names wins."""
    names = F.regexp_extract_all(packet, F.lit(pattern), F.lit(1))
    values = F.regexp_extract_all(packet, F.lit(pattern), F.lit(2))
    pairs = F.transform(F.arrays_zip(names.alias("n"), values.alias("v")), lambda p, i: F.struct(p["n"].alias("n"), i.alias("i"), p["v"].alias("v")))
    # Bound as a lambda's variable, the sorted pairs are made once.
    last = lambda s: F.filter(s, lambda p, i: ~F.coalesce(F.get(s, i + 1)["n"] == p["n"], F.lit(False)))
    kept = F.get(F.transform(F.array(F.array_sort(pairs)), last), 0)
    return F.map_from_entries(F.transform(kept, lambda p: F.struct(p["n"], p["v"])))


def first_packet(content: Column) -> Column:
    """The first metadata packet in raw bytes, as UTF-8 text; NULL if there is none."""
    found = F.regexp_extract(F.decode(content, "ISO-8859-1"), PACKET, 0)
    return F.when(found != "", F.decode(F.encode(found, "ISO-8859-1"), "UTF-8"))


def camera_attributes(content: Column) -> Column:
    """The camera's attributes of the first packet; an empty map without a packet."""
    return F.coalesce(attributes(first_packet(content), CAMERA_ATTRIBUTE), F.expr("map()").cast("map<string,string>"))


def signed_decimal(text: Column) -> Column:
    """A signed number; not subject to the hemisphere letter."""
    return text.try_cast("double")


def degrees_of(parts: Column, hemisphere: Column) -> Column:
    """Decimal degrees of three (num, den) rationals; south and west are negative."""
    value = lambda i: F.try_divide(F.get(parts, i)["num"].cast("double"), F.get(parts, i)["den"].cast("double"))
    degrees = value(0) + value(1) / 60.0 + value(2) / 3600.0
    return F.when(hemisphere.isin("S", "W"), -degrees).otherwise(degrees)


def position(exif_lat: Column, exif_lon: Column, xmp_lat: Column, xmp_lon: Column) -> Column:
    """Latitude and longitude as a pair, with their source; EXIF wins only if complete."""
    exif = F.when(exif_lat.isNotNull() & exif_lon.isNotNull(), F.struct(exif_lat.alias("lat"), exif_lon.alias("lon"), F.lit("exif").alias("source")))
    xmp = F.when(xmp_lat.isNotNull() & xmp_lon.isNotNull(), F.struct(xmp_lat.alias("lat"), xmp_lon.alias("lon"), F.lit("xmp").alias("source")))
    return F.coalesce(exif, xmp)


def capture_time(original: Column, fraction: Column) -> Column:
    """Epoch seconds of a local text time read as UTC, with its fractional digits if all are digits."""
    seconds = F.unix_timestamp(F.try_to_timestamp(F.trim(original), F.lit("yyyy:MM:dd HH:mm:ss"))).cast("double")
    part = F.when(F.trim(fraction).rlike("^[0-9]+$"), F.concat(F.lit("0."), F.trim(fraction)).try_cast("double"))
    return seconds + F.coalesce(part, F.lit(0.0))


def altitudes(alt: Column, alt_ref: Column, xmp: Column) -> tuple[Column, Column]:
    """Absolute (the packet's, else EXIF's, negative below the sea) and relative altitude (the packet's alone)."""
    above = F.try_divide(alt["num"].cast("double"), alt["den"].cast("double"))
    exif = F.when(alt_ref == 1, -above).otherwise(above)
    absolute = F.try_element_at(xmp, F.lit("AbsoluteAltitude"))
    return F.coalesce(F.when(absolute.isNotNull(), signed_decimal(absolute)), F.when(absolute.isNull(), exif)), signed_decimal(F.try_element_at(xmp, F.lit("RelativeAltitude")))


def read_metadata(files: DataFrame, key: str = "path") -> DataFrame:
    """One row a file: position and its source, altitudes, capture time and gimbal yaw.

    key, exif (raw fields), xmp (the camera's attributes), lat, lon, source,
    abs_alt_m, rel_alt_m, t, gimbal_yaw_deg; what a file does not tell is NULL.
    EXIF gives the position if it has latitude and longitude with their
    hemispheres, else the packet if it has both. Files are read once: the
    packet is found by expressions, the EXIF block by one Arrow kernel.
    """
    told = files.select(key, "content", camera_attributes(F.col("content")).alias("xmp"))
    kind = told.schema
    raw = told.select(F.struct(key, "xmp").alias("row"), "content").mapInArrow(exif._read, f"row struct<`{key}`:{kind[key].dataType.simpleString()},xmp:map<string,string>>, exif {exif.DDL}")
    rows = raw.select("row.*", "exif")
    e = F.col("exif")
    lat = F.when(e["lat_ref"].isNotNull(), degrees_of(e["lat"], e["lat_ref"]))
    lon = F.when(e["lon_ref"].isNotNull(), degrees_of(e["lon"], e["lon_ref"]))
    xmp = lambda name: signed_decimal(F.try_element_at("xmp", F.lit(name)))
    high, low = altitudes(e["alt"], e["alt_ref"], F.col("xmp"))
    out = rows.withColumn("fix", position(lat, lon, xmp("GpsLatitude"), xmp("GpsLongitude")))
    has = F.col("fix").isNotNull()
    return out.select(
        key, "exif", "xmp", "fix.lat", "fix.lon", "fix.source", F.when(has, high).alias("abs_alt_m"), F.when(has, low).alias("rel_alt_m"),
        capture_time(e["taken"], e["subsecond"]).alias("t"), xmp("GimbalYawDegree").alias("gimbal_yaw_deg"),
    )


def exif_positions(metadata: DataFrame, key: str = "path") -> DataFrame:
    """(key, lat, lon) of files whose position is EXIF's; others have none here."""
    return metadata.where("source = 'exif'").select(key, "lat", "lon")


def capture_times(metadata: DataFrame, key: str = "path") -> DataFrame:
    """(key, t) of files with a capture time."""
    return metadata.where("t is not null").select(key, "t")


def read_packets(df: DataFrame) -> DataFrame:
    """(path, attributes) of ``binaryFile`` rows; an empty map where a file has no packet."""
    return df.select("path", F.coalesce(attributes(first_packet(F.col("content"))), F.expr("map()").cast("map<string,string>")).alias("attributes"))
