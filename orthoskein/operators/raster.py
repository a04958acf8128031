"""Raster operators: warping into tiles, edge distances, blending and seam differences.

Images are rows (image_id, height, width, rgb BINARY); warped images are rows of
tiles (image_id, ty, tx, rgb, mask, weight), so that a task holds one image or one tile.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TILE = 256
TILE_SCHEMA = "image_id long, ty int, tx int, rgb binary, mask binary, weight binary"


def corners(poses: DataFrame) -> DataFrame:
    """Bounding box of each image's four projected corners: image_id, x0, y0, x1, y1."""
    xs, ys = [], []
    for cx, cy in ((F.lit(0.0), F.lit(0.0)), (F.col("cols"), F.lit(0.0)), (F.col("cols"), F.col("rows")), (F.lit(0.0), F.col("rows"))):
        w = F.col("t20") * cx + F.col("t21") * cy + F.col("t22")
        xs.append((F.col("t00") * cx + F.col("t01") * cy + F.col("t02")) / w)
        ys.append((F.col("t10") * cx + F.col("t11") * cy + F.col("t12")) / w)
    return poses.select("image_id", F.least(*xs).alias("x0"), F.least(*ys).alias("y0"), F.greatest(*xs).alias("x1"), F.greatest(*ys).alias("y1"))


def canvas(poses: DataFrame) -> DataFrame:
    """Origin and size of the canvas that holds all images: x0, y0, height, width."""
    box = corners(poses).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
    return box.select("x0", "y0", F.ceil(F.col("y1") - F.col("y0")).alias("height"), F.ceil(F.col("x1") - F.col("x0")).alias("width"))


def _lower_envelope(f: np.ndarray) -> np.ndarray:
    """min over q of (x - q)**2 + f[:, q] for every x, in one pass over the columns for all rows at once.

    Each row keeps a stack of the parabolas that are least somewhere, and where
    each begins to be.
    """
    h, w = f.shape
    rows = np.arange(h)
    place, begin, top = np.zeros((h, w), np.int32), np.full((h, w + 1), np.inf), np.zeros(h, np.int64)
    begin[:, 0] = -np.inf
    for q in range(1, w):
        active, value = rows, f[:, q] + q * q
        while len(active):
            p = place[active, top[active]]
            meet = (value[active] - f[active, p] - p.astype(float) ** 2) / (2.0 * (q - p))
            stays = meet > begin[active, top[active]]
            done = active[stays]
            top[done] += 1
            place[done, top[done]], begin[done, top[done]], begin[done, top[done] + 1] = q, meet[stays], np.inf
            active = active[~stays]
            top[active] -= 1
    out, at = np.empty((h, w)), np.zeros(h, np.int64)
    for x in range(w):
        late = np.flatnonzero(begin[rows, at + 1] < x)
        while len(late):
            at[late] += 1
            late = late[begin[late, at[late] + 1] < x]
        p = place[rows, at]
        out[:, x] = (x - p) ** 2.0 + f[rows, p]
    return out


def edge_distance(mask: np.ndarray, far: float | None = None) -> np.ndarray:
    """Exact distance of each pixel to the nearest zero pixel, float32, at most ``far``.

    ``far`` is the mask's diagonal by default; without a zero pixel all are as far.
    Columns first, by running positions, then rows by lower envelopes.
    """
    h, w = mask.shape
    far = float(np.hypot(h, w)) if far is None else far
    if mask.all():
        return np.full((h, w), far, np.float32)
    rows = np.arange(h)[:, None]
    up = np.maximum.accumulate(np.where(mask == 0, rows, -(h + w)), axis=0)
    down = np.minimum.accumulate(np.where(mask == 0, rows, 2 * (h + w))[::-1], axis=0)[::-1]
    vertical = np.minimum(np.minimum(rows - up, down - rows), h + w).astype(np.float64) ** 2
    return np.minimum(np.sqrt(_lower_envelope(vertical)), far).astype(np.float32)


def warp(image: np.ndarray, t: np.ndarray, x0: float, y0: float, height: int, width: int) -> tuple[np.ndarray, np.ndarray, tuple[int, int]]:
    """Bilinear warp of an image into its own box of the canvas: pixels, mask, (top, left).

    Beyond its border an image is zero, and so is its mask of 255: pixels less
    than one source pixel outside get their share of both. Positions are taken
    to 1/32 of a source pixel and values rounded, as fixed-point resampling does.
    """
    h, w = image.shape[:2]
    shift = np.array([[1, 0, -x0], [0, 1, -y0], [0, 0, 1.0]]) @ t
    edge = shift @ np.array([[-1, w, w, -1], [-1, -1, h, h], [1, 1, 1, 1.0]])
    edge = edge[:2] / edge[2]
    left, top = (max(0, int(np.floor(v.min()))) for v in edge)
    right, bottom = min(width, int(np.ceil(edge[0].max())) + 1), min(height, int(np.ceil(edge[1].max())) + 1)
    if right <= left or bottom <= top or abs(np.linalg.det(shift)) < 1e-300:
        return np.zeros((0, 0, 3), np.uint8), np.zeros((0, 0), np.uint8), (top, left)
    gx, gy = np.meshgrid(np.arange(left, right), np.arange(top, bottom))
    src = np.linalg.inv(shift) @ np.stack([gx.ravel(), gy.ravel(), np.ones(gx.size)])
    with np.errstate(divide="ignore", invalid="ignore"):
        at = np.rint(src[:2] / src[2] * 32)
    inside = np.isfinite(at).all(axis=0) & (at[0] > -32) & (at[0] < 32 * w) & (at[1] > -32) & (at[1] < 32 * h)
    fx, fy = (np.where(inside, v, 0).astype(np.int64) + 32 for v in at)
    ix, iy, ax, ay = fx >> 5, fy >> 5, (fx & 31)[:, None], (fy & 31)[:, None]
    # One more row and column of zeros all around; the mask is a fourth channel.
    p = np.zeros((h + 2, w + 2, 4), np.int64)
    p[1:-1, 1:-1, :3], p[1:-1, 1:-1, 3] = image, 255
    value = (p[iy, ix] * (32 - ax) + p[iy, ix + 1] * ax) * (32 - ay) + (p[iy + 1, ix] * (32 - ax) + p[iy + 1, ix + 1] * ax) * ay
    pixels = np.where(inside[:, None], (value + 512) >> 10, 0).astype(np.uint8).reshape(*gx.shape, 4)
    return np.ascontiguousarray(pixels[..., :3]), np.ascontiguousarray(pixels[..., 3]), (top, left)


def _tiles(x0: float, y0: float, height: int, width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                image = np.frombuffer(r.rgb, np.uint8).reshape(r.height, r.width, 3)
                t = np.array([getattr(r, f"t{i}{j}") for i in range(3) for j in range(3)]).reshape(3, 3)
                rgb, mask, (top, left) = warp(image, t, x0, y0, height, width)
                # The distance crosses tiles, so it is taken on the whole image; zeros close its box, but for the canvas's own border.
                pad = ((int(top > 0), int(top + mask.shape[0] < height)), (int(left > 0), int(left + mask.shape[1] < width)))
                weight = mask.astype(np.float32)
                if mask.size:
                    weight = edge_distance(np.pad(mask, pad), float(np.hypot(height, width)))[pad[0][0] : pad[0][0] + mask.shape[0], pad[1][0] : pad[1][0] + mask.shape[1]]
                rows = []
                for ty in range(top // TILE, (top + mask.shape[0] + TILE - 1) // TILE):
                    for tx in range(left // TILE, (left + mask.shape[1] + TILE - 1) // TILE):
                        tile_rgb, tile_mask, tile_weight = np.zeros((TILE, TILE, 3), np.uint8), np.zeros((TILE, TILE), np.uint8), np.zeros((TILE, TILE), np.float32)
                        a, b = max(top, ty * TILE), min(top + mask.shape[0], (ty + 1) * TILE)
                        c, d = max(left, tx * TILE), min(left + mask.shape[1], (tx + 1) * TILE)
                        if a >= b or c >= d or not mask[a - top : b - top, c - left : d - left].any():
                            continue
                        inner, outer = (slice(a - ty * TILE, b - ty * TILE), slice(c - tx * TILE, d - tx * TILE)), (slice(a - top, b - top), slice(c - left, d - left))
                        tile_rgb[inner], tile_mask[inner], tile_weight[inner] = rgb[outer], mask[outer], weight[outer]
                        rows.append((r.image_id, ty, tx, tile_rgb.tobytes(), tile_mask.tobytes(), tile_weight.tobytes()))
                yield pd.DataFrame(rows, columns=["image_id", "ty", "tx", "rgb", "mask", "weight"])

    return run


def finite(poses: DataFrame) -> DataFrame:
    """Poses all of whose cells are finite numbers."""
    return poses.where(" AND ".join(f"t{i}{j} IS NOT NULL AND NOT isnan(t{i}{j}) AND abs(t{i}{j}) < double('infinity')" for i in range(3) for j in range(3)))


def warp_tiles(images: DataFrame, poses: DataFrame) -> DataFrame:
    """Tiles of all images warped into one canvas; images without a pixel on it give none."""
    usable = finite(poses)
    box = canvas(usable).first()
    if box.height is None:
        return images.sparkSession.createDataFrame([], TILE_SCHEMA)
    cells = [f"t{i}{j}" for i in range(3) for j in range(3)]
    joined = images.join(usable.select("image_id", *cells), "image_id")
    return joined.mapInPandas(_tiles(box.x0, box.y0, int(box.height), int(box.width)), TILE_SCHEMA)


def _blend(tiles: pd.DataFrame) -> pd.DataFrame:
    total, weight = np.zeros((TILE, TILE, 3)), np.zeros((TILE, TILE))
    for r in tiles.sort_values("image_id").itertuples():
        w = np.frombuffer(r.weight, np.float32).reshape(TILE, TILE).astype(np.float64)
        total += w[..., None] * np.frombuffer(r.rgb, np.uint8).reshape(TILE, TILE, 3)
        weight += w
    mean = np.where(weight[..., None] > 0, total / np.where(weight > 0, weight, 1)[..., None], 0)
    return pd.DataFrame({"ty": [tiles["ty"].iloc[0]], "tx": [tiles["tx"].iloc[0]], "rgb": [np.rint(mean).astype(np.uint8).tobytes()]})


def blend(tiles: DataFrame) -> DataFrame:
    """Weighted mean of all images at each pixel, rounded half to even; 0 where none covers it."""
    return tiles.groupBy("ty", "tx").applyInPandas(_blend, "ty int, tx int, rgb binary")


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(r.image_id, int((np.frombuffer(r.mask, np.uint8) > 0).sum()), int(np.frombuffer(r.rgb, np.uint8).sum(dtype=np.int64))) for r in batch.itertuples()]
        yield pd.DataFrame(rows, columns=["image_id", "pixels", "total"])


def pixel_sums(tiles: DataFrame) -> DataFrame:
    """(image_id, pixels, total): covered pixels of each warped image and the sum of their values."""
    parts = tiles.select("image_id", "rgb", "mask").mapInPandas(_sums, "image_id long, pixels long, total long")
    return parts.groupBy("image_id").agg(F.sum("pixels").alias("pixels"), F.sum("total").alias("total"))


def _shares(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"image_id": batch["image_id"], "share": [float(np.frombuffer(a, np.float32).sum(dtype=np.float64)) for a in batch["alpha"]]})


def share_sums(alphas: DataFrame) -> DataFrame:
    """(image_id, share): pixels that each image makes up, counted by its shares."""
    return alphas.select("image_id", "alpha").mapInPandas(_shares, "image_id long, share double").groupBy("image_id").agg(F.sum("share").alias("share"))


def _alphas(tiles: pd.DataFrame) -> pd.DataFrame:
    weights = [np.frombuffer(w, np.float32).astype(np.float64) for w in tiles["weight"]]
    total = np.sum(weights, axis=0)
    alpha = [np.where(total > 0, w / np.where(total > 0, total, 1), 0).astype(np.float32).tobytes() for w in weights]
    return pd.DataFrame({"image_id": tiles["image_id"], "ty": tiles["ty"], "tx": tiles["tx"], "alpha": alpha})


def alphas(tiles: DataFrame) -> DataFrame:
    """(image_id, ty, tx, alpha): each image's share of every pixel, float32; the shares of a covered pixel sum to 1."""
    return tiles.select("image_id", "ty", "tx", "weight").groupBy("ty", "tx").applyInPandas(_alphas, "image_id long, ty int, tx int, alpha binary")


def _difference(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for r in batch.itertuples():
            both = (np.frombuffer(r.mask, np.uint8) > 0) & (np.frombuffer(r.mask_b, np.uint8) > 0)
            bands = [np.frombuffer(x, np.float32) > 0 for x in (r.alpha, r.alpha_b) if x is not None]
            if bands:
                both &= np.logical_or.reduce(bands)
            a, b = (np.frombuffer(x, np.uint8).reshape(-1, 3)[both].astype(np.float32) for x in (r.rgb, r.rgb_b))
            rows.append((r.src, r.dst, float(np.abs(a / np.float32(255) - b / np.float32(255)).sum(dtype=np.float64)), int(both.sum()) * 3))
        yield pd.DataFrame(rows, columns=["src", "dst", "total", "n"])


def seam_differences(tiles: DataFrame, band: DataFrame | None = None) -> DataFrame:
    """(src, dst, total, n): summed difference over the common pixels of each overlapping pair.

    ``band`` (image_id, ty, tx, alpha) keeps pixels where either image has a
    share; an image without rows in it sets no limit.
    """
    if band is None:
        rows = tiles.withColumn("alpha", F.lit(None).cast("binary"))
    else:
        none = F.lit(bytearray(4 * TILE * TILE))
        listed = band.select("image_id").distinct().withColumn("listed", F.lit(True))
        rows = tiles.join(band.select("image_id", "ty", "tx", "alpha"), ["image_id", "ty", "tx"], "left").join(listed, "image_id", "left")
        rows = rows.withColumn("alpha", F.when(F.col("listed"), F.coalesce("alpha", none)))
    a = rows.select("ty", "tx", F.col("image_id").alias("src"), "rgb", "mask", "alpha")
    b = rows.select("ty", "tx", F.col("image_id").alias("dst"), *[F.col(c).alias(f"{c}_b") for c in ("rgb", "mask", "alpha")])
    meet = a.join(b, ["ty", "tx"]).where("src < dst").select("src", "dst", "rgb", "mask", "alpha", "rgb_b", "mask_b", "alpha_b")
    parts = meet.mapInPandas(_difference, "src long, dst long, total double, n long")
    return parts.groupBy("src", "dst").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).where("n > 0")


def seam_error(tiles: DataFrame, band: DataFrame | None = None) -> DataFrame:
    """Mean difference over all common pixels of all pairs (of the band, if given); NULL without any."""
    return seam_differences(tiles, band).agg((F.sum("total") / F.sum("n")).alias("seam_error"))
