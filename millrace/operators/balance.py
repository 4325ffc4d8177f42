"""Oversampling of rare classes: which parents to vary how often, and the variation itself."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def oversample_plan(parents: DataFrame, deficits: DataFrame, label: str, key: str = "sample_id") -> DataFrame:
    """(label, i, parent_sample_id, synthetic_id): ``deficits(label, missing)`` variants a class.

    Variant i of a class takes parent i mod n in the order of a hash, so the plan is reproducible
    and every parent is used about equally often. Parents should be training samples only.
    """
    placed = parents.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).select(label, key).distinct()
    # no class needs more parents than the greatest deficit, so a class of very many rows is cut down
    # to so many before it meets in one task (a limit on the rank is taken before the shuffle)
    most = deficits.agg(F.coalesce(F.max("missing"), F.lit(0))).first()[0]
    placed = placed.withColumn("_i", F.row_number().over(W.partitionBy(label).orderBy(F.xxhash64(key), key)) - 1).filter(F.col("_i") < int(most))
    n = placed.groupBy(label).agg(F.count("*").alias("_n"))
    rows = deficits.filter("missing > 0").join(n, label).select(label, "_n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("missing").cast("long"))).alias("i"))
    out = rows.withColumn("_i", F.pmod(F.col("i") - 1, F.col("_n")).cast("int")).join(placed, [label, "_i"])
    return out.select(label, "i", F.col(key).alias("parent_sample_id"), F.substring(F.sha2(F.concat_ws("|", key, F.col("i").cast("string")), 256), 1, 24).alias("synthetic_id"))


#: Fixed values of the variation: greatest angle, contrast, brightness, and shifts of hue and saturation.
ANGLE, CONTRAST, BRIGHTNESS, HUE, SATURATION = 15.0, (0.88, 1.14), 14.0, 6.0, (0.85, 1.15)


def _slanted(image: np.ndarray, degrees: float) -> np.ndarray:
    """The picture turned about its centre, its border mirrored outwards."""
    h, w = image.shape[:2]
    yy, xx = np.mgrid[:h, :w].astype(np.float64)
    a, cy, cx = np.deg2rad(degrees), h / 2, w / 2
    y, x = cy + np.sin(a) * (xx - cx) + np.cos(a) * (yy - cy), cx + np.cos(a) * (xx - cx) - np.sin(a) * (yy - cy)
    mirror = lambda v, n: np.abs((v + n - 1) % max(1, 2 * (n - 1)) - (n - 1))
    y, x = mirror(y, h), mirror(x, w)
    i, j = np.clip(y.astype(int), 0, max(0, h - 2)), np.clip(x.astype(int), 0, max(0, w - 2))
    k, m = np.minimum(i + 1, h - 1), np.minimum(j + 1, w - 1)
    u, v = (y - i)[..., None], (x - j)[..., None]
    p = image.astype(np.float64)
    return (1 - u) * (1 - v) * p[i, j] + u * (1 - v) * p[k, j] + (1 - u) * v * p[i, m] + u * v * p[k, m]


def _tinted(image: np.ndarray, turn: float, scale: float) -> np.ndarray:
    """The picture with its hue (in half degrees) turned and its saturation scaled."""
    x = np.clip(image, 0, 255)
    high, low = x.max(axis=2), x.min(axis=2)
    span = high - low
    safe = np.where(span > 0, span, 1)
    b, g, r = x[..., 0], x[..., 1], x[..., 2]
    hue = np.where(high == r, (g - b) / safe, np.where(high == g, 2 + (b - r) / safe, 4 + (r - g) / safe)) + turn / 30
    span = np.minimum(span * scale, high)
    wave = lambda n: high - span * np.clip(np.minimum((n + hue) % 6, 4 - (n + hue) % 6), 0, 1)
    return np.stack([wave(1), wave(3), wave(5)], axis=2)


def vary(image: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A variant of a picture (rows, columns, channels): flips, a slant or quarter turns, contrast and
    brightness, hue and saturation, now and then a slight blur. An alpha channel turns with the rest."""
    out = image
    if rng.random() > 0.5:
        out = out[:, ::-1]
    if rng.random() > 0.7:
        out = out[::-1]
    angle = float(rng.uniform(-ANGLE, ANGLE))
    out = np.rot90(out, int(rng.integers(1, 4))).astype(np.float64) if rng.random() > 0.8 else _slanted(out, angle)
    colour, rest = out[..., :3], out[..., 3:]
    colour = np.clip(colour * rng.uniform(*CONTRAST) + rng.uniform(-BRIGHTNESS, BRIGHTNESS), 0, 255)
    if rng.random() > 0.4 and colour.shape[2] == 3:
        colour = _tinted(colour, float(rng.uniform(-HUE, HUE)), float(rng.uniform(*SATURATION)))
    if rng.random() > 0.75:
        k = np.array([1, 2, 1]) / 4
        p = np.pad(colour, ((1, 1), (1, 1), (0, 0)), mode="reflect" if min(colour.shape[:2]) > 1 else "edge")
        p = sum(k[i] * p[i : i + colour.shape[0]] for i in range(3))
        colour = sum(k[i] * p[:, i : i + colour.shape[1]] for i in range(3))
    return np.clip(np.rint(np.concatenate([colour, rest], axis=2)), 0, 255).astype(np.uint8)


def synthesize(plan: DataFrame, images: DataFrame, seed: int = 0) -> DataFrame:
    """plan ⋈ images(sample_id, height, width, channels, data) -> variants, seeded by parent and number."""
    pixels = images.select(F.col("sample_id").alias("parent_sample_id"), "height", "width", "channels", "data")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zlib

        for part in parts:
            rows = []
            for r in part.itertuples():
                image = np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, r.channels)
                new = vary(image, np.random.default_rng([seed, zlib.crc32(str(r.parent_sample_id).encode()), int(r.i)]))
                rows.append((r.synthetic_id, r.parent_sample_id, *new.shape, new.tobytes()))
            yield pd.DataFrame(rows, columns=["sample_id", "parent_sample_id", "height", "width", "channels", "data"])

    return plan.join(pixels, "parent_sample_id").mapInPandas(run, "sample_id string, parent_sample_id string, height int, width int, channels int, data binary")
