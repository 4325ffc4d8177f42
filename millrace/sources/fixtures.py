"""Made-up corpora: small annotated sources in three formats, and families of transformed pictures."""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.vision import symmetries

IMAGES = "sample_id string, height int, width int, channels int, data binary, family string, transformation string, source string"


def png(image: np.ndarray) -> bytes:
    """A picture (blue, green, red[, alpha]) as a PNG file."""
    h, w, c = image.shape
    order = [2, 1, 0, 3][:c] if c > 1 else [0]
    raw = b"".join(b"\0" + np.ascontiguousarray(image[i][:, order]).tobytes() for i in range(h))
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, {1: 0, 3: 2, 4: 6}[c], 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def _blurred(image: np.ndarray) -> np.ndarray:
    k = np.array([1, 4, 6, 4, 1]) / 16
    p = np.pad(image.astype(np.float64), ((2, 2), (2, 2), (0, 0)), mode="reflect")
    p = sum(k[i] * p[i : i + image.shape[0]] for i in range(5))
    return sum(k[i] * p[:, i : i + image.shape[1]] for i in range(5))


def _sampled(image: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The picture at fractional places, by bilinear interpolation; black outside."""
    h, w = image.shape[:2]
    inside = (y > -0.5) & (y < h - 0.5) & (x > -0.5) & (x < w - 0.5)
    y, x = np.clip(y, 0, h - 1), np.clip(x, 0, w - 1)
    i, j = np.minimum(y.astype(int), h - 2), np.minimum(x.astype(int), w - 2)
    u, v = (y - i)[..., None], (x - j)[..., None]
    p = image.astype(np.float64)
    out = (1 - u) * (1 - v) * p[i, j] + u * (1 - v) * p[i + 1, j] + (1 - u) * v * p[i, j + 1] + u * v * p[i + 1, j + 1]
    return np.where(inside[..., None], out, 0)


def _quantised(image: np.ndarray, step: float) -> np.ndarray:
    """What a lossy coder leaves: blocks of 8 x 8 in the frequency domain, rounded, coarser upwards."""
    n = np.arange(8)
    dct = np.sqrt(2 / 8) * np.cos(np.pi * (2 * n + 1) * n[:, None] / 16)
    dct[0] /= np.sqrt(2)
    h, w, c = image.shape
    p = image.astype(np.float64).reshape(h // 8, 8, w // 8, 8, c).transpose(0, 2, 4, 1, 3)
    q = step * (1 + n[:, None] + n)
    f = np.rint(dct @ p @ dct.T / q) * q
    return (dct.T @ f @ dct).transpose(0, 3, 1, 4, 2).reshape(h, w, c)


def leaf(rng: np.random.Generator, height: int = 192, width: int = 256) -> np.ndarray:
    image = _blurred(rng.integers(20, 220, (height, width, 3)))
    yy, xx = np.mgrid[:height, :width]
    for _ in range(18):
        x, y, r = rng.integers(10, width - 10), rng.integers(10, height - 10), rng.integers(4, 20)
        image[(yy - y) ** 2 + (xx - x) ** 2 <= r * r] = rng.integers(20, 235, 3)
    return _bytes(image)


def _bytes(image: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(image), 0, 255).astype(np.uint8)


def family_pictures(index: int, seed: int = 41) -> Iterator[tuple[str, str, np.ndarray]]:
    """(family, transformation, picture): fourteen forms of one picture and a shuffled negative."""
    rng = np.random.default_rng([seed, index])
    image = leaf(rng)
    h, w = image.shape[:2]
    yy, xx = np.mgrid[:h, :w].astype(np.float64)
    for name, v in symmetries(image):
        yield f"leaf-{index}", name, np.ascontiguousarray(v)
    yield f"leaf-{index}", "jpeg", _bytes(_quantised(image, 2.0))
    sy, sx = np.mgrid[: h * 3 // 2, : w * 3 // 2].astype(np.float64)
    yield f"leaf-{index}", "scale", _bytes(_sampled(image, np.clip((sy + 0.5) / 1.5 - 0.5, 0, h - 1), np.clip((sx + 0.5) / 1.5 - 0.5, 0, w - 1)))
    yield f"leaf-{index}", "brightness", _bytes(image.astype(float) + 20)
    yield f"leaf-{index}", "contrast", _bytes(image * 1.25)
    angle, scale = np.deg2rad(23), 0.8
    dy, dx = (yy - h / 2) / scale, (xx - w / 2) / scale
    yield f"leaf-{index}", "rotation_padding", _bytes(_sampled(image, h / 2 + np.sin(angle) * dx + np.cos(angle) * dy, w / 2 + np.cos(angle) * dx - np.sin(angle) * dy))
    yield f"leaf-{index}", "crop", np.ascontiguousarray(image[25:160, 35:225])
    yield f"negative-{index}", "shuffled", image.reshape(-1, 3)[rng.permutation(h * w)].reshape(image.shape)


def benchmark_images(spark: SparkSession, families: int = 6, seed: int = 41) -> DataFrame:
    """IMAGES of ``families`` families of fifteen pictures, made in tasks."""

    def make(batches):
        import pandas as pd

        for part in batches:
            rows = [(f"{f}-{t}", *p.shape, p.tobytes(), f, t, "synthetic") for i in part["id"] for f, t, p in family_pictures(int(i), seed)]
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in IMAGES.split(", ")])

    return spark.range(families).repartition(min(families, 64)).mapInPandas(make, IMAGES)


def write_benchmark(folder: str, families: int = 6, seed: int = 41) -> str:
    """The same as PNG files and ``manifest.json`` in an empty folder; the path of the manifest."""
    at = Path(folder)
    at.mkdir(parents=True, exist_ok=True)
    if any(at.iterdir()):
        raise FileExistsError(f"{folder} is not empty")
    rows = []
    for i in range(families):
        for family, name, picture in family_pictures(i, seed):
            (at / f"{family}-{name}.png").write_bytes(png(picture))
            rows.append({"id": f"{family}-{name}", "filepath": f"{family}-{name}.png", "family": family, "transformation": name})
    (at / "manifest.json").write_text(json.dumps({"seed": seed, "synthetic": True, "samples": rows}))
    return str(at / "manifest.json")


MANIFEST = "struct<seed:int,synthetic:boolean,samples:array<struct<id:string,filepath:string,family:string,transformation:string,source:string,capture_group:string>>>"


def read_benchmark(spark: SparkSession, manifest: str) -> DataFrame:
    """(id, filepath, family, transformation, source, capture_group, synthetic) of a benchmark's manifest.

    Ids must be unique; id, filepath and family must be texts that aren't blank; ``synthetic`` must be said.
    """
    text = spark.read.text(manifest, wholetext=True).select(F.from_json("value", MANIFEST).alias("m"))
    head = text.select("m.synthetic", F.size("m.samples").alias("n")).first()
    if head is None or head["synthetic"] is None or (head["n"] or 0) <= 0:
        raise ValueError("the manifest must say whether it is synthetic and list samples")
    rows = text.select(F.explode("m.samples").alias("s"), F.col("m.synthetic").alias("synthetic")).select("s.*", "synthetic")
    blank = F.lit(False)
    for c in ("id", "filepath", "family"):
        blank = blank | F.coalesce(F.trim(c) == "", F.lit(True))
    bad, n, ids = rows.agg(F.count_if(blank), F.count("*"), F.count_distinct("id")).first()
    if bad or n != ids:
        raise ValueError(f"{bad} samples lack a field, {n - ids} ids come again")
    return rows.withColumn("transformation", F.coalesce("transformation", F.lit("unknown"))).withColumn("source", F.coalesce("source", F.lit("unknown")))


def write_sources(folder: str, samples: int = 10, seed: int = 42, edge_cases: bool = False) -> list[str]:
    """A COCO, a YOLO and a VOC source with the same pictures of two classes; the three folders.

    ``edge_cases`` adds a box that lies outside, a damaged picture, and an exact copy with another label.
    """
    rng, root, classes = np.random.default_rng(seed), Path(folder), ("healthy", "diseased")
    coco, yolo, voc = root / "mock_coco", root / "mock_yolo", root / "mock_voc"
    for p in (coco / "train", yolo / "images" / "train", yolo / "labels" / "train", voc / "JPEGImages", voc / "Annotations"):
        p.mkdir(parents=True, exist_ok=False)
    images, notes = [], []
    for i in range(samples):
        picture = _bytes(_blurred(rng.integers(0, 255, (96, 96, 3))))
        x, y, w, h = (int(rng.integers(5, 30)), int(rng.integers(5, 30)), int(rng.integers(20, 50)), int(rng.integers(20, 50)))
        label = i % 2
        data = png(picture)
        _write_one(coco / "train" / f"coco-{i:02d}.png", data)
        _write_one(yolo / "images" / "train" / f"yolo-{i:02d}.png", data)
        _write_one(voc / "JPEGImages" / f"voc-{i:02d}.png", data)
        images.append({"id": i + 1, "file_name": f"coco-{i:02d}.png", "width": 96, "height": 96})
        notes.append({"id": i + 1, "image_id": i + 1, "category_id": label + 1, "bbox": [float(x), float(y), float(w), float(h)], "area": float(w * h), "iscrowd": 0})
        (yolo / "labels" / "train" / f"yolo-{i:02d}.txt").write_text(f"{label} {(x + w / 2) / 96:.6f} {(y + h / 2) / 96:.6f} {w / 96:.6f} {h / 96:.6f}\n")
        (voc / "Annotations" / f"voc-{i:02d}.xml").write_text(
            f"<annotation><filename>voc-{i:02d}.png</filename><size><width>96</width><height>96</height><depth>3</depth></size>"
            f"<object><name>{classes[label]}</name><bndbox><xmin>{x}</xmin><ymin>{y}</ymin><xmax>{x + w}</xmax><ymax>{y + h}</ymax></bndbox></object></annotation>"
        )
    if edge_cases and samples:
        notes[0]["bbox"][0] = -5.0
        (voc / "JPEGImages" / "voc-00.png").write_bytes(b"no picture")
        _write_one(coco / "train" / "coco-copy.png", (coco / "train" / "coco-00.png").read_bytes())
        images.append({"id": samples + 1, "file_name": "coco-copy.png", "width": 96, "height": 96})
        notes.append({"id": samples + 1, "image_id": samples + 1, "category_id": 2, "bbox": [1.0, 1.0, 20.0, 20.0], "area": 400.0, "iscrowd": 0})
    (coco / "train" / "_annotations.coco.json").write_text(json.dumps({"images": images, "annotations": notes, "categories": [{"id": k + 1, "name": c} for k, c in enumerate(classes)]}))
    (yolo / "data.yaml").write_text("path: .\ntrain: images/train\nnames: [healthy, diseased]\n")
    return [str(coco), str(yolo), str(voc)]


def _write_one(path: Path, data: bytes) -> None:
    with open(path, "xb") as out:
        out.write(data)
