"""Exports: manifests, checksums, COCO and YOLO text, class folders, atomic publication, report, bundle."""

from __future__ import annotations

import hashlib
import html
import json
import os
import shutil
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.geometry import pixel_box, yolo_line
from millrace.functions.text import export_name, slug

MANIFEST = ("sample_id", "filepath", "source_dataset", "source_split", "assigned_split", "source_label", "task_type", "asset_sha256", "group_id", "representative_id")


def write_atomic(path: str, data: str | bytes) -> None:
    """Either the old or the new content, never a part."""
    at = Path(path)
    at.parent.mkdir(parents=True, exist_ok=True)
    temporary = at.with_name(f".{at.name}.{uuid.uuid4().hex}")
    with open(temporary, "wb") as f:
        f.write(data.encode() if isinstance(data, str) else data)
        f.flush()
        os.fsync(f.fileno())
    os.replace(temporary, at)


def publish(target: str, fill: Callable[[str], None]) -> None:
    """``fill`` writes into a new folder beside ``target``, which then takes its place in one step."""
    at = Path(target)
    if at.exists() and any(at.iterdir()):
        raise FileExistsError(f"{target} isn't empty")
    temporary = at.with_name(f".{at.name}.{uuid.uuid4().hex}")
    temporary.mkdir(parents=True)
    try:
        fill(str(temporary))
        if at.exists():
            at.rmdir()
        os.replace(temporary, at)
    except BaseException:
        shutil.rmtree(temporary, ignore_errors=True)
        raise


def manifest(samples: DataFrame) -> DataFrame:
    have = set(samples.columns)
    return samples.select(*(F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in MANIFEST), export_name(F.col("sample_id"), F.col("filepath")).alias("export_name"))


def checksum_lines(samples: DataFrame) -> DataFrame:
    return samples.filter("asset_sha256 is not null").select(F.format_string("%s  %s", F.lower("asset_sha256"), export_name(F.col("sample_id"), F.col("filepath"))).alias("line"))


def class_ids(rows: DataFrame, label: str) -> DataFrame:
    """(label, class_id) from 0 in alphabetical order, the same for every split. One row a class."""
    names = [r[0] for r in rows.filter(F.col(label).isNotNull()).select(label).distinct().orderBy(label).toLocalIterator()]
    return rows.sparkSession.createDataFrame(list(zip(names, range(len(names)))) or [], f"{label} string, class_id int")


def yolo_labels(boxes: DataFrame, classes: DataFrame) -> DataFrame:
    """boxes(sample_id, label, box) -> (sample_id, text): the lines of each label file."""
    lines = boxes.join(classes, "label").select("sample_id", F.struct("class_id", yolo_line(F.col("class_id"), F.col("box")).alias("line")).alias("l"))
    return lines.groupBy("sample_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("l")), lambda x: x["line"]), "\n").alias("text"))


def coco_rows(boxes: DataFrame, classes: DataFrame) -> DataFrame:
    """boxes(sample_id, label, box, width, height) -> one JSON annotation a row."""
    pixel = pixel_box(F.col("box"), F.col("width"), F.col("height"))
    note = F.struct(F.col("sample_id").alias("image"), F.col("class_id").alias("category_id"), F.transform(pixel, lambda v: F.round(v, 3)).alias("bbox"), F.round(F.get(pixel, 2) * F.get(pixel, 3), 3).alias("area"), F.lit(0).alias("iscrowd"))
    return boxes.join(classes, "label").select("sample_id", F.to_json(note).alias("annotation"))


def copy_verified(samples: DataFrame, folder: str) -> DataFrame:
    """(sample_id, copied, error): streams each file, compares the digest, never overwrites.

    A file that exists with the right digest counts as copied, so a task
    that runs twice does no harm.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for r in part.itertuples():
                target = os.path.join(folder, r.target)
                try:
                    os.makedirs(os.path.dirname(target), exist_ok=True)
                    _copy(r.filepath, target, r.asset_sha256)
                    rows.append((r.sample_id, True, None))
                except Exception as e:  # noqa: BLE001
                    rows.append((r.sample_id, False, str(e)[:300]))
            yield pd.DataFrame(rows, columns=["sample_id", "copied", "error"])

    named = samples.select("sample_id", "filepath", "asset_sha256", F.concat_ws("/", F.coalesce("assigned_split", F.lit("unassigned")), slug(F.col("source_label"), "unlabeled"), export_name(F.col("sample_id"), F.col("filepath"))).alias("target"))
    return named.mapInPandas(run, "sample_id string, copied boolean, error string")


def _digest(path: str) -> str:
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while chunk := f.read(1 << 20):
            h.update(chunk)
    return h.hexdigest()


def _copy(source: str, target: str, expected: str | None) -> tuple[str, int]:
    """(digest, bytes): copies and hashes in one stream. A source that is empty, changes meanwhile or
    has another digest is an error; a target that exists is left if it is the same, else an error."""
    before = os.stat(source)
    temporary, h, size = f"{target}.{uuid.uuid4().hex}", hashlib.sha256(), 0
    try:
        with open(source, "rb") as f, open(temporary, "xb") as out:
            while chunk := f.read(1 << 20):
                h.update(chunk)
                out.write(chunk)
                size += len(chunk)
        after = os.stat(source)
        if not size:
            raise ValueError("the file is empty")
        if (before.st_size, before.st_mtime_ns) != (after.st_size, after.st_mtime_ns) or size != after.st_size or expected and h.hexdigest() != expected.lower():
            raise ValueError("the file has changed")
        try:
            os.link(temporary, target)  # fails where something exists, so nothing is overwritten
        except FileExistsError:
            if _digest(target) != h.hexdigest():
                raise
        except OSError:
            if os.path.exists(target):
                raise FileExistsError(target) from None
            os.rename(temporary, target)
        return h.hexdigest(), size
    finally:
        if os.path.exists(temporary):
            os.remove(temporary)


def link_or_copy(source: str, target: str) -> str:
    """``linked`` or ``copied``; never overwrites."""
    os.makedirs(os.path.dirname(target), exist_ok=True)
    try:
        os.link(source, target)
        return "linked"
    except FileExistsError:
        raise
    except OSError:
        with open(source, "rb") as f, open(target, "xb") as out:
            shutil.copyfileobj(f, out, 1 << 20)
        return "copied"


def report_html(title: str, tables: dict[str, DataFrame], limit: int = 200) -> str:
    """A page of small aggregate tables (``limit`` rows each are shown; the tables themselves are whole)."""
    parts = [f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>"]
    for name, df in tables.items():
        rows = df.limit(limit).collect()
        head = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns)
        body = "".join("<tr>" + "".join(f"<td>{html.escape(str(v))}</td>" for v in r) + "</tr>" for r in rows)
        parts.append(f"<h2>{html.escape(name)}</h2><table><tr>{head}</tr>{body}</table>")
    return "\n".join(parts)


def dataset_card(name: str, sources: DataFrame) -> str:
    rows = sources.orderBy("source_dataset").collect()  # one row a source
    unknown = [r.source_dataset for r in rows if (r.license or "unknown").strip().lower() == "unknown"]
    lines = [f"# {name}", "", "| source | licence | version |", "| --- | --- | --- |", *(f"| {r.source_dataset} | {r.license or 'unknown'} | {r.version or 'unknown'} |" for r in rows)]
    return "\n".join(lines + ([""] + [f"No known licence: {', '.join(unknown)}."] if unknown else [])) + "\n"


def bundle(folder: str, target: str) -> str:
    """A zip of a published folder with its sha256 beside it; files in a fixed order and of a fixed date."""
    temporary = f"{target}.{uuid.uuid4().hex}"
    with zipfile.ZipFile(temporary, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(Path(folder).rglob("*")):
            if p.is_file():
                info = zipfile.ZipInfo(str(p.relative_to(folder)), (1980, 1, 1, 0, 0, 0))
                info.compress_type = zipfile.ZIP_DEFLATED
                with z.open(info, "w") as out, open(p, "rb") as f:
                    shutil.copyfileobj(f, out, 1 << 20)
    os.replace(temporary, target)
    write_atomic(f"{target}.sha256", f"{_digest(target)}  {os.path.basename(target)}\n")
    return target


def export(samples: DataFrame, boxes: DataFrame | None, target: str, formats: tuple[str, ...] = ("manifest", "coco", "yolo")) -> None:
    """Manifest, checksums and annotation text of kept samples, published in one step."""
    if unknown := set(formats) - {"manifest", "coco", "yolo"}:
        raise ValueError(f"unknown formats {sorted(unknown)}")
    if samples.isEmpty():
        raise ValueError("nothing to export")

    def fill(at: str) -> None:
        m = manifest(samples)
        m.write.option("header", True).csv(f"{at}/manifest.csv")
        m.write.json(f"{at}/manifest.jsonl")
        if "asset_sha256" in samples.columns:
            checksum_lines(samples).write.text(f"{at}/checksums.sha256")
        if boxes is not None:
            classes = class_ids(boxes, "label")
            classes.coalesce(1).write.json(f"{at}/classes")
            if "yolo" in formats:
                yolo_labels(boxes, classes).write.parquet(f"{at}/yolo")
            if "coco" in formats:
                coco_rows(boxes, classes).write.json(f"{at}/coco")
        write_atomic(f"{at}/_SUMMARY.json", json.dumps({"samples": samples.count(), "formats": sorted(formats)}))

    publish(target, fill)


def condition_of(derived: Column, mapped: Column, label: Column, healthy: tuple[str, ...] = ("sano", "healthy")) -> Column:
    """The cascade of the public label list: derived, else mapped, else by the label."""
    return F.coalesce(derived, mapped, F.when(F.lower(label).isin(*healthy), "sano").otherwise("enfermo"))
