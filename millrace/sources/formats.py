"""Readers of COCO, YOLO, VOC and class-folder datasets into one sample schema, with their audits.

Everything that grows with the data (annotations, label files, picture lists) is read by Spark; the
driver only looks at folder names and at the small YAML and manifest files.
"""

from __future__ import annotations

import json
import os
import shutil
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import label_of_path, natural_key, split_of_path

PICTURES = ("jpg", "jpeg", "png", "bmp", "webp", "tif", "tiff")
BOX = "struct<label:string,source_label:string,bounding_box:array<double>,blur_variance:double>"
SAMPLE = f"sample_id string, filepath string, source_dataset string, source_split string, source_label string, width int, height int, boxes array<{BOX}>"
_COLUMNS = [x.strip().split(" ")[0] for x in ("sample_id", "filepath", "source_dataset", "source_split", "source_label", "width", "height", "boxes")]

COCO = T.StructType(
    [
        T.StructField("images", T.ArrayType(T.StructType([T.StructField("id", T.LongType()), T.StructField("file_name", T.StringType()), T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())]))),
        T.StructField("annotations", T.ArrayType(T.StructType([T.StructField("id", T.LongType()), T.StructField("image_id", T.LongType()), T.StructField("category_id", T.LongType()), T.StructField("bbox", T.ArrayType(T.DoubleType()))]))),
        T.StructField("categories", T.ArrayType(T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())]))),
    ]
)


def sample_key(source: str, path: str):
    return F.substring(F.sha2(F.concat_ws("|", F.lit(source) if isinstance(source, str) and not source.startswith("@") else F.col(source[1:]), F.col(path)), 256), 1, 24)


def files_below(folder: str, *suffixes: str) -> list[str]:
    return sorted(str(p) for p in Path(folder).rglob("*") if p.is_file() and p.suffix.lower().lstrip(".") in suffixes)


#: Parts of the names of COCO files, and how deep a source is looked through for its format.
COCO_HINTS, DEPTH, PICTURE_DEPTH = ("coco", "annotation", "instances"), 3, 5
SPLIT_FOLDERS = ("train", "val", "valid", "validation", "test")


def first_file(folder: str, fits: Callable[[str], bool], depth: int = DEPTH) -> str | None:
    """The first fitting file at the least depth, in the order of names, at most ``depth`` folders down."""
    level = [folder]
    for _ in range(depth + 1):
        below = []
        for at in level:
            entries = sorted(os.scandir(at), key=lambda e: e.name)
            for e in entries:
                if e.is_file() and fits(e.name):
                    return e.path
            below += [e.path for e in entries if e.is_dir(follow_symlinks=False)]
        level = below
    return None


def _is_coco(name: str) -> bool:
    return name.lower().endswith(".json") and any(h in name.lower() for h in COCO_HINTS)


def _is_picture(name: str) -> bool:
    return name.lower().rsplit(".", 1)[-1] in PICTURES


def sniff(folder: str) -> str:
    """coco, yolo, voc, tree or unknown, by the files of the first folders; the first match counts."""
    if first_file(folder, _is_coco):
        return "coco"
    if first_file(folder, lambda n: n in ("data.yaml", "dataset.yaml")):
        return "yolo"
    if first_file(folder, lambda n: n.lower().endswith(".xml")):
        return "voc"
    return "tree" if first_file(folder, _is_picture, PICTURE_DEPTH) else "unknown"


def discover(raw: str) -> list[dict]:
    """One entry for each source folder: name, path, format, its split folders, and the field that holds labels."""
    out = []
    for p in sorted(Path(raw).iterdir()):
        if not p.is_dir() or p.name.startswith((".", "_")):
            continue
        kind = sniff(str(p))
        near = [q.name.lower() for q in [*p.iterdir(), *(r for q in p.iterdir() if q.is_dir() for r in q.iterdir())] if q.is_dir()]
        out.append({"name": p.name, "path": str(p), "format": kind, "splits": [s for s in SPLIT_FOLDERS if s in near], "label_field": "source_label" if kind == "tree" else "boxes"})
    return out


def coco_files(folder: str) -> list[str]:
    """The COCO file of each folder that has one; several in one folder are an error."""
    found: dict[str, list[str]] = {}
    for p in files_below(folder, "json"):
        if _is_coco(os.path.basename(p)):
            found.setdefault(os.path.dirname(p), []).append(p)
    if several := {k: v for k, v in found.items() if len(v) > 1}:
        raise ValueError(f"several COCO files in one folder: {several}")
    if not found:
        raise ValueError(f"no COCO file in {folder}")
    return sorted(v[0] for v in found.values())


def sample_scan(folder: str, files: int = 200, megabytes: int = 256) -> dict:
    """Reads the first pictures, up to a number and a size: files, bytes, MiB a second and how many
    don't begin like a picture. A probe of a source's disk, not of its content."""
    import time

    heads = (b"\x89PNG", b"\xff\xd8\xff", b"BM", b"RIFF", b"II*\0", b"MM\0*")
    n = size = broken = 0
    began = time.perf_counter()
    for root, folders, names in os.walk(folder):
        folders.sort()
        for name in sorted(names):
            if not _is_picture(name):
                continue
            if n >= files or size >= megabytes << 20:
                break
            with open(os.path.join(root, name), "rb") as f:
                data = f.read()
            n, size, broken = n + 1, size + len(data), broken + (not data.startswith(heads))
    seconds = max(time.perf_counter() - began, 1e-9)
    return {"files": n, "bytes": size, "mib_per_second": round(size / (1 << 20) / seconds, 3), "broken": broken}


def promote(built: str, target: str) -> None:
    """``built`` takes the place of ``target``; what was there is kept until it has, and comes back if it can't."""
    old = f"{target}.old"
    if os.path.exists(old):
        raise FileExistsError(f"{old} is left from an attempt that didn't end")
    had = os.path.exists(target)
    if had:
        os.rename(target, old)
    try:
        os.rename(built, target)
    except BaseException:
        if had:
            os.rename(old, target)
        raise
    if had:
        shutil.rmtree(old)


def pictures(spark: SparkSession, folder: str) -> DataFrame:
    """(path, size_bytes, modified_at) of the pictures below a folder: metadata only, no bytes."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    rx = r"(?i)\.(" + "|".join(PICTURES) + ")$"
    return df.select(F.regexp_replace("path", "^file:", "").alias("path"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at")).filter(F.col("path").rlike(rx))


def decoded(spark: SparkSession, folder: str) -> DataFrame:
    """(path, height, width, channels, data, digest) of the pictures; an unreadable one has height -1."""
    image = spark.read.format("image").option("recursiveFileLookup", "true").load(folder).select("image.*")
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", F.sha2("content", 256).alias("digest"))
    clean = F.regexp_replace(F.col("path"), "^file:/*", "/")
    return image.select(F.regexp_replace("origin", "^file:/*", "/").alias("path"), "height", "width", F.col("nChannels").alias("channels"), "data").join(raw.select(clean.alias("path"), "digest"), "path", "left")


def _coco_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc, images, annotations, categories). The usual name begins with an underscore, which Spark's
    file sources hide, so tasks read the files themselves; one file is one row."""

    def load(parts):
        for part in parts:
            texts = []
            for p in part["doc"]:
                with open(p, encoding="utf-8") as f:
                    texts.append(f.read())
            yield part.assign(text=texts)

    files = coco_files(folder)
    paths = spark.createDataFrame([(p,) for p in files], "doc string").repartition(max(1, min(len(files), 200)))
    return paths.mapInPandas(load, "doc string, text string").select("doc", F.from_json("text", COCO).alias("c")).select("doc", "c.*")


def read_coco(spark: SparkSession, folder: str, source: str, strict: bool = False) -> DataFrame:
    """Pictures with their boxes. Pictures outside the folder or missing on disk, and annotations
    without a picture, are left out; with ``strict`` they are an error."""
    doc = _coco_documents(spark, folder)
    images = doc.select("doc", F.explode("images").alias("i")).select("doc", "i.*")
    safe = ~F.col("file_name").rlike(r"(^/)|(^|/)\.\.(/|$)") & F.col("file_name").isNotNull()
    notes = doc.select("doc", F.explode("annotations").alias("a")).select("doc", "a.*").withColumnRenamed("id", "annotation_id")
    names = doc.select("doc", F.explode("categories").alias("c")).select("doc", F.col("c.id").alias("category_id"), F.col("c.name").alias("label"))
    base = F.regexp_replace("doc", r"^file:/*", "/")
    images = images.withColumn("filepath", F.concat(F.regexp_replace(base, r"[^/]+$", ""), "file_name"))
    there = pictures(spark, folder).select(F.col("path").alias("filepath"))
    if strict:
        bad = images.filter(~safe).count() + images.filter(safe).join(there, "filepath", "left_anti").count() + notes.join(images.select("doc", F.col("id").alias("image_id")), ["doc", "image_id"], "left_anti").count()
        if bad:
            raise ValueError(f"{bad} references of {source} lead nowhere")
    images = images.filter(safe).join(there, "filepath", "left_semi")
    box = lambda i, side: F.get("bbox", i) / F.col(side)
    placed = notes.join(names, ["doc", "category_id"], "left").join(images.select("doc", F.col("id").alias("image_id"), "width", "height"), ["doc", "image_id"])
    boxes = placed.groupBy("doc", "image_id").agg(F.collect_list(F.struct(F.col("label"), F.col("label").alias("source_label"), F.array(box(0, "width"), box(1, "height"), box(2, "width"), box(3, "height")).alias("bounding_box"), F.lit(None).cast("double").alias("blur_variance"))).alias("boxes"))
    return _sample(images.withColumnRenamed("id", "image_id").join(boxes, ["doc", "image_id"], "left"), source)


def _sample(df: DataFrame, source: str) -> DataFrame:
    have = set(df.columns)
    out = df.withColumn("source_dataset", F.lit(source)).withColumn("sample_id", sample_key(source, "filepath"))
    out = out.withColumn("source_split", F.coalesce(F.nullif(split_of_path(F.col("filepath")), F.lit("")), F.lit("unspecified")))
    for name, kind in (("source_label", "string"), ("width", "int"), ("height", "int"), ("boxes", f"array<{BOX}>")):
        if name not in have:
            out = out.withColumn(name, F.lit(None).cast(kind))
    return out.select(*_COLUMNS)


def yolo_names(folder: str) -> list[str]:
    import yaml

    for name in ("data.yaml", "dataset.yaml"):
        at = os.path.join(folder, name)
        if os.path.exists(at):
            with open(at) as f:
                names = (yaml.safe_load(f) or {}).get("names") or []
            return [names[k] for k in sorted(names)] if isinstance(names, dict) else list(names)
    raise FileNotFoundError(f"no data.yaml in {folder}")


def yolo_description(folder: str) -> dict:
    """The YAML of a source; an error if it isn't one."""
    import yaml

    for name in ("data.yaml", "dataset.yaml"):
        at = os.path.join(folder, name)
        if os.path.exists(at):
            with open(at) as f:
                found = yaml.safe_load(f)
            if not isinstance(found, dict):
                raise ValueError(f"{at} is no description")
            return found
    raise FileNotFoundError(f"no data.yaml in {folder}")


def yolo_splits(folder: str) -> dict[str, str]:
    """The folder of each split that the description names, relative to the source.

    Descriptions often hold paths of the machine they were made on. Tried are the path as it is, the
    path without its steps upwards, the split's usual folders, and the path's last part.
    """
    found = yolo_description(folder)
    out = {}
    for split in ("train", "val", "test"):
        said = found.get(split)
        if not isinstance(said, str):
            continue
        parts = [p for p in said.replace("\\", "/").split("/") if p not in ("", ".", "..")]
        tries = [] if said.startswith("/") else [said, "/".join(parts)]
        for name in (split, "valid", "validation") if split == "val" else (split,):
            tries += [name, f"{name}/images", f"images/{name}"]
        tries += [f"images/{parts[-1]}", parts[-1]] if parts else []
        root = os.path.realpath(folder)
        inside = [os.path.realpath(os.path.join(folder, t)) for t in tries]
        at = next((p for p in inside if os.path.exists(p) and (p + "/").startswith(root + "/")), None)
        if at is None:
            raise ValueError(f"{split}: {said} leads nowhere in {folder}")
        out[split] = os.path.relpath(at, root)
    if not out:
        raise ValueError(f"the description in {folder} names no split")
    return out


def read_yolo(spark: SparkSession, folder: str, source: str, strict: bool = False) -> DataFrame:
    """Label lines joined to their pictures by split and stem; malformed lines are left out. With
    ``strict`` a split that leads nowhere is an error."""
    if strict:
        yolo_splits(folder)
    names = spark.createDataFrame([(i, str(n)) for i, n in enumerate(yolo_names(folder))] or [(-1, "")], "cls int, label string")
    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").text(folder).withColumn("doc", F.input_file_name())
    part = F.split(F.trim("value"), r"\s+")
    lines = text.filter(F.size(part) == 5).select("doc", *(F.expr(f"try_cast(split(trim(value), '\\\\s+')[{i}] as double)").alias(c) for i, c in enumerate(("cls", "xc", "yc", "w", "h")))).filter("cls is not null and xc is not null and yc is not null and w is not null and h is not null")
    boxes = lines.withColumn("cls", F.col("cls").cast("int")).join(names, "cls").groupBy("doc").agg(F.collect_list(F.struct(F.col("label"), F.col("label").alias("source_label"), F.array(F.col("xc") - F.col("w") / 2, F.col("yc") - F.col("h") / 2, "w", "h").alias("bounding_box"), F.lit(None).cast("double").alias("blur_variance"))).alias("boxes"))
    key = lambda c: F.concat_ws("|", split_of_path(F.col(c)), natural_key(F.col(c)))
    photos = pictures(spark, folder).select(F.col("path").alias("filepath")).withColumn("k", key("filepath"))
    return _sample(photos.join(boxes.withColumn("k", key("doc")).drop("doc"), "k", "left"), source)


VOC = "filename string, size struct<width:int,height:int,depth:int>, object array<struct<name:string,bndbox:struct<xmin:double,ymin:double,xmax:double,ymax:double>>>"


def read_voc(spark: SparkSession, folder: str, source: str, strict: bool = False) -> DataFrame:
    """XML annotations joined to pictures by a key that forgives blanks and copy marks."""
    doc = spark.read.format("xml").option("rowTag", "annotation").schema(VOC).load(files_below(folder, "xml"))
    w, h = F.col("size.width"), F.col("size.height")
    boxes = F.transform(
        "object",
        lambda o: F.struct(o["name"].alias("label"), o["name"].alias("source_label"), F.array(o["bndbox"]["xmin"] / w, o["bndbox"]["ymin"] / h, (o["bndbox"]["xmax"] - o["bndbox"]["xmin"]) / w, (o["bndbox"]["ymax"] - o["bndbox"]["ymin"]) / h).alias("bounding_box"), F.lit(None).cast("double").alias("blur_variance")),
    )
    notes = doc.select(natural_key(F.col("filename")).alias("k"), w.alias("width"), h.alias("height"), boxes.alias("boxes")).dropDuplicates(["k"])
    photos = pictures(spark, folder).select(F.col("path").alias("filepath")).withColumn("k", natural_key(F.col("filepath")))
    if strict and (lost := notes.join(photos, "k", "left_anti").count()):
        raise ValueError(f"{lost} annotations of {source} have no picture")
    return _sample(photos.join(notes, "k"), source)


def read_tree(spark: SparkSession, folder: str, source: str, strict: bool = False) -> DataFrame:
    """Pictures whose folder is their label."""
    photos = pictures(spark, folder).select(F.col("path").alias("filepath"))
    inner = F.regexp_replace("filepath", "^" + folder.rstrip("/") + "/", f"{source}/")
    return _sample(photos.withColumn("source_label", label_of_path(inner)), source)


READERS = {"coco": read_coco, "yolo": read_yolo, "voc": read_voc, "tree": read_tree}


def ingest(spark: SparkSession, raw: str, strict: bool = False, report_path: str | None = None) -> tuple[DataFrame, list[dict]]:
    """All sources below a folder as one table, and a report of what became of each, which is also
    written to ``report_path``. With ``strict`` the first fault of a source ends the ingest."""
    out, report = None, []
    for entry in discover(raw):
        reader = READERS.get(entry["format"])
        try:
            if reader is None:
                raise ValueError("unsupported source")
            part = reader(spark, entry["path"], entry["name"], strict)
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
            report.append(entry | {"status": "ok", "samples": part.count(), "error": None})
        except Exception as e:  # noqa: BLE001
            report.append(entry | {"status": "failed", "samples": 0, "error": str(e)[:500]})
            if strict:
                _report(report, report_path)
                raise
    _report(report, report_path)
    return (out if out is not None else spark.createDataFrame([], SAMPLE)), report


def _report(report: list[dict], path: str | None) -> None:
    from millrace.sinks.export import write_atomic

    if path:
        write_atomic(path, json.dumps({"sources": report, "samples": sum(r["samples"] for r in report)}))


def source_manifest(folder: str) -> dict:
    """The provenance of a source (source.yaml, .yml or .json); unknown keys are an error, missing
    ones are ``unknown``."""
    known = ("name", "version", "license", "url", "citation", "sensor", "geography", "acquired_at", "tasks")
    for name in ("source.yaml", "source.yml", "source.json"):
        at = os.path.join(folder, name)
        if os.path.exists(at):
            with open(at) as f:
                text = f.read()
            if name.endswith("json"):
                found = json.loads(text)
            else:
                import yaml

                found = yaml.safe_load(text) or {}
            if extra := set(found) - set(known):
                raise ValueError(f"{at} has unknown keys {sorted(extra)}")
            return {k: found.get(k, "unknown") for k in known}
    return dict.fromkeys(known, "unknown")


ISSUES = "code string, severity string, item string"


def audit_raw(spark: SparkSession, raw: str) -> DataFrame:
    """(source, code, severity, item) of all sources below a folder, and of pictures of equal bytes that
    have different labels. A folder that isn't there is one issue."""
    schema = f"source string, {ISSUES}"
    if not os.path.isdir(raw):
        return spark.createDataFrame([("", "missing_raw_dir", "error", raw)], schema)
    out, samples = spark.createDataFrame([], schema), None
    for entry in discover(raw):
        out = out.unionByName(audit(spark, entry["path"], entry["format"]).withColumn("source", F.lit(entry["name"])))
        if entry["format"] in READERS:
            try:
                part = READERS[entry["format"]](spark, entry["path"], entry["name"])
                part.schema  # an unreadable description ends here, and is an issue above
                samples = part if samples is None else samples.unionByName(part)
            except (ValueError, OSError):
                pass
    if samples is not None:
        labels = F.array_sort(F.array_distinct(F.filter(F.concat(F.array("source_label"), F.coalesce(F.transform("boxes", lambda b: b["label"]), F.array().cast("array<string>"))), lambda x: x.isNotNull())))
        raws = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(raw).select(F.regexp_replace("path", "^file:/*", "/").alias("filepath"), F.sha2("content", 256).alias("digest"))
        known = samples.select("filepath", F.array_join(labels, "|").alias("labels")).join(raws, "filepath")
        torn = known.groupBy("digest").agg(F.count_distinct("labels").alias("n"), F.min("filepath").alias("item")).filter("n > 1")
        out = out.unionByName(torn.select(F.lit("").alias("source"), F.lit("conflicting_duplicate_labels").alias("code"), F.lit("error").alias("severity"), "item"))
    return out


def audit_counts(issues: DataFrame, samples: DataFrame) -> DataFrame:
    """One row: sources, images and boxes of the samples, errors and warnings of the issues."""
    s = samples.agg(F.count_distinct("source_dataset").alias("sources"), F.count("*").alias("images"), F.coalesce(F.sum(F.coalesce(F.size("boxes"), F.lit(0))), F.lit(0)).alias("boxes"))
    return s.crossJoin(issues.agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings")))  # one row each


def _one_issue(spark: SparkSession, code: str, item: str) -> DataFrame:
    return spark.createDataFrame([(code, "error", item)], ISSUES)


def _unreadable(spark: SparkSession, folder: str) -> DataFrame:
    """Pictures that can't be decoded."""
    image = spark.read.format("image").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{" + ",".join([*PICTURES, *(p.upper() for p in PICTURES)]) + "}").load(folder)
    return _issue(image.filter("image.height <= 0"), "corrupt_image", F.col("image.origin"))


def audit(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """(code, severity, item) of structural faults, without changing anything."""
    if kind == "yolo":
        try:
            found = yolo_description(folder)
        except FileNotFoundError:
            return _one_issue(spark, "invalid_yolo_yaml", folder)
        except ValueError:
            return _one_issue(spark, "invalid_yolo_schema", folder)
        except Exception:  # noqa: BLE001 - whatever the YAML reader raises
            return _one_issue(spark, "invalid_yolo_yaml", folder)
        if not found.get("names"):
            return _one_issue(spark, "missing_yolo_names", folder)
    out = _audit(spark, folder, kind)
    if kind == "yolo":
        try:
            yolo_splits(folder)
        except ValueError as e:
            out = out.unionByName(_one_issue(spark, "missing_yolo_split", str(e)))
    return out.unionByName(_unreadable(spark, folder)) if kind in READERS else out


def _audit(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    rows = []
    if kind == "coco":
        try:
            doc = _coco_documents(spark, folder)
        except ValueError as e:
            return _one_issue(spark, "invalid_coco_schema", str(e))
        images = doc.select("doc", F.explode("images").alias("i")).select("doc", "i.*")
        notes = doc.select("doc", F.explode("annotations").alias("a")).select("doc", "a.*")
        nothing = F.col("images").isNull() & F.col("annotations").isNull() & F.col("categories").isNull()
        names = doc.select("doc", F.explode("categories").alias("c")).select("doc", F.col("c.id").alias("category_id"))
        sized = notes.join(images.select("doc", F.col("id").alias("image_id"), "width", "height"), ["doc", "image_id"])
        b = [F.get("bbox", i) for i in range(4)]
        wrong = (F.coalesce(F.size("bbox"), F.lit(0)) != 4) | ~F.coalesce((b[0] >= 0) & (b[1] >= 0) & (b[2] > 0) & (b[3] > 0), F.lit(False))
        photos = pictures(spark, folder).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name")).distinct()
        rows = [
            _issue(doc.filter(nothing), "invalid_coco_json", F.col("doc")),
            _issue(doc.filter(~nothing & (F.col("images").isNull() | F.col("annotations").isNull() | F.col("categories").isNull())), "invalid_coco_schema", F.col("doc")),
            _issue(notes.filter("id is null or image_id is null or category_id is null"), "invalid_coco_annotation", F.col("id")),
            _issue(images.filter("file_name is null"), "missing_file_name", F.col("id")),
            _issue(images.filter(F.col("file_name").rlike(r"(^/)|(^|/)\.\.(/|$)")), "external_media_path", F.col("file_name")),
            _issue(images.withColumn("name", F.regexp_extract("file_name", r"([^/]+)$", 1)).join(photos, "name", "left_anti"), "missing_image", F.col("file_name")),
            _issue(notes.join(images.select("doc", F.col("id").alias("image_id")), ["doc", "image_id"], "left_anti"), "orphan_annotation", F.col("id")),
            _issue(notes.join(names, ["doc", "category_id"], "left_anti"), "unknown_category", F.col("id")),
            _issue(sized.filter(wrong), "invalid_bbox", F.col("id")),
            _issue(sized.filter(~wrong & ((b[0] + b[2] > F.col("width")) | (b[1] + b[3] > F.col("height")))), "bbox_out_of_bounds", F.col("id")),
        ]
    elif kind == "yolo":
        n = len(yolo_names(folder))
        text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").text(folder).withColumn("doc", F.input_file_name()).filter(F.trim("value") != "")
        v = [F.expr(f"try_cast(get(split(trim(value), '\\\\s+'), {i}) as double)") for i in range(5)]
        bad = (F.size(F.split(F.trim("value"), r"\s+")) != 5) | v[0].isNull() | v[1].isNull() | v[2].isNull() | v[3].isNull() | v[4].isNull()
        inside = (v[1] - v[3] / 2 >= -1e-9) & (v[1] + v[3] / 2 <= 1 + 1e-9) & (v[2] - v[4] / 2 >= -1e-9) & (v[2] + v[4] / 2 <= 1 + 1e-9)
        photos = pictures(spark, folder).select(natural_key(F.col("path")).alias("k"), "path")
        rows = [
            _issue(text.filter(bad), "invalid_yolo_row", F.col("doc")),
            _issue(text.filter(~bad & ((v[0] < 0) | (v[0] >= n))), "unknown_yolo_class", F.col("doc")),
            _issue(text.filter(~bad & ~inside), "bbox_out_of_bounds", F.col("doc")),
            _issue(photos.join(text.select(natural_key(F.col("doc")).alias("k")).distinct(), "k", "left_anti"), "missing_yolo_label", F.col("path"), "warning"),
        ]
    elif kind == "voc":
        raw = spark.read.text(files_below(folder, "xml"), wholetext=True).select(F.input_file_name().alias("doc"), "value")
        doc = spark.read.format("xml").option("rowTag", "annotation").schema(VOC).load(files_below(folder, "xml"))
        photos = pictures(spark, folder).select(natural_key(F.col("path")).alias("k")).distinct()
        objects = doc.select("filename", "size", F.explode_outer("object").alias("o"))
        x = F.col("o.bndbox")
        rows = [
            _issue(raw.filter(~F.col("value").rlike(r"(?s)<annotation[\s>].*</annotation>\s*$")), "invalid_voc_xml", F.col("doc")),
            _issue(doc.filter("filename is null"), "missing_file_name", F.lit("")),
            _issue(doc.withColumn("k", natural_key(F.col("filename"))).join(photos, "k", "left_anti"), "missing_image", F.col("filename")),
            _issue(objects.filter(F.col("o").isNotNull() & (F.coalesce(F.trim("o.name"), F.lit("")) == "")), "missing_voc_label", F.col("filename")),
            _issue(objects.filter((x["xmin"] < 0) | (x["ymin"] < 0) | (x["xmax"] > F.col("size.width")) | (x["ymax"] > F.col("size.height"))), "bbox_out_of_bounds", F.col("filename")),
        ]
    if not rows:
        return spark.createDataFrame([("unsupported_source", "warning", folder)] if kind == "unknown" else [], "code string, severity string, item string")
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def _issue(df: DataFrame, code: str, item, severity: str = "error") -> DataFrame:
    return df.select(F.lit(code).alias("code"), F.lit(severity).alias("severity"), item.cast("string").alias("item"))
