"""Exports and releases: manifests, COCO and YOLO trees, class folders, evidence, bundles and their texts.

``target`` is a folder that executors and driver share. Tables are written by Spark; a COCO document is
streamed by one task a split; media are copied and hashed by tasks. Nothing counts before the folder
has taken its place in one step.
"""

from __future__ import annotations

import csv
import json
import os
from collections.abc import Iterator, Sequence
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.geometry import yolo_line
from millrace.functions.text import export_name, slug
from millrace.operators import relational as rel
from millrace.operators.splits import split_groups
from millrace.sinks.export import _copy, bundle, class_ids, link_or_copy, publish, write_atomic
from millrace.storage import stage

SPLITS = ("train", "val", "test")
FORMATS = ("manifest", "classification", "coco", "yolo", "archive", "datumaro")
#: The columns of a release's manifest, with what stands for an unknown value.
MANIFEST = {
    "id": "", "filepath": "", "source_path": "", "source_dataset": "", "source_split": "", "assigned_split": "", "source_label": "", "normalized_label": "",
    "task_type": "unlabeled", "normalized_labels": "", "asset_sha256": "", "size_bytes": "0", "detection_exported": "false", "family_id": "", "split_group_id": "",
    "representative_id": "", "curation_reason": "", "deduplication_version": "", "source_version": "unknown", "source_license": "unknown",
}


def manifest(samples: DataFrame) -> DataFrame:
    """The twenty columns of MANIFEST; ``filepath`` is relative to the export, lists are joined by commas."""
    have = {f.name: f.dataType.typeName() for f in samples.schema.fields}
    own = {"id": F.col("sample_id").cast("string"), "filepath": F.concat(F.lit("images/"), export_name(F.col("sample_id"), F.col("filepath")))}
    if "source_path" not in have:
        own["source_path"] = F.col("filepath")

    def value(c: str, default: str) -> Column:
        if c in own:
            return own[c]
        if c not in have:
            return F.lit(default)
        v = F.array_join(c, ",") if have[c] == "array" else F.col(c).cast("string")
        return F.coalesce(v, F.lit(default))

    return samples.select(*(value(c, d).alias(c) for c, d in MANIFEST.items()))


def keep_boxes(samples: DataFrame, least_blur: float) -> DataFrame:
    """samples with the boxes that are sharp enough (or of unknown blur), and ``detection_exported``:
    false where there are no boxes or where the filter left none."""
    kept = rel.filter_boxes(F.col("boxes"), least_blur)
    out = samples.withColumn("_kept", F.when(F.col("boxes").isNotNull(), kept))
    return out.withColumn("detection_exported", F.col("boxes").isNotNull() & ~F.coalesce(rel.emptied(F.col("boxes"), F.col("_kept")), F.lit(False))).withColumn("boxes", F.col("_kept")).drop("_kept")


def coco_documents(samples: DataFrame, classes: DataFrame) -> DataFrame:
    """(split, part, id, text): the entries of a COCO document for each split: images, annotations and
    categories as JSON. Numbers of images and annotations are consecutive from 1 in the order of ids;
    categories are the same in every split. samples(sample_id, filepath, assigned_split, width, height, boxes)."""
    own = samples.select("sample_id", F.col("assigned_split").alias("split"), export_name(F.col("sample_id"), F.col("filepath")).alias("file_name"), "width", "height", "boxes")
    images = stage(rel.numbered(own, "split", "sample_id", name="image_id"), "images")
    boxes = images.select("split", "image_id", "width", "height", F.posexplode("boxes").alias("at", "b")).select("split", "image_id", "at", F.col("b.label").alias("label"), *(F.round(F.get("b.bounding_box", i) * F.col(s), 3).alias(c) for i, (c, s) in enumerate((("x", "width"), ("y", "height"), ("w", "width"), ("h", "height")))))
    notes = rel.numbered(boxes.join(classes, "label"), "split", "image_id", "at", name="id")
    a = notes.select("split", F.lit("annotations").alias("part"), "id", F.to_json(F.struct("id", "image_id", F.col("class_id").alias("category_id"), F.array("x", "y", "w", "h").alias("bbox"), F.round(F.col("w") * F.col("h"), 3).alias("area"), F.lit(0).alias("iscrowd"))).alias("text"))
    i = images.select("split", F.lit("images").alias("part"), F.col("image_id").alias("id"), F.to_json(F.struct(F.col("image_id").alias("id"), "file_name", "width", "height")).alias("text"))
    c = classes.select(F.explode(F.array(*map(F.lit, SPLITS))).alias("split"), F.lit("categories").alias("part"), F.col("class_id").cast("long").alias("id"), F.to_json(F.struct(F.col("class_id").alias("id"), F.col("label").alias("name"), F.lit(None).cast("string").alias("supercategory"))).alias("text"))
    return i.unionByName(a).unionByName(c.join(images.select("split").distinct(), "split", "left_semi"))


def write_coco(samples: DataFrame, classes: DataFrame, folder: str) -> DataFrame:
    """(split, entries): ``<folder>/<split>/labels.json``, streamed by one task a split."""

    def write(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, at, part, done = None, None, None, []
        order = ("annotations", "categories", "images")

        def close() -> None:
            if out is not None:
                for p in order[order.index(part) + 1 :]:
                    out.write(f'], "{p}": [')
                out.write("]}")
                out.flush()
                os.fsync(out.fileno())
                out.close()
                os.replace(out.name, os.path.join(folder, at, "labels.json"))

        for rows in parts:
            for split, kind, text in zip(rows["split"], rows["part"], rows["text"]):
                if split != at:
                    close()
                    os.makedirs(os.path.join(folder, split), exist_ok=True)
                    out, at, part = open(os.path.join(folder, split, f".labels-{os.getpid()}.json"), "w", encoding="utf-8"), split, None  # noqa: SIM115
                    out.write('{"info": {}, "licenses": [], "annotations": [')
                    part, first = "annotations", True
                    done.append([split, 0])
                while part != kind:
                    part, first = order[order.index(part) + 1], True
                    out.write(f'], "{part}": [')
                out.write(("" if first else ",") + "\n" + text)
                first = False
                done[-1][1] += 1
        close()
        yield pd.DataFrame(done, columns=["split", "entries"])

    rows = coco_documents(samples, classes).repartition(len(SPLITS), "split").sortWithinPartitions("split", "part", "id")
    return rows.select("split", "part", "text").mapInPandas(write, "split string, entries bigint")


def write_yolo(samples: DataFrame, classes: DataFrame, folder: str) -> DataFrame:
    """(split, files): a label file for each sample under ``labels/<split>``, empty without boxes."""
    lines = samples.select("sample_id", F.explode("boxes").alias("b")).select("sample_id", F.col("b.label").alias("label"), F.col("b.bounding_box").alias("box")).join(classes, "label")
    texts = lines.groupBy("sample_id").agg(F.array_join(F.array_sort(F.collect_list(yolo_line(F.col("class_id"), F.col("box")))), "\n").alias("text"))
    rows = samples.select("sample_id", F.col("assigned_split").alias("split")).join(texts, "sample_id", "left")

    def write(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for key, split, text in zip(part["sample_id"], part["split"], part["text"]):
                at = os.path.join(folder, "labels", split)
                os.makedirs(at, exist_ok=True)
                with open(os.path.join(at, f".{key}"), "w") as out:
                    out.write(f"{text}\n" if isinstance(text, str) and text else "")
                os.replace(os.path.join(at, f".{key}"), os.path.join(at, f"{key}.txt"))
            yield part.groupby("split").size().rename("files").reset_index()

    return rows.mapInPandas(write, "split string, files bigint").groupBy("split").agg(F.sum("files").alias("files"))


def yolo_yaml(classes: DataFrame, splits: Sequence[str]) -> str:
    """The portable description of a YOLO tree."""
    names = "".join(f"  {r.class_id}: {json.dumps(r.label, ensure_ascii=False)}\n" for r in classes.orderBy("class_id").toLocalIterator())
    return "names:\n" + names + "".join(f"{s}: ./images/{s}/\n" for s in splits)


MEDIA = "sample_id string, asset_sha256 string, size_bytes bigint, links int, error string"


def copy_media(samples: DataFrame, folder: str, formats: Sequence[str]) -> DataFrame:
    """MEDIA: each file once under ``images``, copied and hashed in one stream, and linked from there
    into the trees of the formats. An error is a row."""
    name = export_name(F.col("sample_id"), F.col("filepath"))
    trees = []
    if "classification" in formats:
        trees.append(F.when(F.array_contains(F.split(F.coalesce("task_type", F.lit("")), ","), "classification"), F.concat_ws("/", F.lit("classification"), "assigned_split", slug(F.coalesce("normalized_label", F.lit("unlabeled")), "unlabeled"), name)))
    if "coco" in formats:
        trees.append(F.when(F.col("detection_exported"), F.concat_ws("/", F.lit("coco"), "assigned_split", F.lit("data"), name)))
    if "yolo" in formats:
        trees.append(F.when(F.col("detection_exported"), F.concat_ws("/", F.lit("yolo/images"), "assigned_split", name)))
    named = samples.select("sample_id", "filepath", F.col("asset_sha256").alias("expected"), name.alias("name"), F.array_compact(F.array(*trees)).alias("links") if trees else F.array().cast("array<string>").alias("links"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(os.path.join(folder, "images"), exist_ok=True)
        for part in parts:
            rows = []
            for r in part.itertuples():
                at = os.path.join(folder, "images", r.name)
                try:
                    digest, size = _copy(r.filepath, at, r.expected)
                    for link in r.links:
                        if not os.path.exists(os.path.join(folder, link)):  # a task that runs again
                            link_or_copy(at, os.path.join(folder, link))
                    rows.append((r.sample_id, digest, size, len(r.links), None))
                except Exception as e:  # noqa: BLE001
                    rows.append((r.sample_id, None, None, 0, f"{type(e).__name__}: {e}"[:300]))
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in MEDIA.split(", ")])

    return named.mapInPandas(run, MEDIA)


def evidence(samples: DataFrame, links: DataFrame) -> DataFrame:
    """(id, text): per sample its links to others, annotations, curation and history as one JSON line."""
    ends = links.select(F.col("left_id").alias("sample_id"), F.struct(F.col("right_id").alias("other_id"), "level", "method", "transform", "rejected").alias("l")).unionByName(links.select(F.col("right_id").alias("sample_id"), F.struct(F.col("left_id").alias("other_id"), "level", "method", "transform", "rejected").alias("l")))
    per = ends.filter("sample_id is not null").groupBy("sample_id").agg(F.array_sort(F.collect_set("l")).alias("links"))
    keep = [c for c in ("source_path", "source_label", "boxes", "status", "phase", "reason", "confidence", "representative_id", "evidence_level", "review_reasons", "history") if c in samples.columns]
    met = samples.select("sample_id", *keep).join(per, "sample_id", "left")
    return met.select(F.col("sample_id").alias("id"), F.to_json(F.struct(F.col("sample_id").alias("id"), F.coalesce("links", F.array().cast(per.schema["links"].dataType)).alias("links"), *keep)).alias("text"))


def run_summary(samples: DataFrame) -> dict:
    """Counts of statuses, phases, sources, labels and splits, and class weights, for one document."""
    count = lambda c, df=samples: {str(r[0]): r[1] for r in df.groupBy(c).count().orderBy(c).collect()} if c in samples.columns else {}
    from millrace.operators.aggregates import class_weights

    kept = samples.filter("lower(status) = 'kept'") if "status" in samples.columns else samples
    weights = {r[0]: r["weight"] for r in class_weights(kept, "normalized_label").collect()} if "normalized_label" in samples.columns else {}
    return {"samples": samples.count(), "statuses": count("status"), "phases": count("phase"), "sources": count("source_dataset"), "splits": count("assigned_split", kept), "labels": count("normalized_label", kept), "class_weights": weights}


def optional_tools(sources: DataFrame) -> dict:
    """Which optional exporters are installed, and the sources they would cover."""
    import importlib.util

    return {"datumaro": importlib.util.find_spec("datumaro") is not None, "sources": sorted(r[0] for r in sources.select("source_dataset").distinct().collect() if r[0])}


def views(samples: DataFrame) -> list[str]:
    """Named views of kept, review and removed samples in the session."""
    names = []
    for status in ("kept", "review", "removed"):
        samples.filter(F.lower("status") == status).createOrReplaceTempView(f"curation_{status}")
        names.append(f"curation_{status}")
    return names


def export(samples: DataFrame, target: str, formats: Sequence[str] = ("manifest", "classification", "coco", "yolo"), links: DataFrame | None = None, least_blur: float = 15.0, balance: DataFrame | None = None) -> dict:
    """Checks, copies and writes the kept samples in the formats and publishes them in one step.

    samples(sample_id, filepath, assigned_split, ... and what MANIFEST names, boxes, width, height, status).
    Refused are unknown or no formats, a folder with content, no kept sample, kept samples without one
    of the three splits, groups in several splits, removed samples whose representative isn't kept,
    media that can't be copied as they were, and formats of which none has anything. ``balance`` are
    synthetic rows of the training split to add. Returns the summary that is written beside the data.
    """
    if not formats or set(formats) - set(FORMATS):
        raise ValueError(f"formats must be some of {FORMATS}")
    kept = samples.filter("lower(status) = 'kept'") if "status" in samples.columns else samples
    if balance is not None:
        kept = kept.unionByName(balance, allowMissingColumns=True)
    if kept.isEmpty():
        raise ValueError("nothing to export")
    bad = kept.filter(~F.coalesce(F.col("assigned_split").isin(*SPLITS), F.lit(False))).count()
    if bad:
        raise ValueError(f"{bad} kept samples have no split")
    if "split_group_id" in kept.columns and not split_groups(kept.withColumnRenamed("assigned_split", "split"), "split_group_id").isEmpty():
        raise ValueError("a group lies in several splits")
    if {"status", "representative_id", "phase"} <= set(samples.columns):
        from millrace.operators.review import audit_representatives

        if not audit_representatives(samples).isEmpty():
            raise ValueError("a removed sample has no kept representative")
    for c, kind in (("task_type", "string"), ("normalized_label", "string"), ("asset_sha256", "string"), ("boxes", "array<struct<label:string,bounding_box:array<double>,blur_variance:double>>")):
        if c not in kept.columns:
            kept = kept.withColumn(c, F.lit(None).cast(kind))
    kept = stage(keep_boxes(kept, least_blur), "kept")
    shown = kept.filter("detection_exported")
    summary = {"skipped": {}, "formats": [], **run_summary(samples)}

    def fill(at: str) -> None:
        media = stage(copy_media(kept, at, formats), "media")
        failed = media.filter("error is not null")
        if not failed.isEmpty():
            raise ValueError(f"{failed.count()} files weren't copied, first: {failed.first().error}")
        whole = stage(kept.drop("asset_sha256", "size_bytes").join(media.select("sample_id", "asset_sha256", "size_bytes"), "sample_id"), "whole")
        rows = manifest(whole)
        rows.write.option("header", True).csv(f"{at}/manifest.csv")
        rows.write.json(f"{at}/manifest.jsonl")
        rows.select(F.format_string("%s  %s", "asset_sha256", "filepath").alias("line")).write.text(f"{at}/checksums.sha256")
        summary["formats"] += ["manifest"] if "manifest" in formats else []
        if links is not None:
            evidence(samples, links).select("text").write.text(f"{at}/duplicate_evidence.jsonl")
        if "archive" in formats:
            whole.write.parquet(f"{at}/archive")
            summary["formats"].append("archive")
        if "classification" in formats:
            if os.path.isdir(f"{at}/classification"):
                summary["formats"].append("classification")
            else:
                summary["skipped"]["classification"] = "no samples of classification"
        some = not shown.isEmpty()
        classes = class_ids(shown.select(F.explode("boxes.label").alias("label")), "label") if some else None
        for f in ("coco", "yolo"):
            if f in formats and not some:
                summary["skipped"][f] = "no samples with boxes"
        if some and "coco" in formats:
            write_coco(shown, classes, f"{at}/coco").collect()
            summary["formats"].append("coco")
        if some and "yolo" in formats:
            files = {r.split: r.files for r in write_yolo(shown, classes, f"{at}/yolo").collect()}
            write_atomic(f"{at}/yolo/dataset.yaml", yolo_yaml(classes, [s for s in SPLITS if s in files]))
            summary["formats"].append("yolo")
        if "datumaro" in formats:
            summary["skipped"]["datumaro"] = "not installed"
        if not summary["formats"]:
            raise ValueError(f"no format has anything: {summary['skipped']}")
        totals = media.agg(F.count("*"), F.sum("size_bytes"), F.sum("links")).first()
        summary["export"] = dict(zip(("images", "image_bytes", "links"), totals))
        summary["export"]["emptied_by_box_filter"] = kept.filter("not detection_exported and boxes is not null").count()
        write_atomic(f"{at}/curation_summary.json", json.dumps(summary, default=str, ensure_ascii=False))

    publish(target, fill)
    return summary


def curation_report(samples: DataFrame, title: str = "Curation", pairs: DataFrame | None = None) -> str:
    """An HTML page: statuses, sources, labels, reasons, class weights, and sources that share duplicates.
    Only aggregates reach the driver."""
    from millrace.operators import aggregates as agg
    from millrace.sinks.export import report_html

    tables = {"Statuses": agg.counts(samples, F.lower("status").alias("status")), "Sources": agg.status_pivot(samples, "source_dataset"), "Share removed": agg.drop_rates(samples, "source_dataset"), "Reasons": agg.top_reasons(samples)}
    if "normalized_label" in samples.columns:
        tables |= {"Labels": agg.label_sources(samples, "normalized_label", "source_dataset"), "Class weights": agg.class_weights(samples.filter("lower(status) = 'kept'"), "normalized_label")}
    if pairs is not None:
        tables["Sources that share duplicates"] = agg.contamination(rel.pair_sources(pairs, samples))
    return report_html(title, tables)


# releases

#: Labels that decide the condition in the public list.
OLIVE, HEALTHY, DAMAGED = ("olivo", "olive_tree", "crown"), ("sano", "sana", "verde", "envero", "negra", "healthy", "nodamage", "intacta"), ("defectuosa", "defects", "bad", "mala", "enfermo", "quemado", "dry", "dañado", "danada", "damaged")
LABEL_COLUMNS = ("filename", "split", "disease", "condition", "task", "source_dataset", "source_url")


def condition_of(derived: Column, mapped: Column, label: Column) -> Column:
    """derived, else mapped, else by the label: olivo, sano, dañado, and enfermo for the rest."""
    return F.coalesce(F.nullif(derived, F.lit("")), mapped, F.when(label.isin(*OLIVE), "olivo").when(label.isin(*HEALTHY), "sano").when(label.isin(*DAMAGED), "dañado").otherwise("enfermo"))


def clean_labels(rows: DataFrame, registry: DataFrame, conditions: DataFrame | None = None, unannotated: DataFrame | None = None) -> DataFrame:
    """LABEL_COLUMNS of a manifest. registry(source_dataset, title, url), conditions(label, condition),
    unannotated(filename): files that go to ``test_unannotated``."""
    name = F.element_at(F.split("filepath", "/"), -1)
    label = F.coalesce(F.nullif(F.col("normalized_label"), F.lit("")), F.lit("objeto"))
    derived = F.col("derived_label") if "derived_label" in rows.columns else F.lit(None).cast("string")
    own = rows.select(name.alias("filename"), F.coalesce(F.nullif(F.col("assigned_split"), F.lit("")), F.lit("train")).alias("split"), F.when(label == "rust_mite", "aculus_olearius").otherwise(label).alias("disease"), derived.alias("_d"), F.coalesce("task_type", F.lit("detection")).alias("task"), F.col("source_dataset").alias("_s"))
    if conditions is not None:
        own = own.join(conditions.select(F.col("label").alias("disease"), F.col("condition").alias("_c")), "disease", "left")
    else:
        own = own.withColumn("_c", F.lit(None).cast("string"))
    own = own.join(registry.select(F.col("source_dataset").alias("_s"), "title", "url"), "_s", "left")
    if unannotated is not None:
        own = own.join(unannotated.select("filename").distinct().withColumn("_u", F.lit(True)), "filename", "left")
    else:
        own = own.withColumn("_u", F.lit(None).cast("boolean"))
    none = F.coalesce("_u", F.lit(False))
    return own.select("filename", F.when(none, "test_unannotated").otherwise(F.col("split")).alias("split"), "disease", condition_of(F.col("_d"), F.col("_c"), F.col("disease")).alias("condition"), F.when(none, "unannotated").otherwise(F.col("task")).alias("task"), F.coalesce("title", "_s").alias("source_dataset"), F.coalesce("url", F.lit("")).alias("source_url"))


def layout_of(rows: DataFrame, has_coco: bool, asked: str = "auto") -> str:
    """detection or classification: as asked, else by which task more samples have."""
    if asked != "auto":
        return asked
    task = F.lower("task_type")
    d, c = rows.agg(F.count_if(F.contains(task, F.lit("detection"))), F.count_if(F.contains(task, F.lit("classification")))).first()
    return "detection" if has_coco and d >= c and d > 0 else "classification"


def release_counts(labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((disease, condition, images), (split, images, percent)) of a public label list."""
    classes = labels.groupBy("disease").agg(F.min("condition").alias("condition"), F.count("*").alias("images"))
    total = labels.agg(F.count("*").alias("n"))
    splits = labels.groupBy("split").agg(F.count("*").alias("images")).crossJoin(total).select("split", "images", F.round(F.col("images") * 100.0 / F.col("n"), 1).alias("percent"))  # one row each
    return classes, splits


def release_readme(name: str, version: str, labels: DataFrame, layout: str, meta: dict | None = None) -> str:
    """The README of a release: what it is, classes and splits with their counts. One row a class."""
    meta = meta or {}
    classes, splits = release_counts(labels)
    rows = classes.orderBy(F.desc("images"), "disease").collect()
    parts = {r.split: r for r in splits.collect()}
    said = ", ".join(f"{s}: {parts[s].images:,} ({parts[s].percent:.1f} %)" for s in (*SPLITS, "test_unannotated") if s in parts)
    lines = [f"# {meta.get('title', name)} {version}", "", meta.get("description", ""), "", f"{sum(r.images for r in rows):,} images. {said}.", "", "| class | scientific name | condition | images |", "| --- | --- | --- | ---: |"]
    lines += [f"| `{r.disease}` | *{(meta.get('scientific_names') or {}).get(r.disease, '-')}* | {r.condition} | {r.images:,} |" for r in rows]
    where = "Boxes are in `dataset/<split>/labels.json` (COCO)." if layout == "detection" else "Images lie in `dataset/<split>/<class>`."
    return "\n".join([*lines, "", where, "", "`annotations/labels.csv` has one row an image, `SOURCES.md` where they come from.", ""])


def sources_text(labels: DataFrame, registry: DataFrame) -> str:
    """Where the images come from, by registered name or title. One row a source."""
    counts = labels.groupBy("source_dataset").agg(F.count("*").alias("images"))
    by_name = registry.join(counts, "source_dataset", "left")
    titled = counts.select(F.col("source_dataset").alias("title"), F.col("images").alias("_t"))
    met = by_name.join(titled, "title", "left").withColumn("images", F.coalesce("images", "_t")).filter("images > 0").orderBy("source_dataset").collect()
    lines = ["# Sources", ""]
    for r in met:
        lines.append(f"## {r.title or r.source_dataset}")
        lines += [f"- {label}: {r[c]}" for c, label in (("url", "repository"), ("license", "licence"), ("authors", "authors"), ("version", "version")) if c in r.asDict() and r[c]]
        lines += [f"- images: {r.images:,}", ""]
    return "\n".join(lines) + "\n"


def catalogue_sheet(name: str, version: str, images: int, archive: str, megabytes: float, meta: dict | None = None) -> str:
    """The fields of an open-data catalogue's form."""
    meta = {"license": "unknown", "language": "es", "tags": [], **(meta or {})}
    rows = {"title": meta.get("title", name), "name": slug_text(f"{name}-{version}"), "version": version, "licence": meta["license"], "language": meta["language"], "tags": ", ".join(meta["tags"]), "images": f"{images:,}", "resource": archive, "size": f"{megabytes:.1f} MB"}
    return "\n".join(["# Catalogue entry", "", "| field | value |", "| --- | --- |", *(f"| {k} | {v} |" for k, v in rows.items())]) + "\n"


def slug_text(text: str) -> str:
    import re

    return re.sub(r"[^a-z0-9]+", "-", text.lower()).strip("-")


def read_manifest(spark, folder: str, fallbacks: Sequence[str] = ()) -> DataFrame:
    """The manifest of an export, else its public label list, else the first of some other files."""
    for at in (f"{folder}/manifest.csv", f"{folder}/annotations/labels.csv", *fallbacks):
        if os.path.exists(at):
            return spark.read.option("header", True).csv(at)
    raise FileNotFoundError(f"no manifest in {folder}")


def matching_report(reports: str, run: str | None = None) -> str | None:
    """The report folder of a run, else the one that changed last."""
    found = [p for p in Path(reports).iterdir() if p.is_dir()] if os.path.isdir(reports) else []
    if run and (mine := [p for p in found if p.name == run or p.name.endswith(run)]):
        return str(max(mine, key=lambda p: p.name))
    return str(max(found, key=lambda p: (p.stat().st_mtime, p.name))) if found else None


def release(spark, exported: str, target: str, name: str, version: str, registry: DataFrame, layout: str = "auto", conditions: DataFrame | None = None, meta: dict | None = None) -> dict:
    """A folder and zip of an export for the public: data in one layout, label list, README, sources, sheet.

    In the detection layout COCO documents keep the images that have annotations; all other images go
    to ``dataset/test_unannotated``. Returns counts, layout and the path of the archive.
    """
    rows = read_manifest(spark, exported)
    chosen = layout_of(rows, os.path.isdir(f"{exported}/coco"), layout)
    result: dict = {"layout": chosen}

    def fill(at: str) -> None:
        unannotated = None
        if chosen == "detection":
            lone = rows.filter("coalesce(detection_exported, 'false') <> 'true'").select("filepath", F.element_at(F.split("filepath", "/"), -1).alias("filename"))
            seen = rows.filter("detection_exported = 'true'").select("filepath", F.concat_ws("/", F.lit("dataset"), "assigned_split", F.lit("images"), F.element_at(F.split("filepath", "/"), -1)).alias("to"))
            moved = seen.unionByName(lone.select("filepath", F.concat(F.lit("dataset/test_unannotated/images/"), "filename").alias("to")))
            unannotated = lone.select("filename")
            for s in SPLITS:
                if os.path.exists(f"{exported}/coco/{s}/labels.json"):
                    link_or_copy(f"{exported}/coco/{s}/labels.json", f"{at}/dataset/{s}/labels.json")
        else:
            moved = rows.select("filepath", F.concat_ws("/", F.lit("dataset"), "assigned_split", slug(F.col("normalized_label"), "unlabeled"), F.element_at(F.split("filepath", "/"), -1)).alias("to"))
        result["linked"] = _link(moved, exported, at).agg(F.count("*")).first()[0]
        labels = stage(clean_labels(rows, registry, conditions, unannotated), "labels")
        os.makedirs(f"{at}/annotations", exist_ok=True)
        with open(f"{at}/annotations/labels.csv", "w", newline="", encoding="utf-8") as out:
            w = csv.writer(out)
            w.writerow(LABEL_COLUMNS)
            for r in labels.orderBy("filename").toLocalIterator():
                w.writerow(r)
        result["images"] = labels.count()
        write_atomic(f"{at}/README.md", release_readme(name, version, labels, chosen, meta))
        write_atomic(f"{at}/SOURCES.md", sources_text(labels, registry))

    publish(target, fill)
    result["archive"] = bundle(target, f"{target.rstrip('/')}.zip")
    size = os.path.getsize(result["archive"]) / 1e6
    write_atomic(f"{target.rstrip('/')}-catalogue.md", catalogue_sheet(name, version, result["images"], os.path.basename(result["archive"]), size, meta))
    return result


def _link(moved: DataFrame, source: str, target: str) -> DataFrame:
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for a, b in zip(part["filepath"], part["to"]):
                if not os.path.exists(os.path.join(target, b)):
                    link_or_copy(os.path.join(source, a), os.path.join(target, b))
            yield part[["to"]]

    return stage(moved.mapInPandas(run, "to string"), "linked")


def example_gallery(samples: DataFrame, group: str, folder: str, n: int = 24) -> DataFrame:
    """(group, sample_id): copies the first ``n`` files of each group, by id, into a folder of its own."""
    from millrace.operators.ranking import first_of_each

    own = first_of_each(samples.filter(F.col(group).isNotNull()).select(group, "sample_id", "filepath").distinct(), group, n, "sample_id")
    moved = own.select(F.col(group).alias("g"), "sample_id", "filepath", F.concat_ws("/", slug(F.col(group), "other"), export_name(F.col("sample_id"), F.col("filepath"))).alias("to"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            done = []
            for r in part.itertuples():
                at = os.path.join(folder, r.to)
                os.makedirs(os.path.dirname(at), exist_ok=True)
                try:
                    _copy(r.filepath, at, None)
                    done.append((r.g, r.sample_id))
                except (OSError, ValueError):
                    pass  # an example that can't be read isn't shown
            yield pd.DataFrame(done, columns=["g", "sample_id"])

    return moved.mapInPandas(run, "g string, sample_id string").withColumnRenamed("g", group)


__all__ = ["clean_labels", "coco_documents", "copy_media", "evidence", "example_gallery", "export", "keep_boxes", "layout_of", "manifest", "matching_report", "optional_tools", "read_manifest", "release", "release_counts", "run_summary", "views", "write_coco", "write_yolo"]
