"""Exports and releases of a small annotated collection, read back from the files."""

from __future__ import annotations

import csv
import json
import os
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import relational as rel
from millrace.sinks import export, release
from millrace.sources import fixtures

BOX = "array<struct<label:string,bounding_box:array<double>,blur_variance:double>>"
SAMPLE = f"sample_id string, filepath string, source_dataset string, source_label string, normalized_label string, task_type string, assigned_split string, split_group_id string, width int, height int, status string, phase string, representative_id string, normalized_labels array<string>, boxes {BOX}"


@pytest.fixture
def samples(spark, tmp_path):
    rng, rows = np.random.default_rng(1), []
    (tmp_path / "raw").mkdir()
    for i in range(12):
        at = tmp_path / "raw" / f"p{i}.PNG"
        at.write_bytes(fixtures.png(rng.integers(0, 255, (40, 50, 3)).astype(np.uint8)))
        boxes = [("x", [0.1, 0.2, 0.3, 0.4], None), ("y", [0.5, 0.5, 0.2, 0.2], 10.0 if i == 1 else 200.0)] if i < 6 else ([("x", [0.0, 0.0, 0.5, 0.5], 1.0)] if i == 6 else None)
        rows.append((f"s{i:02d}", str(at), "src", "Raw", ["x", "y"][i % 2], "classification,detection" if i < 7 else "classification", release.SPLITS[i % 3], f"g{i}", 50, 40, "kept" if i < 11 else "removed", "quality", "", ["x", "y"], boxes))
    return spark.createDataFrame(rows, SAMPLE)


def test_export_in_all_formats(spark, samples, tmp_path):
    links = spark.createDataFrame([("s00", "s01", "exact_bytes", "m", "r0", False), ("s00", None, "e", "m", "r0", None)], "left_id string, right_id string, level string, method string, transform string, rejected boolean")
    out = str(tmp_path / "out")
    summary = release.export(samples, out, links=links)
    assert summary["export"] == {"images": 11, "image_bytes": sum(os.path.getsize(r.filepath) for r in samples.filter("status = 'kept'").collect()), "links": 11 + 6 + 6, "emptied_by_box_filter": 1}
    assert sorted(summary["formats"]) == ["classification", "coco", "manifest", "yolo"]
    rows = release.read_manifest(spark, out)
    assert rows.columns == list(release.MANIFEST) and rows.count() == 11
    first = rows.filter("id = 's01'").first()
    assert first.filepath == "images/s01.png" and first.normalized_labels == "x,y" and first.detection_exported == "true" and first.source_license == "unknown"
    sums = {line.split("  ")[1]: line.split("  ")[0] for line in (r.value for r in spark.read.text(f"{out}/checksums.sha256").collect())}
    assert sums["images/s01.png"] == first.asset_sha256 == export._digest(f"{out}/images/s01.png")
    assert os.path.exists(f"{out}/classification/val/y/s01.png") and len(list(os.scandir(f"{out}/images"))) == 11
    doc = json.load(open(f"{out}/coco/val/labels.json"))
    assert [i["file_name"] for i in doc["images"]] == ["s01.png", "s04.png"] and [c["name"] for c in doc["categories"]] == ["x", "y"]
    ids = [i["id"] for s in release.SPLITS for i in json.load(open(f"{out}/coco/{s}/labels.json"))["images"]]
    assert sorted(ids) == list(range(1, 7))
    of = {i["id"]: i["file_name"] for i in doc["images"]}
    assert [a["bbox"] for a in doc["annotations"] if of[a["image_id"]] == "s01.png"] == [[5.0, 8.0, 15.0, 16.0]]  # the blurred box is gone
    assert open(f"{out}/yolo/labels/val/s01.txt").read() == "0 0.250000 0.400000 0.300000 0.400000\n"
    assert "0: \"x\"" in open(f"{out}/yolo/dataset.yaml").read() and os.path.exists(f"{out}/yolo/images/val/s01.png")
    said = [json.loads(r.value) for r in spark.read.text(f"{out}/duplicate_evidence.jsonl").collect()]
    assert len(said) == 12 and next(x for x in said if x["id"] == "s01")["links"][0]["other_id"] == "s00"
    with pytest.raises(FileExistsError):
        release.export(samples, out)


@pytest.mark.parametrize("change, formats", [
    (lambda s: s.withColumn("status", F.lit("removed")), ("manifest",)),
    (lambda s: s.withColumn("assigned_split", F.lit("x")), ("manifest",)),
    (lambda s: s.withColumn("split_group_id", F.lit("one")), ("manifest",)),
    (lambda s: s.withColumn("asset_sha256", F.lit("00")), ("manifest",)),
    (lambda s: s.withColumn("representative_id", F.when(F.col("status") == "removed", "zz").otherwise("")), ("manifest",)),
    (lambda s: s.withColumn("boxes", F.lit(None).cast(BOX)), ("coco",)),
    (lambda s: s, ()), (lambda s: s, ("nonsense",)),
])
def test_refused_exports_leave_nothing(samples, tmp_path, change, formats):
    with pytest.raises(ValueError):
        release.export(change(samples), str(tmp_path / "out"), formats)
    assert not (tmp_path / "out").exists() and not [p for p in tmp_path.iterdir() if p.name.startswith(".out")]


def test_release(spark, samples, tmp_path):
    out, registry = str(tmp_path / "out"), spark.createDataFrame([("src", "The Source", "http://x", "CC0")], "source_dataset string, title string, url string, license string")
    release.export(samples, out)
    for layout, folder in (("detection", "dataset/test_unannotated/images/s07.png"), ("classification", "dataset/val/y/s01.png")):
        target = str(tmp_path / layout)
        got = release.release(spark, out, target, "Leaves", "1.0", registry, layout, spark.createDataFrame([("y", "sano")], "label string, condition string"))
        assert got["layout"] == layout and got["images"] == 11 and got["linked"] == 11
        rows = list(csv.DictReader(open(f"{target}/annotations/labels.csv")))
        assert list(rows[0]) == list(release.LABEL_COLUMNS) and rows[1]["condition"] == "sano" and rows[0]["source_dataset"] == "The Source"
        assert (rows[7]["split"] == "test_unannotated") == (layout == "detection")
        assert os.path.exists(f"{target}/{folder}") and "The Source" in open(f"{target}/SOURCES.md").read() and "| `y` |" in open(f"{target}/README.md").read()
        with zipfile.ZipFile(f"{target}.zip") as z:
            assert "README.md" in z.namelist() and folder in z.namelist()
        assert os.path.exists(f"{target}.zip.sha256") and "11" in open(f"{target}-catalogue.md").read()
    assert release.layout_of(release.read_manifest(spark, out), True) == "classification"


def test_small_parts(spark, samples, tmp_path):
    assert release.views(samples)[0] == "curation_kept" and spark.sql("select count(*) as n from curation_kept").first().n == 11
    s = release.run_summary(samples)
    assert s["statuses"] == {"kept": 11, "removed": 1} and set(s["class_weights"]) == {"x", "y"}
    assert release.optional_tools(samples)["sources"] == ["src"]
    g = release.example_gallery(samples, "normalized_label", str(tmp_path / "g"), 2)
    assert {(r.normalized_label, r.sample_id) for r in g.collect()} == {("x", "s00"), ("x", "s02"), ("y", "s01"), ("y", "s03")} and os.path.exists(tmp_path / "g/x/s02.png")
    (tmp_path / "r/20250101-a").mkdir(parents=True)
    (tmp_path / "r/20250102-b").mkdir()
    assert release.matching_report(str(tmp_path / "r"), "a").endswith("20250101-a") and release.matching_report(str(tmp_path / "none")) is None
    n = rel.numbered(spark.range(1000).repartition(7), "id", name="n").collect()
    assert sorted((r["id"], r["n"]) for r in n) == [(i, i + 1) for i in range(1000)]
    with pytest.raises(FileNotFoundError):
        release.read_manifest(spark, str(tmp_path))


def test_copies(tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    a.write_bytes(b"x" * 10)
    digest, size = export._copy(str(a), str(b), None)
    assert size == 10 and export._copy(str(a), str(b), digest)[0] == digest  # a second time does no harm
    b.write_bytes(b"y")
    with pytest.raises(FileExistsError):
        export._copy(str(a), str(b), None)
    a.write_bytes(b"")
    with pytest.raises(ValueError):
        export._copy(str(a), str(tmp_path / "c"), None)
    assert not (tmp_path / "c").exists() and sorted(p.name for p in tmp_path.iterdir()) == ["a", "b"]
