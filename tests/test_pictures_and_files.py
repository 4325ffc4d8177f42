from __future__ import annotations

import json
import struct
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import vision
from millrace.operators import balance
from millrace.plans import runs
from millrace.sinks import export
from millrace.sources import fixtures, formats


def png(image: np.ndarray) -> bytes:
    h, w, _ = image.shape
    raw = b"".join(b"\0" + image[i, :, ::-1].tobytes() for i in range(h))
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def leaf(seed: int, h: int = 96, w: int = 128) -> np.ndarray:
    rng = np.random.default_rng(seed)
    small = rng.integers(30, 220, (12, 16, 3))
    return np.kron(small, np.ones((h // 12, w // 16, 1))).astype(np.uint8)


def test_symmetries_share_hashes_and_families():
    p = leaf(1)
    q = np.ascontiguousarray(np.rot90(p[:, ::-1], 1))
    assert min(vision.pixel_digests(p).values()) == min(vision.pixel_digests(q).values())
    hashes = {vision.perceptual_hash(vision.gray(v)) for _, v in vision.symmetries(p)}
    assert vision.perceptual_hash(vision.gray(q)) in hashes
    assert vision.verify_pair(p, q)[0] == "exact_pixels" and vision.verify_pair(p, p) == ("exact_pixels", "r0")
    noisy = np.clip(p.astype(int) + np.random.default_rng(2).integers(-2, 3, p.shape), 0, 255).astype(np.uint8)
    assert vision.verify_pair(p, noisy)[0] == "verified_visual"
    assert vision.verify_pair(p, leaf(9))[0] in ("candidate", "rejected")


def test_kernels():
    p = leaf(3)
    flat = np.full_like(p, 128)
    assert vision.blur_variance(vision.gray(flat)) == 0 < vision.blur_variance(vision.gray(p))
    assert vision.entropy(vision.gray(flat)) == 0
    h = vision.colour_histogram(p)
    assert h.shape == (512,) and np.linalg.norm(h) == pytest.approx(1) and not vision.colour_histogram(np.zeros_like(p)).any()
    assert vision.low_resolution(100, 400, 320) and not vision.low_resolution(640, 480, 320)
    mean, p5, p95 = vision.brightness(p)
    assert p5 <= mean <= p95


@pytest.fixture
def raw(tmp_path):
    root = tmp_path / "raw"
    coco = root / "a_coco" / "train"
    coco.mkdir(parents=True)
    for i in range(3):
        (coco / f"i{i}.png").write_bytes(png(leaf(i)))
    doc = {
        "images": [{"id": i, "file_name": f"i{i}.png", "width": 128, "height": 96} for i in range(3)] + [{"id": 8, "file_name": "../x.png", "width": 1, "height": 1}, {"id": 9, "file_name": "gone.png", "width": 9, "height": 9}],
        "annotations": [{"id": 1, "image_id": 0, "category_id": 1, "bbox": [0, 0, 64, 48]}, {"id": 2, "image_id": 77, "category_id": 1, "bbox": [0, 0, 1, 1]}, {"id": 3, "image_id": 1, "category_id": 5, "bbox": [0, 0, -4, 4]}, {"id": 4, "image_id": 2, "category_id": 1, "bbox": [100, 0, 64, 48]}],
        "categories": [{"id": 1, "name": "roya"}],
    }
    (coco / "_annotations.coco.json").write_text(json.dumps(doc))
    yolo = root / "b_yolo"
    for part in ("images/train", "labels/train"):
        (yolo / part).mkdir(parents=True)
    (yolo / "data.yaml").write_text("names: [sano, roya]\ntrain: images/train\n")
    for i in range(2):
        (yolo / f"images/train/y{i}.png").write_bytes(png(leaf(10 + i)))
    (yolo / "labels/train/y0.txt").write_text("1 0.5 0.5 0.2 0.2\nbroken\n7 0.5 0.5 0.2 0.2\n")
    voc = root / "c_voc"
    (voc / "JPEGImages").mkdir(parents=True)
    (voc / "JPEGImages" / "v 1.png").write_bytes(png(leaf(20)))
    (voc / "v1.xml").write_text("<annotation><filename>v1.png</filename><size><width>128</width><height>96</height><depth>3</depth></size><object><name>roya</name><bndbox><xmin>0</xmin><ymin>0</ymin><xmax>64</xmax><ymax>48</ymax></bndbox></object><object><name>sano</name><bndbox><xmin>0</xmin><ymin>0</ymin><xmax>640</xmax><ymax>48</ymax></bndbox></object></annotation>")
    tree = root / "d_tree" / "train" / "Roya"
    tree.mkdir(parents=True)
    (tree / "t.png").write_bytes(png(leaf(30)))
    (tree / "bad.png").write_bytes(b"no picture")
    return root


def test_ingest_of_four_formats(spark, raw):
    df, report = formats.ingest(spark, str(raw))
    assert [(r["format"], r["status"]) for r in report] == [("coco", "ok"), ("yolo", "ok"), ("voc", "ok"), ("tree", "ok")]
    rows = {r.filepath.rsplit("/", 1)[1]: r for r in df.collect()}
    assert rows["i0.png"].boxes[0].label == "roya" and rows["i0.png"].boxes[0].bounding_box == [0, 0, 0.5, 0.5] and rows["i0.png"].source_split == "train"
    assert "x.png" not in rows and [b.label for b in rows["y0.png"].boxes] == ["roya"] and rows["y1.png"].boxes is None
    assert [b.label for b in rows["v 1.png"].boxes] == ["roya", "sano"] and rows["t.png"].source_label == "Roya"
    with pytest.raises(ValueError):
        formats.read_coco(spark, str(raw / "a_coco"), "a", strict=True)


def test_audit(spark, raw):
    codes = lambda name, kind: sorted(r.code for r in formats.audit(spark, str(raw / name), kind).collect())
    assert codes("a_coco", "coco") == sorted(["external_media_path", "missing_image", "missing_image", "orphan_annotation", "unknown_category", "invalid_bbox", "bbox_out_of_bounds"])
    assert codes("b_yolo", "yolo") == sorted(["invalid_yolo_row", "unknown_yolo_class", "missing_yolo_label"])
    assert codes("c_voc", "voc") == ["bbox_out_of_bounds"]


def test_sources_and_their_audit(spark, tmp_path):
    raw = tmp_path / "raw"
    fixtures.write_sources(str(raw), 4, edge_cases=True)
    found = formats.discover(str(raw))
    assert [(f["name"], f["format"], f["splits"]) for f in found] == [("mock_coco", "coco", ["train"]), ("mock_voc", "voc", []), ("mock_yolo", "yolo", ["train"])]
    df, report = formats.ingest(spark, str(raw), report_path=str(tmp_path / "report.json"))
    assert df.count() == 5 + 4 + 4 and json.loads((tmp_path / "report.json").read_text())["samples"] == 13
    issues = formats.audit_raw(spark, str(raw))
    codes = {(r.source, r.code) for r in issues.collect()}
    assert codes == {("mock_coco", "invalid_bbox"), ("mock_voc", "corrupt_image"), ("", "conflicting_duplicate_labels")}
    counts = formats.audit_counts(issues, df).first()
    assert (counts.sources, counts.images, counts.boxes, counts.warnings) == (3, 13, 13, 0) and counts.errors >= 3
    assert [r.code for r in formats.audit_raw(spark, str(raw / "none")).collect()] == ["missing_raw_dir"]
    assert formats.sample_scan(str(raw))["files"] == 13 and formats.sample_scan(str(raw))["broken"] == 1 and formats.sample_scan(str(raw), files=2)["files"] == 2
    (raw / "mock_coco" / "train" / "other_coco.json").write_text("{}")
    with pytest.raises(ValueError):
        formats.coco_files(str(raw / "mock_coco"))


@pytest.mark.parametrize("text, code", [("[1]", "invalid_yolo_schema"), ("a: [", "invalid_yolo_yaml"), ("train: x", "missing_yolo_names"), ("names: [a]\ntrain: /gone/x", "missing_yolo_split")])
def test_descriptions_with_faults(spark, tmp_path, text, code):
    (tmp_path / "images").mkdir()
    (tmp_path / "images" / "a.png").write_bytes(fixtures.png(leaf(1)))
    (tmp_path / "images" / "a.txt").write_text("0 0.5 0.5 0.1 0.1\n")
    (tmp_path / "data.yaml").write_text(text)
    assert code in {r.code for r in formats.audit(spark, str(tmp_path), "yolo").collect()}


@pytest.mark.parametrize("said, there, want", [("../train/images", "train/images", "train/images"), ("C:\\x\\train", "images/train", "images/train"), ("/home/me/val", "valid", "valid")])
def test_splits_are_found(tmp_path, said, there, want):
    (tmp_path / there).mkdir(parents=True)
    split = "val" if "val" in said else "train"
    (tmp_path / "data.yaml").write_text(json.dumps({"names": ["a"], split: said}))
    assert formats.yolo_splits(str(tmp_path)) == {split: want}


def test_promotion_comes_back(tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "old").write_text("")
    with pytest.raises(OSError):
        formats.promote(str(tmp_path / "none"), str(tmp_path / "t"))
    assert (tmp_path / "t" / "old").exists()
    (tmp_path / "b").mkdir()
    formats.promote(str(tmp_path / "b"), str(tmp_path / "t"))
    assert not (tmp_path / "t" / "old").exists() and not (tmp_path / "t.old").exists()


def test_kernels_of_text_and_masks():
    p = np.full((120, 200, 3), 90, np.uint8)
    assert not vision.looks_written(p) and vision.wants_reading(False, False, None, None) and not vision.wants_reading(False, False, 5, 10) and not vision.wants_reading(True, False, 50, 90)
    for i, x in enumerate(range(60, 140, 4)):
        p[50 + 8 * (i % 5 < 2) : 66 - 6 * (i % 4 < 2), x : x + 2] = 250
    assert vision.looks_written(p)
    assert vision.agency_text([("Shutterstock", 80)]) and not vision.agency_text([("shutterstock", 20)]) and not vision.agency_text([("leaf", 99)])
    green = np.zeros((60, 60, 3), np.uint8)
    green[10:50, 10:50] = (20, 200, 20)
    green[25:35, 25:35] = (20, 40, 120)  # a lesion within the leaf
    assert vision.leaf_mask(green)[30, 30] and not vision.leaf_mask(green)[5, 5]
    assert vision.box_blurs(leaf(4), [[0, 0, 1, 1], [0.99, 0.99, 0.001, 0.001]])[1] == 0.0
    alpha = np.full((60, 60), 255, np.uint8)
    alpha[:10] = 0
    assert vision.transparent(alpha) and not vision.transparent(None)
    colours = vision.palette(["a", "b"])
    assert colours["classes"] == {"background": 0, "a": 1, "b": 2}
    m = vision.semantic_mask(10, 10, [{"label": "b", "bounding_box": [0.5, 0, 0.5, 0.5], "mask": np.ones((2, 2))}], colours["classes"])
    assert m[:5, 5:].all() and m.sum() == 2 * 25 and vision.semantic_mask(5, 5, [{"label": "a"}], {}) is None
    assert vision.preview(np.dstack([leaf(1), np.full((96, 128), 9, np.uint8)]), "r90").startswith("iVBOR")
    holes = np.ones((5, 5), bool)
    holes[2, 2] = holes[0, 0] = False
    assert vision.filled(holes)[2, 2] and not vision.filled(holes)[0, 0]


def test_metrics_and_descriptors(spark, raw):
    images = formats.decoded(spark, str(raw / "d_tree")).withColumn("sample_id", F.regexp_extract("path", r"([^/]+)$", 1))
    m = {r.sample_id: r for r in vision.picture_metrics(images).collect()}
    assert m["bad.png"].is_corrupted and not m["t.png"].is_corrupted and m["t.png"].width == 128 and m["t.png"].blur_variance > 0
    d = vision.picture_descriptors(images).collect()
    assert len(d) == 2 and next(r for r in d if r.sample_id == "bad.png").error
    good = next(r for r in d if r.sample_id == "t.png")
    assert len(good.phashes) == 8 and len(good.histogram) == 512
    plan = spark.createDataFrame([("x", 1, "t.png", "n1"), ("x", 2, "t.png", "n2")], "label string, i long, parent_sample_id string, synthetic_id string")
    assert {(r.sample_id, r.channels) for r in balance.synthesize(plan, images).collect()} == {("n1", 3), ("n2", 3)}


def test_export_is_atomic_and_verified(spark, raw, tmp_path):
    df = formats.read_tree(spark, str(raw / "d_tree"), "d").withColumn("asset_sha256", F.lit(None).cast("string")).withColumn("assigned_split", F.lit("train"))
    boxes = spark.createDataFrame([("s", "roya", [0.0, 0.0, 0.5, 0.5], 100, 50)], "sample_id string, label string, box array<double>, width int, height int")
    out = str(tmp_path / "export")
    export.export(df, boxes, out)
    assert spark.read.option("header", True).csv(f"{out}/manifest.csv").count() == 2
    assert spark.read.parquet(f"{out}/yolo").first().text == "0 0.250000 0.250000 0.500000 0.500000"
    assert json.loads(spark.read.json(f"{out}/coco").first().annotation)["bbox"] == [0, 0, 50, 25]
    with pytest.raises(FileExistsError):
        export.export(df, boxes, out)
    with pytest.raises(ValueError):
        export.export(df.limit(0), boxes, str(tmp_path / "none"))
    copied = export.copy_verified(df, str(tmp_path / "media")).collect()
    assert all(r.copied for r in copied) and (tmp_path / "media" / "train" / "roya").is_dir()
    wrong = export.copy_verified(df.withColumn("asset_sha256", F.lit("0" * 64)), str(tmp_path / "media2")).collect()
    assert not any(r.copied for r in wrong)
    at = export.bundle(out, str(tmp_path / "b.zip"))
    assert "_SUMMARY.json" in zipfile.ZipFile(at).namelist()


def test_runs(spark, tmp_path):
    mark = runs.fingerprint({"a": 1}, str(tmp_path))
    assert mark != runs.fingerprint({"a": 2}, str(tmp_path))
    calls = []

    def make():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert runs.Run(spark, str(tmp_path / "run"), mark).phase("one", make).count() == 3
    assert len(calls) == 1
    runs.Run(spark, str(tmp_path / "run"), mark).done()
    assert runs.latest_run(str(tmp_path)).endswith("run")
    with runs.single_writer(str(tmp_path / "run")), pytest.raises(BlockingIOError), runs.single_writer(str(tmp_path / "run")):
        pass
    assert {c["check"]: c["status"] for c in runs.preflight(str(tmp_path), str(tmp_path / "o"))}["raw"] == "pass"


def test_stream_takes_each_record_once(spark, tmp_path):
    import datetime as dt

    from millrace.streaming import ingest

    schema = "path string, source_dataset string, size_bytes bigint, content string, modified_at timestamp_ntz"
    rows = [(f"p{i}", "s", 40, f"{i % 3},a,train,detection,x\n", dt.datetime(2025, 1, 1, i)) for i in range(6)]
    spark.createDataFrame(rows, schema).repartition(2).write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        ingest.write(ingest.new_records(ingest.stream_fragments(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.label_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 1, 2]
