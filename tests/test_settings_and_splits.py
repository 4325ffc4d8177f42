from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.operators import relational as rel
from millrace.operators import splits
from millrace.plans import config, runs
from millrace.sinks import release


def test_policies(tmp_path):
    p = config.policy({"schema_version": "1.0", "quality": {"severe_blur": 5}, "deduplication": {"candidate_neighbors": 12}})
    assert p["quality"]["severe_blur"] == 5 and p["quality"]["review_blur"] == 25.0 and p["splits"]["train"] == 0.8
    for bad in ({"x": {}}, {"deduplication": {"x": 1}}, {"quality": {"severe_blur": 99}}, {"splits": {"train": 0.9}}, {"quality": {"ocr_timeout_seconds": 0}}, {"quality": {"min_brightness": 250}}, {"deduplication": {"semantic_action": "drop"}}, {"quality": {"ocr_confidence": float("nan")}}):
        with pytest.raises(ValueError):
            config.policy(bad)
    (tmp_path / "a.yaml").write_text("s: {title: A}\nt: {title: T}\n")
    (tmp_path / "b.json").write_text('{"s": {"title": "B"}}')
    assert config.registry(str(tmp_path / "a.yaml"), None, str(tmp_path / "none"), str(tmp_path / "b.json")) == {"s": {"title": "B"}, "t": {"title": "T"}}
    (tmp_path / "leaf_set.yaml").write_text("title: Leaves")
    assert config.release_description("LeafSet", (str(tmp_path),)) == {"title": "Leaves"} and config.release_description("Other", (str(tmp_path),)) == {}
    (tmp_path / "c.yaml").write_text("- 1")
    with pytest.raises(ValueError):
        config.load_policy(str(tmp_path / "c.yaml"))
    assert runs.workers(8) == 6 and runs.workers(1) == 1 and runs.session_settings(8, 10 << 30)["spark.sql.shuffle.partitions"] == "80"
    assert {c["check"]: c["status"] for c in runs.preflight(str(tmp_path), str(tmp_path / "o"))} == {"raw": "pass", "out": "pass", "cache": "skipped", "disk": "pass", "database": "skipped", "accelerator": "skipped"}


def test_metadata_and_backfill(spark):
    s = spark.createDataFrame([("a", "/raw/S/train/Leaf Rust/x.jpg"), ("b", "/raw/T/y.jpg")], "sample_id string, filepath string")
    src = spark.createDataFrame([("S", "tree", "2", None)], "source_dataset string, format string, version string, license string")
    got = {r.sample_id: r for r in rel.with_metadata(s, src, "/raw").collect()}
    assert (got["a"].source_dataset, got["a"].source_split, got["a"].source_label, got["a"].normalized_label, got["a"].source_version, got["a"].source_license, got["a"].status) == ("S", "train", "Leaf Rust", "leaf_rust", "2", "unknown", "kept")
    assert (got["b"].source_format, got["b"].source_label, got["b"].source_sensor) == ("unknown", "", "RGB")
    df = spark.createDataFrame([(1.0, (2.0, 3)), (float("nan"), (2.0, 3)), (None, None)], "w double, q struct<w:double,h:int>")
    assert [(r.w, r.h, r.z) for r in rel.backfilled(df, "q", {"w": "double", "h": "int", "z": "string"}).collect()] == [(1.0, 3, None), (2.0, 3, None), (None, None, None)]
    e = spark.createDataFrame([("a", "b")], "left string, right string")
    m = spark.createDataFrame([("a", " AB "), ("b", "")], "sample_id string, asset_sha256 string")
    assert tuple(rel.with_assets(e, m).select("left_asset", "right_asset").first()) == ("ab", None)


def test_partition_of_kept_samples(spark):
    rows = [(f"s{i:03d}", "removed" if i % 10 == 0 else "kept", f"l{i % 3}", ["x", "val"]) for i in range(300)]
    samples = spark.createDataFrame(rows, "sample_id string, status string, normalized_label string, tags array<string>")
    families = samples.select("sample_id", F.concat(F.lit("g"), F.floor(F.substring("sample_id", 2, 3).cast("int") / 3).cast("string")).alias("group_id"))
    out = splits.partition(samples, families, {"train": 0.8, "val": 0.1, "test": 0.1})
    assert out.count() == 300 and out.filter("status = 'removed' and assigned_split is not null").count() == 0 and out.filter("status = 'kept' and assigned_split is null").count() == 0
    assert out.filter("assigned_split is not null").groupBy("split_group_id").agg(F.count_distinct("assigned_split").alias("n")).filter("n > 1").isEmpty()
    assert all(r.tags == sorted(["x", *([r.assigned_split] if r.assigned_split else [])]) for r in out.collect())
    a, b = out.filter("assigned_split = 'test'").first(), out.filter("assigned_split = 'train'").first()
    after = splits.reconcile_samples(out, spark.createDataFrame([(a.sample_id, b.sample_id)], "left string, right string"))
    assert after.filter(F.col("split_group_id") == a.split_group_id).filter("assigned_split <> 'train'").isEmpty() and after.count() == 300
    page = release.curation_report(out.withColumn("source_dataset", F.lit("s")).withColumn("reason", F.lit("<r>")).withColumn("phase", F.lit("quality")))
    assert "&lt;r&gt;" in page and "Class weights" in page
