"""The duplicate run over made-up families of pictures."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import vision
from millrace.operators import matching
from millrace.sources import fixtures, formats


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    images = fixtures.benchmark_images(spark, 6)
    cache = str(tmp_path_factory.mktemp("cache"))
    return images, cache, *matching.detect(images, cache)


def truth_of(images):
    return images.select("sample_id", "family", "transformation", "source")


def test_confirmed_pairs_are_right_and_none_of_the_plain_ones_is_missed(spark, run):
    images, _, descriptors, pairs = run
    assert images.count() == descriptors.count() == 90
    out = matching.evaluate(pairs, truth_of(images))
    total = out["total"].first()
    assert total.pairs > 0 and total.false_pairs == 0 and total.precision == 1.0 and total.contaminated_families == 0
    recall = {r.transformation: r.recall for r in out["by_transformation"].collect()}
    assert all(recall[t] == 1.0 for t in (*vision.TRANSFORMS, "jpeg", "scale")) and "shuffled" not in recall
    assert out["by_source"].first().members == 84
    stats = matching.run_stats(descriptors, pairs).first()
    assert stats.images == 90 and stats.invalid == 0 and stats.exact_pixels == 42


def test_candidates_are_those_of_all_pairs(spark, run):
    _, _, descriptors, _ = run
    rows = {r.sample_id: (np.array(r.phashes).astype(np.int64).view(np.uint64), np.array(r.histogram, np.float32)) for r in descriptors.select("sample_id", "phashes", "histogram").collect()}
    want = set()
    for q, (h, x) in rows.items():
        seen = [(o, int(np.bitwise_count(h[0] ^ g).min()), float(x @ y)) for o, (g, y) in rows.items() if o != q]
        seen = [s for s in seen if s[1] <= 12 or s[2] >= 0.92]
        want |= {(q, o) for o, _, _ in sorted(seen, key=lambda s: (s[1], s[0]))[:5]} | {(q, o) for o, _, _ in sorted(seen, key=lambda s: (-round(s[2], 6), s[0]))[:5]}
    for block in (1024, 16):
        found = matching.scored(descriptors, neighbours=5, block=block)
        got = {(r.query, r.other) for r in found.collect()}
        assert len(got ^ want) <= 0.02 * len(want)  # equal colours may differ in their last digit
    everything = matching.scored(descriptors, neighbours=None).select(F.col("query").alias("left"), F.col("other").alias("right"))
    assert matching.retrieval_recall(everything, everything).first().recall == 1.0


def test_the_cache_is_used_and_damage_is_mended(spark, run, tmp_path, monkeypatch):
    images, _, descriptors, pairs = run
    few = images.limit(10)
    cache = str(tmp_path / "c")
    first = matching.cached_descriptors(few, cache)
    assert first.count() == 10
    n = spark.read.parquet(cache).count()
    matching.cached_descriptors(few, cache).count()
    assert spark.read.parquet(cache).count() == n  # nothing new
    spark.read.parquet(cache).withColumn("sharpness", F.lit(-1.0)).write.parquet(cache + "2")
    assert matching.cached_descriptors(few, cache + "2").filter("sharpness < 0").count() == 0
    two = pairs.limit(20)
    again = matching.cached_verification(two, descriptors, str(tmp_path / "p"))
    assert again.count() == 20
    assert matching.cached_verification(two, descriptors, str(tmp_path / "p")).exceptAll(again).isEmpty()


def test_assignment_leaks_and_independence(spark, run):
    images, _, descriptors, pairs = run
    facts = images.select("sample_id", F.lit("kept").alias("status"))
    out = matching.duplicates_of(descriptors, pairs, facts)
    rows = out.collect()
    family = {r.sample_id: r.family for r in images.select("sample_id", "family").collect()}
    assert all(family[r.sample_id] == family[r.representative_id] for r in rows if r.representative_id)
    assert sum(r.state == "representative" for r in rows) >= 6
    splits = images.select("sample_id", F.when(F.col("transformation") == "jpeg", "test").otherwise("train").alias("split"))
    leaks = matching.visual_leaks(pairs, splits)
    assert leaks.filter(F.col("level").isin("verified_visual", "exact_pixels")).count() > 0
    assert matching.visual_leaks(pairs, splits, leaks.select("left", "right")).count() == 0
    t = images.select("source", F.lit(None).cast("string").alias("capture_group"), "family", F.col("sample_id").alias("pixels"))
    assert matching.shared_with(t, t).count() > 0
    assert matching.shared_with(t.filter("family = 'leaf-0'"), t.filter("family = 'leaf-1'")).count() == 0


def test_the_ladder(spark):
    rng = np.random.default_rng(1)
    p = fixtures.leaf(rng)
    flat = np.full((64, 64, 3), 128, np.uint8)
    clear = np.dstack([p, np.full(p.shape[:2], 255, np.uint8)])
    rows = [("a", p), ("b", p), ("c", np.ascontiguousarray(p[:, ::-1])), ("d", flat), ("e", clear), ("f", _noise(p)), ("g", fixtures.leaf(rng))]
    images = spark.createDataFrame([(k, *v.shape, v.tobytes(), k) for k, v in rows] + [("x", -1, -1, 3, b"", "x")], "sample_id string, height int, width int, channels int, data binary, own string")
    d = vision.picture_descriptors(images)
    assert d.filter("sample_id = 'x'").first().error
    pairs = spark.createDataFrame([("a", k) for k in "bcdefgx"], "left string, right string")
    got = {r.right: (r.level, r.transform, r.reason) for r in matching.verify_pairs(pairs, d).collect()}
    assert got["b"] == ("exact_bytes", "r0", None) and got["c"] == ("exact_pixels", "mirror_r0", None)
    assert got["d"][::2] == ("candidate", "low_information") and got["e"][::2] == ("candidate", "alpha_requires_review")
    assert got["f"][:2] == ("verified_visual", "r0") and got["g"][0] == "rejected" and "x" not in got
    assert matching.candidate_pairs(d.limit(0)).count() == 0


def _noise(p):
    return np.clip(p.astype(int) + np.random.default_rng(2).integers(-2, 3, p.shape), 0, 255).astype(np.uint8)


def test_written_benchmark_and_its_manifest(spark, tmp_path):
    manifest = fixtures.write_benchmark(str(tmp_path / "b"), 1)
    rows = fixtures.read_benchmark(spark, manifest)
    assert rows.count() == 15 and rows.filter("synthetic").count() == 15
    images = formats.decoded(spark, str(tmp_path / "b"))
    assert images.filter("height > 0").count() == 15
    with pytest.raises(FileExistsError):
        fixtures.write_benchmark(str(tmp_path / "b"), 1)
    for bad in ('{"samples": [{"id": "a", "filepath": "f", "family": "x"}]}', '{"synthetic": true, "samples": [{"id": "a", "filepath": "f", "family": "x"}, {"id": "a", "filepath": "g", "family": "x"}]}', '{"synthetic": true, "samples": [{"id": "a", "filepath": " ", "family": "x"}]}'):
        (tmp_path / "bad.json").write_text(bad)
        with pytest.raises(ValueError):
            fixtures.read_benchmark(spark, str(tmp_path / "bad.json"))
