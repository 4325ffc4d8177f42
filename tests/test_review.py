"""Duplicate decisions, people's reviews, and what must hold after them."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import decisions, review

SAMPLE = "sample_id string, source_dataset string, source_label string, status string, phase string, reason string, confidence double, representative_id string, evidence_level string, review_reasons array<string>, tags array<string>, history array<struct<at:timestamp,action:string,before:string,after:string>>"


def table(spark, rows):
    return spark.createDataFrame([(i, "s", "x", st, ph, re, 1.0, "", "", rr, tags, None) for i, st, ph, re, rr, tags in rows], SAMPLE)


def kept(spark, ids):
    return table(spark, [(i, "kept", "quality", "ok", [], ["a", "curation_kept"]) for i in ids])


def found(spark, rows):
    return spark.createDataFrame(rows, "sample_id string, representative_id string, level string, conflict boolean")


def test_a_phase_of_duplicates(spark):
    samples = kept(spark, "abcdefghij").unionByName(table(spark, [("r", "review", "quality", "blur", ["old"], []), ("h", "kept", "human_review", "hitl", [], [])]).filter("sample_id = 'r'"))
    got = {r.sample_id: r for r in review.run_duplicate_phase(samples, found(spark, [("b", "a", "exact_bytes", False), ("c", "a", "verified_visual", False), ("d", None, None, True), ("r", "a", "exact_pixels", False)]), "exact_duplicates").collect()}
    assert got["b"].status == "removed" and got["b"].representative_id == "a"
    assert got["c"].status == "review" and got["c"].confidence == 0.85
    assert got["d"].status == "review" and got["d"].phase == "annotation_duplicates"
    assert got["r"].status == "review" and got["r"].review_reasons == ["blur", "duplicate", "old"]  # another phase's review isn't settled
    assert got["b"].tags == ["a", "curation_removed", "exact_duplicates_duplicate"] and [h.action for h in got["b"].history] == ["exact_duplicates"]
    assert json.loads(got["b"].history[0].before)["curation"]["status"] == "kept" and got["a"].history in (None, [])


def test_the_brake_and_exact_evidence(spark):
    samples = kept(spark, "abcd")
    got = {r.sample_id: (r.status, r.reason) for r in review.run_duplicate_phase(samples, found(spark, [("b", "a", "exact_bytes", False), ("c", "a", "exact_bytes", False), ("d", "a", "exact_bytes", False)]), "exact_duplicates").collect()}
    assert got["b"] == ("removed", "duplicate")  # hard: exact and sure
    soft = spark.createDataFrame([("b", "s", "removed", 0.99, "exact_duplicates", "verified_visual", "r", False), ("a", "s", "kept", 1.0, "quality", None, "ok", False)], "sample_id string, g string, status string, confidence double, phase string, evidence_level string, reason string, before boolean")
    assert {r.sample_id: (r.status, r.reason) for r in decisions.ratio_brake(soft, ["g"]).collect()} == {"b": ("review", "second_opinion_r"), "a": ("kept", "ok")}


def test_same_phase_settles_by_exact_evidence_only(spark):
    current = table(spark, [(i, "review", "exact_duplicates", "duplicate", ["duplicate"], []) for i in "ab"])
    new = spark.createDataFrame([("a", "removed", "exact_duplicates", "duplicate", 1.0, "x", "exact_bytes"), ("b", "removed", "exact_duplicates", "duplicate", 1.0, "x", "candidate")], "sample_id string, status string, phase string, reason string, confidence double, representative_id string, evidence_level string")
    got = {r.sample_id: (r.status, r.review_reasons) for r in decisions.merge(current, new).collect()}
    assert got == {"a": ("removed", []), "b": ("review", ["duplicate"])}


def test_what_a_removed_sample_stood_on_goes_to_review(spark):
    samples = table(spark, [("a", "review", "quality", "blur", [], []), ("b", "removed", "exact_duplicates", "duplicate", [], [])]).withColumn("representative_id", F.when(F.col("sample_id") == "b", "a").otherwise(""))
    assert {(r.sample_id, r.problem) for r in review.audit_representatives(samples).collect()} == {("b", "representative_not_kept")}
    assert [r.sample_id for r in review.reconcile_decisions(samples).collect()] == ["b"]
    lone = table(spark, [("c", "removed", "exact_duplicates", "x", [], []), ("d", "removed", "quality", "x", [], [])])
    assert [(r.sample_id, r.problem) for r in review.audit_representatives(lone).collect()] == [("c", "no_representative")]


def test_annotations_that_say_the_same():
    box = {"label": "x", "bounding_box": [0.1, 0.2, 0.3, 0.4]}
    turned = {"label": "x", "bounding_box": list(review.turned(box["bounding_box"], "mirror_r90"))}
    ok = lambda a, b, t="r0": review.compatible(("detection", ["x"], a), ("detection", ["x"], b), t)
    assert ok([box], [box]) and not ok([box], []) and not ok([box], [{**box, "label": "y"}])
    assert ok([turned], [box], "mirror_r90") and not ok([box], [box], "r90")
    assert ok([{**box, "stage": 2}], [box]) and not ok([box], [{**box, "stage": 2}])
    assert ok([{**box, "source_label": "a"}], [{**box, "blur_variance": 3}])
    assert not ok([{**box, "mask": "m"}], [{**box, "mask": "m"}])
    assert not review.compatible(("segmentation", [], []), ("segmentation", [], [])) and not review.compatible(("detection", ["x"], []), ("detection", ["y"], []))


def test_marking_edges(spark):
    notes = spark.createDataFrame([("a", "classification", ["x"], None), ("b", "classification", ["x"], "[]"), ("c", "classification", ["y"], None)], "sample_id string, task_type string, labels array<string>, boxes string")
    edges = spark.createDataFrame([("a", "b", "e", "r0"), ("a", "c", "e", None), ("a", "z", "e", "r0")], "left string, right string, level string, transform string")
    assert {r.right: r.compatible for r in review.mark_compatible(edges, notes).collect()} == {"b": True, "c": False, "z": False}
    assert [r.n for r in spark.createDataFrame([('[{"label": "x", "bounding_box": [], "stage": 1, "note": null}]',), (None,)], "b string").select(review.richness(F.col("b")).alias("n")).collect()] == [1, 0]


LINKS = "left_id string, right_id string, level string, method string, rejected boolean, score double"


def test_people_review_pairs(spark):
    samples = kept(spark, "abc").withColumn("representative_id", F.when(F.col("sample_id") == "b", "a").otherwise(""))
    links = spark.createDataFrame([("b", "a", "exact_bytes", "exact", False, 1.0), ("a", "c", "human_confirmed", "human_review", False, None)], LINKS)
    said = spark.createDataFrame([("b", "a", "reject"), ("c", "a", "reject"), ("a", "b", "reject")], "left string, right string, decision string")
    out, opened, changed = review.review_pairs(said, samples, links)
    assert {(r.left_id, r.right_id, r.method, r.rejected) for r in out.collect()} == {("a", "b", "exact", False), ("a", "b", "human_review", True), ("a", "c", "human_review", True)}
    assert [(r.sample_id, r.status) for r in opened.collect()] == [("b", "review")]
    assert {(r.left, r.right, r.before, r.after) for r in changed.collect()} == {("a", "b", None, "reject"), ("a", "c", "confirm", "reject")}
    again, _, unchanged = review.review_pairs(said, samples, out)
    assert again.exceptAll(out).isEmpty() and unchanged.isEmpty()
    for bad in ([("a", "a", "confirm")], [("a", "z", "confirm")], [("a", "b", "maybe")], [("a", "b", "confirm"), ("b", "a", "reject")], [(None, "b", "confirm")]):
        with pytest.raises(ValueError):
            review.check_reviews(spark.createDataFrame(bad, "left string, right string, decision string"), samples)


def test_manual_tags(spark):
    samples = table(spark, [("a", "review", "q", "r", ["r"], ["kept"]), ("b", "kept", "q", "ok", [], ["removed"]), ("c", "kept", "q", "ok", [], [])])
    got = {r.sample_id: (r.status, r.review_reasons) for r in review.sync_manual(samples).collect()}
    assert got == {"a": ("kept", []), "b": ("removed", [])}
    with pytest.raises(ValueError):
        review.sync_manual(samples.unionByName(table(spark, [("d", "review", "q", "r", [], [])])))
    assert review.sync_manual(samples.unionByName(table(spark, [("d", "review", "q", "r", [], [])])), all_resolved=False).count() == 2
    with pytest.raises(ValueError):
        review.sync_manual(table(spark, [("a", "kept", "q", "r", [], ["kept", "removed"])]))


def test_reset_and_stored_decisions(spark):
    before = kept(spark, "abcd")
    pairs = found(spark, [("b", "a", "exact_bytes", False)])
    after = review.run_duplicate_phases(before, [("exact_duplicates", pairs)])
    assert after.filter("sample_id = 'b'").first().status == "removed"
    back = review.reset_duplicates(after, before.select("sample_id", "status", "phase", "reason"), "exact_duplicates")
    row = back.filter("sample_id = 'b'").first()
    assert row.status == "kept" and row.tags == ["a", "curation_kept"]
    proof = spark.createDataFrame([("a", "b", "exact_bytes", True)], "left string, right string, level string, compatible boolean")
    assert review.apply_stored(before, pairs, proof, "exact_duplicates").filter("status = 'removed'").count() == 1
    with pytest.raises(ValueError):
        review.apply_stored(before, pairs, proof.withColumn("level", F.lit("candidate")), "exact_duplicates")
    with pytest.raises(ValueError):
        review.run_duplicate_phases(before, [("x", pairs), ("x", pairs)])
