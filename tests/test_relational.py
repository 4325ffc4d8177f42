from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import geometry as geo
from millrace.functions import text as tx
from millrace.operators import aggregates as agg
from millrace.operators import balance, components, decisions, duplicates, labels, ranking, representatives, splits
from millrace.operators import relational as rel


def one(df, *columns):
    return df.select(*columns).first()


@pytest.mark.parametrize(("value", "plain", "ascii_"), [("Tizón_Vidrioso", "tizon vidrioso", "tizon_vidrioso"), ("  Peacock-Spot ", "peacock spot", "peacock_spot"), ("", "", "unlabeled"), ("漢字", "漢字", "unlabeled"), (None, None, "unlabeled")])
def test_normal_forms(spark, value, plain, ascii_):
    r = one(spark.createDataFrame([(value,)], "v string"), tx.normal_text(F.col("v")), tx.ascii_label(F.col("v")))
    assert (r[0], r[1]) == (plain, ascii_)


def test_labels_and_paths(spark):
    df = spark.createDataFrame([("Peacock Spot", "/data/x/Validation/Roya/a.JPG", "/d/leaf/img.rf.1.png")], "l string, p string, q string")
    r = one(df, tx.normal_label(F.col("l")), tx.split_of_path(F.col("p")), tx.label_of_path(F.col("p")), tx.augmented_name(F.col("q")), tx.export_name(F.lit("k"), F.col("p")), tx.coarse_label(F.col("l")))
    assert tuple(r) == ("olive_peacock_spot", "valid", "Roya", True, "k.jpg", "enfermo")


@pytest.mark.parametrize(("box", "good"), [([0.1, 0.1, 0.2, 0.2], True), ([0.9, 0.1, 0.2, 0.2], False), ([0.1, 0.1, 0.0, 0.2], False), ([0.1, float("nan"), 0.1, 0.1], False), ([0.1, None, 0.1, 0.1], False), ([0.1], False), (None, False), ([-0.1, 0.0, 0.2, 0.2], False)])
def test_box_validity(spark, box, good):
    assert one(spark.createDataFrame([(box,)], "b array<double>"), geo.valid_box(F.col("b")))[0] is good


def test_four_turns_give_the_box_again(spark):
    df = spark.createDataFrame([([0.1, 0.2, 0.3, 0.4],)], "b array<double>")
    r = one(df, geo.turn_box(F.col("b"), False, 4), geo.turn_box(F.col("b"), True, 0), geo.turn_box(geo.turn_box(F.col("b"), False, 1), False, 3))
    assert r[0] == r[2] == [0.1, 0.2, 0.3, 0.4] and r[1] == pytest.approx([0.6, 0.2, 0.3, 0.4])


def test_latest_and_update(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "y"), ("b", None, "z"), (None, 5, "n")], "k string, t int, v string")
    assert {(r.k, r.v) for r in rel.latest(df, "k", "t").collect()} == {("a", "y"), ("b", "z")}
    new = spark.createDataFrame([("a", "q"), ("b", None)], "k string, v string")
    assert {(r.k, r.v) for r in rel.update_columns(df.filter("t = 2 or k = 'b'").distinct(), new, "k").collect()} == {("a", "q"), ("b", "z")}


def test_edges(spark):
    edges = spark.createDataFrame([("a", "b", "m"), ("c", "b", "m"), ("d", "e", "n")], "left string, right string, method string")
    rejected = spark.createDataFrame([("b", "c")], "left string, right string")
    assert {(r.left, r.right) for r in rel.without_rejected(edges, rejected).collect()} == {("a", "b"), ("d", "e")}
    new = spark.createDataFrame([("x", "y", "m")], "left string, right string, method string")
    assert {r.left for r in rel.replace_edges(edges, "m", new).collect()} == {"d", "x"}


def test_rates_and_weights(spark):
    df = spark.createDataFrame([("s", "kept", "quality"), ("s", "REMOVED", "exact_duplicates"), ("s", "removed", "quality"), ("t", None, None)], "s string, status string, phase string")
    r = {x.s: x for x in agg.status_pivot(df, "s").collect()}
    assert (r["s"].kept, r["s"].removed_quality, r["s"].removed_duplicates, r["t"].total) == (1, 1, 1, 1)
    w = {x.s: x.weight for x in agg.class_weights(df, "s").collect()}
    assert w == {"s": round(4 / 6, 4), "t": 2.0}
    t = {x.s: (x.missing_max, x.missing_mean) for x in agg.balance_targets(df, "s").collect()}
    assert t == {"s": (0, 0), "t": (2, 1)}


def test_wilson(spark):
    low, high = one(spark.createDataFrame([(6, 6)], "k int, n int"), *agg.wilson(F.col("k"), F.col("n")))
    assert low == pytest.approx(0.60966, abs=1e-4) and high == pytest.approx(1)
    assert one(spark.createDataFrame([(0, 0)], "k int, n int"), *agg.wilson(F.col("k"), F.col("n")))[0] is None


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(120)]
    star = [("s000", f"s{i:03d}") for i in range(1, 60)]
    odd = [("x", "x"), (None, "y"), ("c000", "c001")]
    got = {r.v: r.component for r in components.components(spark.createDataFrame(chain + star + odd, "left string, right string")).collect()}
    assert len(got) == 181 and {got[f"c{i:03d}"] for i in range(121)} == {"c000"} and {got[f"s{i:03d}"] for i in range(60)} == {"s000"}
    assert components.components(spark.createDataFrame([], "left string, right string")).count() == 0


def test_bucket_neighbours_are_within_reach(spark):
    df = spark.createDataFrame([("k", f"{i:02d}") for i in range(30)], "b string, i string")
    got = {(int(r.left), int(r.right)) for r in ranking.bucket_neighbours(df, "b", "i", 3).collect()}
    assert got == {(i, j) for i in range(30) for j in range(i + 1, min(30, i + 4))}


def test_semantic_pairs_find_all_close_ones(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 32))
    x = np.concatenate([base, base + 0.15 * rng.standard_normal(base.shape)])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = {(i, j) for i in range(120) for j in range(i + 1, 120) if u[i] @ u[j] >= 0.9}
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, v array<float>")
    got = {(r.left, r.right) for r in duplicates.semantic_pairs(df, "id", "v", 0.9).collect()}
    assert want and len(got & want) >= 0.95 * len(want) and not got - want
    exact = {(min(r.query, r.other), max(r.query, r.other)) for r in duplicates.all_semantic_pairs(df, "id", "v", 0.9, df).collect()}
    assert exact == want


@pytest.mark.parametrize("size", [{}, {"block": 100}])
def test_semantic_pairs_lose_none_at_the_threshold(spark, size):
    import numpy as np

    rng = np.random.default_rng(11)
    a = rng.standard_normal((1000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal(a.shape)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.9005 * a + np.sqrt(1 - 0.9005**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    x = np.concatenate([a, b, np.zeros((2, 64))])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, v array<float>")
    got = [(r.left, r.right) for r in duplicates.semantic_pairs(df, "id", "v", 0.9, **size).collect()]
    assert sorted(got) == [(i, i + 1000) for i in range(1000)]


def assigned(spark, ranks, edges, fine=None, **options):
    """(replaced by, conflicts) of the operator for one component of string ids."""
    parts = spark.createDataFrame([(v, "c") for v in ranks], "v string, component string")
    links = spark.createDataFrame([(a, b, "e", ok) for a, b, ok in edges], "left string, right string, level string, compatible boolean")
    facts = spark.createDataFrame([(v, -r, "kept" if fine is None or fine[v] else "review") for v, r in ranks.items()], "sample_id string, area int, status string")
    rank = F.struct((-F.col("area")).alias("k0"), F.col("sample_id").alias("k12"))
    rows = representatives.assign(parts, links, facts, rank, **options).collect()
    assert sorted(r.sample_id for r in rows) == sorted(ranks)
    return {r.sample_id: r.representative_id for r in rows if r.representative_id}, {r.sample_id for r in rows if r.conflict}


def walked(ranks, edges, fine):
    """The same by a plain walk in rank order."""
    near, left, taken, conflicts = {}, set(ranks), {}, set()
    for a, b, ok in edges:
        near.setdefault(a, {})[b] = near.setdefault(b, {})[a] = ok
    for r in sorted(ranks, key=ranks.get):
        if r not in left or not fine[r]:
            continue
        left.discard(r)
        for v in sorted(near.get(r, {}), key=ranks.get):
            if v in left and near[r][v]:
                taken[v] = r
                left.discard(v)
            elif v in left:
                conflicts |= {r, v}
    conflicts |= left
    return {v: r for v, r in taken.items() if v not in conflicts and r not in conflicts}, conflicts


def test_representatives_have_direct_evidence(spark):
    chain = [(a, b, True) for a, b in ("ab", "bc", "cd")]
    assert assigned(spark, dict(zip("abcd", range(4))), chain) == ({"b": "a", "d": "c"}, set())
    # the best neighbour that becomes a representative, not the first that is known to be one
    edges = [("y", "x", True), ("x", "r", True), ("r", "v", True), ("s", "v", True)]
    assert assigned(spark, dict(zip("yxrsv", range(5))), edges, local_edges=0)[0] == {"x": "y", "v": "r"}


@pytest.mark.parametrize("local_edges", [0, 8, 500_000])
def test_representatives_are_those_of_a_walk(spark, local_edges):
    rng = np.random.default_rng(5)
    ranks, edges, fine = {}, [], {}
    for c in range(120):  # as parts of one table, so that all are settled together
        n = int(rng.integers(2, 9))
        for i, r in enumerate(rng.permutation(n)):
            ranks[f"{c}-{i}"], fine[f"{c}-{i}"] = 100 * c + int(r), rng.random() < 0.75
        edges += [(f"{c}-{i}", f"{c}-{j}", bool(rng.random() < 0.85)) for i in range(n) for j in range(i) if rng.random() < 0.4]
    assert assigned(spark, ranks, edges, fine, local_edges=local_edges) == walked(ranks, edges, fine)


def test_a_long_chain_is_settled_whole(spark):
    n = 5000
    ranks = {f"{i:05d}": i for i in range(n)}
    got, conflicts = assigned(spark, ranks, [(f"{i:05d}", f"{i + 1:05d}", True) for i in range(n - 1)])
    assert got == {f"{i:05d}": f"{i - 1:05d}" for i in range(1, n, 2)} and not conflicts


def test_equal_bytes_need_no_direct_edge_but_respect_rejections(spark):
    groups = spark.createDataFrame([(v, "c") for v in "abcd"], "v string, component string")
    facts = spark.createDataFrame([("a", 4), ("b", 3), ("c", 2), ("d", 1)], "sample_id string, area int")
    no = spark.createDataFrame([("c", "a"), ("d", "a")], "left string, right string")
    assert {(r.sample_id, r.representative_id) for r in representatives.assign_exact(groups, facts).collect()} == {(v, "a") for v in "bcd"}
    assert {(r.sample_id, r.representative_id) for r in representatives.assign_exact(groups, facts, no).collect()} == {("b", "a"), ("d", "c")}


def test_families_by_links_and_all_keys(spark):
    rows = [("a", "s", "g", None, None, None), ("b", "s", "g", None, None, None), ("c", "t", "g", None, None, None), ("d", "s", "NULL", "", "field", "k"), ("e", "s", "unknown", None, "field", None), ("f", "t", "NULL", None, "field", "K"), ("h", "s", "NULL", None, None, None), ("i", None, "g", None, None, None)]
    samples = spark.createDataFrame(rows, "sample_id string, source_dataset string, capture_group string, video_id string, location string, duplicate_cluster_id string")
    links = [("b", "c", "exact_bytes", None), ("c", "h", "human_confirmed", False), ("h", "c", "exact_bytes", True), ("a", "i", "candidate", False), ("a", "x", "exact_bytes", False)]
    got = {r.sample_id: r.group_id for r in duplicates.all_families(samples, spark.createDataFrame(links, "left_id string, right_id string, level string, rejected boolean")).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "d", "f": "d", "h": "h", "i": "i"}


def test_first_match_skips_nulls(spark):
    m = spark.createDataFrame([(None, None, None, None, None, float("nan"), 100.0, 90.0, 50.0), (False, False, False, False, False, 10.0, 100.0, 90.0, 50.0), (True, True, None, None, None, None, None, None, None)], "processing_error boolean, is_corrupted boolean, has_watermark boolean, low_resolution boolean, has_smearing boolean, blur_variance double, brightness_mean double, brightness_p95 double, brightness_p5 double")
    assert [r[0] for r in m.select(decisions.quality_rules().getField("reason")).collect()] == ["quality_ok", "severe_blur", "processing_error"]


def test_brake_keeps_hard_removals(spark):
    rows = [("a", "removed", 0.9, False), ("b", "removed", 0.99, False), ("c", "kept", 1.0, False)]
    df = spark.createDataFrame([(i, None, s, c, b) for i, s, c, b in rows], "id string, g string, status string, confidence double, before boolean")
    assert {r.id: r.status for r in decisions.ratio_brake(df, ["g"]).collect()} == {"a": "review", "b": "removed", "c": "kept"}


def test_merge_keeps_reasons_for_review(spark):
    schema = "sample_id string, status string, phase string, reason string, review_reasons array<string>"
    current = spark.createDataFrame([("a", "review", "quality", "blur", ["old"]), ("b", "kept", "quality", "ok", []), ("c", "kept", "quality", "ok", None)], schema)
    new = spark.createDataFrame([("a", "kept", "dups", "fine", []), ("b", "removed", "dups", "copy", None)], schema)
    got = {r.sample_id: (r.status, r.review_reasons) for r in decisions.merge(current, new).collect()}
    assert got == {"a": ("review", ["blur", "fine", "old"]), "b": ("removed", []), "c": ("kept", [])}


P = {"train": 0.8, "val": 0.1, "test": 0.1}


def test_allocation(spark):
    rows = spark.createDataFrame([(f"g{i}", "rare" if i % 5 == 0 else "common") for i in range(100) for _ in range(1 + i % 3)], "group_id string, label string")
    groups = splits.group_table(rows)
    for got in (splits.allocate(groups, P), splits.allocate(groups, P, large=10), splits.allocate(groups, P, walk_rows=40)):
        assert got.count() == 100 and got.select("group_id").distinct().count() == 100
        per = rows.join(got, "group_id").groupBy("label", "split").agg(F.count("*").alias("n")).collect()
        for label, total in (("rare", 39), ("common", 160)):
            sizes = {r.split: r.n for r in per if r.label == label}
            assert all(abs(sizes.get(s, 0) - total * q) <= 3 for s, q in P.items()), sizes  # groups have up to three rows
    with pytest.raises(ValueError):
        splits.allocate(groups, {"train": 0.5})
    assert splits.allocate(groups.limit(0), P).count() == 0


@pytest.mark.parametrize("options, size, off", [({}, 2000, 0.01), ({"walk_rows": 2000}, 2000, 0.01), ({}, 20_000, 0.035)])
def test_allocation_with_many_labels_and_a_large_group(spark, options, size, off):
    g = spark.range(30_000).select(F.concat(F.lit("g"), "id").alias("group_id"), F.explode(F.array_repeat(F.concat(F.lit("l"), F.floor(F.sqrt(F.col("id") * 30)).cast("string")), 2)).alias("label"))
    big = spark.range(size).select(F.lit("big").alias("group_id"), F.lit("l5").alias("label"))
    groups = splits.group_table(g.unionByName(big))
    got = splits.allocate(groups, P, **options)
    n = {r.split: r.n for r in groups.join(got, "group_id").groupBy("split").agg(F.sum("size").alias("n")).collect()}
    assert got.count() == 30_001 and all(abs(n[s] / (60_000 + size) - q) < off for s, q in P.items()), n
    assert got.filter("group_id = 'big'").first().split == "train"


def test_a_hot_class_is_dealt_in_runs(spark):
    keyed = spark.range(1000).select(F.col("id").alias("group_id"), F.lit("c").alias("class"))
    classes = spark.createDataFrame([("c", 1000)], "class string, n long")
    quotas = spark.createDataFrame([("c", [800, 101, 99])], "class string, quota array<long>")
    got = splits._dealt(keyed, classes, quotas, list(P), run=90)
    assert {r["split"]: r["count"] for r in got.groupBy("split").count().collect()} == {"train": 800, "val": 101, "test": 99}


def test_reconcile(spark):
    a = spark.createDataFrame([("g1", "test"), ("g2", "train"), ("g3", "val")], "group_id string, split string")
    pairs = spark.createDataFrame([("g1", "g2")], "left string, right string")
    assert {r.group_id: r.split for r in splits.reconcile(a, pairs).collect()} == {"g1": "train", "g2": "train", "g3": "val"}


def test_oversampling_uses_parents_evenly(spark):
    parents = spark.createDataFrame([("x", f"p{i}") for i in range(4)], "label string, sample_id string")
    plan = balance.oversample_plan(parents, spark.createDataFrame([("x", 10), ("y", 3)], "label string, missing long"), "label").collect()
    assert len(plan) == 10 and len({r.synthetic_id for r in plan}) == 10
    assert sorted(sum(r.parent_sample_id == f"p{i}" for r in plan) for i in range(4)) == [2, 2, 3, 3]


def test_ontology():
    flat = labels.flatten_ontology({"classes": {"rust": ["roya", "oxido"], "rot": "podre"}, "coarse_mapping": {"sick": ["rust", "rot"]}})
    assert ("roya", "rust", "sick") in flat
    with pytest.raises(ValueError):
        labels.flatten_ontology({"classes": {"a": ["x"], "b": ["x"]}})
    with pytest.raises(ValueError):
        labels.flatten_ontology({"classes": {"a": []}})


def test_label_pairs(spark):
    df = spark.createDataFrame([("leaf_spot", 9), ("leaf_spots", 2), ("ripe", 5), ("unripe", 5), ("leaf_rust", 3)], "l string, n long")
    got = {(r.left, r.right): (r.category, r.merge, r.canonical) for r in labels.label_pairs(df, "l", "n").collect()}
    assert got[("leaf_spot", "leaf_spots")][1:] == (True, "leaf_spot") and got[("ripe", "unripe")][:2] == ("lifecycle_stage", False)


@pytest.mark.parametrize("label, coarse", [("termite", "termite"), ("tempest", "tempest"), ("moldova", "moldova"), ("unhealthy", "sano"), ("Leaf Rust", "enfermo"), ("hoja sana", "sano"), ("mite", "enfermo"), ("kent", "kent")])
def test_coarse_labels_go_by_whole_words(spark, label, coarse):
    df = spark.createDataFrame([(label,)], "l string")
    assert one(df, tx.coarse_label(F.col("l")))[0] == coarse
    assert one(df, tx.coarse_label(F.col("l"), F.lit(True)))[0] == (coarse if coarse in ("sano", "enfermo") else "enfermo")


def test_label_phase_merges_and_renames(spark):
    rows = [("a", "s", "Leaf Spot", ["leaf_spot", "lef spot"]), ("b", "s", "leaf-spot", []), ("c", "t", "lef spot", None), ("d", "t", None, []), ("e", "t", "unripe", []), ("f", "t", "ripe", [])]
    df = spark.createDataFrame([(i, s, l, None if b is None else [(x,) for x in b]) for i, s, l, b in rows], "sample_id string, source_dataset string, source_label string, boxes array<struct<label:string>>")
    out, mapping = labels.label_phase(df)
    got = {r.sample_id: (r.normalized_label, r.normalized_labels) for r in out.collect()}
    assert got["a"] == ("leaf_spot", ["leaf_spot"]) and got["c"][0] == "leaf_spot" and got["d"] == (None, []) and got["e"][0] == "unripe"
    assert [b.label for b in out.filter("sample_id = 'a'").first().boxes] == ["leaf_spot", "leaf_spot"]
    text = labels.proposed_ontology(mapping, labels.label_counts(df))
    assert '"leaf_spot":' in text and '"lef spot"  # s: 1, t: 1' in text
    own = spark.createDataFrame([("Leaf Spot", "mancha")], "raw string, canonical string")
    assert labels.label_phase(df, own)[0].filter("sample_id = 'a'").first().normalized_label == "mancha"
    with pytest.raises(ValueError):
        labels.cleaning_tool("on")


def test_label_pairs_are_those_of_all_pairs(spark):
    import difflib
    import random

    rng = random.Random(4)
    words = {"mould", "mold", "rust", "rast", "a", "a_b", "s", "es"} | {"".join(rng.choice("abcd_") for _ in range(rng.randint(2, 9))) for _ in range(150)}
    df = spark.createDataFrame([(w, 1) for w in sorted(words)], "l string, n long")
    got = {(r.left, r.right): r for r in labels.label_pairs(df, "l", "n").collect()}
    assert got["mold", "mould"].merge and got["mold", "mould"].ratio == 0.888889 and ("rast", "rust") in got
    from millrace.operators.labels import stem_of
    stem = {r.l: r.s for r in df.select("l", stem_of(F.col("l")).alias("s")).collect()}
    ratio = lambda a, b: difflib.SequenceMatcher(None, a, b).ratio()
    want = {(a, b) for a in words for b in words if a < b and round(max(ratio(a, b), ratio(stem[a], stem[b])), 6) >= 0.75}
    assert want == {k for k, r in got.items() if r.ratio >= 0.75} and ("a", "a_b") in got


def test_nan_is_unknown(spark):
    df = spark.createDataFrame([(float("nan"), 2.0), (None, None)], "a double, b double")
    assert [r[0] for r in df.select(rel.first_known(F.col("a"), F.col("b"), default=-1)).collect()] == [2.0, -1.0]
    assert not math.isnan(-1.0)


@pytest.mark.parametrize("block_bytes", [64 << 20, 1])
def test_mislabelled_vectors(spark, block_bytes):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((4, 8))
    rows = [(i, int(i % 4), [float(v) for v in centres[i % 4] + 0.05 * rng.standard_normal(8)]) for i in range(80)]
    rows += [(100, 0, [float(v) for v in centres[3]]), (101, None, [1.0] * 8), (102, 1, [0.0] * 8), (103, 1, None), (104, 1, [1.0])]
    df = spark.createDataFrame(rows, "id long, label int, v array<double>")
    got = duplicates.mislabelled(df, agg.centroids(df.filter("size(v) = 8"), "label", "v"), "id", "label", "v", block_bytes=block_bytes).collect()
    assert [(r.id, r.label, r.nearer) for r in got] == [(100, 0, 3)]
    assert duplicates.mislabelled(df.limit(0), agg.centroids(df.limit(0), "label", "v"), "id", "label", "v").count() == 0
