"""Duplicates and people: what is replaced, what a person has to look at, and what a person said."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.decisions import EXACT, HARD, merge, ratio_brake
from millrace.operators.relational import tag_conflicts
from millrace.storage import stage

#: Task types whose geometry isn't compared, and keys of a box that say nothing of its content.
UNCOMPARED = ("segmentation", "keypoints")
PRIVATE = ("_id", "_cls", "label", "bounding_box", "blur_variance", "source_label", "source_field")


def turned(box: list[float], transform: str) -> tuple[float, ...]:
    """A unit box (x, y, w, h) under one of the eight symmetries, to five decimals."""
    x, y, w, h = box
    if transform.startswith("mirror_"):
        x = 1 - x - w
    for _ in range(int(transform.rsplit("r", 1)[1]) // 90):
        x, y, w, h = y, 1 - x - w, h, w
    return tuple(round(v, 5) for v in (x, y, w, h))


def signature(task: str | None, labels: list[str] | None, boxes: list[dict] | None, transform: str = "r0"):
    """What two annotations are compared by, or None where they can't be."""
    tasks = set((task or "unlabeled").split(","))
    if tasks & set(UNCOMPARED) or any(b.get("mask") is not None for b in boxes or []):
        return None
    out = [(b.get("label"), turned(b["bounding_box"], transform), {k: v for k, v in b.items() if k not in PRIVATE and k != "mask"}) for b in boxes or []]
    return ",".join(sorted(tasks)), tuple(sorted(set(labels or []))), sorted(out, key=lambda b: (str(b[0]), b[1], json.dumps(b[2], sort_keys=True, default=str)))


def compatible(left: tuple, right: tuple, transform: str | None = "r0") -> bool:
    """Whether a representative's annotations say all that the other's do: the same task and labels,
    and for each box one of the same label and place that has all of its attributes."""
    a, b = signature(*left), signature(*right, transform or "r0")
    if a is None or b is None or a[:2] != b[:2] or len(a[2]) != len(b[2]):
        return False
    free = list(a[2])
    for label, box, attributes in b[2]:
        at = next((i for i, (m, o, own) in enumerate(free) if m == label and o == box and all(k in own and own[k] == v for k, v in attributes.items())), None)
        if at is None:
            return False
        free.pop(at)
    return True


def mark_compatible(edges: DataFrame, annotations: DataFrame) -> DataFrame:
    """edges with ``compatible``: annotations(sample_id, task_type, labels, boxes), where boxes is a JSON
    array of objects. The transform of an edge turns its right end's boxes onto its left end's; a sample
    without annotations has no label and no boxes. As edges have two directions, both must hold."""
    of = lambda s: annotations.select(F.col("sample_id").alias(s), *(F.col(c).alias(f"{s}_{c}") for c in ("task_type", "labels", "boxes")))
    met = edges.join(of("left"), "left", "left").join(of("right"), "right", "left")

    @F.pandas_udf("boolean")
    def judge(t1: pd.Series, l1: pd.Series, b1: pd.Series, t2: pd.Series, l2: pd.Series, b2: pd.Series, turn: pd.Series) -> pd.Series:
        read = lambda t, l, b: (t, None if l is None else list(l), json.loads(b) if b else [])  # noqa: E731, E741
        return pd.Series([compatible(read(a, b, c), read(d, e, f), g) for a, b, c, d, e, f, g in zip(t1, l1, b1, t2, l2, b2, turn)])

    ok = judge("left_task_type", "left_labels", "left_boxes", "right_task_type", "right_labels", "right_boxes", F.coalesce("transform", F.lit("r0")))
    return met.withColumn("compatible", ok).select(*edges.columns, "compatible")


def richness(boxes: Column) -> Column:
    """How many attributes with a value the boxes (a JSON array) have: more of them make a better copy."""

    @F.pandas_udf("int")
    def count(values: pd.Series) -> pd.Series:
        return values.map(lambda t: sum(v not in (None, {}, []) for b in json.loads(t or "[]") for k, v in b.items() if k not in PRIVATE))

    return count(boxes)


def duplicate_decisions(assignments: DataFrame, samples: DataFrame, phase: str, reason: str, status: str = "removed", confidence: float = 1.0) -> DataFrame:
    """Decisions for replaced samples. assignments(sample_id, representative_id, level, conflict).

    What is removed already or was decided by a person is left alone. Without exact evidence, a
    representative and valid annotations a removal becomes a review. Conflicts are always reviews.
    """
    own = assignments.join(samples.select("sample_id", F.lower("status").alias("_s"), F.col("phase").alias("_p"), *([F.col("annotation_valid").alias("_v")] if "annotation_valid" in samples.columns else [F.lit(True).alias("_v")])), "sample_id", "left")
    own = own.filter("coalesce(_s <> 'removed', true) and coalesce(_p <> 'human_review', true) and (representative_id is not null or conflict)")
    exact = F.coalesce(F.col("level").isin(*EXACT), F.lit(False))
    rep = F.coalesce("representative_id", F.lit(""))
    clear = exact & (rep != "") & F.coalesce("_v", F.lit(True)) if status == "removed" else F.coalesce("_v", F.lit(True))
    conflict = F.coalesce("conflict", F.lit(False))
    state = F.when(conflict, "review").when(clear, status).otherwise("review")
    keep = F.when(conflict, "annotation_conflict_requires_human_review").when((state == "removed") & (rep != ""), F.concat(F.lit("duplicate_of:"), rep)).otherwise("potential_duplicate_requires_human_review")
    return own.select(
        "sample_id", state.alias("status"), F.when(conflict, "annotation_duplicates").otherwise(phase).alias("phase"), F.when(conflict, "label_conflict_between_duplicates").otherwise(reason).alias("reason"),
        F.when(conflict | exact, 1.0).otherwise(F.least(F.lit(confidence), F.lit(0.85))).alias("confidence"), keep.alias("keep_reason"), rep.alias("representative_id"), F.coalesce("level", F.lit("candidate")).alias("evidence_level"),
    )


def reconcile_decisions(samples: DataFrame) -> DataFrame:
    """Reviews for removed samples whose representative isn't kept. samples(sample_id, status, representative_id)."""
    of = samples.select(F.col("sample_id").alias("representative_id"), F.lower("status").alias("_r"))
    gone = samples.filter("lower(status) = 'removed' and representative_id <> ''").select("sample_id", "representative_id").join(of, "representative_id", "left")
    lost = gone.filter("coalesce(_r <> 'kept', true)")
    return lost.select("sample_id", F.lit("review").alias("status"), F.lit("consistency_duplicates").alias("phase"), F.lit("representative_pending_review").alias("reason"), F.lit(0.0).alias("confidence"), "representative_id")


def run_duplicate_phase(samples: DataFrame, assignments: DataFrame, phase: str, groups: tuple[str, ...] = ("source_dataset", "source_label"), status: str = "removed", phase_limit: float = 0.40, total_limit: float = 0.65) -> DataFrame:
    """samples after one duplicate phase: decisions, brake, merge, then representatives that went."""
    new = duplicate_decisions(assignments, samples, phase, "duplicate", status)
    whole = samples.select("sample_id", *groups, (F.lower("status") == "removed").alias("before")).join(new, "sample_id", "left")
    braked = ratio_brake(whole, groups, phase_limit, total_limit, HARD).filter("status is not null").drop(*groups, "before", "braked")
    after = stage(merge(samples, braked, prefix=phase), "phase")
    return merge(after, reconcile_decisions(after), prefix="consistency_duplicates")


def run_duplicate_phases(samples: DataFrame, phases: list[tuple[str, DataFrame]], **options) -> DataFrame:
    """The phases (name, assignments) one after the other; a name that comes again, or no assignments
    table, is an error before anything is decided."""
    names = [n for n, _ in phases]
    if len(set(names)) != len(names) or any(a is None for _, a in phases):
        raise ValueError("each phase needs a name of its own and its assignments")
    for name, assignments in phases:
        samples = run_duplicate_phase(samples, assignments, name, **options)
    return samples


def reset_duplicates(samples: DataFrame, baseline: DataFrame, phase: str | None = None) -> DataFrame:
    """samples as they were before a duplicate phase (or all of them), where that phase decided last.

    baseline(sample_id, decision fields) is the snapshot from before. What a person decided stays; tags
    of the phase go, and the state's tag is set anew.
    """
    fields = [c for c in baseline.columns if c != "sample_id" and c in samples.columns]
    out = samples.join(baseline.select("sample_id", *(F.col(c).alias(f"b_{c}") for c in fields), F.lit(True).alias("_has")), "sample_id", "left")
    mine = (F.col("phase") == phase) if phase else F.coalesce(F.col("phase").endswith("duplicates"), F.lit(False))
    human = F.coalesce(F.col("phase") == "human_review", F.lit(False))
    back = F.coalesce(mine & ~human & F.col("_has"), F.lit(False))
    done = out.select("*", back.alias("_back"), human.alias("_human"))
    restored = done.select(*(F.when(F.col("_back"), F.col(f"b_{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in samples.columns), "_human")
    if "tags" in samples.columns:
        prefixes = (f"{phase}_", "curation_") if phase else ("exact_duplicates_", "semantic_duplicates_", "augmentation_duplicates_", "consistency_duplicates_", "redundant_", "curation_")
        keep = F.filter(F.coalesce("tags", F.array().cast("array<string>")), lambda t: ~_starts(t, prefixes))
        fresh = F.array_sort(F.array_distinct(F.concat(keep, F.array(F.concat(F.lit("curation_"), F.coalesce(F.lower("status"), F.lit("kept")))))))
        restored = restored.withColumn("tags", F.when(F.col("_human"), F.col("tags")).otherwise(fresh))
    return restored.drop("_human")


def _starts(text: Column, prefixes: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | text.startswith(p)
    return out


def check_reviews(reviews: DataFrame, samples: DataFrame) -> DataFrame:
    """(left, right, decision) of a person's pair reviews, each unordered pair once; raises if a pair
    has an unknown or equal end, another decision than confirm or reject, or both."""
    pairs = reviews.select(F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right"), "decision", (F.col("left").isNotNull() & F.col("right").isNotNull() & (F.col("left") != F.col("right")) & F.col("decision").isin("confirm", "reject")).alias("fine"))
    bad = pairs.filter("not coalesce(fine, false)").count()
    ids = samples.select("sample_id").distinct()
    ends = pairs.select(F.explode(F.array("left", "right")).alias("sample_id")).filter("sample_id is not null").distinct()
    bad += ends.join(ids, "sample_id", "left_anti").count()
    once = pairs.groupBy("left", "right").agg(F.min("decision").alias("decision"), F.count_distinct("decision").alias("n"))
    twice = once.filter("n > 1").count()
    if bad or twice:
        raise ValueError(f"{bad} reviewed pairs are invalid, {twice} contradict each other")
    return once.drop("n")


def review_pairs(reviews: DataFrame, samples: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(links, decisions, transitions) after a person confirmed or rejected pairs.

    The person's earlier word on a pair is replaced, other methods' links stay, so a review can be
    taken back. A sample that a now rejected partner replaced is opened for review. transitions(left,
    right, before, after) are the pairs whose word changed.
    """
    own = stage(check_reviews(reviews, samples), "reviews")
    norm = links.select(*(F.least("left_id", "right_id").alias(c) if c == "left_id" else F.greatest("left_id", "right_id").alias(c) if c == "right_id" else F.col(c) for c in links.columns))
    said = norm.filter("method = 'human_review'").groupBy(F.col("left_id").alias("left"), F.col("right_id").alias("right")).agg(F.when(F.max(F.coalesce("rejected", F.lit(False))), "reject").otherwise("confirm").alias("before"))
    changed = own.join(said, ["left", "right"], "left").filter("before is null or before <> decision").select("left", "right", "before", F.col("decision").alias("after"))
    reviewed = own.select(F.col("left").alias("left_id"), F.col("right").alias("right_id"), F.lit("human_review").alias("method"))
    kept = norm.join(reviewed, ["left_id", "right_id", "method"], "left_anti").select(*links.columns)
    new = {"left_id": F.col("left"), "right_id": F.col("right"), "method": F.lit("human_review"), "level": F.lit("human_confirmed"), "rejected": F.col("decision") == "reject"}
    added = own.select(*(new.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in links.schema.fields))
    no = own.filter("decision = 'reject'")
    both = no.select(F.col("left").alias("sample_id"), F.col("right").alias("representative_id")).unionByName(no.select(F.col("right").alias("sample_id"), F.col("left").alias("representative_id")))
    opened = samples.select("sample_id", "representative_id").join(both, ["sample_id", "representative_id"], "left_semi").select("sample_id").distinct()
    decisions = opened.select("sample_id", F.lit("review").alias("status"), F.lit("human_review").alias("phase"), F.lit("duplicate_relation_rejected").alias("reason"), F.lit(1.0).alias("confidence"))
    return kept.unionByName(added), decisions, changed


def sync_manual(samples: DataFrame, all_resolved: bool = True) -> DataFrame:
    """Decisions from the tags ``kept`` and ``removed`` that people set. Raises, before anything is
    decided, if a sample has both or (``all_resolved``) a review has neither."""
    kept, removed = samples.filter(F.array_contains("tags", "kept")), samples.filter(F.array_contains("tags", "removed"))
    both = tag_conflicts(samples, "kept", "removed").count()
    if both:
        raise ValueError(f"{both} samples are tagged both kept and removed")
    left = unresolved(samples).count()
    if all_resolved and left:
        raise ValueError(f"{left} samples are still in review")
    of = lambda df, status, reason: df.select("sample_id", F.lit(status).alias("status"), F.lit("human_review").alias("phase"), F.lit(reason).alias("reason"), F.lit(1.0).alias("confidence"), F.lit("").alias("representative_id"), F.lit("human_review").alias("evidence_level"), F.array().cast("array<string>").alias("review_reasons"))
    return of(kept, "kept", "hitl_approved").unionByName(of(removed, "removed", "hitl_rejected")).distinct()


def unresolved(samples: DataFrame) -> DataFrame:
    """Reviews that people tagged neither kept nor removed."""
    tags = F.coalesce("tags", F.array().cast("array<string>"))
    return samples.filter((F.lower("status") == "review") & ~F.array_contains(tags, "kept") & ~F.array_contains(tags, "removed")).select("sample_id").distinct()


def audit_representatives(samples: DataFrame, evidence: DataFrame | None = None) -> DataFrame:
    """(sample_id, problem) of removed samples that no kept sample stands for; must be empty.

    ``evidence``(left, right, level, compatible) is a fresh verification of (representative, sample):
    if it is given, a removal also needs exact and compatible evidence now.
    """
    own = samples.filter("lower(status) = 'removed'").select("sample_id", "phase", F.coalesce("representative_id", F.lit("")).alias("representative_id"))
    of = samples.select(F.col("sample_id").alias("representative_id"), F.lower("status").alias("_r")).dropDuplicates(["representative_id"])
    met = own.join(of, "representative_id", "left")
    problem = F.when((F.col("representative_id") == "") & F.coalesce(F.col("phase").endswith("duplicates"), F.lit(False)), "no_representative").when((F.col("representative_id") != "") & F.coalesce(F.col("_r") != "kept", F.lit(True)), "representative_not_kept")
    if evidence is not None:
        fine = evidence.filter(F.col("level").isin(*EXACT) & F.coalesce("compatible", F.lit(True))).select(F.col("left").alias("representative_id"), F.col("right").alias("sample_id"), F.lit(True).alias("_fine")).distinct()
        met = met.join(fine, ["representative_id", "sample_id"], "left")
        problem = problem.when((F.col("representative_id") != "") & F.col("_fine").isNull(), "evidence_outdated")
    return met.withColumn("problem", problem).filter("problem is not null").select("sample_id", "problem").distinct()


def apply_stored(samples: DataFrame, assignments: DataFrame, evidence: DataFrame, phase: str, **options) -> DataFrame:
    """samples after stored assignments were applied, if they still hold.

    ``evidence``(left, right, level, compatible) is a verification of every (representative, sample) as
    their files are now. If one removal is no longer exact and compatible, or its representative isn't
    kept, nothing is decided and an error says how many.
    """
    new = duplicate_decisions(assignments, samples, phase, "duplicate").filter("status = 'removed'").select("sample_id", "representative_id")
    fine = evidence.filter(F.col("level").isin(*EXACT) & F.coalesce("compatible", F.lit(True))).select(F.col("left").alias("representative_id"), F.col("right").alias("sample_id"))
    kept = samples.filter("lower(status) = 'kept'").select(F.col("sample_id").alias("representative_id"))
    gone = new.count() - new.join(fine, ["representative_id", "sample_id"], "left_semi").join(kept, "representative_id", "left_semi").count()
    if gone:
        raise ValueError(f"content, annotations or representative of {gone} samples have changed; detect again")
    return run_duplicate_phase(samples, assignments, phase, **options)
