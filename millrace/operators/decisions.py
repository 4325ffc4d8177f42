"""Ordered rules, merging of records with history, and ratio limits of groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_match(rules: Sequence[tuple[Column, str, str, float]], otherwise: tuple[str, str, float]) -> Column:
    """(status, reason, confidence) of the first rule that holds; a null condition doesn't hold."""
    out = None
    for condition, status, reason, confidence in rules:
        value = F.struct(F.lit(status).alias("status"), F.lit(reason).alias("reason"), F.lit(confidence).alias("confidence"))
        out = F.when(condition, value) if out is None else out.when(condition, value)
    status, reason, confidence = otherwise
    last = F.struct(F.lit(status).alias("status"), F.lit(reason).alias("reason"), F.lit(confidence).alias("confidence"))
    return last if out is None else out.otherwise(last)


def quality_rules(severe: float = 15, review: float = 25, dark: float = 18, bright: float = 245, dark_p95: float = 45, bright_p5: float = 210, annotations: Column | None = None) -> Column:
    """The cascade over metric columns; metrics that are null or NaN skip their rule.

    ``annotations``, if given, says whether a sample's annotations are valid (null is valid).
    """
    c = F.col
    blur, mean = F.nanvl("blur_variance", F.lit(None).cast("double")), c("brightness_mean")
    rules = [
        (c("processing_error"), "review", "processing_error", 1.0),
        *([(~annotations, "review", "invalid_annotations", 1.0)] if annotations is not None else []),
        (c("is_corrupted"), "removed", "corrupted", 1.0),
        (c("has_watermark"), "removed", "watermark", 0.99),
        (c("low_resolution"), "removed", "low_resolution", 0.98),
        (c("has_smearing"), "removed", "smearing", 0.92),
        ((blur >= 0) & (blur < severe), "removed", "severe_blur", 0.94),
        ((blur >= 0) & (blur < review), "review", "blur", 0.72),
        ((mean < dark) | (mean > bright), "removed", "brightness", 0.90),
        ((c("brightness_p95") < dark_p95) | (c("brightness_p5") > bright_p5), "review", "exposure", 0.70),
    ]
    return first_match(rules, ("kept", "quality_ok", 1.0))


#: Evidence that proves equal content, and the confidence from which a removal is hard.
EXACT = ("exact_bytes", "exact_pixels")
HARD = 0.98
STATE_TAGS = ("curation_kept", "curation_review", "curation_removed")
FIELDS = ("status", "phase", "reason", "confidence", "keep_reason", "cluster_id", "representative_id", "evidence_level", "review_reasons")


def _column(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def ratio_brake(decisions: DataFrame, groups: Sequence[str], phase_limit: float = 0.40, total_limit: float = 0.65, hard: float = HARD) -> DataFrame:
    """Soft removals of a group turn into reviews where too large a part of the group would go.

    ``decisions`` has status, confidence and ``before`` (removed earlier). A removal is soft below
    ``hard``, and in a phase of duplicates without exact evidence (columns ``phase`` and
    ``evidence_level``, if there are any). Its reason gets the prefix ``second_opinion_``. Group totals
    come from an aggregate that is joined back, so a group of a third of all rows doesn't end in one task.
    """
    removed = F.coalesce(F.col("status") == "removed", F.lit(False))
    totals = decisions.groupBy(*groups).agg(F.count("*").alias("_n"), F.count_if(removed).alias("_p"), F.count_if(F.coalesce("before", F.lit(False))).alias("_b"))
    over = (F.col("_p") / F.col("_n") > phase_limit) | ((F.col("_b") + F.col("_p")) / F.col("_n") > total_limit)
    on = [decisions[g].eqNullSafe(totals[g]) for g in groups]
    out = decisions.join(totals, on, "left").drop(*(totals[g] for g in groups))
    unproven = F.coalesce(_column(decisions, "phase").endswith("duplicates"), F.lit(False)) & ~F.coalesce(_column(decisions, "evidence_level").isin(*EXACT), F.lit(False))
    soft = removed & ((F.coalesce("confidence", F.lit(0.0)) < hard) | unproven) & over
    out = out.withColumn("braked", soft).withColumn("status", F.when(soft, "review").otherwise(F.col("status"))).drop("_n", "_p", "_b")
    if "reason" in decisions.columns:
        out = out.withColumn("reason", F.when(F.col("braked"), F.concat(F.lit("second_opinion_"), F.coalesce("reason", F.lit("")))).otherwise(F.col("reason")))
    return out


def merge(current: DataFrame, new: DataFrame, key: str = "sample_id", prefix: str | None = None, at: Column | None = None) -> DataFrame:
    """New decisions over current ones; samples without a new one stay as they are.

    A current review keeps its reasons: only a removal of the same phase by exact evidence settles the
    reason it names and the current one, and while others are left the sample stays in review. A new
    review adds its own reason. Reasons are sorted and distinct. With ``prefix``, state tags are replaced
    and ``<prefix>_<reason>`` is added to ``tags``, and what changed is appended to ``history`` with ``at``.
    """
    have = [c for c in FIELDS if c in current.columns or c in new.columns]
    kinds = {f.name: f.dataType for f in (*new.schema.fields, *current.schema.fields)}
    fill = lambda df: df.select("*", *(F.lit(None).cast(kinds[c]).alias(c) for c in have if c not in df.columns))
    current, new = fill(current), fill(new)
    n = new.select(key, *(F.col(c).alias(f"n_{c}") for c in have), F.lit(True).alias("_new"))
    out = current.join(n, key, "left")
    none = F.array().cast("array<string>")
    get = lambda c: F.col(c) if c in out.columns else F.lit(None).cast("string")
    said = lambda c: F.when(F.coalesce(get(c), F.lit("")) != "", F.array(get(c))).otherwise(none)
    before = F.when(F.lower("status") == "review", F.concat(F.coalesce(get("review_reasons").cast("array<string>"), none), said("reason"))).otherwise(none)
    settled = F.coalesce((get("phase") == get("n_phase")) & get("n_evidence_level").isin(*EXACT) & (F.lower("n_status") == "removed"), F.lit(False))
    before = F.when(settled, F.array_except(before, F.concat(said("reason"), said("n_reason")))).otherwise(before)
    own = F.coalesce(get("n_review_reasons").cast("array<string>"), none)
    both = F.when(F.lower("status") == "review", F.concat(own, before)).otherwise(own)
    kept = F.coalesce(F.lower("status") == "review", F.lit(False)) & (F.size(both) > 0) & (F.lower("n_status") != "review")
    status = F.when(kept, "review").otherwise(F.lower("n_status"))
    reasons = F.when(status == "review", F.concat(both, said("n_reason"))).otherwise(both)
    reasons = F.array_sort(F.array_distinct(F.filter(reasons, lambda r: r.isNotNull())))
    new_ = F.coalesce("_new", F.lit(False))
    values = {c: F.when(new_, F.col(f"n_{c}")).otherwise(F.col(c)) for c in have}
    values["status"] = F.when(new_, status).otherwise(F.col("status"))
    values["review_reasons"] = F.when(new_, reasons).otherwise(F.coalesce(get("review_reasons").cast("array<string>"), none))
    rest = [c for c in current.columns if c not in (key, *have, "tags", "history")]
    done = out.select(key, *rest, *(v.alias(c) for c, v in values.items()), *(c for c in ("tags", "history") if c in current.columns), F.struct(*(F.col(c) for c in have)).alias("_before"), new_.alias("_changed"), *(F.col(c).alias(f"_{c}") for c in ("n_reason",)))
    if prefix is not None and "tags" in current.columns:
        old = F.coalesce("tags", none)
        tags = F.array_except(old, F.array(*map(F.lit, STATE_TAGS)))
        tags = F.array_sort(F.array_distinct(F.concat(tags, F.array(F.concat(F.lit("curation_"), "status"), F.concat(F.lit(f"{prefix}_"), F.coalesce("_n_reason", F.lit("")))))))
        done = done.withColumn("_tags", old).withColumn("tags", F.when(F.col("_changed"), tags).otherwise(F.col("tags")))
        if "history" in current.columns:
            done = append_history(done, have, prefix, at)
        done = done.drop("_tags")
    return done.drop("_before", "_changed", "_n_reason")


HISTORY = "array<struct<at:timestamp,action:string,before:string,after:string>>"


def append_history(rows: DataFrame, fields: Sequence[str], action: str, at: Column | None = None) -> DataFrame:
    """rows with ``_before`` (fields as they were) and ``_tags``: one entry more in ``history`` where
    fields or tags differ now; before and after are JSON."""
    was, now = F.to_json(F.struct(F.col("_before").alias("curation"), F.col("_tags").alias("tags"))), F.to_json(F.struct(F.struct(*(F.col(c) for c in fields)).alias("curation"), "tags"))
    entry = F.array(F.struct((at if at is not None else F.current_timestamp()).cast("timestamp").alias("at"), F.lit(action).alias("action"), was.alias("before"), now.alias("after")))
    old = F.coalesce(F.col("history").cast(HISTORY), F.array().cast(HISTORY))
    return rows.withColumn("history", F.when(was != now, F.concat(old, entry.cast(HISTORY))).otherwise(old))


def quality_phase(samples: DataFrame, rules: Column, groups: Sequence[str] = ("source_dataset", "source_label"), phase_limit: float = 0.40, total_limit: float = 0.65) -> DataFrame:
    """(sample_id, status, phase, reason, confidence, braked) of samples that aren't removed yet: the
    rules, then the brake. samples(sample_id, groups, status, metrics ...)."""
    gone = F.coalesce(F.lower("status") == "removed", F.lit(False))
    judged = samples.select("*", gone.alias("before"), rules.alias("_r"))
    judged = judged.select("sample_id", *groups, "before", *(F.when(~F.col("before"), F.col(f"_r.{c}")).alias(c) for c in ("status", "reason", "confidence")), F.lit("quality").alias("phase"))
    return ratio_brake(judged, groups, phase_limit, total_limit).filter("not before").select("sample_id", "status", "phase", "reason", "confidence", "braked")


def history(events: DataFrame, key: str, at: str, *columns: str) -> DataFrame:
    """Consecutive states that differ: (key, at, before, after)."""
    state = F.to_json(F.struct(*columns))
    before = F.lag(state).over(W.partitionBy(key).orderBy(at, state))
    return events.select(key, at, before.alias("before"), state.alias("after")).filter("before is null or before <> after")


def reconcile(assigned: DataFrame, decisions: DataFrame) -> DataFrame:
    """Replaced samples whose representative isn't kept, with its status."""
    of = decisions.select(F.col("sample_id").alias("representative_id"), F.lower("status").alias("representative_status"))
    return assigned.join(of, "representative_id", "left").filter(F.coalesce(F.col("representative_status") != "kept", F.lit(True)))
