"""Who stands for whom in duplicate groups: a walk in rank order, spread over components and rounds."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.storage import drop, stage

NODE = "v string, state string, representative string, level string, transform string"


def keep_rank(df: DataFrame, key: str = "sample_id") -> Column:
    """The twelve keys of the best copy and its id, as one struct whose least value is the best.

    Columns that ``df`` doesn't have don't distinguish its rows; null flags count as false, a null
    ``annotation_valid`` as true.
    """
    flag = lambda c: F.coalesce(F.col(c).cast("boolean"), F.lit(False)).cast("int") if c in df.columns else F.lit(0)
    number = lambda c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(0.0)) if c in df.columns else F.lit(0.0)
    status = F.lower("status") if "status" in df.columns else F.lit("kept")
    invalid = (~F.coalesce(F.col("annotation_valid"), F.lit(True))).cast("int") if "annotation_valid" in df.columns else F.lit(0)
    path = F.lower(F.coalesce("filepath", F.lit(""))) if "filepath" in df.columns else F.lit("")
    return F.struct(
        F.coalesce((status == "removed").cast("int"), F.lit(0)).alias("k0"),
        F.coalesce((status == "review").cast("int"), F.lit(0)).alias("k1"),
        flag("is_corrupted").alias("k2"),
        invalid.alias("k3"),
        flag("has_watermark").alias("k4"),
        flag("has_smearing").alias("k5"),
        flag("low_resolution").alias("k6"),
        (-number("richness")).alias("k7"),
        (-number("area")).alias("k8"),
        (-number("sharpness")).alias("k9"),
        number("padding").alias("k10"),
        path.rlike(r"\.rf\.|_aug|augmentation").cast("int").alias("k11"),
        F.col(key).cast("string").alias("k12"),
    )


def eligible(df: DataFrame) -> Column:
    """Whether a sample may stand for others: kept, not corrupted, measured and with valid annotations."""
    fine = F.lit(True)
    if "status" in df.columns:
        fine = fine & F.coalesce(F.lower("status") == "kept", F.lit(False))
    for c in ("is_corrupted", "processing_error"):
        if c in df.columns:
            fine = fine & ~F.coalesce(F.col(c), F.lit(False))
    if "annotation_valid" in df.columns:
        fine = fine & F.coalesce(F.col("annotation_valid"), F.lit(True))
    return fine


def _walk(nodes: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
    """The walk over whole components: nodes(v, state, eligible, k0..), near(v, u, level, transform)."""
    keys = [c for c in nodes.columns if c.startswith("k") and c[1:].isdigit()]
    nodes = nodes.sort_values(sorted(keys, key=lambda c: int(c[1:])), kind="stable")
    of: dict[str, list[tuple[str, str, str]]] = {}
    for v, u, level, transform in zip(near["v"], near["u"], near["level"], near["transform"]):
        of.setdefault(u, []).append((v, level, transform))
    left = dict.fromkeys(nodes["v"][nodes["state"] == "open"])
    out = []
    for u, state, fine in zip(nodes["v"], nodes["state"], nodes["eligible"]):
        if state == "open":
            if u not in left or not fine:
                continue
            del left[u]
            out.append((u, "representative", None, None, None))
        for v, level, transform in of.get(u, ()):
            if v in left:
                del left[v]
                out.append((v, "replaced", u, level, transform))
    out += [(v, "left over", None, None, None) for v in left]
    return pd.DataFrame(out, columns=["v", "state", "representative", "level", "transform"])


def assign(parts: DataFrame, edges: DataFrame, facts: DataFrame, rank: Column | None = None, may: Column | None = None, local_edges: int = 500_000) -> DataFrame:
    """(sample_id, state, representative_id, level, transform, conflict) of every sample of ``parts``.

    parts(v, component), edges(left, right, level[, transform][, compatible]), facts(sample_id, ...).
    The result is that of walking each component in the order of ``rank``: a sample that is still
    there and eligible becomes a representative and takes all neighbours that are still there, by
    direct evidence only. ``state`` is representative, replaced or left over. An edge that isn't
    ``compatible`` takes nobody; the two ends are conflicts if it would have, samples that are left
    over are conflicts, and what touches a conflict isn't replaced.

    Components of at most ``local_edges`` edges are walked in one task each batch of about as many
    edges. Larger ones take rounds of joins, in which a sample is settled as soon as its best open or
    chosen neighbour is: the same result, without holding the component. Rounds go on until every
    sample is settled (each settles one at least), and what has become small is walked.
    """
    rank, may = rank if rank is not None else keep_rank(facts), may if may is not None else eligible(facts)
    extra = {"transform": F.lit("r0"), "compatible": F.lit(True)}
    own = edges.select("left", "right", "level", *(F.coalesce(F.col(c), d).alias(c) if c in edges.columns else d.alias(c) for c, d in extra.items())).filter("left <> right")
    both = own.unionByName(own.select(F.col("right").alias("left"), F.col("left").alias("right"), "level", "transform", "compatible"))
    both = both.groupBy(F.col("left").alias("v"), F.col("right").alias("u")).agg(F.min_by(F.struct("level", "transform"), F.struct("level", "transform")).alias("m"), F.min("compatible").alias("compatible"))
    both = stage(both.select("v", "u", "m.level", "m.transform", "compatible").join(parts.select("v", "component"), "v"), "links")
    rated = facts.dropDuplicates(["sample_id"]).select(F.col("sample_id").alias("v"), rank.alias("rank"), may.alias("eligible"))
    fallback = F.struct(*(F.col(f"rank.{f.name}") if f.name != "k12" else F.coalesce(F.col("rank.k12"), F.col("v")).alias("k12") for f in rated.schema["rank"].dataType.fields))
    nodes = parts.select("v", "component").distinct().join(rated, "v", "left").withColumn("rank", fallback).withColumn("eligible", F.coalesce("eligible", F.lit(False)))
    nodes = stage(nodes.withColumn("state", F.lit("open")), "nodes")
    usable = both.filter("compatible").select("v", "u", "level", "transform", "component")
    settled: DataFrame | None = None
    now = nodes
    while True:
        sizes = now.filter("state = 'open'").select("v", "component").join(usable.select("v"), "v", "left").groupBy("component").agg(F.count("*").alias("edges"))
        sizes = stage(sizes.withColumn("small", F.col("edges") <= local_edges), "sizes")
        total, large = sizes.agg(F.sum(F.when(F.col("small"), F.col("edges"))), F.count_if(~F.col("small"))).first()
        found = _local(now, usable, sizes, total or 0, local_edges)
        if large:
            found = found.unionByName(_round(now, usable, sizes))
        found = stage(found, "settled")
        drop(sizes)
        settled = found if settled is None else settled.unionByName(found)
        if not large:
            break
        gone = found.select("v", F.col("state").alias("new"))
        rest = now.join(gone, "v", "left").filter("new is null or new = 'representative'").withColumn("state", F.coalesce("new", "state")).drop("new")
        open_ = rest.filter("state = 'open'").select("component").distinct()
        following = stage(rest.join(open_, "component", "left_semi").select(*now.columns), "nodes")
        if now is not nodes:
            drop(now)
        now = following
    return _conflicts(settled, nodes, both)


def _local(now: DataFrame, usable: DataFrame, sizes: DataFrame, total: int, local_edges: int) -> DataFrame:
    small = sizes.filter("small").select("component")
    bucket = F.pmod(F.xxhash64("component"), F.lit(max(1, -(-total // max(1, local_edges)), now.sparkSession.sparkContext.defaultParallelism))).alias("bucket")
    mine = now.join(small, "component", "left_semi").select("v", "state", "eligible", "rank.*", bucket)
    near = usable.join(small, "component", "left_semi").join(now.select(F.col("v")), "v", "left_semi").select("v", "u", "level", "transform", bucket)
    return mine.groupBy("bucket").cogroup(near.groupBy("bucket")).applyInPandas(lambda n, e: _walk(n, e), NODE)


def _round(now: DataFrame, usable: DataFrame, sizes: DataFrame) -> DataFrame:
    here = now.join(sizes.filter("not small").select("component"), "component", "left_semi")
    u = here.filter("eligible").select(F.col("v").alias("u"), F.col("rank").alias("u_rank"), F.col("state").alias("u_state"))
    open_ = here.filter("state = 'open'").select("v", "rank", "eligible")
    near = usable.drop("component").join(open_, "v").join(u, "u").filter("not eligible or u_rank < rank")
    first = near.groupBy("v").agg(F.min(F.struct("u_rank", "u", "u_state", "level", "transform")).alias("m"))
    state = F.when(F.col("m").isNull(), F.when(F.col("eligible"), "representative").otherwise("left over")).when(F.col("m.u_state") == "representative", "replaced")
    out = open_.join(first, "v", "left").withColumn("state", state).filter("state is not null")
    of = lambda c: F.when(F.col("state") == "replaced", F.col(f"m.{c}"))
    return out.select("v", "state", of("u").alias("representative"), of("level").alias("level"), of("transform").alias("transform"))


def _conflicts(settled: DataFrame, nodes: DataFrame, both: DataFrame) -> DataFrame:
    of = nodes.select("v", "rank", "eligible")
    turn = settled.join(of, "v").join(of.select(F.col("v").alias("representative"), F.col("rank").alias("r_rank")), "representative", "left")
    turn = turn.select("v", "state", "representative", "level", "transform", F.when(F.col("state") == "replaced", F.col("r_rank")).when(F.col("state") == "representative", F.col("rank")).alias("turn"))
    chosen = settled.filter("state = 'representative'").select(F.col("v").alias("u")).join(of.select(F.col("v").alias("u"), F.col("rank").alias("u_rank")), "u")
    met = both.filter("not compatible").select("v", "u").join(turn.select("v", "turn"), "v").join(chosen, "u").filter("turn is null or u_rank < turn")
    conflicts = met.select("v").unionByName(met.select(F.col("u").alias("v"))).unionByName(settled.filter("state = 'left over'").select("v")).distinct().withColumn("conflict", F.lit(True))
    out = turn.drop("turn").join(conflicts, "v", "left").join(conflicts.select(F.col("v").alias("representative"), F.col("conflict").alias("r_conflict")), "representative", "left")
    conflict, off = F.coalesce("conflict", F.lit(False)), F.coalesce("conflict", "r_conflict", F.lit(False))
    keep = lambda c: F.when(~off, F.col(c))
    return out.select(F.col("v").alias("sample_id"), F.when((F.col("state") == "replaced") & off, "left over").otherwise(F.col("state")).alias("state"), keep("representative").alias("representative_id"), keep("level").alias("level"), keep("transform").alias("transform"), conflict.alias("conflict"))


def assign_exact(groups: DataFrame, facts: DataFrame, rejected: DataFrame | None = None, rank: Column | None = None, may: Column | None = None) -> DataFrame:
    """(sample_id, representative_id) within groups(v, component) of equal bytes, where any member
    may stand for any other except where a person rejected the pair (rejected(left, right)).

    Rounds: the best eligible sample takes the rest of its group; who is rejected with it stays for
    the next round, so there are as many rounds as the rejections of one group need.
    """
    rank, may = rank if rank is not None else keep_rank(facts), may if may is not None else eligible(facts)
    rated = facts.dropDuplicates(["sample_id"]).select(F.col("sample_id").alias("v"), rank.alias("rank"), may.alias("eligible"))
    open_ = groups.select("v", "component").distinct().join(rated, "v")
    no = None if rejected is None else rejected.unionByName(rejected.select(F.col("right").alias("left"), F.col("left").alias("right"))).distinct()
    done = None
    while True:
        best = open_.filter("eligible").groupBy("component").agg(F.min_by("v", "rank").alias("representative_id"))
        met = open_.join(best, "component")
        if no is not None:
            met = met.join(no.select(F.col("left").alias("v"), F.col("right").alias("representative_id"), F.lit(True).alias("no")), ["v", "representative_id"], "left")
        else:
            met = met.withColumn("no", F.lit(None).cast("boolean"))
        met = stage(met, "exact")
        taken = met.filter("no is null and v <> representative_id").select(F.col("v").alias("sample_id"), "representative_id")
        done = taken if done is None else done.unionByName(taken)
        open_ = met.filter("no").select("v", "component", "rank", "eligible")
        if no is None or open_.isEmpty():
            return done
