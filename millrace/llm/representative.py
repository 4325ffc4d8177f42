"""Problem 6: one representative of each duplicate group, from the best known values.

Per sample and field the usable value of the latest timestamp counts. Where a sample has usable
values of a field without any timestamp only, currency reasoning decides: the timestamped rows of
all samples teach how often value a is followed by value b; a precedes b if that is commoner than
the reverse; what precedes what directly or through other values gives each value a topological
depth, and of the values of the sample the deepest is taken, of equally deep ones the greatest.

Everything is aggregation and joins in the JVM. Transitions are read off with a lag within (sample,
day) and a second one over the first and last row of each day, so that no window holds all rows of
a sample that is measured very often.

Defined results: null, NaN, infinite and non-positive sizes and null, NaN, infinite and negative
blur are unusable; equal timestamps take the greater value; a sample without metrics has no pixels
and no blur but is eligible; a flag counts as true if any of the sample's latest rows has it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.storage import stage


def usable(field: str) -> Column:
    value = F.col(field).cast("double")
    known = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
    return F.when(known & (value >= 0 if field == "blur_variance" else value > 0), value)


def transitions(rows: DataFrame) -> DataFrame:
    """rows(key, field, value, at) -> (field, before, after, times) of consecutive differing values."""
    timed = rows.filter("at is not null").groupBy("key", "field", "at").agg(F.max("value").alias("value"))
    day = F.to_date("at")
    within = W.partitionBy("key", "field", "day").orderBy("at")
    timed = timed.withColumn("day", day)
    inner = timed.withColumn("before", F.lag("value").over(within)).select("field", "before", F.col("value").alias("after"))
    ends = timed.groupBy("key", "field", "day").agg(F.min_by("value", "at").alias("first"), F.max_by("value", "at").alias("last"))
    outer = ends.withColumn("before", F.lag("last").over(W.partitionBy("key", "field").orderBy("day"))).select("field", "before", F.col("first").alias("after"))
    return inner.unionByName(outer).filter("before <> after").groupBy("field", "before", "after").agg(F.count("*").alias("times"))


def precedence(rows: DataFrame) -> DataFrame:
    """(field, before, after): the order that the timestamped rows teach; b follows a if that transition
    is commoner than its reverse."""
    seen = transitions(rows)
    back = seen.select("field", F.col("after").alias("before"), F.col("before").alias("after"), F.col("times").alias("reverse"))
    return seen.join(back, ["field", "before", "after"], "left").filter("times > coalesce(reverse, 0)").select("field", "before", "after")


def depths(order: DataFrame) -> DataFrame:
    """(field, value, depth): the topological depth of each value, one more than that of the deepest
    value before it, however long the way; so a value that comes after another one, directly or
    through others, is deeper.

    Rounds take away the values that no remaining value precedes. When none is left to take, the
    others lie on or behind a cycle and share one depth beyond all of them. There are as many rounds
    as the longest chain has values; each reads and writes what remains.
    """
    edges = stage(order, "order")
    nodes = stage(edges.select("field", F.col("before").alias("value")).unionByName(edges.select("field", F.col("after").alias("value"))).distinct(), "values")
    done, depth = None, 0
    while True:
        preceded = edges.select("field", F.col("after").alias("value")).distinct()
        first = stage(nodes.join(preceded, ["field", "value"], "left_anti").withColumn("depth", F.lit(depth)), "first")
        if first.isEmpty():
            rest = nodes.withColumn("depth", F.lit(depth))
            return rest if done is None else done.unionByName(rest)
        done = first if done is None else done.unionByName(first)
        taken = first.select("field", "value")
        nodes = stage(nodes.join(taken, ["field", "value"], "left_anti"), "values")
        edges = stage(edges.join(taken.withColumnRenamed("value", "before"), ["field", "before"], "left_anti"), "order")
        depth += 1


def topologically_latest(untimed: DataFrame, rows: DataFrame) -> DataFrame:
    """(key, field, value, known): the latest value of each group whose rows carry no timestamps, and
    whether the learned order knows at least one of its values.

    A group takes the deepest of its values; values that the order doesn't know come before those it
    does, and equal depths go to the greater value.
    """
    options = untimed.select("key", "field", "value").distinct()
    fields = options.select("field").distinct()
    deep = depths(precedence(rows.join(F.broadcast(fields), "field", "left_semi")))  # a handful of fields
    ranked = options.join(deep, ["field", "value"], "left")
    return ranked.groupBy("key", "field").agg(F.max(F.struct(F.coalesce("depth", F.lit(-1)).alias("depth"), "value")).alias("m"), F.max(F.col("depth").isNotNull()).alias("known")).select("key", "field", "m.value", "known")


def long_rows(metrics: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """(key, field, value, at) of every usable value."""
    each = F.array(*(F.struct(F.lit(f).alias("field"), usable(f).alias("value")) for f in fields))
    return metrics.filter("sample_id is not null").select(F.col("sample_id").alias("key"), F.col("measured_at").alias("at"), F.inline(each)).filter("value is not null")


def withheld(metrics: DataFrame, fields: tuple[str, ...] = ("width", "height", "blur_variance")) -> DataFrame:
    """(field, groups, known, right): how often the learned order finds the value that is truly latest
    when the timestamps of a sample are hidden.

    Samples are halved by a hash; the order is learned from each half and asked about the other one's
    samples with two or more usable values of a field, each with its timestamp. ``known`` counts the
    groups of which the order knows a value, ``right`` those whose latest value it gives.
    """
    rows = stage(long_rows(metrics, fields).filter("at is not null").withColumn("half", F.pmod(F.xxhash64("key"), F.lit(2))), "rows")
    truth = rows.groupBy("key", "field").agg(F.max_by("value", F.struct("at", "value")).alias("latest"), F.count_distinct("value").alias("n")).filter("n > 1")
    found = None
    for half in (0, 1):
        asked = rows.filter(F.col("half") == half).join(truth.select("key", "field"), ["key", "field"], "left_semi")
        part = topologically_latest(asked, rows.filter(F.col("half") != half).select("key", "field", "value", "at"))
        found = part if found is None else found.unionByName(part)
    met = found.join(truth, ["key", "field"])
    return met.groupBy("field").agg(F.count("*").alias("groups"), F.count_if("known").alias("known"), F.count_if(F.col("value") == F.col("latest")).alias("right"))


def best_known(metrics: DataFrame, fields: tuple[str, ...] = ("width", "height", "blur_variance")) -> DataFrame:
    """(sample_id, *fields, eligible)."""
    rows = metrics.select("sample_id", "measured_at", "is_corrupted", "processing_error", *(usable(f).alias(f) for f in fields)).filter("sample_id is not null")
    bad = F.coalesce("is_corrupted", F.lit(False)) | F.coalesce("processing_error", F.lit(False))
    timed = lambda f: F.max(F.when(F.col(f).isNotNull() & F.col("measured_at").isNotNull(), F.struct("measured_at", f))).getField(f)
    latest = F.max(F.struct(F.col("measured_at").isNotNull().alias("k"), "measured_at", bad.alias("bad"))).getField("bad")
    dated = rows.groupBy("sample_id").agg(*(timed(f).alias(f) for f in fields), (~latest).alias("eligible"))
    if rows.filter("measured_at is null").isEmpty():  # nothing to reason about
        return dated
    long = long_rows(metrics, fields)
    have = dated.select(F.col("sample_id").alias("key"), F.inline(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("dated")) for f in fields)))).filter("dated is not null").drop("dated")
    reasoned = topologically_latest(long.filter("at is null").join(have, ["key", "field"], "left_anti"), long)
    wide = reasoned.groupBy("key").agg(*(F.max(F.when(F.col("field") == f, F.col("value"))).alias(f"r_{f}") for f in fields)).withColumnRenamed("key", "sample_id")
    return dated.join(wide, "sample_id", "left").select("sample_id", *(F.coalesce(f, f"r_{f}").alias(f) for f in fields), "eligible")


def representatives(decisions: DataFrame, metrics: DataFrame) -> DataFrame:
    """One row for each group with an eligible sample: its representative and the values that won."""
    members = decisions.filter("cluster_id is not null and sample_id is not null").select("cluster_id", "sample_id").distinct()
    rated = members.join(best_known(metrics), "sample_id", "left").filter(F.coalesce("eligible", F.lit(True)))
    pixels = F.coalesce(F.col("width") * F.col("height"), F.lit(0.0))
    rank = F.struct((-pixels).alias("p"), (-F.coalesce("blur_variance", F.lit(-1.0))).alias("b"), "sample_id", "width", "height", "blur_variance")
    return rated.groupBy("cluster_id").agg(F.min(rank).alias("r"), F.count("*").alias("eligible_samples")).select("cluster_id", F.col("r.sample_id").alias("representative_id"), "r.width", "r.height", "r.blur_variance", "eligible_samples")
