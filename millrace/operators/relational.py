"""Projections, predicates, column updates and joins over sample tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, key: str, *order: str) -> DataFrame:
    """One row for each key: the one with the greatest ``order``; rows without a key are left out.

    An aggregate, not a window, so that repeated rows meet before the shuffle.
    """
    rest = [c for c in df.columns if c != key]
    rank = F.struct(*(F.struct(F.col(c).isNotNull().alias("k"), F.col(c).alias("v")).alias(f"o{i}") for i, c in enumerate(order)), F.to_json(F.struct(*rest)).alias("tie"))
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rest), rank).alias("r")).select(key, *(F.col("r")[c].alias(c) for c in rest))


def with_tag(df: DataFrame, tag: str, column: str = "tags") -> DataFrame:
    return df.filter(F.array_contains(column, tag))


def add_tags(tags: Column, *new: str) -> Column:
    return F.array_sort(F.array_union(F.coalesce(tags, F.array().cast("array<string>")), F.array(*[F.lit(t) for t in new])))


def remove_tags(tags: Column, *old: str) -> Column:
    return F.array_sort(F.array_except(F.coalesce(tags, F.array().cast("array<string>")), F.array(*[F.lit(t) for t in old])))


def strip_tag_prefix(tags: Column, prefix: str) -> Column:
    return F.array_sort(F.filter(F.coalesce(tags, F.array().cast("array<string>")), lambda t: ~t.startswith(prefix)))


def keep_ids(df: DataFrame, ids: DataFrame, key: str = "sample_id") -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def drop_ids(df: DataFrame, ids: DataFrame, key: str = "sample_id") -> DataFrame:
    return df.join(ids.select(key), key, "left_anti")


def update_columns(df: DataFrame, values: DataFrame, key: str) -> DataFrame:
    """A new snapshot of ``df`` with the values that ``values`` has (its nulls change nothing)."""
    changed = [c for c in values.columns if c != key]
    new = values.select(key, *(F.col(c).alias(f"new_{c}") for c in changed))
    return df.join(new, key, "left").select(*(F.coalesce(F.col(f"new_{c}"), F.col(c)).alias(c) if c in changed else F.col(c) for c in df.columns), *(F.col(f"new_{c}").alias(c) for c in changed if c not in df.columns))


def first_known(*columns: Column, default: float | None = None) -> Column:
    """The first of some numbers that is neither null nor NaN."""
    known = [F.when(~F.isnan(c.cast("double")), c) for c in columns]
    return F.coalesce(*known, F.lit(default)) if default is not None else F.coalesce(*known)


def filter_boxes(boxes: Column, least: float) -> Column:
    """Boxes whose sharpness is unknown or at least ``least``."""
    return F.filter(boxes, lambda b: F.coalesce(b["blur_variance"] >= least, F.lit(True)))


def emptied(before: Column, after: Column) -> Column:
    """Whether a filter took all boxes of a row that had some."""
    return (F.coalesce(F.size(before), F.lit(0)) > 0) & (F.coalesce(F.size(after), F.lit(0)) == 0)


def provenance(samples: DataFrame, sources: DataFrame, columns: Sequence[str], key: str = "source_dataset", broadcast_rows: int = 100_000) -> DataFrame:
    """Each sample with the facts of its source; ``unknown`` where there is none.

    The list of sources is broadcast only if it has at most ``broadcast_rows`` rows.
    """
    facts = sources.select(key, *columns).dropDuplicates([key])
    small = facts.limit(broadcast_rows + 1).count() <= broadcast_rows
    out = samples.join(F.broadcast(facts) if small else facts, key, "left")
    return out.select(*samples.columns, *(F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias(c) for c in columns))


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows whose reference leads nowhere."""
    return children.join(parents.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def referenced(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    return children.join(parents.select(F.col(parent_key).alias(child_key)), child_key, "left_semi")


def ordered_pair(left: str, right: str) -> tuple[Column, Column]:
    return F.least(left, right).alias("left"), F.greatest(left, right).alias("right")


def without_rejected(edges: DataFrame, rejected: DataFrame) -> DataFrame:
    """Edges (left, right, ...) of which nobody said that they are none, in whichever direction."""
    said = rejected.select(*ordered_pair("left", "right")).distinct()
    pair = edges.withColumn("_a", F.least("left", "right")).withColumn("_b", F.greatest("left", "right"))
    return pair.join(said.select(F.col("left").alias("_a"), F.col("right").alias("_b")), ["_a", "_b"], "left_anti").drop("_a", "_b")


def replace_edges(edges: DataFrame, method: str, new: DataFrame) -> DataFrame:
    """The edges of one method exchanged for new ones; those of other methods stay."""
    return edges.filter(F.col("method").isNull() | (F.col("method") != method)).unionByName(new.filter(F.col("method") == method), allowMissingColumns=True)


def with_assets(edges: DataFrame, metrics: DataFrame) -> DataFrame:
    """Edges with the digests that both ends had when they were found (``left_asset``, ``right_asset``)."""
    of = metrics.filter("sample_id is not null and trim(asset_sha256) <> ''").groupBy("sample_id").agg(F.min(F.lower(F.trim("asset_sha256"))).alias("asset"))
    out = edges
    for side in ("left", "right"):
        out = out.join(of.select(F.col("sample_id").alias(side), F.col("asset").alias(f"{side}_asset")), side, "left")
    return out


def with_metadata(samples: DataFrame, sources: DataFrame, raw: str) -> DataFrame:
    """samples(sample_id, filepath) with what their path and their source's record say, and the first
    decision of each (kept). sources(source_dataset, format, version, license, ...)."""
    from millrace.functions.text import label_of_path, normal_label, split_of_path

    inner = F.regexp_replace("filepath", "^" + raw.rstrip("/") + "/", "")
    first = F.split(inner, "/")[0]
    own = samples.select("*", inner.alias("source_path"), first.alias("source_dataset"), split_of_path(inner).alias("source_split"))
    known = [c for c in ("format", "version", "license", "homepage", "citation", "sensor", "geography") if c in sources.columns]
    met = own.join(sources.select("source_dataset", *(F.col(c).alias(f"_{c}") for c in known)).dropDuplicates(["source_dataset"]), "source_dataset", "left")
    of = lambda c, default: F.coalesce(F.nullif(F.col(f"_{c}").cast("string"), F.lit("")), F.lit(default)) if c in known else F.lit(default)
    label = F.when(of("format", "unknown") == "tree", F.coalesce(label_of_path(inner), F.lit(""))).otherwise("")
    fields = {"source_format": of("format", "unknown"), "source_label": label, "normalized_label": normal_label(label), "source_version": of("version", "unknown"), "source_license": of("license", "unknown"), "source_url": of("homepage", ""), "source_citation": of("citation", ""), "source_sensor": of("sensor", "RGB"), "source_geography": of("geography", "")}
    decision = {"status": F.lit("kept"), "phase": F.lit("ingestion"), "reason": F.lit("accepted_on_ingest"), "confidence": F.lit(1.0), "keep_reason": F.lit("initial_candidate"), "cluster_id": F.lit("")}
    return met.select(*own.columns, *(v.alias(c) for c, v in (fields | decision).items()))


def backfilled(df: DataFrame, nested: str, schema: dict[str, str]) -> DataFrame:
    """Flat columns declared by ``schema``, filled from those of a nested column where they are missing
    or null; numbers that are NaN count as missing."""
    inner = {f.name for f in df.schema[nested].dataType.fields} if nested in df.columns else set()
    out = df
    for name, kind in schema.items():
        flat = F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)
        deep = F.col(f"{nested}.{name}").cast(kind) if name in inner else F.lit(None).cast(kind)
        if kind in ("double", "float"):
            flat, deep = (F.when(~F.isnan(c), c) for c in (flat, deep))
        out = out.withColumn(name, F.coalesce(flat, deep))
    return out


def pair_sources(pairs: DataFrame, samples: DataFrame) -> DataFrame:
    """Pairs (left, right) with the source of each end."""
    of = samples.select("sample_id", "source_dataset").dropDuplicates(["sample_id"])
    out = pairs
    for side in ("left", "right"):
        out = out.join(of.select(F.col("sample_id").alias(side), F.col("source_dataset").alias(f"{side}_source")), side, "left")
    return out


def tag_conflicts(samples: DataFrame, one: str, other: str) -> DataFrame:
    """Ids that carry both of two tags which exclude each other."""
    ids = lambda tag: with_tag(samples, tag).select("sample_id")
    return ids(one).intersect(ids(other))


def either_key(rows: DataFrame, registry: DataFrame, key: str, first: str, second: str, value: str) -> DataFrame:
    """A join on one of two keys: two equi-joins instead of an OR, which would be a nested loop."""
    a = registry.select(F.col(first).alias(key), F.col(value).alias("_v1")).dropDuplicates([key])
    b = registry.select(F.col(second).alias(key), F.col(value).alias("_v2")).dropDuplicates([key])
    return rows.join(a, key, "left").join(b, key, "left").withColumn(value, F.coalesce("_v1", "_v2")).drop("_v1", "_v2")


def leaks_between(a: DataFrame, b: DataFrame, *keys: str) -> DataFrame:
    """Values of ``keys`` that two sets share."""
    known = " and ".join(f"{k} is not null" for k in keys)
    return a.filter(known).select(*keys).intersect(b.filter(known).select(*keys))


def numbered(df: DataFrame, *order: str, name: str = "id", start: int = 1) -> DataFrame:
    """Rows with consecutive numbers in an order, without gathering them in one task: ranges are
    counted, and only their counts (one for each task) reach the driver."""
    from millrace.storage import stage

    laid = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(laid.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = sorted((r["p"], r["count"]) for r in placed.groupBy(part.alias("p")).count().collect())
    offsets, total = [], start
    for p, n in counts:
        offsets.append((p, total))
        total += n
    before = df.sparkSession.createDataFrame(offsets, "_p long, _before long")
    return placed.withColumn("_p", part).join(F.broadcast(before), "_p").withColumn(name, F.col("_before") + row).drop("_at", "_p", "_before")
