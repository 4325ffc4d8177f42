"""Duplicates: exact and by embedding, bands of perceptual hash and colour; families and who stands for them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import known_key
from millrace.operators.components import components

EXACT = ("exact_bytes", "exact_pixels")
CONFIRMED = (*EXACT, "verified_visual", "human_confirmed")


def stable_identity(*parts: Column) -> Column:
    """A hash of what an asset is, independent of when it was stored."""
    return F.sha2(F.to_json(F.array(*(F.coalesce(p.cast("string"), F.lit("")) for p in parts))), 256)


def exact_edges(metrics: DataFrame, key: str = "sample_id", digest: str = "asset_sha256") -> DataFrame:
    """(left, right): every other sample of equal bytes tied to the smallest: a star, not all pairs."""
    d = F.lower(F.trim(digest))
    own = metrics.select(F.col(key).alias("right"), d.alias("d")).filter("right is not null and d <> ''").distinct()
    least = own.groupBy("d").agg(F.min("right").alias("left"))
    return own.join(least, "d").filter("left <> right").select("left", "right").distinct()


def hamming(variants: Column, other: Column) -> Column:
    """Fewest differing bits between one hash and any of several."""
    return F.array_min(F.transform(F.filter(variants, lambda h: h.isNotNull()), lambda h: F.bit_count(h.bitwiseXOR(other))))


def cosine(a: Column, b: Column) -> Column:
    """The cosine of two vectors as a Catalyst expression; null for a zero vector."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    n = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(n > 0, dot(a, b) / n)


def band_keys(descriptors: DataFrame, key: str = "sample_id") -> DataFrame:
    """(key, bucket): byte bands of all hash variants and of 48 random planes of the histogram."""
    planes = np.random.default_rng(7141).standard_normal((512, 48)).astype(np.float32)

    @F.pandas_udf("array<int>")
    def colour(histograms: pd.Series) -> pd.Series:
        def code(h):
            if h is None or len(h) != 512:
                return []
            x = np.asarray(h, np.float32)
            return np.packbits(x @ planes > 0).tolist() if np.isfinite(x).all() and x.any() else []

        return histograms.map(code)

    byte = lambda h, b: (F.shiftrightunsigned(h, 8 * b).bitwiseAND(F.lit(255)) + 256 * b).cast("int")
    hashes = F.transform(F.filter("phashes", lambda h: h.isNotNull()), lambda h: F.array(*(byte(h, b) for b in range(8))))
    bands = F.coalesce(F.flatten(hashes), F.array().cast("array<int>"))
    colours = F.transform(colour("histogram"), lambda v, i: i * 256 + v + 4096)
    return descriptors.filter(F.col(key).isNotNull()).select(key, F.explode(F.array_distinct(F.concat(bands, colours))).alias("bucket"))


def semantic_pairs(vectors: DataFrame, key: str, vector: str, least: float, block: int = 2048) -> DataFrame:
    """(left, right, similarity) of all pairs of at least ``least``: an exact join, in blocks of about
    ``block`` vectors, as matrix products.

    Each pair of blocks meets in one task. Work and shuffle grow with the square of the vectors; at
    0.9, hashes of random planes would have to compare nearly as many pairs, and lose some. Only
    vectors of equal length meet; a zero vector, or one with a null or NaN, has no pair.
    """
    import pyarrow as pa

    own = vectors.filter(F.col(key).isNotNull() & (F.size(vector) > 0)).select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"), F.size(vector).alias("n"))
    blocks = max(1, -(-own.count() // block))
    placed = own.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    met = placed.select("n", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "b", "id", "v")

    def compare(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        ids, b, first = rows.column("id").combine_chunks(), rows.column("b").to_numpy(), rows.column("i")[0].as_py()
        x = rows.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        with np.errstate(invalid="ignore", divide="ignore"):
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
        one = first == rows.column("j")[0].as_py()
        lefts = np.flatnonzero(b == first)
        rights = lefts if one else np.flatnonzero(b != first)
        out = []
        for at in range(0, len(lefts), 1024):
            some = lefts[at : at + 1024]
            s = x[some] @ x[rights].T
            i, j = np.nonzero(s >= least)
            if one:
                i, j = i[some[i] < rights[j]], j[some[i] < rights[j]]
            out.append((some[i], rights[j], s[i, j]))
        l, r, s = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        return pa.table({"l": ids.take(pa.array(l)), "r": ids.take(pa.array(r)), "similarity": pa.array(s)})

    kind = own.schema["id"].dataType.simpleString()
    found = met.groupBy("n", "i", "j").applyInArrow(compare, f"l {kind}, r {kind}, similarity double").filter("l <> r")
    return found.select(F.least("l", "r").alias("left"), F.greatest("l", "r").alias("right"), "similarity")


def all_semantic_pairs(vectors: DataFrame, key: str, vector: str, least: float, queries: DataFrame) -> DataFrame:
    """Exact partners of a stated query set against all rows, as blocked matrix products.

    ``queries`` is broadcast in blocks of 4 096 vectors (a few MB), against which the vectors stream.
    """
    import pyarrow as pa

    rows = [(r[0], r[1]) for r in queries.select(key, vector).collect()]
    out = None
    for at in range(0, max(1, len(rows)), 4096):
        part = rows[at : at + 4096]
        shared = vectors.sparkSession.sparkContext.broadcast(([r[0] for r in part], np.array([r[1] for r in part], np.float64)))

        def run(batches, shared=shared):
            ids, q = shared.value
            if not len(ids):
                return
            q = q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-12)
            for batch in batches:
                x = np.array(batch.column(1).to_pylist(), np.float64).reshape(batch.num_rows, -1)
                x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
                s = x @ q.T
                i, j = np.nonzero(s >= least)
                yield pa.RecordBatch.from_arrays([pa.array([ids[k] for k in j]), batch.column(0).take(pa.array(i)), pa.array(s[i, j].astype(np.float64))], ["query", "other", "similarity"])

        kind = vectors.schema[key].dataType.simpleString()
        found = vectors.filter(F.size(vector) > 0).select(key, vector).mapInArrow(run, f"query {kind}, other {kind}, similarity double")
        out = found if out is None else out.unionByName(found)
    return out.filter("query <> other")


def families(samples: DataFrame, edges: DataFrame, keys: tuple[str, ...] = ("capture_group", "video_id")) -> DataFrame:
    """(v, component): samples tied by an edge or by a key within their source, with stars per key."""
    stars = None
    for i, k in enumerate(keys):
        named = F.concat_ws("|", F.lit(f"~{i}"), "source_dataset", k)
        part = samples.filter(F.col(k).isNotNull() & (F.trim(k) != "") & F.col("source_dataset").isNotNull() & F.col("sample_id").isNotNull()).select(F.col("sample_id").alias("left"), named.alias("right"))
        stars = part if stars is None else stars.unionByName(part)
    tied = edges.select("left", "right")
    return components(tied.unionByName(stars) if stars is not None else tied).filter(~F.col("v").startswith("~"))


def confirmed_edges(links: DataFrame, samples: DataFrame) -> DataFrame:
    """(left, right) of known samples with a confirmed link, of which no row is rejected."""
    pair = links.filter("left_id <> right_id").groupBy(F.least("left_id", "right_id").alias("left"), F.greatest("left_id", "right_id").alias("right"))
    kept = pair.agg(F.max(F.coalesce("rejected", F.lit(False))).alias("rejected"), F.max(F.coalesce(F.col("level").isin(*CONFIRMED), F.lit(False))).alias("confirmed")).filter("confirmed and not rejected")
    known = samples.select("sample_id").filter("sample_id is not null").distinct()
    for side in ("left", "right"):
        kept = kept.join(known.withColumnRenamed("sample_id", side), side, "left_semi")
    return kept.select("left", "right")


def all_families(samples: DataFrame, links: DataFrame) -> DataFrame:
    """(sample_id, group_id) of every sample: tied by confirmed links, by capture group, video and
    location within a source, and by duplicate cluster anywhere. A key or source that says nothing
    ('', 'NULL', 'unknown') ties nothing; a sample without ties is its own group."""
    source = known_key(F.col("source_dataset"))
    keys = [F.concat(F.lit(f"~{i}|"), source, F.lit("|"), known_key(F.col(k))) for i, k in enumerate(("capture_group", "video_id", "location"))]
    keys.append(F.concat(F.lit("~9|"), known_key(F.col("duplicate_cluster_id"))))
    stars = samples.filter("sample_id is not null").select(F.col("sample_id").alias("left"), F.explode(F.array(*keys)).alias("right")).filter("right is not null")
    parts = components(confirmed_edges(links, samples).unionByName(stars)).filter(~F.col("v").startswith("~")).withColumnRenamed("v", "sample_id")
    ids = samples.select("sample_id").filter("sample_id is not null").distinct()
    return ids.join(parts, "sample_id", "left").select("sample_id", F.coalesce("component", "sample_id").alias("group_id"))


def mislabelled(vectors: DataFrame, centre: DataFrame, key: str, label: str, vector: str, margin: float = 0.05, block_bytes: int = 64 << 20) -> DataFrame:
    """Vectors whose own class centre is farther than another one by more than ``margin``.

    ``centre`` is centroids(...): (label, i, c). Centres are broadcast as matrices of at most
    ``block_bytes``, as many as it takes, and vectors meet each as a matrix product where they lie. With
    one matrix nothing is shuffled; with several, the least distance over all of them counts. Zero
    vectors, vectors of another length than the centres and those without a label have no distance.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    spark = vectors.sparkSession
    kinds = {c: vectors.schema[c].dataType.simpleString() for c in (key, label)}
    rows = centre.groupBy(label).agg(F.array_sort(F.collect_list(F.struct("i", "c"))).alias("v")).orderBy(label)
    blocks: list[tuple[list, np.ndarray]] = []
    names, held, size = [], [], 0
    for r in rows.toLocalIterator():
        names.append(r[label])
        held.append([x["c"] for x in r["v"]])
        size += 8 * len(held[-1])
        if size >= block_bytes:
            blocks.append((names, np.array(held, np.float64)))
            names, held, size = [], [], 0
    if held:
        blocks.append((names, np.array(held, np.float64)))
    schema = f"key {kinds[key]}, label {kinds[label]}, own double, d double, other {kinds[label]}"
    empty = spark.createDataFrame([], schema)

    def against(shared) -> DataFrame:  # noqa: ANN001
        def run(batches):
            names, centres = shared.value
            at = {n: i for i, n in enumerate(names)}
            for batch in batches:
                lengths = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
                batch = batch.filter(pa.array(lengths == centres.shape[1]))
                if not batch.num_rows:
                    continue
                x = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
                n = np.linalg.norm(x, axis=1)
                fine = n > 0
                batch, x = batch.filter(pa.array(fine)), x[fine] / n[fine, None]
                d = 1 - x @ centres.T
                mine = np.array([at.get(v, -1) for v in batch.column(1).to_pylist()], dtype=int)
                i = np.arange(len(x))
                own = np.where(mine >= 0, d[i, np.maximum(mine, 0)], np.nan)
                d[i[mine >= 0], mine[mine >= 0]] = np.inf
                best = d.argmin(axis=1) if d.shape[1] else np.zeros(len(x), int)
                least = d[i, best]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(own, mask=mine < 0), pa.array(least, mask=~np.isfinite(least)), pa.array(names).cast(batch.column(1).type).take(pa.array(best))],
                    ["key", "label", "own", "d", "other"],
                )

        return vectors.filter(F.col(label).isNotNull()).select(key, label, vector).mapInArrow(run, schema)

    found = [against(spark.sparkContext.broadcast(b)) for b in blocks] or [empty]
    out = found[0]
    if len(found) > 1:
        for part in found[1:]:
            out = out.unionByName(part)
        out = out.groupBy("key", "label").agg(F.min("own").alias("own"), F.min(F.when(F.col("d").isNotNull(), F.struct("d", "other"))).alias("o")).select("key", "label", "own", "o.d", "o.other")
    far = out.filter(F.col("own") > F.col("d") + margin)
    return far.select(F.col("key").alias(key), F.col("label").alias(label), F.col("other").alias("nearer"), F.round("own", 6).alias("own_distance"), F.round("d", 6).alias("nearer_distance"))
