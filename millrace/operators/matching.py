"""Pictures that show the same: candidates by hash and colour, verification, and the run over both.

Candidates are exact: every pair within the bounds is found (``alike``). Pictures with equal pixels
(under the eight symmetries) are one family and compared once; a family gives a star, not all pairs.
Of each picture the ``neighbours`` nearest by hash and the ``neighbours`` most alike in colour go on to
verification, which is the operator's purpose (a top-k by two signals), not a cut of what is found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions import vision
from millrace.operators import alike
from millrace.operators.duplicates import CONFIRMED, EXACT
from millrace.operators.representatives import assign
from millrace.storage import stage

POLICY = {"distance": 12, "similarity": 0.92, "neighbours": 20, "correlation": 0.97, "error": 0.04}


def scored(descriptors: DataFrame, distance: int = 12, similarity: float = 0.92, neighbours: int | None = 20, block: int = 16384) -> DataFrame:
    """(query, other, distance, similarity): for each picture the others whose any hash is within ``distance`` bits of its first
    hash, or whose colours have at least ``similarity``; the best ``neighbours`` by either signal.

    descriptors(sample_id, phashes, histogram, ...), one row a picture. Pictures that look equal are
    compared once, and all of them are in the result. Of equal similarity (to six decimals) or distance the smaller
    id comes first. Only pictures with eight hashes and a histogram of 512 finite numbers take part.
    """
    fine = (F.size("phashes") == 8) & F.forall("phashes", lambda h: h.isNotNull()) & (F.size("histogram") == 512) & F.forall("histogram", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = descriptors.filter(F.col("sample_id").isNotNull() & fine).select(F.col("sample_id").cast("string").alias("id"), "phashes", F.col("histogram").cast("array<float>").alias("histogram"))
    if "informative" in descriptors.columns:
        own = descriptors.filter("informative").select("sample_id").join(own.withColumnRenamed("id", "sample_id"), "sample_id").withColumnRenamed("sample_id", "id")
    members, pairs = alike.class_pairs(own, distance, similarity, block)
    others = members
    if neighbours is not None:  # of a class no more can be among the nearest of a picture, which may be one of them itself
        others = members.withColumn("place", F.row_number().over(W.partitionBy("cid").orderBy("id"))).filter(F.col("place") <= neighbours + 1)
    found = pairs.join(members.select(F.col("cid").alias("qc"), F.col("id").alias("query")), "qc").join(others.select(F.col("cid").alias("oc"), F.col("id").alias("other")), "oc").filter("query <> other")
    if neighbours is not None:
        near = F.row_number().over(W.partitionBy("query").orderBy("distance", "other"))
        like = F.row_number().over(W.partitionBy("query").orderBy(F.desc(F.round("similarity", 6)), "other"))
        found = found.withColumn("n", near).withColumn("m", like).filter((F.col("n") <= neighbours) | (F.col("m") <= neighbours))
    return found.select("query", "other", "distance", F.col("similarity").cast("float").alias("similarity"))


def candidate_pairs(descriptors: DataFrame, distance: int = 12, similarity: float = 0.92, neighbours: int | None = 20, extra: DataFrame | None = None) -> DataFrame:
    """(left, right): the pairs to verify: stars of families, both signals' nearest, and ``extra``.

    Of a family (equal pixels) only its smallest member is compared with other families.
    """
    known = descriptors.filter("family is not null").select("sample_id", "family")
    heads = known.groupBy("family").agg(F.min("sample_id").alias("head"))
    stars = known.join(heads, "family").filter("sample_id <> head").select(F.col("head").alias("left"), F.col("sample_id").alias("right"))
    one = descriptors.join(heads.select(F.col("head").alias("sample_id")), "sample_id", "left_semi")
    found = scored(one, distance, similarity, neighbours)
    pairs = stars.unionByName(found.select(F.least("query", "other").alias("left"), F.greatest("query", "other").alias("right")))
    if extra is not None:
        for side in ("left", "right"):
            extra = extra.join(known.select(F.col("sample_id").alias(side)), side, "left_semi")
        pairs = pairs.unionByName(extra.filter("left <> right").select(F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right")))
    return pairs.distinct()


EVIDENCE = "level string, reason string, transform string, correlation double, error double, textured_tiles int, color_error double"


def verify_pairs(pairs: DataFrame, descriptors: DataFrame, correlation: float = 0.97, error: float = 0.04) -> DataFrame:
    """(left, right, left_asset, right_asset, EVIDENCE, phash_distance, histogram_similarity) of each pair.

    The ladder: equal bytes, equal pixels under a symmetry, too little information, transparency, and
    only then the pictures, whose thumbnails are fetched for the pairs that need them.
    """
    light = ("asset", "pixels", "phashes", "histogram", "informative", "has_alpha")
    of = lambda side, columns: descriptors.filter("error is null").select(F.col("sample_id").alias(side), *(F.col(c).alias(f"{side[0]}_{c}") for c in columns))
    met = pairs.select("left", "right").join(of("left", light), "left").join(of("right", light), "right")
    same = F.map_keys(F.map_filter("r_pixels", lambda _, d: d == F.element_at("l_pixels", "r0")))
    # the first symmetry in the usual order
    turn = F.array_min(F.transform(same, lambda n: F.array_position(F.array(*map(F.lit, vision.TRANSFORMS)), n)))
    level = F.when(F.col("l_asset") == F.col("r_asset"), "exact_bytes").when(F.size(same) > 0, "exact_pixels").when(~F.col("l_informative") | ~F.col("r_informative") | F.col("l_has_alpha") | F.col("r_has_alpha"), "candidate")
    reason = F.when(level == "candidate", F.when(~F.col("l_informative") | ~F.col("r_informative"), "low_information").otherwise("alpha_requires_review"))
    transform = F.when(level == "exact_bytes", "r0").when(level == "exact_pixels", F.element_at(F.array(*map(F.lit, vision.TRANSFORMS)), turn.cast("int")))
    bits = F.array_min(F.transform("r_phashes", lambda h: F.bit_count(h.bitwiseXOR(F.get("l_phashes", 0)))))
    dot = F.aggregate(F.zip_with("l_histogram", "r_histogram", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, v: s + v)
    met = stage(met.select("left", "right", F.col("l_asset").alias("left_asset"), F.col("r_asset").alias("right_asset"), level.alias("level"), reason.alias("reason"), transform.alias("transform"), bits.cast("int").alias("phash_distance"), dot.alias("histogram_similarity")), "pairs")
    none = {x.split()[0]: x.split()[1] for x in EVIDENCE.split(", ")[3:]}
    settled = met.filter("level is not null").select("left", "right", "left_asset", "right_asset", "level", "reason", "transform", *(F.lit(None).cast(t).alias(n) for n, t in none.items()), "phash_distance", "histogram_similarity")
    open_ = met.filter("level is null").drop("level", "reason", "transform")
    thumbs = open_.join(of("left", ("thumbnail",)), "left").join(of("right", ("thumbnail",)), "right")

    @F.pandas_udf(f"struct<{', '.join(x.replace(' ', ':') for x in EVIDENCE.split(', '))}>")
    def look(a, b):  # noqa: ANN001, ANN202
        import pandas as pd

        names = [x.split()[0] for x in EVIDENCE.split(", ")]
        rows = [vision.visual_evidence(vision.unpacked(p), vision.unpacked(q), correlation, error) for p, q in zip(a, b)]
        return pd.DataFrame([[r[n] for n in names] for r in rows], columns=names).astype({"textured_tiles": "Int32"})

    seen = thumbs.withColumn("e", look("l_thumbnail", "r_thumbnail")).select("left", "right", "left_asset", "right_asset", "e.*", "phash_distance", "histogram_similarity")
    return settled.unionByName(seen)


def cached_descriptors(images: DataFrame, path: str) -> DataFrame:
    """The descriptors of images(sample_id, ..., data, digest), of which those that ``path`` holds for
    the same bytes and version are not computed again. Damaged entries (whose check doesn't fit) count
    as missing. New ones are appended; two writers at once at worst store an entry twice."""
    spark = images.sparkSession
    check = F.xxhash64(*[x.split()[0] for x in vision.DESCRIPTORS.split(", ") if x.split()[0] not in ("sample_id", "pixels", "version")], F.to_json("pixels"))
    digest = F.coalesce("digest", F.sha2("data", 256)) if "digest" in images.columns else F.sha2("data", 256)
    own = images.withColumn("digest", digest)
    kept = _table(spark, path, vision.DESCRIPTORS + ", check bigint")
    good = kept.filter((F.col("version") == vision.VERSION) & (F.col("check") == check)).dropDuplicates(["asset"]).drop("check", "sample_id")
    missing = own.join(good.select(F.col("asset").alias("digest")), "digest", "left_anti").dropDuplicates(["digest"])
    fresh = stage(vision.picture_descriptors(missing), "descriptors")
    fresh.withColumn("check", check).write.mode("append").parquet(path)
    whole = good.unionByName(fresh.drop("sample_id")) if not fresh.isEmpty() else good
    return own.select(F.col("sample_id").cast("string").alias("sample_id"), F.col("digest").alias("asset")).join(whole, "asset").select(*[x.split()[0] for x in vision.DESCRIPTORS.split(", ")])


def cached_verification(pairs: DataFrame, descriptors: DataFrame, path: str, correlation: float = 0.97, error: float = 0.04) -> DataFrame:
    """``verify_pairs``, of which pairs of the same two assets, version and thresholds are looked up."""
    spark = pairs.sparkSession
    terms = F.lit(f"{vision.VERSION}|{correlation}|{error}")
    assets = descriptors.filter("error is null").select("sample_id", "asset")
    keyed = pairs.select("left", "right").join(assets.select(F.col("sample_id").alias("left"), F.col("asset").alias("left_asset")), "left").join(assets.select(F.col("sample_id").alias("right"), F.col("asset").alias("right_asset")), "right")
    kept = _table(spark, path, f"terms string, left_asset string, right_asset string, {EVIDENCE}, phash_distance int, histogram_similarity double")
    good = stage(kept.filter(F.col("terms") == terms).drop("terms").dropDuplicates(["left_asset", "right_asset"]), "known")
    missing = keyed.join(good.select("left_asset", "right_asset"), ["left_asset", "right_asset"], "left_anti").select("left", "right")
    fresh = stage(verify_pairs(missing, descriptors, correlation, error), "verified")
    new = fresh.drop("left", "right").dropDuplicates(["left_asset", "right_asset"])
    new.withColumn("terms", terms).write.mode("append").parquet(path)
    return keyed.join(good, ["left_asset", "right_asset"]).select(*fresh.columns).unionByName(fresh)


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def detect(images: DataFrame, cache: str, policy: dict | None = None, extra: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(descriptors, pairs) of a duplicate run: describe, find candidates, verify; both are staged."""
    p = POLICY | (policy or {})
    descriptors = stage(cached_descriptors(images, f"{cache}/descriptors"), "descriptors")
    pairs = stage(candidate_pairs(descriptors, p["distance"], p["similarity"], p["neighbours"], extra), "candidates")
    return descriptors, stage(cached_verification(pairs, descriptors, f"{cache}/pairs", p["correlation"], p["error"]), "evidence")


def run_stats(descriptors: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row: images, invalid, low_information, candidates and pairs by level."""
    d = descriptors.agg(F.count("*").alias("images"), F.count_if(F.col("error").isNotNull()).alias("invalid"), F.count_if(~F.coalesce("informative", F.lit(True))).alias("low_information"))
    levels = ("exact_bytes", "exact_pixels", "verified_visual", "candidate", "rejected")
    return d.crossJoin(pairs.agg(F.count("*").alias("candidates"), *(F.count_if(F.col("level") == v).alias(v) for v in levels)))  # one row each


def duplicates_of(descriptors: DataFrame, pairs: DataFrame, facts: DataFrame, rejected: DataFrame | None = None) -> DataFrame:
    """The assignment of ``representatives.assign`` from verified pairs: confirmed levels, less pairs
    that a person rejected. facts(sample_id, ...) rank and qualify the samples."""
    from millrace.operators.components import components

    edges = pairs.filter(F.col("level").isin(*CONFIRMED)).select("left", "right", "level", "transform")
    if rejected is not None:
        no = rejected.select(F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right")).distinct()
        edges = edges.join(no, ["left", "right"], "left_anti")
    edges = stage(edges, "edges")
    described = descriptors.select("sample_id", (F.col("width") * F.col("height")).alias("area"), "sharpness", "padding")
    known = facts.drop("area", "sharpness", "padding").join(described, "sample_id", "left")
    return assign(components(edges), edges, known)


def visual_leaks(pairs: DataFrame, splits: DataFrame, rejected: DataFrame | None = None) -> DataFrame:
    """(left, right, left_split, right_split, level): verified pairs whose ends lie in different splits.

    Confirmed ones are errors, candidates are for a person to look at; rejected pairs don't count.
    """
    from millrace.operators.splits import crossing_pairs

    own = pairs.filter(F.col("level").isin(*CONFIRMED, "candidate")).select("left", "right", "level")
    if rejected is not None:
        own = own.join(rejected.select(F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right")), ["left", "right"], "left_anti")
    return crossing_pairs(own, splits).select("left", "right", "left_split", "right_split", "level")


def evaluate(pairs: DataFrame, truth: DataFrame, levels: tuple[str, ...] = CONFIRMED) -> dict[str, DataFrame]:
    """How confirmed pairs agree with truth(sample_id, family, transformation, source).

    ``total``: pairs, false pairs, precision, contaminated families; ``by_transformation``: members of
    families of two or more and how many of them a right pair holds; ``by_source``: the same with pairs.
    """
    side = lambda s: truth.select(F.col("sample_id").alias(s), F.col("family").alias(f"{s}_family"), F.col("source").alias(f"{s}_source"))
    own = pairs.filter(F.col("level").isin(*levels)).select("left", "right").join(side("left"), "left").join(side("right"), "right")
    own = stage(own.withColumn("right_pair", F.col("left_family") == F.col("right_family")), "judged")
    ends = own.select(F.explode(F.array(F.struct(F.col("left").alias("sample_id"), F.col("left_family").alias("family")), F.struct(F.col("right").alias("sample_id"), F.col("right_family").alias("family")))).alias("e"), "right_pair").select("e.*", "right_pair")
    recovered = ends.filter("right_pair").select("sample_id").distinct().withColumn("found", F.lit(True))
    families = ends.agg(F.count_distinct("family").alias("families"), F.count_distinct(F.when(~F.col("right_pair"), F.col("family"))).alias("contaminated_families"))
    total = own.agg(F.count("*").alias("pairs"), F.count_if(~F.col("right_pair")).alias("false_pairs")).withColumn("precision", F.when(F.col("pairs") > 0, 1 - F.col("false_pairs") / F.col("pairs"))).crossJoin(families)
    several = truth.groupBy("family").count().filter("count > 1").select("family")
    members = truth.join(several, "family", "left_semi").join(recovered, "sample_id", "left")
    recall = lambda key: members.groupBy(key).agg(F.count("*").alias("members"), F.count("found").alias("recovered")).withColumn("recall", F.col("recovered") / F.col("members"))
    related = own.select(F.explode(F.array_distinct(F.array("left_source", "right_source"))).alias("source"), "right_pair").groupBy("source").agg(F.count("*").alias("pairs"), F.count_if(~F.col("right_pair")).alias("false_pairs"))
    return {"total": total, "by_transformation": recall("transformation"), "by_source": recall("source").join(related, "source", "left")}


def retrieval_recall(found: DataFrame, oracle: DataFrame) -> DataFrame:
    """(pairs, oracle_pairs, both, recall) of two sets of unordered pairs."""
    norm = lambda df: df.select(F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right")).distinct()
    a, b = norm(found).withColumn("a", F.lit(1)), norm(oracle).withColumn("b", F.lit(1))
    out = a.join(b, ["left", "right"], "full").agg(F.count("a").alias("pairs"), F.count("b").alias("oracle_pairs"), F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("both"))
    return out.withColumn("recall", F.when(F.col("oracle_pairs") > 0, F.col("both") / F.col("oracle_pairs")))


def shared_with(evaluation: DataFrame, calibration: DataFrame) -> DataFrame:
    """(what, value): captures within a source, families and pixel families that both sets hold; both
    have source, capture_group, family and pixels. Must be empty for an independent evaluation."""
    def keys(df: DataFrame) -> DataFrame:
        capture: Column = F.concat_ws("|", F.coalesce("source", F.lit("unknown")), F.coalesce("capture_group", "family"))
        return df.select(F.explode(F.array(*(F.struct(F.lit(n).alias("what"), c.alias("value")) for n, c in (("capture", capture), ("family", F.col("family")), ("pixels", F.col("pixels")))))).alias("k")).select("k.*").filter("value is not null")

    return keys(evaluation).intersect(keys(calibration))


__all__ = ["EXACT", "cached_descriptors", "cached_verification", "candidate_pairs", "detect", "duplicates_of", "evaluate", "retrieval_recall", "run_stats", "scored", "shared_with", "verify_pairs", "visual_leaks"]
