"""Counts, rates, matrices and statistics of the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATUSES = ("kept", "review", "removed")


def counts(df: DataFrame, *keys: str | Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows"))


def status_pivot(decisions: DataFrame, key: str) -> DataFrame:
    """Statuses of each key side by side; removals apart by whether a duplicate phase made them."""
    status = F.lower("status")
    duplicate = F.coalesce(F.col("phase").endswith("duplicates"), F.lit(False))
    return decisions.groupBy(key).agg(
        *(F.count_if(status == s).alias(s) for s in STATUSES),
        F.count_if((status == "removed") & ~duplicate).alias("removed_quality"),
        F.count_if((status == "removed") & duplicate).alias("removed_duplicates"),
        F.count("*").alias("total"),
    )


def drop_rates(decisions: DataFrame, key: str) -> DataFrame:
    removed = F.count_if(F.lower("status") == "removed")
    return decisions.groupBy(key).agg(F.count("*").alias("total"), removed.alias("removed"), F.round(removed * 100.0 / F.count("*"), 4).alias("drop_rate"))


def grouping_report(decisions: DataFrame, *keys: str) -> DataFrame:
    """Counts by every key alone and over all, in one pass (grouping sets)."""
    return decisions.cube(*keys).agg(F.count("*").alias("rows"), F.grouping_id().alias("level")).filter(F.col("level") >= (1 << len(keys)) - 1 - (1 << (len(keys) - 1)))


def label_sources(rows: DataFrame, label: str, source: str) -> DataFrame:
    """How often each label comes from each source, and from how many sources it comes at all."""
    return rows.groupBy(label).agg(F.count("*").alias("rows"), F.count_distinct(source).alias("sources"), F.array_sort(F.collect_set(source)).alias("source_list"))


def canonical_matrix(rows: DataFrame, canonical: str, raw: str, source: str) -> DataFrame:
    """Per canonical class: total, rows of each source, raw labels."""
    per = rows.groupBy(canonical, source).agg(F.count("*").alias("n"), F.collect_set(raw).alias("raw"))
    by = F.map_from_entries(F.array_sort(F.collect_list(F.struct(source, "n"))))
    return per.filter(F.col(source).isNotNull()).groupBy(canonical).agg(F.sum("n").alias("total"), by.alias("by_source"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("raw")))).alias("raw_labels"))


def class_weights(rows: DataFrame, label: str) -> DataFrame:
    """N / (classes x rows of the class), to four decimals."""
    per = rows.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("rows"))
    whole = per.agg(F.sum("rows").alias("_n"), F.count("*").alias("_c"))  # one row
    return per.crossJoin(F.broadcast(whole)).select(label, "rows", F.bround(F.col("_n") / (F.col("_c") * F.col("rows")), 4).alias("weight"))


def balance_targets(rows: DataFrame, label: str, cap: int = 2000) -> DataFrame:
    """Per class its rows and, for the targets max, mean and median, how many are missing (capped)."""
    per = rows.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("rows"))
    whole = per.agg(F.max("rows").alias("_max"), F.bround(F.avg("rows")).cast("long").alias("_mean"), F.bround(F.median("rows")).cast("long").alias("_median"))
    out = per.crossJoin(F.broadcast(whole))
    missing = lambda t: F.least(F.lit(cap).cast("long"), F.greatest(F.lit(0).cast("long"), F.col(t) - F.col("rows")))
    return out.select(label, "rows", *(missing(f"_{t}").alias(f"missing_{t}") for t in ("max", "mean", "median")))


def quality_summary(metrics: DataFrame) -> DataFrame:
    """One row: counts, means, and the smallest and largest picture."""
    area = F.when((F.col("width") > 0) & (F.col("height") > 0), F.col("width").cast("long") * F.col("height"))
    blur = F.when(~F.isnan("blur_variance") & (F.col("blur_variance") >= 0), F.col("blur_variance"))
    rows = metrics.withColumn("_area", area).withColumn("_blur", blur)
    return rows.agg(
        F.count("*").alias("rows"),
        F.count_if("is_corrupted").alias("corrupted"),
        F.count_if("processing_error").alias("errors"),
        F.count_if("has_watermark").alias("watermarked"),
        F.count_if("low_resolution").alias("low_resolution"),
        F.round(F.avg("_blur"), 4).alias("mean_blur"),
        F.round(F.avg("brightness_mean"), 4).alias("mean_brightness"),
        F.min("_area").alias("least_area"),
        F.max("_area").alias("greatest_area"),
        F.percentile("_blur", 0.5).alias("median_blur"),
    )


def equal_groups(rows: DataFrame, key: str, member: str) -> DataFrame:
    """Values that several members share."""
    return rows.filter(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(key).agg(F.count_distinct(member).alias("members"), F.min(member).alias("first")).filter("members > 1")


def contradictions(rows: DataFrame, key: str, label: str) -> DataFrame:
    """Values whose members carry different labels."""
    return rows.filter(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(key).agg(F.count("*").alias("rows"), F.count_distinct(label).alias("labels")).filter("labels > 1")


def contamination(pairs: DataFrame) -> DataFrame:
    """How often two sources share a duplicate (left_source, right_source)."""
    a, b = F.least("left_source", "right_source"), F.greatest("left_source", "right_source")
    return pairs.filter("left_source is not null and right_source is not null and left_source <> right_source").groupBy(a.alias("source_a"), b.alias("source_b")).agg(F.count("*").alias("pairs"))


def top_reasons(decisions: DataFrame, n: int = 10) -> DataFrame:
    return decisions.filter("reason is not null").groupBy("reason").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "reason").limit(n)


def wilson(hits: Column, trials: Column, z: float = 1.959963984540054) -> tuple[Column, Column]:
    """The 95 % interval of a proportion."""
    n, p = trials.cast("double"), hits / trials
    middle = (p + z * z / (2 * n)) / (1 + z * z / n)
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)
    low, high = F.greatest(F.lit(0.0), middle - half), F.least(F.lit(1.0), middle + half)
    return F.when(trials > 0, low), F.when(trials > 0, high)


def precision_recall(found: DataFrame, truth: DataFrame, *keys: str) -> DataFrame:
    """One row with hits, precision and recall of distinct pairs."""
    both = found.select(*keys).distinct().withColumn("_f", F.lit(1)).join(truth.select(*keys).distinct().withColumn("_t", F.lit(1)), list(keys), "full")
    hits, f, t = F.count_if(F.col("_f").isNotNull() & F.col("_t").isNotNull()), F.count("_f"), F.count("_t")
    return both.agg(hits.alias("hits"), f.alias("found"), t.alias("true_pairs"), F.round(F.try_divide(hits, f), 6).alias("precision"), F.round(F.try_divide(hits, t), 6).alias("recall"))


def centroids(vectors: DataFrame, label: str, vector: str) -> DataFrame:
    """(label, i, c): the mean of unit vectors of each class, of unit length itself, in long form."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    flat = vectors.filter(F.col(label).isNotNull()).withColumn("_n", norm).filter("_n > 0").select(label, "_n", F.posexplode(vector).alias("i", "x"))
    mean = flat.groupBy(label, "i").agg(F.avg(F.col("x").cast("double") / F.col("_n")).alias("m"))
    length = mean.groupBy(label).agg(F.sqrt(F.sum(F.col("m") * F.col("m"))).alias("_l")).filter("_l > 0")
    return mean.join(length, label).select(label, "i", (F.col("m") / F.col("_l")).alias("c"))
