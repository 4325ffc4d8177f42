"""Ordered operators: representatives, first examples, windows of a bucket, two-signal tops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def ranked(df: DataFrame, group: str, *order: Column | str, name: str = "place") -> DataFrame:
    return df.withColumn(name, F.row_number().over(W.partitionBy(group).orderBy(*order)))


def first_of_each(df: DataFrame, group: str, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows of each group. A limit on the rank is taken before the shuffle, too."""
    return ranked(df, group, *order).filter(F.col("place") <= n)


def keep_order(area: str = "area", sharpness: str = "sharpness", padding: str = "padding", path: str = "filepath", key: str = "sample_id") -> list[Column]:
    """Best copy first: usable, clean, sharp and large before others, then the smallest id."""
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)).cast("int").asc()
    return [flag("is_corrupted"), flag("has_watermark"), flag("has_smearing"), flag("low_resolution"), F.coalesce(F.col(area), F.lit(0)).desc(), F.coalesce(F.col(sharpness), F.lit(0.0)).desc(), F.coalesce(F.col(padding), F.lit(0.0)).asc(), F.lower(path).rlike(r"\.rf\.|_aug|augmentation").cast("int").asc(), F.col(key).asc()]


def bucket_neighbours(keys: DataFrame, bucket: str, key: str, reach: int) -> DataFrame:
    """(left, right): members of a bucket that lie at most ``reach`` places apart in the order of ids.

    A range of places, not all pairs: rows grow with reach, not with the square of the bucket. The
    place is cut into stretches of ``reach``, so that the join is an equi-join on bucket and stretch.
    """
    placed = keys.select(bucket, key).distinct().withColumn("place", F.row_number().over(W.partitionBy(bucket).orderBy(key)))
    cell = F.floor(F.col("place") / reach).cast("long")
    a = placed.select(bucket, F.col(key).alias("left"), F.col("place").alias("_p"), F.explode(F.array(cell, cell + 1)).alias("_c"))
    b = placed.select(bucket, F.col(key).alias("right"), F.col("place").alias("_q"), cell.alias("_c"))
    return a.join(b, [bucket, "_c"]).filter((F.col("_q") > F.col("_p")) & (F.col("_q") - F.col("_p") <= reach)).select(F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right"))


def two_signals(candidates: DataFrame, query: str, near: Column, alike: Column, n: int, *tie: str) -> DataFrame:
    """Per query the ``n`` nearest by one signal and the ``n`` most alike by another."""
    a = F.row_number().over(W.partitionBy(query).orderBy(near.asc(), *tie))
    b = F.row_number().over(W.partitionBy(query).orderBy(alike.desc(), *tie))
    return candidates.withColumn("by_near", a).withColumn("by_alike", b).filter((F.col("by_near") <= n) | (F.col("by_alike") <= n))


def vote_pool(votes: DataFrame, query: str, other: str, pool: int) -> DataFrame:
    """Candidates of each query by number of shared buckets, at most ``pool`` of them."""
    n = votes.groupBy(query, other).agg(F.count("*").alias("votes"))
    return first_of_each(n, query, pool, F.desc("votes"), other)


def rarity_order(groups: DataFrame) -> list[Column]:
    """groups(group_id, size, rarest): rare labels first, then large groups, then a stable hash."""
    return [F.col("rarest").asc(), F.col("size").desc(), F.sha2("group_id", 256).asc()]
