"""Problem 5: the matches of duplicate_links as clusters of samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.grid_components import components

#: The levels that confirm a match.
CONFIRMED = ("exact_bytes", "exact_pixels", "verified_visual", "human_confirmed")


def confirmed_links(links: DataFrame, samples: DataFrame) -> DataFrame:
    """(left, right) of the pairs that link: a confirmed row, and no row of the pair is rejected.

    Null ids, loops and pairs with an id that is not in ``samples`` don't link; a null level
    confirms nothing and a null ``rejected`` rejects nothing.
    """
    pairs = (
        links.filter("left_id <> right_id")
        .groupBy(F.least("left_id", "right_id").alias("left"), F.greatest("left_id", "right_id").alias("right"))
        .agg(F.max(F.coalesce("rejected", F.lit(False))).alias("rejected"), F.max(F.coalesce(F.col("level").isin(*CONFIRMED), F.lit(False))).alias("confirmed"))
        .filter("confirmed and not rejected")
    )
    known = samples.select("sample_id").filter("sample_id is not null").distinct()
    for side in ("left", "right"):
        pairs = pairs.join(known.withColumnRenamed("sample_id", side), side, "left_semi")
    return pairs.select("left", "right")


def clusters(links: DataFrame, samples: DataFrame) -> DataFrame:
    """(sample_id, cluster_id) of every sample in a cluster of two or more."""
    return components(confirmed_links(links, samples)).select(F.col("v").alias("sample_id"), F.col("component").alias("cluster_id"))


def all_clusters(links: DataFrame, samples: DataFrame) -> DataFrame:
    """One row for each sample; one without a match is its own cluster."""
    known = samples.select("sample_id").filter("sample_id is not null").distinct()
    return known.join(clusters(links, samples), "sample_id", "left").select("sample_id", F.coalesce("cluster_id", "sample_id").alias("cluster_id"))
