"""The registered queries of the problems tagged llm. Imported by __spark_entry__.py only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import canonical, grouped_splits, links, neighbours, overlap, personal, representative, tiling, tokenize
from millrace.storage import stage, table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return grouped_splits.shared_groups(table(spark, d, "samples"))


def p1_splits(spark: SparkSession, d: str) -> DataFrame:
    return grouped_splits.split_samples(table(spark, d, "samples")).select("sample_id", "group_id", "assigned_split").distinct()


def p1_balance(spark: SparkSession, d: str) -> DataFrame:
    """Per label whether the splits have their parts of it, and (label null) that no group is split."""
    samples = table(spark, d, "samples")
    assigned = stage(p1_splits(spark, d), "assigned")
    torn = assigned.filter("group_id is not null").groupBy("group_id").agg(F.count_distinct("assigned_split").alias("n")).filter("n > 1")
    none = torn.agg(F.lit(None).cast("string").alias("label"), F.count("*").alias("samples"), (F.count("*") == 0).alias("balanced"))
    return grouped_splits.balance(samples, assigned).unionByName(none)


def _p2(spark: SparkSession, d: str) -> DataFrame:
    vectors = neighbours.usable(table(spark, d, "descriptors"), "sample_id", "histogram", 512, "computed_at")
    members, _, graph = neighbours.neighbour_graph(vectors)
    return neighbours.nearest_pairs(members, graph)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _p2(spark, d).select("left_id", "right_id").distinct()


def p2_search(spark: SparkSession, d: str) -> DataFrame:
    """The 20 nearest of every sample whose id is divisible by 50, by greedy search along the graph."""
    vectors = neighbours.usable(table(spark, d, "descriptors"), "sample_id", "histogram", 512, "computed_at")
    members, classes, graph = neighbours.neighbour_graph(vectors)
    asked = vectors.filter(F.pmod(F.conv(F.substring("id", -8, 8), 16, 10).cast("long"), F.lit(50)) == 0)
    return neighbours.search(asked, members, classes, graph).select("id", "neighbour", F.round("cosine", 6).alias("cosine"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    mapped = canonical.map_entries(table(spark, d, "labels"), table(spark, d, "ontology"))
    return mapped.filter("not exact").select("label_id", "field", "entry_id").distinct()


def p3_misses(spark: SparkSession, d: str) -> DataFrame:
    return canonical.misses(canonical.map_entries(table(spark, d, "labels"), table(spark, d, "ontology")))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return links.clusters(table(spark, d, "duplicate_links"), table(spark, d, "samples"))


def p5_all(spark: SparkSession, d: str) -> DataFrame:
    return links.all_clusters(table(spark, d, "duplicate_links"), table(spark, d, "samples"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return representative.representatives(table(spark, d, "decisions"), table(spark, d, "quality_metrics")).select("cluster_id", "representative_id")


def p6_survivors(spark: SparkSession, d: str) -> DataFrame:
    return representative.representatives(table(spark, d, "decisions"), table(spark, d, "quality_metrics"))


def p6_currency(spark: SparkSession, d: str) -> DataFrame:
    """Per field: samples with several values whose timestamps are hidden, and for how many of them the
    order learned from other samples gives the value that is truly the latest."""
    return representative.withheld(table(spark, d, "quality_metrics"))


def _p7(spark: SparkSession, d: str) -> DataFrame:
    return overlap.cross_split_pairs(table(spark, d, "labels"), table(spark, d, "quality_metrics"), table(spark, d, "descriptors"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _p7(spark, d).select(F.least("train_id", "held_id").alias("left_id"), F.greatest("train_id", "held_id").alias("right_id")).distinct()


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels")
    return overlap.report(labels, overlap.covered(labels, table(spark, d, "quality_metrics"), table(spark, d, "descriptors")))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenize.encode_documents(table(spark, d, "documents"))


def _p9(spark: SparkSession, d: str) -> DataFrame:
    return tiling.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _p9(spark, d).select("doc_id", "item_id").distinct()


def p9_coverage(spark: SparkSession, d: str) -> DataFrame:
    return _p9(spark, d)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return personal.findings(table(spark, d, "documents"), table(spark, d, "contributors")).select("doc_id", "kind", "found").distinct()


def p10_redacted(spark: SparkSession, d: str) -> DataFrame:
    return personal.redact(table(spark, d, "documents"), table(spark, d, "contributors"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (p1_found, p1_splits, p1_balance, p2_found, p2_search, p3_found, p3_misses, p5_found, p5_all, p6_found, p6_survivors, p6_currency, p7_found, p7_report, p8_ids, p9_found, p9_coverage, p10_found, p10_redacted)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    from millrace.llm.sql import SQL

    return SQL
