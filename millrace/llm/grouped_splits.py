"""Problem 1: splits that keep related samples together.

Samples that share a capture group, video or location within a source, or a duplicate cluster
anywhere, are one component (bipartite edges of sample and key, so a key that a third of the
samples share costs one edge a sample). Components then get their split by grouped iterative
stratification: their labels are added up to a vector, the label of which the fewest samples are
outstanding comes first, and what holds it goes to the split that needs that label most.

Components with exactly the same vector are one class with a count, so what is walked are classes
and at most a thousand very large components, see ``place_groups``: no component is merged with one
of another vector and no label with another.

Defined results: a blank key, or one that says that nothing is known, ties nothing, and neither
does a key without a source; a null label counts as ``unlabeled``; a sample with several labels
counts under each; rows of one sample share its split; rows without an id are single; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import known_key as plain
from millrace.llm.grid_components import components
from millrace.operators.splits import ROWS, place_groups
from millrace.storage import stage

KEYS = ("capture_group", "video_id", "location")
SPLITS = ("train", "val", "test")


def ties(samples: DataFrame) -> DataFrame:
    """(left, right): a sample and a key it has. '~' keeps keys behind every id."""
    source = plain(F.col("source_dataset"))
    keys = [F.concat(F.lit(f"~{i}|"), source, F.lit("|"), plain(F.col(k))) for i, k in enumerate(KEYS)]
    keys.append(F.concat(F.lit("~9|"), plain(F.col("duplicate_cluster_id"))))
    return samples.filter("sample_id is not null").select(F.col("sample_id").alias("left"), F.explode(F.array(*keys)).alias("right")).filter("right is not null")


def related(samples: DataFrame) -> DataFrame:
    """(sample_id, group_id) for every sample that has a key."""
    return components(ties(samples)).filter(~F.col("v").startswith("~")).select(F.col("v").alias("sample_id"), F.col("component").alias("group_id"))


def shared_groups(samples: DataFrame) -> DataFrame:
    """The samples that must share their split with another one."""
    groups = related(samples)
    sizes = groups.groupBy("group_id").count().filter("count > 1").select("group_id")
    return groups.join(sizes, "group_id", "left_semi").select("sample_id", "group_id")


def stratify(items: list[tuple[str, dict[str, int]]], need: dict[str, list[float]], total: dict[str, float], proportions: list[float], names: list[str]) -> list[int]:
    """The split of each item, given its label counts: the label of which the fewest are outstanding
    comes first, and of what holds it the most first; each goes to the split that needs that label
    most, then to the one that needs rows most."""
    left: dict[str, int] = {}
    holders: dict[str, list[int]] = {}
    for i, (_, counts) in enumerate(items):
        for label, n in counts.items():
            left[label] = left.get(label, 0) + n
            holders.setdefault(label, []).append(i)
    placed, out = [False] * len(items), [0] * len(items)
    draw = [hashlib.sha256(name.encode()).digest() for name, _ in items]  # so that no vector is favoured by its place
    heap = [(n, x) for x, n in left.items() if x != ROWS]
    heapq.heapify(heap)
    while heap or ROWS in left:
        n, label = heapq.heappop(heap) if heap else (left[ROWS], ROWS)  # what has no label comes last
        if label not in left:
            continue
        if n != left[label]:
            heapq.heappush(heap, (left[label], label))
            continue
        for i in sorted((i for i in holders[label] if not placed[i]), key=lambda i: (-items[i][1][label], draw[i])):
            counts, tie = items[i][1], draw[i][0]

            def wanting(s: int, counts: dict[str, int] = counts, label: str = label, tie: int = tie) -> tuple:
                """The share of its own that a split still wants when half of the item is in it."""
                p = max(proportions[s], 1e-9)
                share = lambda x: round((need[x][s] - counts[x] / 2) / (max(total[x], 1.0) * p), 9) if x in counts else 0.0
                return share(label), share(ROWS), (tie + s) % len(proportions)

            best = max(range(len(proportions)), key=wanting)
            placed[i], out[i] = True, best
            for x, m in counts.items():
                need[x][best] -= m
                if x in left:
                    left[x] -= m
        del left[label]
    return out


def label_vectors(samples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((sample_id, group_id), (group_id, labels)): every sample with its component, and of every
    component how many samples it has of each label, and in all. A sample counts under each of its labels."""
    own = samples.select("sample_id", F.coalesce(plain(F.col("source_label")), F.lit("unlabeled")).alias("label")).filter("sample_id is not null").distinct()
    ids = own.select("sample_id").distinct().join(related(samples), "sample_id", "left").select("sample_id", F.coalesce("group_id", "sample_id").alias("group_id"))
    ids = stage(ids, "groups")
    rows = own.join(ids, "sample_id").select("group_id", "label").unionByName(ids.select("group_id", F.lit(ROWS).alias("label")))
    per = rows.groupBy("group_id", "label").agg(F.count("*").alias("n"))
    return ids, per.groupBy("group_id").agg(F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("labels"))


def split_samples(samples: DataFrame, proportions: tuple[float, float, float] = (0.8, 0.1, 0.1), **options: int) -> DataFrame:
    """Every row of ``samples`` with ``group_id`` and ``assigned_split``."""
    ids, vectors = label_vectors(samples)
    groups = place_groups(vectors, dict(zip(SPLITS, proportions)), stratify, even_rows=False, **options).withColumnRenamed("split", "assigned_split")
    out = samples.drop("group_id", "assigned_split").join(ids.join(groups, "group_id"), "sample_id", "left")
    alone = F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in ("filepath", "source_dataset", "source_label")]), F.lit(1000)) / 1000.0
    single = F.when(alone < proportions[0], SPLITS[0]).when(alone < proportions[0] + proportions[1], SPLITS[1]).otherwise(SPLITS[2])
    return out.withColumn("assigned_split", F.coalesce("assigned_split", single))


def balance(samples: DataFrame, assigned: DataFrame, proportions: tuple[float, float, float] = (0.8, 0.1, 0.1)) -> DataFrame:
    """(label, samples, balanced): whether each split has its part of a label's samples, within one in
    a hundred of them, one sample and twice what the largest component holds (which can't be divided,
    and of which the other labels have a say).
    assigned(sample_id, group_id, assigned_split)."""
    own = samples.select("sample_id", F.coalesce(plain(F.col("source_label")), F.lit("unlabeled")).alias("label")).filter("sample_id is not null").distinct()
    rows = own.join(assigned.select("sample_id", "group_id", "assigned_split").distinct(), "sample_id")
    per = rows.groupBy("label", "group_id", "assigned_split").agg(F.count("*").alias("n"))
    sums = per.groupBy("label").agg(F.sum("n").alias("samples"), F.max("n").alias("most"), *(F.sum(F.when(F.col("assigned_split") == s, F.col("n")).otherwise(0)).alias(s) for s in SPLITS))
    fine = F.lit(True)
    for s, p in zip(SPLITS, proportions):
        fine = fine & (F.abs(F.col(s) - p * F.col("samples")) <= 0.01 * F.col("samples") + 1 + 2 * F.col("most"))
    return sums.select("label", "samples", fine.alias("balanced"))
