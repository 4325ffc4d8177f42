"""Splits of groups: allocation, audits, reconciliation after new duplicates, pairs that cross splits."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators.components import components
from millrace.storage import stage

PRIORITY = {"train": 0, "val": 1, "test": 2}


def group_table(rows: DataFrame, group: str = "group_id", label: str = "label") -> DataFrame:
    """(group_id, size, rarest, labels): one row a group, labels as a map of counts."""
    named = rows.select(F.col(group).alias("group_id"), F.coalesce(F.col(label), F.lit("__unlabeled__")).alias("label"))
    totals = named.groupBy("label").agg(F.count("*").alias("total"))
    per = named.groupBy("group_id", "label").agg(F.count("*").alias("n")).join(totals, "label")
    return per.groupBy("group_id").agg(F.sum("n").alias("size"), F.min("total").alias("rarest"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "n")))).alias("labels"))


ROWS = "\0rows"  # the label that every row has


def greedy_walk(items: list[tuple[str, dict[str, int]]], need: dict[str, list[float]], total: dict[str, float], proportions: list[float], names: list[str]) -> list[int]:
    """The split of each item: in rarity order, to the split where the squared error of sizes and
    label counts is least after it, ties by a hash of item and split."""
    order = sorted(range(len(items)), key=lambda i: (min((total[x] for x in items[i][1] if x != ROWS), default=0), -items[i][1].get(ROWS, 0), hashlib.sha256(items[i][0].encode()).hexdigest()))
    out = [0] * len(items)
    for i in order:
        name, counts = items[i]

        def change(s: int, name: str = name, counts: dict[str, int] = counts) -> tuple[float, str]:
            # (held - want)^2 / want, where need is want - held; only what the item changes differs
            moved = sum(((need[x][s] - n) ** 2 - need[x][s] ** 2) / max(total[x] * proportions[s], 1.0) for x, n in counts.items())
            return round(moved, 9), hashlib.sha256(f"{name}:{names[s]}".encode()).hexdigest()

        out[i] = min(range(len(proportions)), key=change)
        for x, n in counts.items():
            need[x][out[i]] -= n
    return out


def place_groups(groups: DataFrame, proportions: dict[str, float], walk: Callable, large: int = 1024, few: int = 64, walk_rows: int = 500_000, even_rows: bool = True) -> DataFrame:
    """groups(group_id, labels: map of counts) -> (group_id, split), by ``walk`` over label vectors.

    Groups with the same label vector are one class with a count. First come the groups of more than
    1 / ``large`` of all rows (fewer than ``large`` of them), which are walked with the whole needs
    of all splits. Of a class of ``few`` groups or more each split gets the whole part of its share:
    the mean of the shares that the splits still want, after the large groups, of the class's labels
    and (``even_rows``) of all rows. What that leaves of a class, and all of smaller ones, is walked
    to fill what the splits still need. Both walks run in a task, over fewer than ``few`` groups of a
    class; beyond ``walk_rows`` of them several tasks share the classes, of which each balances its
    own and its part of what the large groups left. The rule is the same at every size.
    """
    names, shares = list(proportions), list(proportions.values())
    if abs(sum(shares) - 1) > 1e-9:
        raise ValueError("proportions must add up to 1")
    entries = F.array_sort(F.transform(F.map_entries("labels"), lambda e: F.struct(e["key"].alias("label"), e["value"].cast("bigint").alias("n"))))
    keyed = stage(groups.select("group_id", entries.alias("e")).withColumn("class", F.sha2(F.to_json("e"), 256)).withColumn("size", F.coalesce(F.get(F.filter("e", lambda x: x["label"] == ROWS), 0)["n"], F.lit(0))), "keyed")
    whole, = keyed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()
    big = F.col("size") * large > whole
    classes = stage(keyed.groupBy("class").agg(F.first("e").alias("e"), F.first("size").alias("size"), F.count("*").alias("n")), "classes")
    tops = classes.filter(big)
    of_tops = tops.select(F.explode("e.label").alias("label")).distinct()
    totals = classes.select("n", F.explode("e").alias("x")).select(F.col("x.label").alias("label"), (F.col("x.n") * F.col("n")).alias("m")).join(of_tops, "label", "left_semi").groupBy("label").agg(F.sum("m").alias("total"))
    # fewer than ``large`` groups and the labels they hold
    held = [(r["class"], {x.label: x.n for x in r["e"]}) for r in tops.orderBy("class").toLocalIterator() for _ in range(r["n"])]
    total = {r["label"]: float(r["total"]) for r in totals.toLocalIterator()}
    need = {x: [t * p for p in shares] for x, t in total.items()}
    chosen = walk([(f"{c}:{i}", v) for i, (c, v) in enumerate(held)], need, total, shares, names)
    given: dict[str, list[int]] = {}
    debts: dict[str, list[float]] = {}
    for (c, counts), s in zip(held, chosen):
        given.setdefault(c, [0] * len(names))[s] += 1
        for x, n in counts.items():
            debts.setdefault(x, [0.0] * len(names))
            for k, p in enumerate(shares):
                debts[x][k] += n * p - (n if k == s else 0)
    parts = max(1, -(-(classes.agg(F.sum(F.least("n", F.lit(few)))).first()[0] or 0) // walk_rows))

    def rest(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("class")
        vectors = [{x["label"]: x["n"] for x in e} for e in rows["e"]]
        total: dict[str, float] = {}
        for counts, n in zip(vectors, rows["n"]):
            for x, m in counts.items():
                total[x] = total.get(x, 0.0) + n * m
        debt = {x: [d / parts for d in debts.get(x, [0.0] * len(names))] for x in total}
        need = {x: [t * p + d for p, d in zip(shares, debt[x])] for x, t in total.items()}
        own = {x: [max(0.0, n) for n in v] for x, v in need.items()}  # what splits still want of a label
        own = {x: [n / (sum(v) or 1.0) for n in v] for x, v in own.items()}
        quotas, items, at = [], [], []
        for i, (c, counts, n) in enumerate(zip(rows["class"], vectors, rows["n"])):
            labels = [x for x in counts if x != ROWS] or list(counts)
            both = ([own[ROWS]] if even_rows and ROWS in counts else []) * len(labels) + [own[x] for x in labels]
            quota = [int(n * sum(v[s] for v in both) / max(1, len(both)) + 1e-9) if n >= few else 0 for s in range(len(names))]
            quotas.append(quota)
            for k in range(n - sum(quota)):
                items.append((f"{c}:{k}", counts))
                at.append(i)
            for x, m in counts.items():
                for s, q in enumerate(quota):
                    need[x][s] -= q * m
        for i, s in zip(at, walk(items, need, total, shares, names)):
            quotas[i][s] += 1
        return pd.DataFrame({"class": list(rows["class"]), "quota": quotas})

    small = classes.filter(~big).select("class", "e", "n", F.pmod(F.xxhash64("class"), F.lit(parts)).alias("part"))
    quotas = small.groupBy("part").applyInPandas(rest, "class string, quota array<bigint>")
    quotas = quotas.unionByName(groups.sparkSession.createDataFrame(list(given.items()), "class string, quota array<bigint>"))
    return _dealt(keyed.select("group_id", "class"), classes.select("class", "n"), quotas, names)


def _dealt(keyed: DataFrame, classes: DataFrame, quotas: DataFrame, names: list[str], run: int = 100_000) -> DataFrame:
    """The groups of a class to its quotas, in the order of a hash; a large class is numbered in runs."""
    runs = F.ceil(F.col("n") / run).cast("long")
    own = keyed.join(classes, "class").select("group_id", "class", F.pmod(F.xxhash64("group_id"), runs).alias("run"))
    before = own.groupBy("class", "run").count().withColumn("before", F.sum("count").over(W.partitionBy("class").orderBy("run")) - F.col("count")).drop("count")
    place = F.row_number().over(W.partitionBy("class", "run").orderBy(F.xxhash64("group_id", F.lit(1)), "group_id"))
    numbered = own.withColumn("place", place).join(before, ["class", "run"]).join(quotas, "class").withColumn("place", F.col("place") + F.col("before"))
    split, upto = None, F.lit(0)
    for i, name in enumerate(names):
        upto = upto + F.get("quota", i)
        split = F.when(F.col("place") <= upto, name) if split is None else split.when(F.col("place") <= upto, name)
    return numbered.select("group_id", split.alias("split"))


def allocate(groups: DataFrame, proportions: dict[str, float], **options: int) -> DataFrame:
    """(group_id, split): groups(group_id, size, labels) to splits by ``greedy_walk`` over classes of
    groups with equal label counts, see ``place_groups``."""
    counted = groups.select("group_id", F.map_concat("labels", F.create_map(F.lit(ROWS), F.col("size").cast("bigint"))).alias("labels"))
    return place_groups(counted, proportions, greedy_walk, **options)


def split_groups(rows: DataFrame, group: str) -> DataFrame:
    """Groups that lie in more than one split: must be empty."""
    return rows.filter(F.col(group).isNotNull()).groupBy(group).agg(F.array_sort(F.collect_set("split")).alias("splits")).filter(F.size("splits") > 1)


def reconcile(assigned: DataFrame, pairs: DataFrame) -> DataFrame:
    """assigned(group_id, split), pairs(left, right) of groups -> (group_id, split): groups that were
    found to belong together take the first of their splits in the order train, val, test."""
    parts = components(pairs).withColumnRenamed("v", "group_id")
    order = F.element_at(F.create_map(*[F.lit(x) for kv in PRIORITY.items() for x in kv]), F.col("split"))
    joined = assigned.join(parts, "group_id", "left").withColumn("component", F.coalesce("component", "group_id"))
    best = joined.groupBy("component").agg(F.min_by("split", order).alias("best"))
    return joined.join(best, "component").select("group_id", F.col("best").alias("split"))


def crossing_pairs(pairs: DataFrame, splits: DataFrame) -> DataFrame:
    """Pairs (left, right) whose ends lie in different splits."""
    a = splits.select(F.col("sample_id").alias("left"), F.col("split").alias("left_split"))
    b = splits.select(F.col("sample_id").alias("right"), F.col("split").alias("right_split"))
    return pairs.join(a, "left").join(b, "right").filter("left_split <> right_split")


SPLIT_TAGS = ("train", "val", "test")


def partition(samples: DataFrame, families: DataFrame, proportions: dict[str, float], label: str = "normalized_label") -> DataFrame:
    """samples with ``split_group_id``, ``assigned_split`` and the split among their tags.

    families(sample_id, group_id) are of all samples, so that removed ones still tie what they tied;
    only kept samples get a split. A group in two splits would be an error.
    """
    tied = stage(samples.join(families.select("sample_id", F.col("group_id").alias("split_group_id")), "sample_id", "left").withColumn("split_group_id", F.coalesce("split_group_id", "sample_id")), "tied")
    kept = tied.filter("lower(status) = 'kept'").select("sample_id", "split_group_id", label)
    groups = group_table(kept, "split_group_id", label)
    got = stage(allocate(groups, proportions), "allocation")
    assigned = kept.select("sample_id", "split_group_id").distinct().join(got.select(F.col("group_id").alias("split_group_id"), F.col("split").alias("assigned_split")), "split_group_id").select("sample_id", "assigned_split")
    if not split_groups(assigned.join(tied.select("sample_id", "split_group_id").distinct(), "sample_id").withColumnRenamed("assigned_split", "split"), "split_group_id").isEmpty():
        raise ValueError("a group lies in several splits")
    out = tied.drop("assigned_split").join(assigned, "sample_id", "left")
    tags = F.array_except(F.coalesce("tags", F.array().cast("array<string>")), F.array(*map(F.lit, SPLIT_TAGS)))
    return out.withColumn("tags", F.array_sort(F.array_compact(F.concat(tags, F.array("assigned_split")))))


def reconcile_samples(samples: DataFrame, pairs: DataFrame) -> DataFrame:
    """samples whose split groups are united by newly confirmed pairs(left, right) of samples: all groups
    of a component take the first of their splits in the order train, val, test."""
    of = samples.filter("assigned_split is not null").select("sample_id", "split_group_id").distinct()
    met = pairs.join(of.select(F.col("sample_id").alias("left"), F.col("split_group_id").alias("a")), "left").join(of.select(F.col("sample_id").alias("right"), F.col("split_group_id").alias("b")), "right")
    assigned = samples.filter("assigned_split is not null").select(F.col("split_group_id").alias("group_id"), F.col("assigned_split").alias("split")).distinct()
    new = reconcile(assigned, met.filter("a <> b").select(F.col("a").alias("left"), F.col("b").alias("right")))
    out = samples.join(new.select(F.col("group_id").alias("split_group_id"), F.col("split").alias("_new")).distinct(), "split_group_id", "left")
    return out.withColumn("assigned_split", F.when(F.col("assigned_split").isNotNull(), F.coalesce("_new", "assigned_split"))).drop("_new").select(*samples.columns)
