"""Ontologies, canonical annotations and suggestions which labels mean the same."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.geometry import valid_box
from millrace.functions.text import normal_label, sequence_ratio
from millrace.storage import stage

#: Prefixes that turn a stage of life into its opposite.
OPPOSITES = ("un_", "non_", "partially_", "pre_", "un", "non", "partially")


def flatten_ontology(ontology: dict) -> list[tuple[str, str, str | None]]:
    """(raw label, canonical, coarse) of a hierarchy in any of its written forms.

    ``classes`` / ``canonical_mapping`` / ``fine`` map a canonical name to raw labels (or a raw label
    to its canonical name); ``coarse_mapping`` / ``hierarchy`` map coarse names to canonical ones or
    the other way round. A raw label under two canonical names, or an empty list, is an error.
    """
    def pairs(mapping: dict) -> list[tuple[str, str]]:
        out = []
        for key, value in (mapping or {}).items():
            if isinstance(value, (list, tuple)):
                if not value:
                    raise ValueError(f"no labels under {key}")
                out += [(str(v), str(key)) for v in value]
            else:
                out.append((str(key), str(value)))
        return out

    named = next((ontology[k] for k in ("classes", "canonical_mapping", "fine") if k in ontology), None)
    coarse = next((ontology[k] for k in ("coarse_mapping", "hierarchy") if k in ontology), {})
    if named is None:
        named = {k: v for k, v in ontology.items() if k not in ("coarse_mapping", "hierarchy", "name", "version")}
    fine: dict[str, str] = {}
    for raw, canonical in pairs(named):
        if fine.setdefault(raw, canonical) != canonical:
            raise ValueError(f"{raw} belongs to {fine[raw]} and {canonical}")
    above: dict[str, str] = {}
    for canonical, top in pairs(coarse):
        if above.setdefault(canonical, top) != top:
            raise ValueError(f"{canonical} belongs to {above[canonical]} and {top}")
    return [(raw, canonical, above.get(canonical)) for raw, canonical in sorted(fine.items())]


def apply_ontology(rows: DataFrame, ontology: DataFrame, label: str) -> DataFrame:
    """rows with ``canonical``: the ontology's name of the label, else the label's own normal form.

    ontology(raw, canonical) is joined on the normal form; Spark broadcasts it if it is small.
    """
    own = ontology.select(normal_label(F.col("raw")).alias("_key"), "canonical").groupBy("_key").agg(F.min("canonical").alias("canonical"))
    return rows.withColumn("_key", normal_label(F.col(label))).join(own, "_key", "left").withColumn("canonical", F.coalesce("canonical", "_key")).drop("_key")


def canonical_annotations(boxes: Column, label: Column) -> tuple[Column, Column, Column]:
    """(labels, task types, issues) of a row: sorted sets of normal labels, and what is wrong."""
    good = F.filter(boxes, lambda b: valid_box(b["bounding_box"]))
    none = F.array().cast("array<string>")
    of_boxes = F.coalesce(F.transform(good, lambda b: b["label"]), none)
    own = F.when(label.isNotNull(), F.array(label)).otherwise(none)
    names = F.array_sort(F.array_distinct(F.filter(F.concat(of_boxes, own), lambda x: x.isNotNull())))
    tasks = F.array_compact(F.array(F.when(label.isNotNull(), F.lit("classification")), F.when(F.coalesce(F.size(good), F.lit(0)) > 0, F.lit("detection"))))
    issues = F.array_compact(F.array(F.when(F.coalesce(F.size(boxes), F.lit(0)) > F.coalesce(F.size(good), F.lit(0)), F.lit("invalid_bbox")), F.when(F.size(names) == 0, F.lit("no_label"))))
    return names, tasks, issues


#: Endings of labels that say nothing of the class, and names that are kept where variants merge.
ENDINGS = ("_diease", "_disease", "_diseases", "_dataset", "_sin_fondo", "_evaluacion", "_evaluación", "_entrenamiento")
STANDARD_TERMS = (
    "anthracnose", "healthy", "avocado", "powdery_mildew", "leaf_spot",
    "bacterial_canker", "fruit_rot", "apple", "banana", "orange", "mango",
    "papaya", "tomato", "chirimoya", "black_spot", "ring_spot", "phytophthora",
)


def stem_of(label: Column) -> Column:
    """A label without an ending that says nothing of its class (a label that is nothing else stays)."""
    out = F.regexp_replace(label, "(" + "|".join(ENDINGS) + ")$", "")
    return F.when(out == "", label).otherwise(out)


def label_pairs(labels: DataFrame, label: str, rows: str, least_ratio: float = 0.75, least_overlap: float = 0.5) -> DataFrame:
    """Pairs of labels that look alike: (left, right, ratio, overlap, category, merge, canonical).

    labels(label, rows) with one row a label. The ratio is the better one of labels and stems. A pair
    that merges takes the name of a standard term (of a stem, else of a label), else of the label with
    more rows, the left one at a tie; a pair that doesn't merge has no common name.

    No pair that reaches a limit is lost: candidates share a token (for the overlap), or have enough
    letters in common, wherever these stand, for the ratio (of the labels or of their stems). The latter
    are looked for among all pairs, in blocks. labels are a vocabulary, so tokens are shared by few.
    """
    own = labels.filter(F.col(label).isNotNull()).select(F.col(label).alias("l"), F.col(rows).alias("n"))
    keyed = own.select("l", F.explode(F.array_distinct(F.split("l", "_"))).alias("k"))
    sharing = keyed.select(F.col("l").alias("left"), "k").join(keyed.select(F.col("l").alias("right"), "k"), "k").filter("left < right").select("left", "right")
    pairs = sharing.unionByName(_alike(own, least_ratio)).distinct()
    if least_overlap <= 0:
        pairs = own.select(F.col("l").alias("left")).crossJoin(own.select(F.col("l").alias("right"))).filter("left < right")
    pairs = pairs.join(own.select(F.col("l").alias("left"), F.col("n").alias("left_rows")), "left").join(own.select(F.col("l").alias("right"), F.col("n").alias("right_rows")), "right")
    stems = stem_of(F.col("left")), stem_of(F.col("right"))
    ratio = F.greatest(sequence_ratio("left", "right"), sequence_ratio(*stems))
    tokens = [F.array_distinct(F.split(c, "_")) for c in ("left", "right")]
    overlap = F.size(F.array_intersect(*tokens)) / F.size(F.array_union(*tokens))
    scored = pairs.withColumn("ratio", F.round(ratio, 6)).withColumn("overlap", F.round(overlap, 6)).filter((F.col("ratio") >= least_ratio) | (F.col("overlap") >= least_overlap))
    opposite = F.lit(False)
    for p in OPPOSITES:
        opposite = opposite | (F.col("left") == F.concat(F.lit(p), F.col("right"))) | (F.col("right") == F.concat(F.lit(p), F.col("left")))
    category = F.when(opposite, "lifecycle_stage").when((F.col("ratio") >= 0.85) & (F.col("overlap") < 0.5), "typo_variant").when(F.col("ratio") >= 0.85, "exact_variant").otherwise("shared_tokens")
    out = scored.withColumn("category", category).withColumn("merge", F.col("category").isin("typo_variant", "exact_variant"))
    name = F.when(F.col("right_rows") > F.col("left_rows"), F.col("right")).otherwise(F.col("left"))
    for c in (F.col("right"), F.col("left"), stems[1], stems[0]):
        name = F.when(c.isin(*STANDARD_TERMS), c).otherwise(name)
    return out.withColumn("canonical", F.when(F.col("merge"), name))


def proposed_names(pairs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(label, canonical) of every normal label: the name that its most similar merging pair proposes.

    As in a list sorted by similarity and overlap (two digits), the first proposal for a label counts.
    Of a pair whose name is neither of its labels, the left one takes the name.
    """
    one = pairs.filter("merge").select(F.when(F.col("canonical") == F.col("left"), F.col("right")).otherwise(F.col("left")).alias("l"), "canonical", F.struct((-F.round("ratio", 2)).alias("r"), (-F.round("overlap", 2)).alias("o"), "left", "right").alias("k"))
    best = one.groupBy("l").agg(F.min_by("canonical", "k").alias("canonical"))
    own = labels.select(F.col(label).alias("l")).distinct()
    return own.join(best, "l", "left").select(F.col("l").alias(label), F.coalesce("canonical", "l").alias("canonical"))


def label_counts(samples: DataFrame) -> DataFrame:
    """(raw, source_dataset, rows): how many samples of a source have a raw label, as their own or in a box."""
    own = F.when(F.trim("source_label") != "", F.array(F.trim("source_label"))).otherwise(F.array().cast("array<string>"))
    boxes = F.transform("boxes", lambda b: F.trim(b["label"])) if "boxes" in samples.columns else F.array().cast("array<string>")
    every = F.array_distinct(F.filter(F.concat(own, F.coalesce(boxes, F.array().cast("array<string>"))), lambda x: x.isNotNull() & (x != "")))
    return samples.select(F.explode(every).alias("raw"), F.coalesce("source_dataset", F.lit("unknown")).alias("source_dataset")).groupBy("raw", "source_dataset").agg(F.count("*").alias("rows"))


def label_phase(samples: DataFrame, ontology: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(samples with ``normalized_label`` and ``normalized_labels``, boxes renamed; mapping(raw, canonical)).

    An ontology(raw, canonical) decides by itself; without one, variants of labels that look alike are
    merged by ``label_pairs``. Raw labels that neither names take their own normal form.
    """
    counts = label_counts(samples)
    raws = counts.groupBy("raw").agg(F.sum("rows").alias("rows")).withColumn("normal", normal_label(F.col("raw")))
    if ontology is None:
        normal = raws.groupBy("normal").agg(F.sum("rows").alias("rows")).filter("normal <> ''")
        names = proposed_names(label_pairs(normal, "normal", "rows"), normal, "normal")
        mapping = raws.join(names, "normal", "left").select("raw", F.coalesce("canonical", "normal").alias("canonical"))
    else:
        mapping = raws.join(ontology.groupBy("raw").agg(F.min("canonical").alias("canonical")), "raw", "left").select("raw", F.coalesce("canonical", "normal").alias("canonical"))
    mapping = stage(mapping, "mapping")
    of_own = mapping.select(F.col("raw").alias("_raw"), F.col("canonical").alias("normalized_label"))
    out = samples.drop("normalized_label", "normalized_labels").withColumn("_raw", F.trim("source_label")).join(of_own, "_raw", "left").drop("_raw")
    own = F.when(F.col("normalized_label").isNotNull(), F.array("normalized_label")).otherwise(F.array().cast("array<string>"))
    if "boxes" not in samples.columns:
        return out.withColumn("normalized_labels", own), mapping
    # the labels of a row's boxes are few: their names come as a map of just those labels
    key = out.withColumn("_id", F.monotonically_increasing_id())
    key = stage(key, "labelled")
    used = key.select("_id", F.explode(F.array_distinct(F.transform("boxes", lambda b: F.trim(b["label"])))).alias("raw")).join(mapping, "raw")
    maps = used.groupBy("_id").agg(F.map_from_entries(F.collect_list(F.struct("raw", "canonical"))).alias("_names"))
    named = key.join(maps, "_id", "left")
    renamed = F.transform("boxes", lambda b: b.withField("label", F.coalesce(F.try_element_at(F.col("_names"), F.trim(b["label"])), b["label"])))
    named = named.withColumn("boxes", F.when(F.col("_names").isNotNull(), renamed).otherwise(F.col("boxes")))
    labels = F.array_sort(F.array_distinct(F.concat(own, F.coalesce(F.filter(F.transform("boxes", lambda b: b["label"]), lambda x: x.isNotNull() & (x != "")), F.array().cast("array<string>")))))
    return named.withColumn("normalized_labels", labels).drop("_id", "_names"), mapping


def proposed_ontology(mapping: DataFrame, counts: DataFrame) -> str:
    """A YAML text of canonical names with their raw labels and the rows of each source, to be edited.

    It lists the vocabulary, which people have to read: the driver holds it.
    """
    met = mapping.join(counts, "raw").groupBy("canonical", "raw").agg(F.array_sort(F.collect_list(F.struct("source_dataset", "rows"))).alias("of")).orderBy("canonical", "raw")
    lines, last = ["# Proposed ontology: canonical name, raw labels, rows of each source.", ""], None
    for r in met.toLocalIterator():
        if r.canonical != last:
            lines += ([""] if last is not None else []) + [f"{json.dumps(r.canonical, ensure_ascii=False)}:"]
            last = r.canonical
        lines.append(f"  - {json.dumps(r.raw, ensure_ascii=False)}  # " + ", ".join(f"{x.source_dataset}: {x.rows}" for x in r.of))
    return "\n".join(lines) + "\n"


def cleaning_tool(mode: str) -> str:
    """What an optional tool for label errors is asked to do: ``off``, ``auto`` or ``on``. It needs
    predictions on held-out samples, which this engine doesn't make, so ``on`` is an error."""
    if mode not in ("off", "auto", "on"):
        raise ValueError(f"{mode} is no mode")
    if mode == "on":
        raise ValueError("cleaning by predictions needs held-out predictions, which aren't there")
    return "off" if mode == "off" else "left out: no held-out predictions"


def _alike(own: DataFrame, least_ratio: float, block: int = 1024) -> DataFrame:
    """(left, right) of labels ``l`` whose ratio may reach ``least_ratio``, going by their letters.

    A ratio is twice the matching letters by all letters, and no more letters match than both labels
    have, in whatever order. Letters are counted in 64 kinds, which can only raise that bound.
    """
    blocks = max(1, -(-own.count() // block))
    placed = own.select("l", stem_of(F.col("l")).alias("s"), F.pmod(F.xxhash64("l"), F.lit(blocks)).cast("int").alias("b")).withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    met = placed.select(F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "b", "l", "s")

    def counts(words: pd.Series) -> np.ndarray:
        out = np.zeros((len(words), 64), np.int32)
        for row, word in enumerate(words):
            for c in word:
                out[row, ord(c) % 64] += 1
        return out

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        first, last = rows["i"].iloc[0], rows["j"].iloc[0]
        a, b = rows[rows["b"] == first], rows[rows["b"] == last]
        names, others = a["l"].to_numpy(), b["l"].to_numpy()
        forms = [(counts(a[c]), counts(b[c])) for c in ("l", "s")]
        out = []
        for at in range(0, len(names), 256):
            fine = np.zeros((len(names[at : at + 256]), len(others)), bool)
            for x, y in forms:
                x = x[at : at + 256]
                common = sum(np.minimum(x[:, k, None], y[None, :, k]) for k in range(64))
                letters = x.sum(axis=1)[:, None] + y.sum(axis=1)[None, :]
                fine |= np.where(letters > 0, 2 * common / np.maximum(letters, 1), 1.0) >= least_ratio - 1e-6
            p, q = np.nonzero(fine)
            out += [(x, y) for x, y in zip(names[at + p], others[q]) if x != y]
        return pd.DataFrame(out, columns=["l", "r"])

    return met.groupBy("i", "j").applyInPandas(compare, "l string, r string").select(F.least("l", "r").alias("left"), F.greatest("l", "r").alias("right"))
