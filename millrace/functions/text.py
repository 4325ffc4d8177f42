"""Text functions: normal forms of labels, slugs, coarse classes, similarity of labels."""

from __future__ import annotations

import difflib
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Aliases of labels, tokens of healthy and of diseased plants, names of splits, and
#: terms that mark a picture agency's overlay. They must be the published ones for equal results.
LABEL_ALIASES = {
    "healthy": "healthy", "saglam": "healthy", "sağlam": "healthy", "hastalıklı": "diseased", "hastalikli": "diseased",
    "olive peacock spot": "olive_peacock_spot", "olive_peacock_spot": "olive_peacock_spot", "peacock spot": "olive_peacock_spot",
    "aculus olearius": "aculus_olearius", "aculus_olearius": "aculus_olearius", "knot disease": "knot_disease",
}
HEALTHY_TOKENS = (
    "sano", "sana", "sanos", "sanas", "healthy", "health", "saglam", "normal", "clean", "control", "vigorous", "saludable",
    "sin_sintomas", "sin_danos", "intacto", "good",
)
DISEASE_TOKENS = (
    "repilo", "antracnosis", "anthracnose", "tuberculosis", "escudete", "blight", "rot", "spot", "rust", "curl", "mildew", "virus",
    "pest", "damage", "damaged", "disease", "diseased", "enfermo", "enferma", "enfermos", "enfermas", "defect", "defective",
    "podredumbre", "mancha", "scab", "canker", "necrosis", "wilt", "bacterial", "fungal", "mite", "aphid", "decay", "mold",
    "leaf_spot", "leaf_scorch", "hastalikli", "hastalıklı", "cycloconium", "virosis", "fumagina",
)
SPLIT_NAMES = ("train", "test", "valid", "val", "validation")
WATERMARK_TERMS = (
    "alamy", "dreamstime", "getty", "istock", "shutterstock", "stock", "watermark", "depositphotos", "adobe", "123rf", "freepik",
    "miden", "picfair", "agefotostock", "canstock",
)


@F.pandas_udf(T.StringType())
def unaccented(text: pd.Series) -> pd.Series:
    """Compatibility decomposition without combining marks; Spark has no such function."""
    return text.map(lambda t: None if t is None else "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)))


def _plain(text: Column) -> Column:
    """Texts that are ASCII already skip the UDF's work, not its result."""
    return F.when(text.rlike(r"^[\x00-\x7F]*$"), text).otherwise(unaccented(text))


def normal_text(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(_plain(text), "[_-]", " "), r"(?U)\s+", " ")))


def normal_label(text: Column) -> Column:
    """Normal text through the alias table, with underscores."""
    plain = normal_text(text)
    alias = F.create_map(*[F.lit(x) for pair in LABEL_ALIASES.items() for x in pair])
    return F.coalesce(F.element_at(alias, plain), F.replace(plain, F.lit(" "), F.lit("_")))


def ascii_label(text: Column) -> Column:
    """Lower-case ASCII letters and digits with underscores; an empty one is ``unlabeled``."""
    ascii_ = F.lower(F.regexp_replace(_plain(F.trim(text)), r"[^\x00-\x7F]", ""))
    out = F.regexp_replace(F.regexp_replace(ascii_, "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(F.coalesce(out, F.lit("")) == "", "unlabeled").otherwise(out)


def slug(text: Column, default: str = "unknown") -> Column:
    out = F.regexp_replace(F.regexp_replace(normal_text(text), r"[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(F.coalesce(out, F.lit("")) == "", default).otherwise(out)


#: Parts of words that mark a healthy or a diseased plant wherever they stand.
HEALTHY_PARTS = ("healthy", "sano", "saglam")
DISEASE_PARTS = ("enferm", "diseas", "rot", "spot", "blight", "rust")


def healthy_tokens(label: Column) -> Column:
    """Whether one of a label's tokens is a word for a healthy plant."""
    return F.arrays_overlap(F.split(ascii_label(label), "_"), F.array(*[F.lit(t) for t in HEALTHY_TOKENS]))


def coarse_label(label: Column, healthy_peer: Column | None = None) -> Column:
    """sano, enfermo, or the label itself; with a healthy class among its peers the rest is enfermo.

    Words count as whole tokens; only a few parts of words count wherever they stand.
    """
    plain = ascii_label(label)
    has = lambda parts: reduce(lambda a, b: a | b, [F.contains(plain, F.lit(t)) for t in parts])
    sick = F.arrays_overlap(F.split(plain, "_"), F.array(*[F.lit(t) for t in DISEASE_TOKENS])) | has(DISEASE_PARTS)
    out = F.when(healthy_tokens(label) | has(HEALTHY_PARTS), "sano").when(sick, "enfermo")
    if healthy_peer is not None:
        out = out.when(F.coalesce(healthy_peer, F.lit(False)), "enfermo")
    return out.otherwise(plain)


def split_of_path(path: Column) -> Column:
    """The first part of a path that names a split; validation counts as valid; else empty."""
    part = F.filter(F.transform(F.split(path, "/"), lambda p: F.lower(F.trim(p))), lambda p: p.isin(*SPLIT_NAMES))
    first = F.try_element_at(part, F.lit(1))
    return F.when(first == "validation", "valid").otherwise(F.coalesce(first, F.lit("")))


def label_of_path(path: Column, generic: tuple[str, ...] = ("images", "img", "data", "raw", "labels", "annotations", "jpegimages")) -> Column:
    """The folder after a split's name, else the parent folder of a path of three or more parts."""
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    at = F.array_position(F.transform(parts, lambda p: F.lower(p).isin(*SPLIT_NAMES)), True)
    after = F.when((at > 0) & (at + 1 < F.size(parts)), F.try_element_at(parts, (at + 1).cast("int")))
    parent = F.when(F.size(parts) >= 3, F.element_at(parts, -2))
    out = F.coalesce(after, F.when(at == 0, parent))
    return F.when(~F.lower(out).isin(*generic, *SPLIT_NAMES), out)


def has_watermark_term(text: Column) -> Column:
    return F.coalesce(F.lower(text).rlike("|".join(WATERMARK_TERMS)), F.lit(False))


def token_jaccard(a: Column, b: Column) -> Column:
    x, y = (F.array_distinct(F.split(c, "[_ ]+")) for c in (a, b))
    return F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)])


def augmented_name(path: Column) -> Column:
    """Whether a path looks like that of a generated variant."""
    return F.lower(path).rlike(r"\.rf\.|_aug|augmentation")


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]+?)(\.[A-Za-z0-9]+)?$", 1)


def export_name(key: Column, path: Column) -> Column:
    return F.concat(key, F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1)))


def natural_key(name: Column) -> Column:
    """A file name without blanks and copy marks, for joins of annotations with their pictures."""
    return F.lower(F.regexp_replace(F.regexp_replace(stem(name), r"\s*\(\d+\)$", ""), r"\s+", ""))


#: Spellings of "not known", without case, spaces, hyphens and underscores.
UNKNOWN = ("", "unknown", "unk", "n/a", "na", "n/d", "nd", "s/d", "sd", "null", "nil", "none", "nan", "?", "??", "???", ".", "*", "desconocido", "desconocida", "sindato", "sindatos", "noaplica", "notavailable", "notapplicable", "undefined", "unspecified", "desconhecido", "semdado", "semdados", "tbd", "<na>", "(null)", "[null]")


def known_key(value: Column) -> Column:
    """A key without case, spaces, hyphens and underscores; null if it says nothing."""
    out = F.regexp_replace(F.lower(value), r"[\s\p{Z}\p{Cf}_\-‐‑‒–—]+", "")
    return F.when(~out.isin(*UNKNOWN), out)
