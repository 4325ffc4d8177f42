"""Settings: the policy of a run, the registry of sources, the description of a release."""

from __future__ import annotations

import json
import math
import os
from collections.abc import Callable
from typing import Any

#: Defaults of a policy, and what each may be.
_between = lambda low, high, open_low=False: lambda v: isinstance(v, (int, float)) and not isinstance(v, bool) and math.isfinite(v) and (low < v if open_low else low <= v) and v <= high
_flag: Callable[[Any], bool] = lambda v: isinstance(v, bool)
_any = float("inf")
POLICY: dict[str, dict[str, tuple[Any, Callable[[Any], bool]]]] = {
    "quality": {
        "min_resolution": (320, _between(1, _any)), "ocr_enabled": (True, _flag), "ocr_confidence": (60.0, _between(0, 100)), "ocr_timeout_seconds": (30.0, _between(0, _any, True)),
        "severe_blur": (15.0, _between(0, _any)), "review_blur": (25.0, _between(0, _any)), "min_brightness": (18.0, _between(0, 255)), "max_brightness": (245.0, _between(0, 255)),
        "dark_p95": (45.0, _between(0, 255)), "bright_p5": (210.0, _between(0, 255)), "min_box_blur": (150.0, _between(0, _any)),
    },
    "deduplication": {
        "exact_enabled": (True, _flag), "semantic_enabled": (True, _flag), "augmentation_enabled": (True, _flag), "semantic_similarity": (0.90, _between(0, 1, True)),
        "augmentation_similarity": (0.92, _between(0, 1, True)), "semantic_action": ("review", lambda v: v in ("review", "remove")), "augmentation_action": ("review", lambda v: v in ("review", "remove")),
        "candidate_neighbors": (20, _between(1, 200)), "candidate_retrieval": ("indexed", lambda v: v in ("indexed", "exhaustive")), "candidate_pool": (512, _between(32, 8192)),
        "phash_distance": (12, _between(0, 64)), "verification_min_correlation": (0.97, _between(0, 1, True)), "verification_max_error": (0.04, _between(0, 1, True)), "remove_exact_transforms": (False, _flag),
    },
    "splits": {"train": (0.8, _between(0, 1)), "val": (0.1, _between(0, 1)), "test": (0.1, _between(0, 1)), "group_by_location": (False, _flag)},
}


def read(path: str) -> dict:
    """A YAML or JSON document that holds names and values."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        found = json.loads(text)
    else:
        import yaml

        found = yaml.safe_load(text)
    if found is None:
        return {}
    if not isinstance(found, dict):
        raise ValueError(f"{path} holds no names and values")
    return found


def policy(found: dict | None = None) -> dict[str, dict]:
    """A whole policy: what is given, checked, and defaults for the rest. Unknown sections and names of
    deduplication, values out of range and contradictions are errors."""
    found = dict(found or {})
    found.pop("schema_version", None)
    if extra := set(found) - set(POLICY):
        raise ValueError(f"unknown sections {sorted(extra)}")
    out: dict[str, dict] = {}
    for section, names in POLICY.items():
        given = found.get(section) or {}
        if section == "deduplication" and (extra := set(given) - set(names)):
            raise ValueError(f"unknown settings {sorted(extra)}")
        out[section] = {n: given.get(n, default) for n, (default, _) in names.items()}
        if bad := [n for n, (_, fits) in names.items() if not fits(out[section][n])]:
            raise ValueError(f"{section}: {bad} out of range")
    q, s = out["quality"], out["splits"]
    if q["severe_blur"] > q["review_blur"] or q["min_brightness"] >= q["max_brightness"]:
        raise ValueError("limits of quality contradict each other")
    if abs(s["train"] + s["val"] + s["test"] - 1) > 1e-9:
        raise ValueError("the parts of the splits must add up to 1")
    return out


def load_policy(path: str | None) -> dict[str, dict]:
    return policy(read(path) if path else None)


def registry(*paths: str | None) -> dict[str, dict]:
    """Sources by name; later files add to and replace what earlier ones say, missing ones say nothing."""
    out: dict[str, dict] = {}
    for p in paths:
        if p and os.path.isfile(p):
            out.update(read(p))
    return out


def release_description(name: str, folders: tuple[str, ...] = ("configs/releases",), path: str | None = None) -> dict:
    """What is said of a release: the given file, else one named after it in the folders, else nothing."""
    import re

    snake = re.sub(r"(?<!^)(?=[A-Z])", "_", name).lower()
    for at in [path, *(f"{d}/{n}.yaml" for d in folders for n in dict.fromkeys((name, snake, name.lower().replace("-", "_"), name.lower())))]:
        if at and os.path.isfile(at):
            return read(at)
    return {}
