"""Runs: fingerprints of inputs, snapshots of phases, a single writer, checks before the start."""

from __future__ import annotations

import contextlib
import fcntl
import hashlib
import json
import os
import shutil
import time
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from millrace.sinks.export import write_atomic


def fingerprint(policy: dict, folder: str) -> str:
    """A hash of the policy and of path, size and time of every file below a folder."""
    h = hashlib.sha256(json.dumps(policy, sort_keys=True, default=str).encode())
    for p in sorted(Path(folder).rglob("*")):
        if p.is_file():
            s = p.stat()
            h.update(f"\0{p.relative_to(folder)}\0{s.st_size}\0{s.st_mtime_ns}".encode())
    return h.hexdigest()


@contextlib.contextmanager
def single_writer(folder: str) -> Iterator[None]:
    """Raises BlockingIOError if another process writes there."""
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, ".lock"), "a+") as f:
        fcntl.flock(f, fcntl.LOCK_EX | fcntl.LOCK_NB)
        f.truncate(0)
        f.write(json.dumps({"pid": os.getpid(), "since": time.time()}))
        f.flush()
        yield


class Run:
    """Phases as Parquet snapshots. A phase whose snapshot has the same fingerprint is read, not run."""

    def __init__(self, spark: SparkSession, folder: str, mark: str) -> None:
        self.spark, self.folder, self.mark = spark, folder, mark

    def phase(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        at, note = f"{self.folder}/{name}.parquet", Path(self.folder) / f"{name}.json"
        if note.exists():
            try:
                old = json.loads(note.read_text())
            except ValueError:
                old = {}
            if isinstance(old, dict) and old.get("mark") == self.mark:
                return self.spark.read.parquet(at)
        make().write.mode("overwrite").parquet(at)
        df = self.spark.read.parquet(at)
        write_atomic(str(note), json.dumps({"mark": self.mark, "rows": df.count()}))
        return df

    def done(self) -> None:
        write_atomic(f"{self.folder}/_SUCCESS", "")


def latest_run(folder: str, name: str = "") -> str | None:
    """The greatest name of a finished run that contains ``name``."""
    runs = [p.name for p in Path(folder).iterdir() if (p / "_SUCCESS").exists() and name in p.name]
    return str(Path(folder) / max(runs)) if runs else None


def workers(cores: int | None = None) -> int:
    """Tasks at once on one machine: all cores but two, at least one."""
    return max(1, (cores or os.cpu_count() or 1) - 2)


def session_settings(cores: int | None = None, input_bytes: int = 0, partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Settings of a local session for an input: its master, and shuffle partitions of bounded size."""
    n = workers(cores)
    return {"spark.master": f"local[{n}]", "spark.sql.shuffle.partitions": str(max(2 * n, -(-input_bytes // partition_bytes))), "spark.sql.adaptive.enabled": "true"}


def preflight(raw: str, out: str, least_free_gb: float = 1.0, cache: str | None = None, accelerator: bool | None = None) -> list[dict]:
    """pass, warning, fail or skipped for what a run needs."""
    checks = [{"check": "raw", "status": "pass" if os.path.isdir(raw) and any(os.scandir(raw)) else "fail"}]
    there = lambda p: next((q for q in [Path(p), *Path(p).parents] if q.exists()), Path("/"))
    for name, at in (("out", out), ("cache", cache)):
        checks.append({"check": name, "status": "skipped" if at is None else "pass" if os.access(there(at), os.W_OK) else "fail"})
    free = shutil.disk_usage(there(out)).free / 1e9
    checks.append({"check": "disk", "status": "pass" if free >= least_free_gb else "warning", "free_gb": round(free, 1)})
    checks.append({"check": "database", "status": "skipped"})  # there is none: tables are files
    checks.append({"check": "accelerator", "status": "skipped" if not accelerator else "pass" if os.path.exists("/dev/nvidia0") else "warning"})
    return checks
