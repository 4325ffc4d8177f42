"""Problem 2: what the graph keeps on disk while it is made, and that slices change nothing."""

from __future__ import annotations

import contextlib
import os
import threading
import time

import numpy as np
from pyspark.sql import functions as F

from millrace import storage
from millrace.llm import neighbours


def sparse_vectors(spark, n, size, some, seed):
    rng = np.random.default_rng(seed)
    centres = rng.random((n // 20, size)) * (np.argsort(rng.random((n // 20, size))) < some)
    x = centres[rng.integers(0, n // 20, n)] * (0.4 + rng.random((n, size)))
    return x, spark.createDataFrame([(f"{i:06d}", [float(a) for a in r]) for i, r in enumerate(x)], "id string, v array<float>")


def test_neighbours_keep_the_disk(spark, monkeypatch):
    """Shuffles of all orders, or of a whole round, would take several times as much."""
    _, v = sparse_vectors(spark, 12_000, 64, 12, 0)
    jvm, most, done = spark.sparkContext._jvm, [0], threading.Event()
    own = [str(x) for x in jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    paths, new_path = [], storage.new_path
    monkeypatch.setattr(storage, "new_path", lambda *a: paths.append(new_path(*a)) or paths[-1])

    def used():
        total = 0
        for top in own + [p.removeprefix("file://") for p in paths]:
            for folder, _, names in os.walk(top):
                for name in names:
                    with contextlib.suppress(OSError):  # deleted meanwhile
                        total += os.stat(os.path.join(folder, name)).st_size
        return total

    jvm.System.gc()  # files of earlier tests may go now
    time.sleep(1)
    before = used()

    def watch():
        while not done.wait(0.02):
            most[0] = max(most[0], used() - before)

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        _, classes, _ = neighbours.neighbour_graph(v, size=64, window=128)
    finally:
        done.set()
        watcher.join()
    rows = classes.select(F.expr("length(idx) + length(val) + 20 * 12 as n")).collect()  # a vector and its list
    assert most[0] < 14 * sum(r.n for r in rows)


def test_neighbours_do_not_depend_on_slices(spark):
    x, v = sparse_vectors(spark, 600, 32, 8, 1)
    graphs = []
    for slices in (1, 6):
        members, _, graph = neighbours.neighbour_graph(v, k=8, size=32, orders=3, window=64, sample=6, slices=slices)
        graphs.append({(r.id, r.other): r.sim for r in graph.join(members, "cid").join(members.selectExpr("id as other", "cid as nbr"), "nbr").select("id", "other", "sim").collect()})
    one, many = graphs
    assert len(one) == len(many) == 600 * 8
    differ = one.keys() ^ many.keys()  # but for equal distances
    assert len(differ) <= 0.001 * len(one)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert all(abs(s - u[int(a)] @ u[int(b)]) < 1e-5 for (a, b), s in many.items())
