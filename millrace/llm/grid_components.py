"""Pairwise matches into groups, over a two-dimensional grid of edge blocks.

Each vertex is hashed to one of ``blocks`` blocks and each edge lies in the partition of its two
blocks. A round runs a local union-find on every edge partition, which leaves (vertex, local root)
stars; a vertex occurs in the partitions of one row and one column only, so the exchange of
representatives gathers at most 2 x blocks roots for it. It takes the smallest as its parent; the
other roots become edges to that parent, and only roots go on to the next round. Rounds end when
no edge is left. Then the parents are resolved from the last round back to the first.

The edges of a hot vertex are spread over a whole row of the grid; a cell that still holds more than
``edges_per_block`` edges is split by a hash of the edge, so that this bounds what one union-find
holds. The grid shrinks with the edges.

Defined results: loops and null ids are no links; repeated links count once; the id of a group is
the smallest vertex id in it; no links give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.storage import drop, stage


def local_stars(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union-find over one block: every vertex with the smallest vertex of its local component."""
    codes, names = pd.factorize(np.concatenate([left, right]), sort=True)
    parent = list(range(len(names)))
    half = len(left)
    for a, b in zip(codes[:half].tolist(), codes[half:].tolist()):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        while parent[b] != b:
            parent[b] = parent[parent[b]]
            b = parent[b]
        if a < b:
            parent[b] = a
        elif b < a:
            parent[a] = b
    for v in range(len(parent)):  # a parent is never larger than its child, so one pass flattens
        parent[v] = parent[parent[v]]
    names = np.asarray(names, dtype=object)
    return names, names[np.asarray(parent)]


def _cell(blocks: int) -> Column:
    a, b = (F.pmod(F.xxhash64(x), F.lit(blocks)).cast("long") for x in ("left", "right"))
    return F.least(a, b) * F.lit(blocks) + F.greatest(a, b)


def _grid(edges: DataFrame, blocks: int, sizes: DataFrame, edges_per_block: int, tasks: int) -> DataFrame:
    """(v, root) of the local union-finds. ``sizes`` (one row a cell) says which cells hold too many
    edges, as the cell of a hub does: their edges are split by a hash of the edge into parts of their own."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        at = None
        # sorted by cell: only one cell is held at a time
        for part in parts:
            cell_of = part["cell"].to_numpy()
            cuts = np.flatnonzero(np.diff(cell_of)) + 1
            for piece in np.split(np.arange(len(part)), cuts):
                if not len(piece):
                    continue
                now = cell_of[piece[0]]
                if at is not None and now != at:
                    yield finish(held)
                    held = []
                at = now
                held.append(part.iloc[piece])
        if held:
            yield finish(held)

    def finish(held: list[pd.DataFrame]) -> pd.DataFrame:
        block = pd.concat(held, ignore_index=True)
        v, root = local_stars(block["left"].to_numpy(object), block["right"].to_numpy(object))
        return pd.DataFrame({"v": v, "root": root})

    parts = F.greatest(F.lit(1), F.ceil(F.col("count") / edges_per_block)).cast("long")
    crowded = sizes.filter(F.col("count") > edges_per_block).select("cell", parts.alias("parts"))  # fewer than edges / edges_per_block
    placed = edges.select("left", "right", _cell(blocks).alias("cell")).join(F.broadcast(crowded), "cell", "left")
    part = F.pmod(F.xxhash64("left", "right"), F.coalesce("parts", F.lit(1).cast("long")))
    placed = placed.select("left", "right", (F.col("cell") * F.lit(1 << 20) + part).alias("cell"))
    return placed.repartition(tasks, "cell").sortWithinPartitions("cell").mapInPandas(run, "v string, root string")


def components(edges: DataFrame, edges_per_block: int = 400_000, max_rounds: int = 60, least_cells: int | None = None) -> DataFrame:
    """edges(left, right) -> (v, component) for every vertex that has a link to another one.

    The first round has at least ``least_cells`` cells (one for each core, unless given), whatever the
    number of edges, so that no input is one task; later rounds have as many as their edges need.
    """
    edges = edges.select(F.col("left").cast("string"), F.col("right").cast("string")).filter("left <> right")
    edges = stage(edges.select(F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right")).distinct(), "edges")
    cells = least_cells or edges.sparkSession.sparkContext.defaultParallelism
    parents: list[DataFrame] = []
    for at in range(max_rounds):
        count = edges.count()
        if not count:
            break
        blocks = max(1, math.ceil(math.sqrt(2 * count / edges_per_block)), math.ceil(math.sqrt(2 * cells)) if at == 0 else 1)
        sizes = edges.groupBy(_cell(blocks).alias("cell")).count()
        tasks = max(1, min(blocks * (blocks + 1) // 2, 2 * max(cells, count // edges_per_block)))
        stars = _grid(edges, blocks, sizes, edges_per_block, tasks)
        if blocks == 1 and count <= edges_per_block:
            parents.append(stage(stars.select("v", F.col("root").alias("parent")), "parents"))
            drop(edges)
            break
        # a vertex lies in the cells of one row and one column, so this set is bounded by their parts
        roots = stage(stars.groupBy("v").agg(F.min("root").alias("parent"), F.collect_set("root").alias("roots")), "roots")
        parents.append(roots)
        left = roots.select(F.explode("roots").alias("right"), F.col("parent").alias("left")).filter("left <> right").select("left", "right").distinct()
        following = stage(left, "edges")
        drop(edges)
        edges = following
    else:
        raise RuntimeError(f"components did not settle within {max_rounds} rounds")
    if not parents:
        return edges.select(F.col("left").alias("v"), F.col("right").alias("component"))
    out = parents[-1].select("v", F.col("parent").alias("component"))
    for before in reversed(parents[:-1]):
        later = out.withColumnRenamed("v", "parent")
        out = before.select("v", "parent").join(later, "parent", "left").select("v", F.coalesce("component", "parent").alias("component"))
    return out
