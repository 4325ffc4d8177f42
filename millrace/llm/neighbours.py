"""Problem 2: the most similar vectors of every vector, by NN-descent in Spark.

Equal vectors (equal after scaling to unit length, to six decimals) are one class and searched once.

Start. Each class gets ``orders`` sort keys in which similar classes are likely to begin alike: in
every fourth order the bits of random hyperplanes, in the others the dimensions that come first in a
consistent random draw in proportion to their squared values (which suits sparse histograms). Runs
of ``window`` consecutive classes of an order are compared with each other; that gives the first
graph of ``k`` neighbours. One order follows another: a class takes its vector and its list along,
so the disk never holds more than one order's shuffle.

Descent. A round joins neighbours of neighbours: each class is the centre of its nearest
``sample`` new and old neighbours and of those that have it as such a neighbour; the vectors of a
centre's circle meet in one place, and pairs of which one is new are compared. What is better than
the worst of a member's list enters it. Circles of hubs are split by hash into parts of bounded
length, each of which meets all of the hub's own neighbours. Circles meet slice by slice, by hash of
the centre, and what a slice finds enters the lists before the next one; all start from the round's
first lists, so slices bound the disk and leave no pair out. Neighbours that were not sampled stay
new for the next round. Rounds end after ``rounds``, or if fewer than one in a thousand entries
changed.

Queries of vectors outside the graph are answered by greedy search along it (``search``).

Defined results: vectors that are null, of another length, all zero or not finite take no part; of
several rows of one sample the latest counts; ties go to the smaller id; fewer than two usable
vectors give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace import storage
from millrace.storage import drop

BITS = 60


def stage(df: DataFrame, what: str) -> DataFrame:
    """As ``storage.stage``, but small; its shuffles leave no files behind."""
    with storage.tidy(df.sparkSession):
        return storage.stage(df, what, "zstd")


def usable(rows: DataFrame, key: str, vector: str, size: int, latest: str | None = None) -> DataFrame:
    """(id, v): one usable vector of each id."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    kept = rows.filter(F.col(key).isNotNull() & (F.size(vector) == size)).filter(fine)
    order = [F.col(latest).isNotNull(), F.col(latest)] if latest else [F.lit(True)]
    return kept.groupBy(F.col(key).alias("id")).agg(F.max_by(vector, F.struct(*order, F.xxhash64(vector))).alias("v"))


def _planes(size: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((size, BITS)).astype(np.float32)


def _draw(x: np.ndarray, seed: int) -> np.ndarray:
    """The six dimensions, with sign, that a consistent weighted draw puts first, as one number."""
    wait = np.random.default_rng(seed).exponential(size=x.shape[1]).astype(np.float32)
    with np.errstate(divide="ignore"):
        score = np.where(x != 0, wait / (x * x), np.inf)
    m = min(6, x.shape[1])
    best = np.argpartition(score, m - 1, axis=1)[:, :m]
    best = np.take_along_axis(best, np.argsort(np.take_along_axis(score, best, 1), axis=1), 1)
    # a random name for each dimension, so that no order favours small indices
    name = np.random.default_rng(seed + 1).permutation(x.shape[1])
    part = (name[best].astype(np.int64) * 2 + (np.take_along_axis(x, best, 1) < 0)) % 1024
    code = np.zeros(len(x), np.int64)
    for j in range(6):
        code = code * 1024 + (part[:, j] if j < m else 0)
    return code


def encode(vectors: DataFrame, size: int) -> DataFrame:
    """(id, key, idx, val): unit vectors without their zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for whole in batches:
            for part in range(0, whole.num_rows, 2000):
                batch = whole.slice(part, 2000)
                x = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                keys = [hashlib.md5(r.tobytes()).digest() for r in np.round(x * 1e6).astype(np.int32)]
                x = x.astype(np.float32)
                row, idx = np.nonzero(x)
                offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(x)))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(keys, pa.binary()), _packed(offsets, idx.astype(np.uint16)), _packed(offsets, x[row, idx])],
                    ["id", "key", "idx", "val"],
                )

    return vectors.mapInArrow(run, f"id {vectors.schema['id'].dataType.simpleString()}, key binary, idx binary, val binary")


def _places(order: int, size: int, seed: int, middle: np.ndarray | None) -> Callable[[np.ndarray], np.ndarray]:
    """What gives unit vectors their places in an order; every fourth one needs the mean."""
    if order % 4:
        return lambda x: _draw(x, seed + 2 * order + 1)
    planes = _planes(size, seed + order)
    weights = (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64)).astype(np.int64)
    return lambda x: ((x - middle) @ planes > 0) @ weights


def coded(rows: DataFrame, size: int, orders: list[int], seed: int, middle: Broadcast | None = None) -> DataFrame:
    """rows(..., idx, val) with their places in some orders as code0, ..."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = [_places(o, size, seed, middle and middle.value) for o in orders]
        for whole in batches:
            for part in range(0, whole.num_rows, 2000):
                batch = whole.slice(part, 2000)
                x = _dense(batch, size)
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(p(x), pa.int64()) for p in places)], [*batch.schema.names, *(f"code{o}" for o in orders)])

    return rows.mapInArrow(run, ", ".join([*(f"{c} {t}" for c, t in rows.dtypes), *(f"code{o} bigint" for o in orders)]))


def _mean(encoded: DataFrame, size: int) -> np.ndarray:
    """The mean of all unit vectors; what goes to the driver has ``size`` numbers a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(size), 0
        for batch in batches:
            if batch.num_rows:
                total += np.bincount(_unpacked(batch.column("idx"), np.uint16)[0], _unpacked(batch.column("val"), np.float32)[0], size)
                n += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total), pa.array([n] * size, pa.int64())], ["i", "s", "n"])

    with storage.tidy(encoded.sparkSession):
        rows = encoded.select("idx", "val").mapInArrow(run, "i int, s double, n bigint").groupBy("i").agg((F.sum("s") / F.greatest(F.sum("n"), F.lit(1))).alias("m")).collect()
    out = np.zeros(size, np.float32)
    for r in rows:
        out[r.i] = r.m
    return out


def _packed(offsets: np.ndarray, values: np.ndarray) -> pa.BinaryArray:
    at = (offsets * values.dtype.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(at.tobytes()), pa.py_buffer(values.tobytes())])


def _unpacked(column: pa.Array, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """(all values, how many each row has) of packed vectors."""
    _, at, data = column.buffers()
    at = np.frombuffer(at, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(dtype), np.diff(at) // np.dtype(dtype).itemsize


def _dense(batch: pa.RecordBatch, size: int) -> np.ndarray:
    x = np.zeros((batch.num_rows, size), np.float32)
    if batch.num_rows:
        idx, n = _unpacked(batch.column("idx"), np.uint16)
        x[np.repeat(np.arange(batch.num_rows), n), idx] = _unpacked(batch.column("val"), np.float32)[0]
    return x


GRAPH = "cid bigint, nbr array<bigint>, sim array<float>, new array<boolean>"


def _lists(cid: np.ndarray, nbr: np.ndarray, sim: np.ndarray, new: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Edges in the order of cid as GRAPH rows: one row a class costs Spark far less than one an edge."""
    if not len(cid):
        return
    first = np.concatenate([[0], np.flatnonzero(np.diff(cid)) + 1])
    offsets = pa.array(np.concatenate([first, [len(cid)]]).astype(np.int32))
    whole = pa.RecordBatch.from_arrays([pa.array(cid[first], pa.int64()), *(pa.ListArray.from_arrays(offsets, pa.array(x, t)) for x, t in ((nbr, pa.int64()), (sim, pa.float32()), (new, pa.bool_())))], ["cid", "nbr", "sim", "new"])
    for at in range(0, whole.num_rows, 10_000):
        yield whole.slice(at, 10_000)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """GRAPH rows as edges (cid, nbr, sim, new)."""
    n = pc.list_value_length(batch.column("nbr")).to_numpy(zero_copy_only=False)
    return np.repeat(batch.column("cid").to_numpy(), n), *(batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("nbr", "sim", "new"))


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0] if len(batches) > 1 else batches[0]


def window_pass(rows: DataFrame, k: int, size: int, window: int, seed: int, then: int, middle: Broadcast) -> DataFrame:
    """rows(cid, idx, val, nbr, sim, code) -> the same rows: the lists also have the best ``k`` within runs of
    ``window`` consecutive classes of the order in ``code``, and ``code`` has the places in the order ``then``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        places = _places(then, size, seed, middle.value)

        def compare(part: pa.RecordBatch) -> pa.RecordBatch:
            ids, x = part.column("cid").to_numpy(), _dense(part, size)
            s = x @ x.T
            np.fill_diagonal(s, -2)
            m = min(k, len(ids) - 1)
            top = np.argpartition(-s, m - 1, axis=1)[:, :m] if m else np.zeros((len(ids), 0), np.int64)
            many = pc.list_value_length(part.column("nbr")).to_numpy(zero_copy_only=False)
            here = np.arange(k) < many[:, None]
            nbr, sim = np.full((len(ids), k), -1, np.int64), np.full((len(ids), k), -np.inf, np.float32)
            nbr[here], sim[here] = (part.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("nbr", "sim"))
            found, near = ids[top], np.take_along_axis(s, top, 1)
            near[(found[:, :, None] == nbr[:, None, :]).any(axis=2)] = -np.inf
            nbr, sim = np.concatenate([nbr, found], axis=1), np.concatenate([sim, near], axis=1)
            order = np.lexsort((nbr, -sim), axis=1)[:, :k]
            nbr, sim = np.take_along_axis(nbr, order, 1), np.take_along_axis(sim, order, 1)
            kept = sim > -np.inf
            offsets = pa.array(np.concatenate([[0], np.cumsum(kept.sum(axis=1))]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(c[kept])) for c in (nbr, sim)]
            return pa.RecordBatch.from_arrays([*(part.column(c) for c in ("cid", "idx", "val")), *lists, pa.array(places(x), pa.int64())], ["cid", "idx", "val", "nbr", "sim", "code"])

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= 2 * window:
                whole = _joined(held)
                at = 0
                while whole.num_rows - at >= 2 * window:
                    yield compare(whole.slice(at, window))
                    at += window
                held, n = [whole.slice(at)], whole.num_rows - at
        if n:
            whole = _joined(held)
            half = -(-n // 2) if n > window else n
            for at in range(0, n, half):
                yield compare(whole.slice(at, half))

    return rows.repartitionByRange("code").sortWithinPartitions("code", "cid").mapInArrow(run, "cid bigint, idx binary, val binary, nbr array<bigint>, sim array<float>, code bigint")


def best(lists: DataFrame, k: int) -> DataFrame:
    """GRAPH rows, several a class -> the k best of each class as one row, best first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        n = 0
        for batch in batches:
            held.append(tuple(x.copy() for x in _flat(batch)))
            n += len(held[-1][0])
            if n > 3_000_000:  # what is held stays bounded by the classes of the partition
                held, n = [_reduced(held, k)], 0
        if held:
            yield from _lists(*_reduced(held, k))

    return lists.select("cid", "nbr", "sim", "new").repartition("cid").mapInArrow(run, GRAPH)


def _reduced(held: list[tuple[np.ndarray, ...]], k: int) -> tuple[np.ndarray, ...]:
    """The k best of each class, best first; an edge that comes twice counts once, and as old if it was."""
    cid, nbr, sim, new = (np.concatenate(x) for x in zip(*held))
    if not len(cid):
        return cid, nbr, sim, new
    order = np.lexsort((nbr, cid))
    cid, nbr = cid[order], nbr[order]
    first = np.flatnonzero(np.concatenate([[True], (cid[1:] != cid[:-1]) | (nbr[1:] != nbr[:-1])]))
    cid, nbr, sim, new = cid[first], nbr[first], np.maximum.reduceat(sim[order], first), np.logical_and.reduceat(new[order], first)
    order = np.lexsort((nbr, -sim, cid))
    cid = cid[order]
    start = np.flatnonzero(np.concatenate([[True], cid[1:] != cid[:-1]]))
    keep = np.arange(len(cid)) - np.repeat(start, np.diff(np.concatenate([start, [len(cid)]]))) < k
    order = order[keep]
    return cid[keep], nbr[order], sim[order], new[order]


def local_join(circles: DataFrame, size: int, k: int, part: int) -> DataFrame:
    """circles(center, salt, member, new, own, worst, idx, val), sorted by center and salt -> better
    edges, of each task the k best of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        out: list[tuple[np.ndarray, ...]] = []
        n = 0

        def meet(ids: np.ndarray, new: np.ndarray, worst: np.ndarray, x: np.ndarray) -> None:
            nonlocal n
            s = x @ x.T
            ok = (s > worst[:, None]) & (new[:, None] | new[None, :]) & (ids[:, None] != ids[None, :])
            i, j = np.nonzero(ok)
            out.append((ids[i], ids[j], s[i, j], np.ones(len(i), bool)))
            n += len(i)

        def compare(rows: pa.RecordBatch) -> None:
            center, salt, ids, new, own, worst = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("center", "salt", "member", "new", "own", "worst"))
            x = _dense(rows, size)
            cuts = np.flatnonzero((np.diff(center) != 0) | (np.diff(salt) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(ids)]):
                if hi - lo < 2:
                    continue
                mine = np.flatnonzero(own[lo:hi]) + lo
                others = np.flatnonzero(~own[lo:hi]) + lo
                for at in range(0, max(1, len(others)), part):
                    here = np.concatenate([mine, others[at : at + part]])
                    meet(ids[here], new[here], worst[here], x[here])

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal out, n
            if out:
                yield from _lists(*_reduced(out, k))
            out, n = [], 0

        waiting = 0
        for batch in batches:
            held.append(batch)
            waiting += batch.num_rows
            if waiting < 4000:
                continue
            whole = _joined(held)
            center, salt = whole.column("center").to_numpy(), whole.column("salt").to_numpy()
            change = np.flatnonzero((np.diff(center) != 0) | (np.diff(salt) != 0))
            if len(change):
                at = int(change[-1]) + 1
                compare(whole.slice(0, at))
                held = [whole.slice(at)]
                if n > 2_000_000:
                    yield from flush()
            else:
                held = [whole]
            waiting = held[0].num_rows
        if held:
            compare(_joined(held))
        yield from flush()

    return circles.mapInArrow(run, GRAPH)


def descend(graph: DataFrame, classes: DataFrame, k: int, size: int, sample: int, slices: int, part: int = 64, hub: int = 4096, merge: int = 4) -> DataFrame:
    """One round: the graph with what circles find and the edges that were sampled marked as old, staged; ``graph``
    is dropped. What ``merge`` slices find enters the lists at once."""
    pairs = F.arrays_zip("nbr", "sim", "new")
    fresh = F.slice(F.filter(pairs, lambda e: e["new"]), 1, sample)
    known = F.slice(F.filter(pairs, lambda e: ~e["new"]), 1, sample)
    sampled = stage(graph.select("cid", F.transform(F.concat(fresh, known), lambda e: F.struct(e["nbr"].alias("nbr"), e["new"].alias("new"))).alias("e")), "sampled")
    used = F.transform(fresh, lambda e: e["nbr"])
    still = F.transform(F.arrays_zip("nbr", "new"), lambda e: e["new"] & ~F.array_contains("used", e["nbr"]))
    following, last = graph.withColumn("used", used).select("cid", "nbr", "sim", still.alias("new")), graph
    edges = sampled.select("cid", F.explode("e").alias("e")).select("cid", "e.nbr", "e.new")
    hubs = stage(edges.groupBy(F.col("nbr").alias("center")).count().filter(F.col("count") > hub).select("center", F.ceil(F.col("count") / hub).cast("int").alias("parts")), "hubs")
    parts = F.coalesce("parts", F.lit(1))
    salts = F.when(F.col("own"), F.sequence(F.lit(0), parts - 1)).otherwise(F.array(F.pmod(F.xxhash64("member"), parts).cast("int")))
    own = edges.select(F.col("cid").alias("center"), F.col("nbr").alias("member"), "new", F.lit(True).alias("own"))
    other = edges.select(F.col("nbr").alias("center"), F.col("cid").alias("member"), "new", F.lit(False).alias("own"))
    worst = F.when(F.size("sim") >= k, F.element_at("sim", k)).otherwise(F.lit(-2.0)).cast("float")
    better: list[DataFrame] = []
    for at in range(slices):
        here = F.pmod(F.xxhash64("center"), F.lit(slices)).cast("string") == str(at)  # a number would be part of the code, which then is compiled for each slice
        circles = own.unionByName(other).filter(here).join(hubs, "center", "left").select("center", "member", "new", "own", F.explode(salts).alias("salt"))
        vectors = classes.select(F.col("cid").alias("member"), "idx", "val").join(following.select(F.col("cid").alias("member"), worst.alias("worst")), "member", "left").withColumn("worst", F.coalesce("worst", F.lit(-2.0).cast("float")))
        met = circles.join(vectors, "member").repartition("center", "salt").sortWithinPartitions("center", "salt")
        better.append(stage(local_join(met.select("center", "salt", "member", "new", "own", "worst", "idx", "val"), size, k, part), "better"))
        if len(better) == merge or at == slices - 1:
            following = stage(best(reduce(DataFrame.unionByName, better, following), k), "graph")
            for x in (last, *better):
                drop(x)
            last, better = following, []
    drop(hubs)
    drop(sampled)
    return following


def neighbour_graph(vectors: DataFrame, k: int = 20, size: int = 512, orders: int = 24, window: int = 512, sample: int = 14, rounds: int = 2, seed: int = 7141, slices: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """vectors(id, v) -> (members(id, cid), classes(cid, idx, val, code1, ...), graph(cid, nbr, sim)), staged but for
    the codes that ``search`` uses. ``slices``: of a round, one for each 6 000 classes and at most 20 if not given."""
    encoded = stage(encode(vectors, size), "encoded")
    middle = vectors.sparkSession.sparkContext.broadcast(_mean(encoded, size))
    once = coded(encoded.groupBy("key").agg(F.first("idx").alias("idx"), F.first("val").alias("val")), size, [0], seed, middle)
    named = stage(once.repartitionByRange("code0", "key").sortWithinPartitions("code0", "key").withColumn("cid", F.monotonically_increasing_id()), "named")
    members = stage(encoded.select("id", "key").join(named.select("key", "cid"), "key").select("id", "cid"), "members")
    drop(encoded)
    last, rows = named, named.select("cid", "idx", "val", F.array().cast("array<bigint>").alias("nbr"), F.array().cast("array<float>").alias("sim"), F.col("code0").alias("code"))
    for o in range(orders):
        rows = stage(window_pass(rows, k, size, window, seed, (o + 1) % orders, middle), "rows")
        drop(last)
        last = rows
    classes = stage(rows.select("cid", "idx", "val"), "classes")
    graph = stage(rows.select("cid", "nbr", "sim", F.transform("nbr", lambda x: F.lit(True)).alias("new")), "graph")
    drop(last)
    slices = slices or min(20, max(1, math.ceil(classes.count() / 6_000)))
    for _ in range(rounds):
        graph = descend(graph, classes, k, size, sample, slices)
        entries, fresh = graph.agg(F.sum(F.size("nbr")), F.sum(F.size(F.filter("new", lambda x: x)))).first()
        if (fresh or 0) < 0.001 * (entries or 1):
            break
    codes = [o for o in range(min(orders, 12)) if o % 4]
    return members, coded(classes, size, codes, seed), graph.select("cid", F.inline(F.arrays_zip("nbr", "sim")))


def nearest_pairs(members: DataFrame, graph: DataFrame, k: int = 20, least: float = 0.9) -> DataFrame:
    """(left_id, right_id, cosine): pairs of which one is among the k most similar of the other.

    The members of a class come first for each other, the smallest ids before others; then come
    those of its neighbours. Of a class no more than k + 1 members can be asked for, so a class of
    very many equal vectors costs k rows a member.
    """
    place = F.row_number().over(W.partitionBy("cid").orderBy("id"))
    few = stage(members.withColumn("place", place).filter(F.col("place") <= k + 1), "few")
    sizes = members.groupBy("cid").agg(F.count("*").alias("n"))
    twins = members.join(few.select("cid", F.col("id").alias("other"), "place"), "cid").filter("id <> other")
    # of the k + 1 smallest a member may be one itself: then the others are its k
    first = few.filter(F.col("place") == k + 1).select(F.col("id").alias("beyond"), "cid")
    twins = twins.join(first, "cid", "left").filter(F.col("beyond").isNull() | (F.col("other") != F.col("beyond")) | (F.col("id") < F.col("beyond"))).select("id", "other", F.lit(1.0).alias("cosine"))
    near = graph.filter(F.col("sim") >= least - 1e-6).join(sizes, "cid").filter(F.col("n") <= k).join(few.filter(F.col("place") <= k).select(F.col("cid").alias("nbr"), F.col("id").alias("other")), "nbr")
    row = F.row_number().over(W.partitionBy("cid").orderBy(F.desc("sim"), "other"))
    near = near.withColumn("row", row).filter(F.col("row") <= k - (F.col("n") - 1)).filter(F.col("sim") >= least)
    across = near.join(members, "cid").select("id", "other", F.col("sim").cast("double").alias("cosine"))
    both = twins.unionByName(across).select(F.least("id", "other").alias("left_id"), F.greatest("id", "other").alias("right_id"), "cosine")
    return both.groupBy("left_id", "right_id").agg(F.max("cosine").alias("cosine"))


def search(queries: DataFrame, members: DataFrame, classes: DataFrame, graph: DataFrame, k: int = 20, size: int = 512, beam: int | None = None, entries: int = 512, window: int = 512, seed: int = 7141) -> DataFrame:
    """queries(id, v) -> (id, neighbour, cosine): greedy search along the graph.

    Each query starts from the best of the classes next to it in those of the first twelve orders of the
    graph that need no mean (some ``window`` in each), and of ``entries`` classes picked by hash (a bounded number,
    which is broadcast). In each round the beam of its best classes is widened by their neighbours,
    until all classes of all beams have been widened. A class that left a beam never comes back, so
    the rounds end. The beam grows with the square root of the classes, unless it is given; ``seed``
    must be the graph's.
    """
    classes = stage(classes, "classes")
    beam = max(beam or max(48, math.isqrt(classes.count())), k + 1)
    codes = [c for c in classes.columns if c.startswith("code")]
    asked = stage(coded(encode(queries, size).drop("key"), size, [int(c[4:]) for c in codes], seed).withColumnRenamed("id", "q"), "asked")
    kind = asked.schema["q"].dataType.simpleString()
    vectors = asked.select("q", F.col("idx").alias("qi"), F.col("val").alias("qv"))
    beam_of = lambda df: df.withColumn("place", F.row_number().over(W.partitionBy("q").orderBy(F.desc("sim"), "cid"))).filter(F.col("place") <= beam).drop("place")
    picked = classes.orderBy(F.xxhash64("cid")).limit(entries).select("cid", "idx", "val")
    starts = _scored(vectors.crossJoin(F.broadcast(picked)), kind, size)
    for c in codes:
        starts = starts.unionByName(_beside(asked, classes, c, kind, size, window, beam))
    held = stage(beam_of(starts.groupBy("q", "cid").agg(F.max("sim").alias("sim"))).withColumn("open", F.lit(True)), "beam")
    both = stage(graph.select("cid", "nbr").unionByName(graph.select(F.col("nbr").alias("cid"), F.col("cid").alias("nbr"))).distinct(), "both")
    while not held.filter("open").isEmpty():
        next_ = held.filter("open").join(both, "cid").select("q", F.col("nbr").alias("cid")).distinct().join(held.select("q", "cid"), ["q", "cid"], "left_anti")
        scored = _scored(next_.join(classes.select("cid", "idx", "val"), "cid").join(vectors, "q"), kind, size).withColumn("open", F.lit(True))
        following = stage(beam_of(held.withColumn("open", F.lit(False)).unionByName(scored)), "beam")
        drop(held)
        held = following
    drop(both)
    few = members.withColumn("place", F.row_number().over(W.partitionBy("cid").orderBy("id"))).filter(F.col("place") <= k + 1).drop("place")
    out = held.join(few, "cid").filter(F.col("id") != F.col("q"))
    return out.withColumn("place", F.row_number().over(W.partitionBy("q").orderBy(F.desc("sim"), "id"))).filter(F.col("place") <= k).select(F.col("q").alias("id"), F.col("id").alias("neighbour"), F.col("sim").alias("cosine"))


def _beside(asked: DataFrame, classes: DataFrame, code: str, kind: str, size: int, window: int, most: int) -> DataFrame:
    """(q, cid, sim): the best ``most`` of some ``window`` classes among which a query falls in one order."""

    def compare(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        query = part.column("cid").is_null()
        near = part.filter(pa.array(~query.to_numpy(zero_copy_only=False)))
        ids, x, mine = near.column("cid").to_numpy(), _dense(near, size), part.filter(query)
        m = min(most, len(ids))
        for at in range(0, mine.num_rows if m else 0, 1000):
            here = mine.slice(at, 1000)
            s = _dense(here, size) @ x.T
            top = np.argpartition(-s, m - 1, axis=1)[:, :m]
            q = here.column("q").take(pa.array(np.repeat(np.arange(here.num_rows), m)))
            yield pa.RecordBatch.from_arrays([q, pa.array(ids[top].ravel()), pa.array(np.take_along_axis(s, top, 1).ravel().astype(np.float64))], ["q", "cid", "sim"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows - batch.column("cid").null_count
            if n >= 2 * window:
                whole = _joined(held)
                place = np.flatnonzero(~whole.column("cid").is_null().to_numpy(zero_copy_only=False))
                lo = 0
                while len(place) >= 2 * window:
                    yield from compare(whole.slice(lo, place[window] - lo))
                    lo, place = place[window], place[window:]
                held, n = [whole.slice(lo)], len(place)
        if n:
            yield from compare(_joined(held))

    own = classes.select(F.lit(None).cast(kind).alias("q"), "cid", "idx", "val", code)
    rows = own.unionByName(asked.select("q", F.lit(None).cast("bigint").alias("cid"), "idx", "val", code))
    return rows.repartitionByRange(code).sortWithinPartitions(code, F.xxhash64("q", "cid")).drop(code).mapInArrow(run, f"q {kind}, cid bigint, sim double")


def _scored(pairs: DataFrame, kind: str, size: int) -> DataFrame:
    """pairs(q, cid, qi, qv, idx, val) -> (q, cid, sim)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                query = pa.RecordBatch.from_arrays([batch.column("qi"), batch.column("qv")], ["idx", "val"])
                s = np.einsum("ij,ij->i", _dense(query, size), _dense(batch, size))
                yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("cid"), pa.array(s.astype(np.float64))], ["q", "cid", "sim"])

    return pairs.select("q", "cid", "qi", "qv", "idx", "val").mapInArrow(run, f"q {kind}, cid bigint, sim double")
