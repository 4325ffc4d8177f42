"""All pairs of pictures that are near by hash or alike in colour, exactly, without meeting all pairs.

Pictures of equal hashes and colours are one class (a copy costs a row, no comparison).

Hashes. Two words of at most ``distance`` different bits, cut into m chunks, differ in some chunk c by
at most r(c) bits, where all r(c) + 1 add up to ``distance`` + 1. So a bucket of targets (by the bits of
a chunk) meets only queries in buckets of so few other bits. Bits are dealt to chunks by how evenly
they are spread, and m is what costs least for the size of a task.

Colours. Unit vectors whose product is at least t share a dimension among the first ones of both, in one
order of all dimensions (rare ones first), up to where less than t of their length remains. Only
vectors that share one meet, first by the lengths of 32 groups of their dimensions, whose product is never
less than that of the vectors. What passes is computed again from the whole vectors.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace import storage
from millrace.storage import drop

SIZE, GROUPS = 512, 32
GROUP = np.random.default_rng(7141).permutation(SIZE) % GROUPS


def stage(df: DataFrame, what: str) -> DataFrame:
    """As ``storage.stage``, but small; its shuffles leave no files behind."""
    with storage.tidy(df.sparkSession):
        return storage.stage(df, what, "zstd")


def _packed(offsets: np.ndarray, values: np.ndarray) -> pa.BinaryArray:
    at = (offsets * values.dtype.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(at.tobytes()), pa.py_buffer(values.tobytes())])


def _rows(values: np.ndarray) -> pa.BinaryArray:
    return _packed(np.arange(len(values) + 1) * values.shape[1], np.ascontiguousarray(values))


def _unpacked(column: pa.Array, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """(all values, how many each row has) of packed rows."""
    if not len(column):
        return np.zeros(0, dtype), np.zeros(0, np.int64)
    _, at, data = column.buffers()
    at = np.frombuffer(at, np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw.copy().view(dtype), np.diff(at) // np.dtype(dtype).itemsize


def _unit(idx: pa.Array, val: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, dimension, value) of vectors scaled to unit length."""
    at, n = _unpacked(idx, np.uint16)
    x = _unpacked(val, np.float32)[0].astype(np.float64)
    row = np.repeat(np.arange(len(n)), n)
    top = np.zeros(len(n))
    np.maximum.at(top, row, np.abs(x))
    x = x / top[row]
    return row, at.astype(np.int64), x / np.sqrt(np.bincount(row, x * x, len(n)))[row]


def _encoded(own: DataFrame) -> DataFrame:
    """(id, key, h, idx, val): hashes as bytes, histograms without their zeros; equal keys for equal looks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in range(0, whole.num_rows, 2000):
                batch = whole.slice(part, 2000)
                h = batch.column("phashes").flatten().to_numpy(zero_copy_only=False).reshape(-1, 8)
                x = batch.column("histogram").flatten().to_numpy(zero_copy_only=False).reshape(-1, SIZE)
                row, idx = np.nonzero(x)
                offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(x)))])
                idx, val = idx.astype(np.uint16), x[row, idx]
                keys = [hashlib.md5(h[k].tobytes() + idx[a:b].tobytes() + val[a:b].tobytes()).digest() for k, (a, b) in enumerate(zip(offsets, offsets[1:]))]
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(keys, pa.binary()), _rows(h), _packed(offsets, idx), _packed(offsets, val)], ["id", "key", "h", "idx", "val"])

    return own.select("id", "phashes", "histogram").mapInArrow(run, "id string, key binary, h binary, idx binary, val binary")


def _few_bits(width: int, most: int) -> np.ndarray:
    """All numbers of ``width`` bits of which at most ``most`` are set."""
    out = at = np.zeros(1, np.int64)
    for _ in range(min(most, width)):
        at = np.unique((at[:, None] | (1 << np.arange(width))[None, :]).ravel())
        at = at[np.bitwise_count(at) > np.bitwise_count(out).max()]
        out = np.concatenate([out, at])
    return out


def _chunks(chance: np.ndarray, distance: int, m: int) -> list[tuple[np.ndarray, int]]:
    """(bits, most different ones) of m chunks; ``chance``: of each bit, how often it is set."""
    even = np.argsort(-np.minimum(chance, 1 - chance), kind="stable")
    return [(even[k::m], (distance + 1) // m - 1 + (k < (distance + 1) % m)) for k in range(m)]


def _share(bits: np.ndarray, most: int, chance: np.ndarray) -> float:
    """The share of pairs of independent words that differ in at most ``most`` of the bits."""
    p = np.ones(1)
    for q in chance[bits]:
        d = 2 * q * (1 - q)
        p = np.convolve(p, [1 - d, d])
    return float(p[: most + 1].sum())


def near_words(queries: np.ndarray, targets: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, target) places of all words that differ in at most ``distance`` bits; pairs may come twice."""
    if not len(queries) or not len(targets) or distance < 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    chance = np.array([((targets >> np.uint64(b)) & np.uint64(1)).mean() for b in range(64)])
    one, turn, mask = 2.5e-9, 7e-5, 2e-8  # seconds of a comparison, of a bucket and of each of the buckets it meets
    plans = [(len(queries) * len(targets) * one, [(np.zeros(0, np.int64), 0)])]
    for m in range(3, min(12, distance + 2)):
        chunks = [c for c in _chunks(chance, distance, m) if c[1] >= 0]
        seconds = sum(len(queries) * len(targets) * _share(b, r, chance) * one + min(1 << len(b), len(targets)) * (turn + mask * sum(math.comb(len(b), k) for k in range(r + 1))) for b, r in chunks)
        plans.append((seconds, chunks))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for bits, most in min(plans, key=lambda p: p[0])[1]:
        value = lambda words: sum((((words >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << k for k, b in enumerate(bits)), np.zeros(len(words), np.int64))  # noqa: B023, E731
        others = _few_bits(len(bits), most)
        q, t = value(queries), value(targets)
        by_q, by_t = np.argsort(q, kind="stable"), np.argsort(t, kind="stable")
        words, sorted_ = queries[by_q], targets[by_t]
        offsets = np.concatenate([[0], np.cumsum(np.bincount(q, minlength=1 << len(bits)))])
        t = t[by_t]
        starts = np.concatenate([[0], np.flatnonzero(np.diff(t)) + 1, [len(t)]])
        for lo, hi in zip(starts[:-1], starts[1:]):
            buckets = others ^ t[lo]
            first, n = offsets[buckets], offsets[buckets + 1] - offsets[buckets]
            held = n > 0
            first, n = first[held], n[held]
            ends = np.cumsum(n)
            if not len(ends):
                continue
            at = np.arange(ends[-1]) + np.repeat(first - ends + n, n)
            met = words[at]
            for a in range(lo, hi, 64):
                here = sorted_[a : min(a + 64, hi), None]
                for b in range(0, len(met), 2048):
                    near = np.bitwise_count(here ^ met[None, b : b + 2048]) <= distance
                    if near.any():
                        i, j = np.nonzero(near)
                        found.append((by_q[at[b + j]], by_t[a + i]))
    i, j = zip(*found) if found else ((np.zeros(0, np.int64),), (np.zeros(0, np.int64),))
    return np.concatenate(i), np.concatenate(j)


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """(a, b) with a < b, each once."""
    a, b = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    kept = (a < b) & np.concatenate([[True], (np.diff(a) != 0) | (np.diff(b) != 0)])[: len(a)]
    return pa.RecordBatch.from_arrays([pa.array(a[kept], pa.int64()), pa.array(b[kept], pa.int64())], ["a", "b"])


def near_by_hash(classes: DataFrame, count: int, distance: int, queries: int = 1 << 20, targets: int = 1 << 17) -> DataFrame:
    """(a, b) of which one's first hash is within ``distance`` bits of any of the other's eight.

    Each task has up to about ``queries`` first hashes and all hashes of ``targets`` classes.
    """
    cores = classes.sparkSession.sparkContext.defaultParallelism
    wide = max(1, -(-count // queries))
    tall = max(-(-count // targets), min(2 * cores, -(-count // 1000)), 1)
    own = classes.select("cid", "h").withColumn("q", F.pmod(F.xxhash64("cid"), F.lit(wide)).cast("int")).withColumn("t", F.pmod(F.xxhash64(F.lit(1), "cid"), F.lit(tall)).cast("int"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = own.select("cid", F.substring("h", 1, 8).alias("h"), "q", every(tall).alias("t"))
    held = own.select("cid", "h", every(wide).alias("q"), "t")

    def compare(rows: pa.Table) -> pa.Table:
        cid = rows.column("cid").to_numpy()
        long = rows.column("long").to_numpy(zero_copy_only=False)
        words = lambda kept: np.concatenate([np.zeros(0, np.uint64), *(_unpacked(c, np.uint64)[0] for c in rows.column("h").filter(pa.array(kept)).chunks)])
        q, t = near_words(words(~long), words(long), distance)
        return pa.Table.from_batches([_pairs(cid[~long][q], cid[long][t // 8])])

    both = asked.withColumn("long", F.lit(False)).unionByName(held.withColumn("long", F.lit(True)))
    return both.repartition(max(wide * tall, 1) * 2, "q", "t").groupBy("q", "t").applyInArrow(compare, "a bigint, b bigint")


def _prefixes(classes: DataFrame, place: np.ndarray, similarity: float, few: bool) -> DataFrame:
    """(dim, cid, u): each class at the first of its dimensions, with the lengths of its groups rounded up. Few classes all come once, at 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in range(0, whole.num_rows, 5000):
                batch = whole.slice(part, 5000)
                row, dim, x = _unit(batch.column("idx"), batch.column("val"))
                groups = np.sqrt(np.bincount(row * GROUPS + GROUP[dim], x * x, batch.num_rows * GROUPS)).reshape(-1, GROUPS)
                u = groups.astype(np.float16)
                u = np.where(u < groups, np.nextafter(u, np.float16(2)), u)
                order = np.lexsort((place[dim], row))
                row, dim, mass = row[order], dim[order], x[order] ** 2
                before = np.cumsum(mass) - mass
                start = np.flatnonzero(np.concatenate([[True], np.diff(row) != 0])[: len(row)])
                before -= np.repeat(before[start], np.diff(np.concatenate([start, [len(row)]])))
                kept = before <= 1 - similarity * similarity + 1e-6
                if few:
                    kept, dim = np.isin(np.arange(len(row)), start), np.zeros_like(dim)
                yield pa.RecordBatch.from_arrays([pa.array(dim[kept].astype(np.int32)), batch.column("cid").take(pa.array(row[kept])), _rows(u[row[kept]])], ["dim", "cid", "u"])

    return classes.select("cid", "idx", "val").mapInArrow(run, "dim int, cid bigint, u binary")


def _counts(classes: DataFrame) -> np.ndarray:
    """How many classes have each dimension; what goes to the driver has 512 numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = sum((np.bincount(_unpacked(b.column("idx"), np.uint16)[0], minlength=SIZE) for b in batches), np.zeros(SIZE, np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(range(SIZE), pa.int32()), pa.array(n, pa.int64())], ["i", "n"])

    out = np.zeros(SIZE, np.int64)
    with storage.tidy(classes.sparkSession):
        for r in classes.select("idx").mapInArrow(run, "i int, n bigint").groupBy("i").agg(F.sum("n").alias("n")).collect():
            out[r.i] = r.n
    return out


def alike_in_colour(classes: DataFrame, count: int, similarity: float, block: int = 16384) -> DataFrame:
    """(a, b), among them all of at least this cosine; a few of less. Classes at one dimension meet in blocks of about ``block``."""
    if not 0 < similarity <= 1:
        raise ValueError("similarity must be above 0 and at most 1")
    counts = _counts(classes)
    place = np.empty(SIZE, np.int64)
    place[np.argsort(counts, kind="stable")] = np.arange(SIZE)
    few = count <= block // 4
    parts = F.array(*(F.lit(max(1, -(-int(n) // block))) for n in counts))
    placed = _prefixes(classes, place, similarity, few).withColumn("parts", F.get(parts, F.col("dim"))).withColumn("p", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
    met = placed.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("dim", F.least("p", "o").alias("i"), F.greatest("p", "o").alias("j"), "p", "cid", "u")

    def compare(rows: pa.Table) -> pa.Table:
        cid, p = rows.column("cid").to_numpy(), rows.column("p").to_numpy()
        u = np.concatenate([_unpacked(c, np.float16)[0] for c in rows.column("u").chunks]).reshape(-1, GROUPS).astype(np.float32)
        first, one = rows.column("i")[0].as_py(), rows.column("i")[0] == rows.column("j")[0]
        lefts = np.flatnonzero(p == first)
        rights = lefts if one else np.flatnonzero(p != first)
        x, y, out = u[lefts], u[rights], []
        for a in range(0, len(lefts), 256):
            begin = a if one else 0
            for b in range(begin, len(rights), 1024):
                s = x[a : a + 256] @ y[b : b + 1024].T >= similarity - 1e-4
                if s.any():
                    i, j = np.nonzero(s)
                    out.append((cid[lefts[a + i]], cid[rights[b + j]]))
        a, b = zip(*out) if out else ((np.zeros(0, np.int64),), (np.zeros(0, np.int64),))
        return pa.Table.from_batches([_pairs(np.concatenate(a), np.concatenate(b))])

    tasks = max(4 * classes.sparkSession.sparkContext.defaultParallelism, int(sum(counts) // 500_000))
    return met.repartition(tasks, "dim", "i", "j").groupBy("dim", "i", "j").applyInArrow(compare, "a bigint, b bigint")


def _judged(met: DataFrame, distance: int, similarity: float) -> DataFrame:
    """Rows (a, b, ah, ai, av, bh, bi, bv) -> (qc, oc, distance, similarity) of what is near or alike, in both directions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def dense(idx: pa.Array, val: pa.Array) -> np.ndarray:
            x = np.zeros((len(idx), SIZE))
            row, dim, v = _unit(idx, val)
            x[row, dim] = v
            return x

        for whole in batches:
            for part in range(0, whole.num_rows, 2000):
                r = whole.slice(part, 2000)
                a, b = (r.column(c).to_numpy() for c in "ab")
                g, h = (_unpacked(r.column(c), np.uint64)[0].reshape(-1, 8) for c in ("ah", "bh"))
                s = np.einsum("ij,ij->i", dense(r.column("ai"), r.column("av")), dense(r.column("bi"), r.column("bv")))
                ways = ((a, b, g, h), (b, a, h, g))
                q, o, s = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([s, s])
                bits = np.concatenate([np.bitwise_count(y[:, :1] ^ z).min(axis=1) for _, _, y, z in ways]).astype(np.int32)
                k = (bits <= distance) | (s >= similarity)
                yield pa.RecordBatch.from_arrays([pa.array(q[k]), pa.array(o[k]), pa.array(bits[k]), pa.array(s[k])], ["qc", "oc", "distance", "similarity"])

    return met.mapInArrow(run, "qc bigint, oc bigint, distance int, similarity double")


def class_pairs(own: DataFrame, distance: int, similarity: float, block: int) -> tuple[DataFrame, DataFrame]:
    """own(id, phashes, histogram) -> (members(id, cid), pairs(qc, oc, distance, similarity) of classes, also of
    each with itself), staged."""
    encoded = stage(_encoded(own), "encoded")
    classes = stage(encoded.groupBy("key").agg(*(F.first(c).alias(c) for c in ("h", "idx", "val"))).withColumn("cid", F.monotonically_increasing_id()), "classes")
    members = stage(encoded.select("id", "key").join(classes.select("key", "cid"), "key").select("id", "cid"), "members")
    drop(encoded)
    count = classes.count()
    found = [stage(near_by_hash(classes, count, distance), "near"), stage(alike_in_colour(classes, count, similarity, block), "alike")]
    side = lambda s: classes.select(F.col("cid").alias(s), F.col("h").alias(f"{s}h"), F.col("idx").alias(f"{s}i"), F.col("val").alias(f"{s}v"))
    met = found[0].unionByName(found[1]).distinct().join(side("a"), "a").join(side("b"), "b").select("a", "b", "ah", "ai", "av", "bh", "bi", "bv")
    same = classes.select(F.col("cid").alias("qc"), F.col("cid").alias("oc"), F.lit(0).alias("distance"), F.when(F.length("idx") > 0, 1.0).otherwise(0.0).alias("similarity"))
    pairs = stage(_judged(met, distance, similarity).unionByName(same), "pairs")
    for x in (classes, *found):
        drop(x)
    return members, pairs
