"""All pairs of pictures near by hash or alike in colour: exactness, order, and what is shuffled for them."""

from __future__ import annotations

from datetime import datetime

import numpy as np
import pytest

from millrace.operators import alike, matching

COLUMNS = "sample_id string, phashes array<bigint>, histogram array<float>, computed_at timestamp"


def pictures(n: int, seed: int = 0) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Ids, hashes and colours; of five neighbours in turn some are near by hash, some alike, some equal."""
    rng = np.random.default_rng(seed)
    h = rng.integers(0, 2**63, (n, 8), dtype=np.uint64)
    x = np.where(rng.random((n, 512)) < 0.05, rng.exponential(size=(n, 512)), 0).astype(np.float32)
    for k in range(1, n, 5):
        h[k, 3] = h[k - 1, 0]
        for b in rng.choice(64, rng.integers(8, 17), replace=False):
            h[k, 3] ^= np.uint64(1) << np.uint64(b)
    for k in range(2, n, 5):
        x[k] = 7e20 * (x[k - 2] + rng.random() * rng.random(512) * 0.6 * (x[k - 2] > 0))
    for k in range(3, n, 10):
        h[k], x[k] = h[k - 1], x[k - 1]
    x[4::25] = 0
    x[9::25] *= -1
    return [f"{k:05d}" for k in range(n)], h, x


def frame(spark, ids, h, x):
    return spark.createDataFrame([(i, a.view(np.int64).tolist(), b.tolist(), datetime(2025, 1, 1)) for i, a, b in zip(ids, h, x)], COLUMNS)


def brute(ids, h, x, distance=12, similarity=0.92):
    x = x.astype(np.float64)
    length = np.linalg.norm(x, axis=1, keepdims=True)
    x = np.divide(x, length, out=np.zeros_like(x), where=length > 0)
    bits = np.min([np.bitwise_count(h[:, :1] ^ h[None, :, v]) for v in range(8)], axis=0)
    i, j = np.nonzero(((bits <= distance) | (x @ x.T >= similarity)) & ~np.eye(len(ids), dtype=bool))
    return {(ids[a], ids[b]): int(bits[a, b]) for a, b in zip(i, j)}


def test_of_many_copies_the_nearest_are_those_of_smallest_ids(spark):
    ids, h, x = pictures(9)
    h[:], x[:] = h[0], x[0]
    got = {}
    for r in matching.scored(frame(spark, ids, h, x), neighbours=2).collect():
        got.setdefault(r.query, set()).add(r.other)
    assert got == {q: set([o for o in ids if o != q][:2]) for q in ids}


@pytest.mark.parametrize("block", [16384, 8])
def test_the_pairs_are_those_of_all_pairs(spark, block):
    ids, h, x = pictures(400)
    rows = matching.scored(frame(spark, ids, h, x), neighbours=None, block=block).collect()
    want = brute(ids, h, x)
    assert len(rows) == len(want) > 300 and {(r.query, r.other): r.distance for r in rows} == want


def test_words_meet_in_few_buckets_and_none_is_missed():
    rng = np.random.default_rng(1)
    q = rng.integers(0, 2**63, 20_000, dtype=np.uint64)
    t = q[:2000].copy()
    for b in rng.integers(0, 64, (2000, 14)).T:
        t ^= np.uint64(1) << b.astype(np.uint64)
    i, j = alike.near_words(q, np.concatenate([t, rng.integers(0, 2**63, 2000, dtype=np.uint64)]), 12)
    want = np.flatnonzero(np.bitwise_count(q[:2000] ^ t) <= 12)
    assert 100 < len(want) and set(zip(want.tolist(), want.tolist())) <= set(zip(i.tolist(), j.tolist()))


@pytest.mark.parametrize("neighbours", [None, 20])
def test_what_is_shuffled_does_not_grow_with_blocks(spark, neighbours):
    ids, h, x = pictures(600)
    own = frame(spark, ids, h, x)
    written = lambda: sum(s.totalShuffleWrite() for s in _executors(spark))
    before = written()
    assert matching.scored(own, neighbours=neighbours, block=16).count() > 100
    assert written() - before < 1_000_000


def _executors(spark):
    them = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return [them.apply(k) for k in range(them.size())]
