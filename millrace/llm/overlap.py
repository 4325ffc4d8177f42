"""Problem 7: evaluation samples that also occur, exactly or almost, in the training split.

Exact copies meet on their digest. Near copies meet on perceptual hashes: each 64-bit hash is a
sequence of bits whose seeds are its eight-bit pieces at eight fixed places. Seeds of two hashes
are collinear if they agree at the same place. With at most six differing bits at least two of the
eight pieces are intact, so every pair within the bound has a chain of two collinear seeds; each
chain is extended over the whole sequence by ungapped alignment, that is counted in differing bits,
and coverage is the share of agreeing bits.

Seeds are matched without a row for each pair of pieces: a hash is sent once for each of its first
seven pieces to the partition of that piece, and the second piece of the chain is matched there by
sorting. Only distinct hashes travel (8 bytes and flags), so a thousand copies of one picture cost
as much as one; places whose piece is shared by very many hashes are salted: training hashes are
spread over the salts, evaluation hashes go to all of them.

Why not minima of windows: with six errors in 64 bits only a run of nine bits is sure to be intact,
so windowed minima would have to pick single eight-bit seeds, of which one alone says nothing. The
pieces at fixed places are complete for chains of two.

Defined results: null, blank or repeated rows and null hashes take no part; a sample that is listed
under several splits counts in each, but never pairs with itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MAX_BITS = 6
PIECES = 8
#: Spellings of the splits, without case and spaces.
TRAIN = ("train", "trn", "training", "tr", "entrenamiento", "treino")
VALIDATION = ("val", "valid", "validation", "validacion", "validación", "dev", "vld")
TEST = ("test", "testing", "tst", "test_unannotated", "test-unannotated", "testunannotated", "prueba", "teste")
T_FIRST, T_ANY, E_FIRST, E_ANY = 1, 2, 4, 8


def split_name(value: Column) -> Column:
    """train, val, test or null."""
    v = F.regexp_replace(F.lower(value), r"[\s\p{Z}\p{Cf}]+", "")
    return F.when(v.isin(*TRAIN), "train").when(v.isin(*VALIDATION), "val").when(v.isin(*TEST), "test")


def sample_of(filename: Column) -> Column:
    """The stem of a file name."""
    return F.regexp_extract(filename, r"([^/\\]+?)(\.[A-Za-z0-9]+)?\s*$", 1)


def sides(labels: DataFrame) -> DataFrame:
    """(sample_id, train, held): whether the sample is listed for training and for evaluation."""
    rows = labels.select(sample_of(F.col("filename")).alias("sample_id"), split_name(F.col("split")).alias("s")).filter("s is not null and sample_id <> ''")
    return rows.groupBy("sample_id").agg(F.max(F.col("s") == "train").alias("train"), F.max(F.col("s") != "train").alias("held"))


def _chains(group_rows: int):
    """Pairs of a training and an evaluation hash within MAX_BITS, of the rows of one (piece, salt)."""
    shifts = np.arange(PIECES, dtype=np.uint64) * np.uint64(64 // PIECES)
    mask = np.uint64((1 << (64 // PIECES)) - 1)

    def pairs(place: int, t: np.ndarray, e: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for second in range(place + 1, PIECES):
            tk, ek = (t >> shifts[second]) & mask, (e >> shifts[second]) & mask
            order = np.argsort(tk, kind="stable")
            ts, sorted_keys = t[order], tk[order]
            low, high = np.searchsorted(sorted_keys, ek, "left"), np.searchsorted(sorted_keys, ek, "right")
            ends = np.cumsum(high - low)
            start = 0
            while start < len(e):  # in chunks of bounded length
                base = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, base + 2_000_000, "right")))
                n = (high - low)[start:stop]
                left = np.repeat(np.arange(start, stop), n)
                at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[start:stop], n)
                a, b = ts[at], e[left]
                x = a ^ b
                near = np.bitwise_count(x) <= MAX_BITS
                a, b, x = a[near], b[near], x[near]
                first = np.ones(len(x), bool)  # report a pair at its first chain only
                for p in range(second):
                    if p != place:
                        first &= ((x >> shifts[p]) & mask) != 0
                yield a[first], b[first]
                start = stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def finish() -> Iterator[pa.RecordBatch]:
            h = np.concatenate([x[0] for x in held])
            f = np.concatenate([x[1] for x in held])
            place = int(at) >> 40
            for rule, mine, theirs in ((1, T_FIRST, E_ANY), (2, T_ANY, E_FIRST)):
                t, e = h[(f & mine) > 0], h[(f & theirs) > 0]
                if len(t) and len(e):
                    for a, b in pairs(place, t, e):
                        if len(a):
                            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(np.full(len(a), rule, np.int32))], ["train_hash", "held_hash", "rule"])

        for batch in batches:
            cell, h, f = (batch.column(c).to_numpy() for c in ("cell", "h", "f"))
            cuts = np.flatnonzero(np.diff(cell)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(cell)]):
                if lo == hi:
                    continue
                if at is not None and cell[lo] != at:
                    yield from finish()
                    held = []
                at = cell[lo]
                held.append((h[lo:hi].view(np.uint64).copy(), f[lo:hi].copy()))
        if held:
            yield from finish()

    return run


def near_hashes(hashes: DataFrame, group_rows: int = 500_000) -> DataFrame:
    """hashes(h, f) with distinct h -> (train_hash, held_hash, rule)."""
    width = 64 // PIECES
    places = [F.lit(i << width).cast("long") + F.shiftrightunsigned("h", i * width).bitwiseAND(F.lit((1 << width) - 1)) for i in range(PIECES - 1)]
    sizes = hashes.select(F.explode(F.array(*places)).alias("place")).groupBy("place").count()
    # at most 7 x 256 rows; the hot places among them get more than one salt
    salts = {r["place"]: -(-r["count"] // group_rows) for r in sizes.filter(F.col("count") > group_rows).collect()}
    keyed = hashes.select("h", "f", F.explode(F.array(*places)).alias("place"))
    cell = lambda salt: (F.shiftright("place", width) * F.lit(1 << 40) + F.col("place").bitwiseAND(F.lit((1 << width) - 1)) * F.lit(1 << 24) + salt).alias("cell")
    if salts:
        n = F.coalesce(F.element_at(F.create_map(*[F.lit(x).cast("long") for kv in salts.items() for x in kv]), F.col("place")), F.lit(1).cast("long"))
        mine = keyed.filter(F.col("f").bitwiseAND(F.lit(T_FIRST | T_ANY)) > 0).select(cell(F.pmod(F.xxhash64("h"), n)), "h", F.col("f").bitwiseAND(F.lit(T_FIRST | T_ANY)).alias("f"))
        theirs = keyed.filter(F.col("f").bitwiseAND(F.lit(E_FIRST | E_ANY)) > 0).select("h", F.col("f").bitwiseAND(F.lit(E_FIRST | E_ANY)).alias("f"), "place", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("salt")).select(cell(F.col("salt")), "h", "f")
        keyed = mine.unionByName(theirs)
    else:
        keyed = keyed.select(cell(F.lit(0).cast("long")), "h", "f")
    spread = keyed.repartition("cell").sortWithinPartitions("cell")
    return spread.mapInArrow(_chains(group_rows), "train_hash bigint, held_hash bigint, rule int")


def _sides_of(labels: DataFrame, metrics: DataFrame, descriptors: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(digests, flat, hashes): digests and hashes of listed samples, and the distinct hashes with flags."""
    side = sides(labels)
    digests = metrics.select("sample_id", F.lower(F.trim("asset_sha256")).alias("digest")).filter("digest <> '' and sample_id is not null").distinct().join(side, "sample_id")
    own = descriptors.filter("phashes is not null and sample_id is not null").select("sample_id", "phashes").join(side, "sample_id")
    flat = own.select("sample_id", "train", "held", F.posexplode("phashes").alias("pos", "h")).filter("h is not null")
    flag = F.when(F.col("train"), F.when(F.col("pos") == 0, T_FIRST | T_ANY).otherwise(T_ANY)).otherwise(0) + F.when(F.col("held"), F.when(F.col("pos") == 0, E_FIRST | E_ANY).otherwise(E_ANY)).otherwise(0)
    return digests, flat, flat.select("h", flag.cast("int").alias("f")).groupBy("h").agg(F.bit_or("f").alias("f"))


def _coverage() -> Column:
    return 1 - F.bit_count(F.col("train_hash").bitwiseXOR(F.col("held_hash"))) / 64.0


def cross_split_pairs(labels: DataFrame, metrics: DataFrame, descriptors: DataFrame) -> DataFrame:
    """(train_id, held_id, how, coverage) of every overlapping pair of samples."""
    digests, flat, hashes = _sides_of(labels, metrics, descriptors)
    same = digests.filter("train").select(F.col("sample_id").alias("train_id"), "digest").join(digests.filter("held").select(F.col("sample_id").alias("held_id"), "digest"), "digest")
    exact = same.select("train_id", "held_id", F.lit("digest").alias("how"), F.lit(1.0).alias("coverage"))
    found = near_hashes(hashes)
    mine = flat.filter("train").select(F.col("sample_id").alias("train_id"), F.col("h").alias("train_hash"), (F.col("pos") == 0).alias("t_first"))
    theirs = flat.filter("held").select(F.col("sample_id").alias("held_id"), F.col("h").alias("held_hash"), (F.col("pos") == 0).alias("e_first"))
    near = (
        found.join(mine, "train_hash")
        .join(theirs, "held_hash")
        .filter("(rule = 1 and t_first) or (rule = 2 and e_first)")
        .select("train_id", "held_id", F.lit("phash").alias("how"), _coverage().alias("coverage"))
    )
    return exact.unionByName(near).filter("train_id <> held_id").groupBy("train_id", "held_id").agg(F.min("how").alias("how"), F.max("coverage").alias("coverage"))


def covered(labels: DataFrame, metrics: DataFrame, descriptors: DataFrame) -> DataFrame:
    """(held_id, coverage): evaluation samples that occur in another training sample, and how much of
    them at best. Nothing is expanded into pairs of samples: a digest or hash that a third of all
    samples share is one row of each side, with its only owner or none if there are several."""
    digests, flat, hashes = _sides_of(labels, metrics, descriptors)
    owner = lambda: F.when(F.min("sample_id") == F.max("sample_id"), F.min("sample_id")).alias("owner")
    of = digests.filter("train").groupBy("digest").agg(owner())
    exact = digests.filter("held").join(of, "digest").filter("owner is null or owner <> sample_id").select(F.col("sample_id").alias("held_id"), F.lit(1.0).alias("coverage"))
    train = flat.filter("train")
    first = train.filter("pos = 0").groupBy(F.col("h").alias("train_hash")).agg(owner()).withColumn("rule", F.lit(1))
    any_ = train.groupBy(F.col("h").alias("train_hash")).agg(owner()).withColumn("rule", F.lit(2))
    near = near_hashes(hashes).join(first.unionByName(any_), ["train_hash", "rule"])
    # of each evaluation hash the two best owners suffice: one of them is another sample, whoever asks
    near = near.groupBy("held_hash", "rule", "owner").agg(F.max(_coverage()).alias("coverage"))
    near = near.withColumn("place", F.row_number().over(W.partitionBy("held_hash", "rule").orderBy(F.desc("coverage"), "owner"))).filter("place <= 2").drop("place")
    theirs = flat.filter("held").select(F.col("sample_id").alias("held_id"), F.col("h").alias("held_hash"), "pos").distinct()
    seen = near.join(theirs, "held_hash").filter("(owner is null or owner <> held_id) and (rule = 1 or pos = 0)").select("held_id", "coverage")
    return exact.unionByName(seen).groupBy("held_id").agg(F.max("coverage").alias("coverage"))


def report(labels: DataFrame, best: DataFrame) -> DataFrame:
    """(split, source_dataset, samples, leaked, coverage): per split and source of evaluation samples,
    from best(held_id, coverage), see ``covered``."""
    held = labels.select(sample_of(F.col("filename")).alias("held_id"), split_name(F.col("split")).alias("split"), "source_dataset").filter("split in ('val', 'test') and held_id <> ''").distinct()
    return held.join(best, "held_id", "left").groupBy("split", "source_dataset").agg(F.count("*").alias("samples"), F.count("coverage").alias("leaked"), F.round(F.sum(F.coalesce("coverage", F.lit(0.0))) / F.count("*"), 6).alias("coverage"))
