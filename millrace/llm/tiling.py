"""Problem 9: documents that carry passages of evaluation items, by greedy string tiling.

Words are runs of letters and digits without case and accents. Every run of ``least`` words is a
Karp-Rabin fingerprint of 64 bits. Documents are tokenised once: their fingerprints are computed for
a batch as one array, and those that pass a filter of the items' fingerprints (a bitmap of fixed
size, whatever the number of items) go on as seeds. Seeds are joined with the items' fingerprints by
an equi-join. For each (document, item) that shares seeds, the longest common runs are marked as
tiles again and again, the longest first, none overlapping another in the document or the item,
until none of ``least`` words is left. A common run of n words is a diagonal of n - least + 1
seeds, so tiles are found from seeds alone and no text travels. The words in tiles give the coverage
of the item, which also counts passages whose order was changed.

Nothing is collected. The filter has ``filter_bits`` bits, built from bitmaps of the partitions; a
false hit of the filter finds no partner in the join. The items' side of the join is broadcast only
if Spark's own size check allows it; else the join shuffles, and adaptive execution splits a passage
that very many documents carry.

Defined results: null, empty and blank texts have no words; items of fewer than ``least`` words
can't be found; repeated items are found under each of their ids; rows without an item_id are no items.
"""

from __future__ import annotations

import bisect
import heapq
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.storage import stage

LEAST = 10
_WORD = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def words(text: str | None) -> list[str]:
    if not text:
        return []
    text = text.casefold()
    if not text.isascii():
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.category(c).startswith("M"))
    return _WORD.findall(text)


class Codes:
    """A 64-bit code for each word, the same in every task; kept while the worker lives."""

    def __init__(self, most: int = 1_000_000) -> None:
        self.of: dict[str, int] = {}
        self.most = most

    def __call__(self, own: list[str]) -> list[int]:
        if len(self.of) > self.most:
            self.of.clear()
        of, out = self.of, []
        for w in own:
            c = of.get(w)
            if c is None:
                c = of[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
            out.append(c)
        return out


_CODES = Codes()


def roll(code: np.ndarray, least: int) -> np.ndarray:
    """The fingerprints of all runs of ``least`` words."""
    n = len(code) - least + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    mixed = (code ^ (code >> np.uint64(31))) * _MIX
    out = np.zeros(n, np.uint64)
    for k in range(least):
        out = out * _BASE + mixed[k : k + n]
    return out ^ (out >> np.uint64(29))


def fingerprints(rows: DataFrame, key: str, text: str, least: int, passing: object | None = None, bits: int = 0) -> DataFrame:
    """(key, at, print, words): the fingerprints of each text, of those that pass the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = None if passing is None else np.frombuffer(passing.value, np.uint8)
        for whole in batches:
            for part in range(0, whole.num_rows, 512):
                batch = whole.slice(part, 512)
                codes: list[int] = []
                begin, keys = [0], batch.column(0).to_pylist()
                for value in batch.column(1).to_pylist():
                    codes += _CODES(words(value))
                    begin.append(len(codes))
                start = np.array(begin)
                h = roll(np.array(codes, dtype=np.uint64), least)
                doc = np.searchsorted(start, np.arange(len(h)), "right") - 1
                fine = np.arange(len(h)) + least <= start[doc + 1]  # no run reaches into the next text
                if seen is not None:
                    slot = h & np.uint64(bits - 1)
                    fine &= (seen[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0
                at = np.flatnonzero(fine)
                doc = doc[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()).take(pa.array(doc)), pa.array((at - start[doc]).astype(np.int32)), pa.array(h[at].view(np.int64)), pa.array(np.diff(start)[doc].astype(np.int32))],
                    ["key", "at", "print", "words"],
                )

    return rows.select(F.col(key).cast("bigint"), text).mapInArrow(run, "key bigint, at int, print bigint, words int")


def bitmap(prints: DataFrame, bits: int) -> bytes:
    """The filter: one bit for each fingerprint modulo ``bits``, gathered as set words of 64 bits."""
    cells = prints.select(F.col("print").bitwiseAND(F.lit(bits - 1)).alias("slot"))
    cells = cells.groupBy(F.shiftright("slot", 6).alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("word"))
    out = np.zeros(bits // 64, np.int64)
    for batch in cells.toArrow().to_batches():  # at most bits / 64 rows of 16 bytes
        out[batch.column("cell").to_numpy()] = batch.column("word").to_numpy()
    return out.astype("<i8").tobytes()


def tiles(d: np.ndarray, i: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiling of one (document, item) from its seeds: (place, place, words), longest first.

    Runs are diagonals of consecutive seeds. What a chosen tile leaves of an overlapping run is a run
    again if it has ``least`` words. Marked words are kept as sorted intervals.
    """
    if not len(d):
        return []
    order = np.lexsort((d, d.astype(np.int64) - i))
    d, i = d[order].astype(np.int64), i[order].astype(np.int64)
    cuts = np.flatnonzero((np.diff(d) != 1) | (np.diff(d - i) != 0)) + 1
    runs = [(hi - lo + least - 1, -int(d[lo]), -int(i[lo])) for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(d)])]
    heap = [(-n, -a, -b) for n, a, b in runs]
    heapq.heapify(heap)
    free_d, free_i, out = Marks(), Marks(), []
    while heap:
        n, a, b = heapq.heappop(heap)
        n = -n
        gaps = sorted([(s - a, e - a) for s, e in free_d.over(a, a + n)] + [(s - b, e - b) for s, e in free_i.over(b, b + n)])
        if not gaps:
            free_d.add(a, a + n)
            free_i.add(b, b + n)
            out.append((a, b, n))
            continue
        at = 0
        for s, e in [*gaps, (n, n)]:
            if s - at >= least:
                heapq.heappush(heap, (at - s, a + at, b + at))
            at = max(at, e)
    return out


class Marks:
    """Disjoint intervals in order."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []

    def over(self, start: int, end: int) -> list[tuple[int, int]]:
        k = bisect.bisect_right(self.ends, start)
        out = []
        while k < len(self.starts) and self.starts[k] < end:
            out.append((max(start, self.starts[k]), min(end, self.ends[k])))
            k += 1
        return out

    def add(self, start: int, end: int) -> None:
        k = bisect.bisect_left(self.starts, start)
        self.starts.insert(k, start)
        self.ends.insert(k, end)


def leaks(documents: DataFrame, items: DataFrame, least: int = LEAST, filter_bits: int = 1 << 24) -> DataFrame:
    """(doc_id, item_id, tiles, longest, matched_words, coverage) of every document with a passage.

    ``filter_bits`` is a power of two: 2 MB as it is. With very many items the filter lets more pass,
    which costs shuffle but loses nothing.
    """
    own = items.filter("item_id is not null").select("item_id", "item_text").distinct()
    prints = stage(fingerprints(own, "item_id", "item_text", least), "prints")
    passing = documents.sparkSession.sparkContext.broadcast(bitmap(prints, filter_bits))
    seeds = fingerprints(documents, "doc_id", "text", least, passing, filter_bits)
    met = seeds.select(F.col("key").alias("doc_id"), F.col("at").alias("d"), "print").join(prints.select(F.col("key").alias("item_id"), F.col("at").alias("i"), "print", "words"), "print")
    pairs = met.groupBy("doc_id", "item_id").agg(F.collect_set(F.struct("d", "i")).alias("seeds"), F.max("words").alias("words"))

    @F.pandas_udf("struct<tiles int, longest int, matched_words int>")
    def tile(seeds: pd.Series) -> pd.DataFrame:
        out = []
        for own in seeds:
            found = tiles(np.array([s["d"] for s in own]), np.array([s["i"] for s in own]), least)
            out.append((len(found), max(n for *_, n in found), sum(n for *_, n in found)))
        return pd.DataFrame(out, columns=["tiles", "longest", "matched_words"])

    done = pairs.select("doc_id", "item_id", "words", tile("seeds").alias("t"))
    return done.select("doc_id", "item_id", "t.tiles", "t.longest", "t.matched_words", (F.col("t.matched_words") / F.col("words")).alias("coverage"))
