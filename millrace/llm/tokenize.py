"""Problem 8: the ids of a public byte-level BPE, by longest matches and backtracking.

A text is cut by the tokenizer's pattern. The bytes of a piece are read as Latin-1, so that an
Aho-Corasick automaton over the vocabulary finds every token that starts at each byte. Encoding
takes the longest token that is compatible with the one before it; where none is, it backs up one
token and tries the next shorter one. A byte from which no continuation was found is never tried
again, so the work is linear in the length of the piece. Two adjacent tokens are compatible if
merging their joined bytes by rank gives these two tokens again; a sequence of which all neighbours
are compatible is the sequence the merges give. Compatibility and short pieces are memoised.

Defined results: null and empty texts have the empty list; strings of special tokens are ordinary
text; lone surrogates can't occur in Spark's strings.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.reuse import once

#: Fixed value: the pattern that cuts texts before the merges, as published with the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary file: printable ones for themselves, the
    others for the letters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def load(path: str) -> tuple[dict[bytes, int], dict[tuple[bytes, bytes], int]]:
    """(token -> id, merge -> rank) of a byte-level BPE file."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    letters = _byte_letters()
    raw = lambda t: bytes(letters[c] for c in t)
    vocabulary = {raw(t): i for t, i in model["vocab"].items() if all(c in letters for c in t)}
    merges = {}
    for rank, m in enumerate(model["merges"]):
        a, b = m.split(" ") if isinstance(m, str) else m
        merges[raw(a), raw(b)] = rank
    return vocabulary, merges


class Encoder:
    def __init__(self, vocabulary: dict[bytes, int], merges: dict[tuple[bytes, bytes], int], memo: int = 500_000) -> None:
        self.ids, self.merges, self.memo = vocabulary, merges, memo
        self.automaton = ahocorasick.Automaton()
        for token in vocabulary:
            self.automaton.add_word(token.decode("latin-1"), token)
        self.automaton.make_automaton()
        self.cut = regex.compile(PATTERN)
        self.pieces: dict[str, np.ndarray] = {}
        self.fits: dict[tuple[bytes, bytes], bool] = {}

    def merged(self, text: bytes) -> list[bytes]:
        """Merging by rank, for the few bytes of two neighbours."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            rank, i = min((self.merges.get((parts[i], parts[i + 1]), 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            pair, out, k = (parts[i], parts[i + 1]), [], 0
            while k < len(parts):
                if k + 1 < len(parts) and (parts[k], parts[k + 1]) == pair:
                    out.append(pair[0] + pair[1])
                    k += 2
                else:
                    out.append(parts[k])
                    k += 1
            parts = out
        return parts

    def compatible(self, a: bytes, b: bytes) -> bool:
        fit = self.fits.get((a, b))
        if fit is None:
            if len(self.fits) >= self.memo:
                self.fits.clear()
            fit = self.fits[a, b] = self.merged(a + b) == [a, b]
        return fit

    def encode_bytes(self, piece: bytes) -> list[int]:
        if piece in self.ids and self.merged(piece) == [piece]:
            return [self.ids[piece]]
        starts: list[list[bytes]] = [[] for _ in piece]
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            starts[end + 1 - len(token)].append(token)
        # tokens found later at the same start are longer
        chosen: list[bytes] = []
        left = [[t for t in starts[0]]]
        dead = bytearray(len(piece) + 1)
        at = 0
        while at < len(piece):
            options = left[-1]
            while options:
                token = options.pop()
                if not dead[at + len(token)] and (not chosen or self.compatible(chosen[-1], token)):
                    chosen.append(token)
                    at += len(token)
                    left.append([t for t in starts[at]] if at < len(piece) else [])
                    break
            else:
                dead[at] = 1
                left.pop()
                at -= len(chosen.pop())
        return [self.ids[t] for t in chosen]

    def encode(self, text: str | None) -> np.ndarray:
        out = []
        for piece in self.cut.findall(text or ""):
            ids = self.pieces.get(piece)
            if ids is None:
                ids = np.asarray(self.encode_bytes(piece.encode("utf-8")), dtype=np.int32)
                if len(piece) <= 64:
                    if len(self.pieces) >= self.memo:
                        self.pieces.clear()
                    self.pieces[piece] = ids
            out.append(ids)
        return np.concatenate(out) if out else np.empty(0, np.int32)


def encode_documents(documents: DataFrame, tokenizer: str = "/opt/tokenizers/byte_bpe_50k.json") -> DataFrame:
    """(doc_id, ids) of every document. The vocabulary (bounded: a published file) is broadcast."""
    model, name = documents.sparkSession.sparkContext.broadcast(load(tokenizer)), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once(name, lambda: Encoder(*model.value))
        for batch in batches:
            for part in range(0, batch.num_rows, 256):
                rows = batch.slice(part, 256)
                ids = [encoder.encode(t) for t in rows.column("text").to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))], ["doc_id", "ids"])

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id bigint, ids array<int>")
