"""Problem 3: freely typed values to the entries of a reference list.

The names and aliases of the list, in every order of their words, go into a symmetric-delete
dictionary: each form is filed under itself and under what is left of it when up to two letters
are deleted. A value's own deletes then reach every form within that edit distance by lookups
alone. Candidates are ranked by weighted Damerau-Levenshtein distance, then by how often the
entry is named exactly in all rows, then by entry id. What reaches no form within its bound is a
miss (entry 0).

The whole value is tried first, then runs of its words, longest first, so that a qualified form
("posible mancha cobriza", "roya espiral - leve") is found; a run of several words may be damaged,
a single word only if all words beside it are qualifiers. A word with a full stop may abbreviate.

A list of at most ``block_entries`` entries is one dictionary, which is broadcast, so its size is
bounded; values are then resolved row by row with a memo, without a shuffle. A longer list is cut
into blocks that distinct values are joined with; meanings are compared in one order over all
blocks, so the number of blocks changes no result.

Defined results: null and blank values are no entries; a value without letters is a miss; an empty
reference list makes every entry a miss.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections import defaultdict
from collections.abc import Iterator
from itertools import permutations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.reuse import once

#: Words that qualify a value without changing what it means.
QUALIFIERS = frozenset(
    "a al algo avanzada avanzado aparente aparentemente caso casi clara claro con confirmar creo de del dudosa dudoso el en es fase foto fuerte fruto grado grave hoja hojas inicial la leve leves ligera ligero lado los las mas media medio moderada moderado muy nivel ok parcial parece posible posibles probable probablemente quizas quiza revisar severa severo sombra sospecha tal tallo tipico tipica un una vez ver zona y "
    "advanced apparent early fruit grade leaf level likely light maybe mild moderate on partial perhaps possible possibly probable probably review severe shadow slight stage suspected the with "
    "avancado com fase folha grau inicio moderado na no parece pouco possivel provavel sombra suspeita talvez".split()
) - {"no"}
NEGATIONS = frozenset(("no", "not", "sin", "without", "sem", "nao", "ni", "nunca", "non"))
MAX_EDITS = 2


def unaccented(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def clean(text: str) -> str:
    """Repaired encoding, without invisible characters; words of CamelCase apart."""
    if "Ã" in text or "Â" in text:
        try:
            text = text.encode("cp1252").decode("utf-8")
        except (UnicodeEncodeError, UnicodeDecodeError):
            pass
    text = unicodedata.normalize("NFKC", text)
    text = "".join(" " if unicodedata.category(c) in ("Zs", "Cc") else c for c in text if unicodedata.category(c) not in ("Cf", "Co", "Cn"))
    return re.sub(r"(?<=[^\W\d_A-ZÁÉÍÓÚÑ])(?=[A-ZÁÉÍÓÚÑ])", " ", text)


def words(text: str) -> list[str]:
    """Lower-case words without accents; an abbreviated one keeps its full stop."""
    return re.findall(r"[^\W_]+\.?", unaccented(clean(text)).casefold())


def distance(a: str, b: str, most: float) -> float:
    """Weighted Damerau-Levenshtein distance, with edits between transposed letters: a doubled
    letter lost or gained costs 0.6, a transposition 0.8, an edit of the first letter 1.2, any
    other edit 1. Above ``most`` it is 9."""
    if a == b:
        return 0.0
    n, m = len(a), len(b)
    if abs(n - m) > MAX_EDITS:
        return 9.0
    lose = [0.0] + [0.6 if i > 1 and a[i - 1] == a[i - 2] else 1.2 if i == 1 else 1.0 for i in range(1, n + 1)]
    gain = [0.0] + [0.6 if j > 1 and b[j - 1] == b[j - 2] else 1.2 if j == 1 else 1.0 for j in range(1, m + 1)]
    rows = [[sum(gain[: j + 1]) for j in range(m + 1)]]
    seen: dict[str, int] = {}
    for i in range(1, n + 1):
        x, before, now, match = a[i - 1], rows[i - 1], [rows[i - 1][0] + lose[i]], 0
        for j in range(1, m + 1):
            y = b[j - 1]
            best = min(before[j] + lose[i], now[j - 1] + gain[j], before[j - 1] + (0.0 if x == y else 1.2 if i == j == 1 else 1.0))
            k = seen.get(y, 0)
            if k and match:
                best = min(best, rows[k - 1][match - 1] + (i - k - 1) + 0.8 + (j - match - 1))
            if x == y:
                match = j
            now.append(best)
        rows.append(now)
        seen[x] = i
    return rows[n][m] if rows[n][m] <= most else 9.0


def deletes(text: str, most: int) -> set[str]:
    """``text`` and what remains when up to ``most`` letters are deleted."""
    out = last = {text}
    for _ in range(most):
        last = {t[:i] + t[i + 1 :] for t in last for i in range(len(t))}
        out = out | last
    return out


def edits_for(length: int) -> int:
    return 0 if length < 4 else 1 if length < 7 else MAX_EDITS


#: (step, by abbreviation, distance, -frequency, entry): the least wins, whatever block it is from.
Meaning = tuple[int, int, float, int, int]


class Dictionary:
    """The forms of one field of the reference list, or of a block of it."""

    def __init__(self, entries: list[tuple[int, str, list[str], int]]) -> None:
        self.frequency = {e: n for e, _, _, n in entries}
        self.exact: dict[str, set[int]] = defaultdict(set)
        self.index: dict[str, set[str]] = defaultdict(set)
        self.starts: dict[tuple[int, int, str], set[tuple[tuple[str, ...], int]]] = defaultdict(set)
        for entry, name, aliases, _ in entries:
            for text in (name, *(aliases or [])):
                own = tuple(w.rstrip(".") for w in words(text)) if text else ()
                if not own:
                    continue
                for order in set(permutations(own)) if len(own) <= 3 else {own}:
                    self.exact["".join(order)].add(entry)
                    for i, w in enumerate(order):  # every beginning of every word, for words that are cut short
                        for n in range(1, len(w)):
                            self.starts[len(order), i, w[:n]].add((order, entry))
        for form in list(self.exact):
            for rest in deletes(form, edits_for(len(form))):
                self.index[rest].add(form)

    def best(self, found: dict[int, float], step: int, short: int = 0) -> Meaning | None:
        return min(((step, short, d, -self.frequency.get(e, 0), e) for e, d in found.items()), default=None)

    def near(self, text: str, edits: int, step: int) -> Meaning | None:
        if text in self.exact:
            return self.best({e: 0.0 for e in self.exact[text]}, step)
        if not edits:
            return None
        found: dict[int, float] = {}
        for form in {f for rest in deletes(text, edits) for f in self.index.get(rest, ())}:
            limit = min(edits, edits_for(len(form)))
            if limit and (d := distance(text, form, 1.2 * limit)) < 9:
                for e in self.exact[form]:
                    found[e] = min(d, found.get(e, 9.0))
        return self.best(found, step)

    def shortened(self, run: list[str], step: int) -> Meaning | None:
        """Words with a full stop as the beginnings of words of a form: looked up by the longest of them."""
        if len(run) < 2 or sum(len(w.rstrip(".")) > 2 for w in run) < len(run) / 2:
            return None
        cut = max((i for i, w in enumerate(run) if w.endswith(".")), key=lambda i: len(run[i]), default=None)
        if cut is None:
            return None
        found: dict[int, float] = {}
        for form, entry in self.starts.get((len(run), cut, run[cut].rstrip(".")), ()):
            cost = 0.0
            for mine, its in zip(run, form):
                short = mine.rstrip(".")
                if its == short:
                    continue
                if mine.endswith(".") and its.startswith(short):
                    cost += 0.5
                elif len(its) >= 5 and (d := distance(short, its, 1.2)) < 9:
                    cost += d
                else:
                    break
            else:
                found[entry] = min(cost, found.get(entry, 9.0))
        return self.best(found, step, 1)

    def resolve(self, value: str) -> Meaning | None:
        """What the value means, or None.

        Steps: the whole value; then runs of its words, longest first, letter for letter; then the
        whole value and runs again, damaged or cut short. The first step that reaches a form decides;
        within it damaged forms come before shortened ones, then distance, frequency and id decide.
        """
        own = words(value)
        bare = [w.rstrip(".") for w in own]
        if not own or not any(c.isalpha() for w in bare for c in w):
            return None
        joined = "".join(bare)
        if got := self.near(joined, 0, 0):
            return got
        step = 0
        sizes = range(min(len(own) - 1, 6), 0, -1)
        for fuzzy in (False, True):
            step += 1
            if fuzzy and bare[0] not in NEGATIONS and (got := self.near(joined, edits_for(len(joined) + 2), step) or self.shortened(own, step)):
                return got
            for size in sizes:
                step += 1
                tried = []
                for i in range(len(own) - size + 1):
                    rest = bare[:i] + bare[i + size :]
                    if i and bare[i - 1] in NEGATIONS:
                        continue
                    text = "".join(bare[i : i + size])
                    tried.append(self.near(text, 0, step))
                    if fuzzy and (size > 1 or all(w in QUALIFIERS or w.isdigit() or len(w) == 1 for w in rest)):
                        tried.append(self.near(text, edits_for(len(text)), step))
                        tried.append(self.shortened(own[i : i + size], step))
                if tried := [t for t in tried if t]:
                    return min(tried)
        return None


def resolver(reference: list[tuple[int, str, str, list[str], int]], memo: int = 200_000):
    """(field, value) -> Meaning or None, with a memo; reference(entry_id, field, name, aliases, frequency)."""
    fields = {f: Dictionary([(e, n, a, k) for e, g, n, a, k in reference if g == f]) for f in {r[1] for r in reference}}
    known: dict[tuple[str, str], Meaning | None] = {}

    def look(field: str, value: str) -> Meaning | None:
        key = (field, value)
        if key not in known:
            if len(known) >= memo:
                known.clear()
            known[key] = fields[field].resolve(value) if field in fields else None
        return known[key]

    return look


def free_entries(labels: DataFrame, fields: tuple[str, ...] = ("disease", "condition")) -> DataFrame:
    """(label_id, field, value) of every entry that isn't blank."""
    pairs = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields))
    return labels.select("label_id", F.inline(pairs)).filter(F.col("value").rlike(r"(?U)\S"))


MEANING = "step int, short int, distance double, rank bigint, entry_id bigint"


def map_entries(labels: DataFrame, ontology: DataFrame, block_entries: int = 2000) -> DataFrame:
    """(label_id, field, value, entry_id, distance, exact): what each free entry means, 0 for none.

    A list of at most ``block_entries`` is one dictionary, and rows are resolved where they lie. A
    longer list is cut into blocks of so many entries: distinct values meet each block in a task that
    holds that block only, and the least meaning over all blocks counts, which is what one dictionary
    of the whole list would have given.
    """
    spark = labels.sparkSession
    listed = ontology.filter("entry_id is not null and field is not null and name is not null").select("entry_id", "field", "name", "aliases")
    entries = free_entries(labels)
    forms = listed.select("field", "entry_id", "name", F.explode(F.array_distinct(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>"))))).alias("value")).filter("value <> ''").distinct()
    named = entries.join(forms.select("field", "value", F.col("entry_id").alias("e")), ["field", "value"]).groupBy("e").agg(F.count("*").alias("frequency"))
    listed = listed.join(named.withColumnRenamed("e", "entry_id"), "entry_id", "left").withColumn("frequency", F.coalesce("frequency", F.lit(0)))
    size = listed.count()
    blocks = max(1, -(-size // block_entries))
    names = forms.filter("value = name").groupBy("field", "value").agg(F.min("entry_id").alias("named"))
    rows = entries.join(F.broadcast(names) if blocks == 1 else names, ["field", "value"], "left")
    free = rows.filter("named is null").select("label_id", "field", "value")
    if blocks == 1:
        shared, name = spark.sparkContext.broadcast([tuple(r) for r in listed.collect()]), uuid.uuid4().hex  # at most block_entries rows

        @F.pandas_udf(f"struct<{MEANING.replace(' ', ':')}>".replace(",:", ", "))
        def meaning(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
            look = once(name, lambda: resolver(shared.value))
            for field, value in batches:
                yield _frame([look(f, v) for f, v in zip(field, value)])

        found = free.withColumn("m", meaning("field", "value"))
    else:
        best = _over_blocks(free.select("field", "value").distinct(), listed, blocks)
        found = free.join(best, ["field", "value"], "left")
    entry = F.coalesce("m.entry_id", F.lit(0).cast("bigint"))
    found = found.select("label_id", "field", "value", entry.alias("entry_id"), F.when(entry > 0, F.col("m.distance")).alias("distance"), F.lit(False).alias("exact"))
    same = rows.filter("named is not null").select("label_id", "field", "value", F.col("named").alias("entry_id"), F.lit(0.0).alias("distance"), F.lit(True).alias("exact"))
    return same.unionByName(found)


def _frame(got: list[Meaning | None]) -> pd.DataFrame:
    return pd.DataFrame([m or (99, 9, 99.0, 0, 0) for m in got], columns=["step", "short", "distance", "rank", "entry_id"])


def _over_blocks(values: DataFrame, listed: DataFrame, blocks: int) -> DataFrame:
    """(field, value, m): the least meaning of distinct values over all blocks of a long list."""
    block = F.pmod(F.xxhash64("entry_id"), F.lit(blocks)).cast("int").alias("block")
    held = listed.select("entry_id", "field", "name", "aliases", "frequency", block)
    asked = values.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def resolve(reference: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        rows = reference[["entry_id", "field", "name", "aliases", "frequency"]].itertuples(index=False, name=None)
        look = resolver([(e, f, n, [] if a is None else list(a), k) for e, f, n, a, k in rows])
        out = _frame([look(f, v) for f, v in zip(part["field"], part["value"])])
        return pd.concat([part[["field", "value"]].reset_index(drop=True), out], axis=1)

    # a block meets the values in as many parts as keep a task small
    parts = max(1, values.count() // 200_000)
    held = held.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("value"), F.lit(parts)).cast("int"))
    met = held.groupBy("block", "part").cogroup(asked.groupBy("block", "part")).applyInPandas(resolve, f"field string, value string, {MEANING}")
    return met.filter("entry_id > 0").groupBy("field", "value").agg(F.min(F.struct("step", "short", "distance", "rank", "entry_id")).alias("m"))


def misses(mapped: DataFrame) -> DataFrame:
    """The values that mean no entry, with their rows."""
    return mapped.filter("entry_id = 0").groupBy("field", "value").agg(F.count("*").alias("entries"))
