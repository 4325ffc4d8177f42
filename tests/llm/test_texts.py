"""Problems 8, 9 and 10 against the public tokenizer, brute force and planted cases."""

from __future__ import annotations

import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import personal, tiling, tokenize

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
needs_vocabulary = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary here")


@pytest.fixture(scope="module")
def coders():
    from tokenizers import Tokenizer

    public = Tokenizer.from_file(VOCABULARY)
    public.encode_special_tokens = True
    return tokenize.Encoder(*tokenize.load(VOCABULARY)), public


@needs_vocabulary
@settings(max_examples=300, deadline=None)
@given(text=st.one_of(st.text(max_size=80), st.text("aeioustn .,'\n\t1<|>ñé漢😀", max_size=120)))
def test_ids_of_any_text(coders, text):
    mine, public = coders
    assert mine.encode(text).tolist() == public.encode(text, add_special_tokens=False).ids


@needs_vocabulary
@pytest.mark.parametrize("text", ["a" * 50_000, " " * 30_000 + "x", "<|endoftext|>", "it's we'll  \n\n ", "0" * 999, "é" * 5000, "‍👩‍👩‍👧", ""])
def test_ids_of_odd_texts(coders, text):
    mine, public = coders
    assert mine.encode(text).tolist() == public.encode(text, add_special_tokens=False).ids


@needs_vocabulary
def test_null_and_empty_texts(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, " hello", "x"), (3, " hello", "x")], "doc_id long, text string, ids string")
    assert sorted((r.doc_id, list(r.ids)) for r in tokenize.encode_documents(df).collect()) == [(1, []), (2, []), (3, [23748]), (3, [23748])]
    assert tokenize.encode_documents(df.limit(0)).count() == 0


def brute_leaks(docs, items, least):
    out = set()
    for d, text in docs:
        w = tiling.words(text)
        runs = {tuple(w[k : k + least]) for k in range(len(w) - least + 1)}
        for i, item in items:
            v = tiling.words(item)
            if any(tuple(v[k : k + least]) in runs for k in range(len(v) - least + 1)):
                out.add((d, i))
    return out


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("ab c", max_size=60), min_size=1, max_size=6), st.lists(st.text("ab c", max_size=40), min_size=1, max_size=4))
def test_tiles_are_found_where_brute_force_finds_them(docs, items):
    found = set()
    for d, text in enumerate(docs):
        own = tiling.words(text)
        h = tiling.roll(np.array(tiling._CODES(own), dtype=np.uint64), 3)
        for i, item in enumerate(items):
            other = tiling.words(item)
            g = tiling.roll(np.array(tiling._CODES(other), dtype=np.uint64), 3)
            seeds = np.array([(p, q) for p in range(len(h)) for q in range(len(g)) if h[p] == g[q]]).reshape(-1, 2)
            tiles = tiling.tiles(seeds[:, 0], seeds[:, 1], 3)
            assert all(own[p : p + n] == other[q : q + n] and n >= 3 for p, q, n in tiles)
            for side in (0, 1):
                used = [x for t in tiles for x in range(t[side], t[side] + t[2])]
                assert len(used) == len(set(used))
            if tiles:
                # the longest common run is a tile
                assert tiles[0][2] == max(n for n in range(3, len(own) + 1) for p in range(len(own) - n + 1) if any(own[p : p + n] == other[q : q + n] for q in range(len(other) - n + 1)))
                found.add((d, i))
    assert found == brute_leaks(list(enumerate(docs)), list(enumerate(items)), 3)


def test_leaks(spark):
    item = "Uno dos tres, cuatro cinco — seis siete ocho nueve diez once doce trece"
    docs = [(1, "xx UNO DÓS tres cuatro > cinco\nseis siete ocho nueve diez yy"), (2, "uno dos tres cuatro cinco seis siete ocho nueve y diez once"), (3, None), (4, ""), (5, item + " " + item), (6, "z " * 20_000 + item)]
    df = spark.createDataFrame([(*d, "own") for d in docs], "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(7, item), (8, "corto"), (9, None), (None, item), (10, item)], "item_id long, item_text string")
    for bits in (1 << 24, 64):  # with a full filter everything goes to the join
        got = {(r.doc_id, r.item_id): r for r in tiling.leaks(df, items, filter_bits=bits).collect()}
        assert set(got) == {(d, i) for d in (1, 5, 6) for i in (7, 10)}
        assert got[1, 7].longest == 10 and got[5, 7].coverage == 1.0
    assert tiling.leaks(df.limit(0), items).count() == 0 and tiling.leaks(df, items.limit(0)).count() == 0


GIVEN = ["Ana", "Bruno", "Celia", "Diego", "Elsa", "Felix", "Greta", "Hugo"]
SURNAME = ["Arizcuén", "Bervián", "Corvalis", "Dunmor", "Estévaro", "Figueirol", "Galdurriz", "Hollenby-Iz"]
NEW = ["Zubiarte", "Wexford", "Yantorno"]


def made(n, surnames):
    out = []
    for i in range(n):
        g, s, t = GIVEN[i % 8], surnames[(i * 3) % len(surnames)], surnames[(i * 5 + 1) % len(surnames)]
        who = [f"{g} {s}", f"{g} {s} {t}", f"{g[0]}. {s}", f"{s}, {g}", f"{g} {chr(65 + i % 26)}. {s}", f"{g.upper()} {s.upper()}"][i % 6]
        phone = [f"06 39 98 {10 + i % 80} {20 + i % 70}", f"+44 7700 900 {100 + i % 800}", f"(555) 555-0{100 + i % 99}", f"0639-98-{10 + i % 80}-{20 + i % 70}"][i % 4]
        number = [f"99{100000 + i}-K", f"99.{100 + i % 800}.{200 + i % 700}-B", f"Z{9000000 + i}Q", f"666-{10 + i % 80}-{1000 + i}"][i % 4]
        place = [f"calle del Pozo Amargo, nº {1 + i % 200}", f"Flat {1 + i % 9}, {1 + i % 150} Hollow Fig Road", "Avda. Sierra Jacinta, s/n", f"Rua da Figueira Alta {1 + i % 90} bis"][i % 4]
        mail = [f"{g.lower()}-{i}@correo.example", f"{g.lower()}{i} [at] correo.test", f"{g.upper()}{i}@CORREO.EXAMPLE"][i % 3]
        text = f"Nota de marzo sobre la hoja. Firma: {who}\nReferencia interna Q-{1000 + i}. Tel. {phone}. DNI {number} en el parte. Domicilio: {place}. Contacto: {mail}; el lote {i} 905 16 424 y la calle 6 del olivar. El cultivar Greta madura con Mancha roja en Soto Mirlo. Serial {4071860000 + i} ok."
        out.append((text, {("person_name", who), ("phone", phone), ("id_number", number), ("address", place), ("email", mail)}))
    return out


def test_held_out_accuracy_with_unknown_surnames():
    train, held = made(600, SURNAME), made(120, SURNAME[:2] + NEW)
    plain = personal.plain
    model, names = personal.fit([t for t, _ in train], frozenset(plain(g) for g in GIVEN), frozenset(plain(s) for s in SURNAME))
    texts = [t for t, _ in held]
    found = {}
    for d, kind, s, e in personal.find(texts, model, names):
        found.setdefault(d, set()).add((kind, texts[d][s:e]))
    hits = sum(len(found.get(d, set()) & want) for d, (_, want) in enumerate(held))
    total = sum(len(want) for _, want in held)
    extra = sum(len(found.get(d, set()) - want) for d, (_, want) in enumerate(held))
    assert hits >= 0.97 * total and extra <= 0.02 * total


def test_findings_and_placeholders(spark):
    rows = made(300, SURNAME)
    df = spark.createDataFrame([(i, t, "own") for i, (t, _) in enumerate(rows)] + [(900, None, ""), (901, "", ""), (902, "   ", ""), (903, "A B " * 20_000 + "12 34 " * 5000, "")], "doc_id long, text string, found string")
    people = spark.createDataFrame([(g, s, 1) for g in GIVEN for s in SURNAME] + [(None, None, 1)], "given_name string, surname string, kind int")
    got = {}
    for r in personal.findings(df, people).collect():
        got.setdefault(r.doc_id, set()).add((r.kind, r.found))
    assert sum(got.get(i, set()) == want for i, (_, want) in enumerate(rows)) >= 285
    new = {r.doc_id: r.text for r in personal.redact(df, people).collect()}
    assert new[900] is None and new[901] == "" and "[EMAIL]" in new[0] and "[PERSON_NAME]" in new[0] and new[0].startswith("Nota de marzo sobre la hoja. Firma: [PERSON_NAME]\nReferencia")
    assert personal.findings(df.limit(0), people).count() == 0 and personal.findings(df.limit(5), people.limit(0)).count() >= 0


@pytest.mark.parametrize("text, found", [("Meet at 12 Oak Hill Road today", "12 Oak Hill Road"), ("12345 Oak Hill Road", "12345 Oak Hill Road"), ("Flat 2, 63 Quillmere Road The Lane is shut", "Flat 2, 63 Quillmere Road"), ("C/ Mayor, 12 bis", "C/ Mayor, 12 bis")])
def test_spans_of_addresses(text, found):
    g = personal.build([text], personal.Names())
    assert found in [t for t, k in zip(g.text, g.kind) if k == "address"]


def test_hints_lose_no_span():
    texts = ["Ana vive en CALLE Ávila 3", "pº del Río 5", "x en Pç. Nova, 9", "7 Elm St", "a arroba b punto com", "A AT B.example", "12A, Hollow Lane", "(+34) 600 123 456", "DNI 12.345.678-Z", "SSN 123-45-6789", "NIE X-1234567-L", "+34 (91) 123 45 67"]
    for text in texts:
        want = {(n.partition("_en")[0], m.group(0)) for n, p in personal.PATTERNS.items() for m in p.finditer(text) if n != "phone" or sum(c.isdigit() for c in m.group(0)) >= 7}
        g = personal.build([text], personal.Names())
        assert want and want <= set(zip(g.kind, g.text))


def test_the_sample_takes_long_texts_and_the_list_is_whole(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(personal, "fit", lambda sample, given, surname: seen.update(sample=sample, given=given, surname=surname))
    docs = spark.createDataFrame([(1, "x" * 50_000), (2, "y"), (3, None), (4, "")], "doc_id long, text string")
    people = spark.range(300_000).select(F.concat(F.lit("Given"), F.col("id") % 7).alias("given_name"), F.concat(F.lit("Sur"), "id").alias("surname"))
    personal.train(docs, people)
    assert sorted(map(len, seen["sample"])) == [1, 50_000] and len(seen["surname"]) == 300_000 and len(seen["given"]) == 7
    personal.train(docs, people.limit(1), train_characters=1)
    assert len(seen["sample"]) == 1
    with pytest.raises(ValueError):
        personal.train(docs, people, most_words=1000)
