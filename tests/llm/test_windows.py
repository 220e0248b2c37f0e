"""Candidate windows of decontamination against the plain scan of one text after another."""

import random

import brute
import numpy as np
import pytest
from tessera.llm import decontaminate as dec


def plain_windows(text, width, filed):
    """{(pos, template)} of a text's windows in any of their forms that are filed."""
    surface, shape, capitals = dec.canonical(text)
    out = set()
    n = len(shape) - width + 1
    if n < 1:
        return out
    spare = dec._spare(shape, width, dec.MIN_LITERALS)
    for i in range(n):
        if spare[i] >= 0:
            places = [k for k in range(width) if i + k in capitals]
            for b in range(1 << len(places)):
                if b.bit_count() <= spare[i]:
                    named = {places[j] for j in range(len(places)) if b >> j & 1}
                    form = " ".join(dec.NAME if k in named else c for k, c in enumerate(shape[i:i + width]))
                    if form in filed:
                        out.add((i, form))
        form = " ".join(surface[i:i + width])
        if form in filed:
            out.add((i, form))
    return out


@pytest.mark.parametrize("words_held", [1 << 20, 0])
def test_whole_table_against_the_plain_scan(spark, sf, words_held):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = dec.item_windows(spark.read.parquet(f"{sf}/benchmark.parquet"))
    filed = {}
    for r in items.select("width", "template").distinct().collect():
        filed.setdefault(r.width, set()).add(r.template)
    got = {}
    for r in dec.candidate_windows(docs, items, sorted(filed), words_held=words_held).collect():
        if r.template in filed[len(r.tokens)]:
            got.setdefault(r.key, set()).add((r.pos, r.template))
    want = {}
    import hashlib

    for d in brute.rows(sf, "documents"):
        found = set().union(*(plain_windows(d["text"], w, f) for w, f in filed.items()))
        if found:
            want[hashlib.md5((d["text"] or "").encode()).hexdigest()] = found
    assert got == want and want


def test_many_texts_at_once_are_the_texts_one_by_one():
    rng = random.Random(4)
    parts = ["Ann", "the", "12", "3.5", "km", "KG", ".", "!", "\n", "x", "Éa", "don't", "7", "s", " ", "?", "Mr", "٣", "Ⅷ", "_"]
    texts = [None, "", "..."] + ["".join(rng.choice(parts) + rng.choice([" ", "", " "]) for _ in range(rng.randint(0, 30))) for _ in range(500)]
    lexicon, none = dec.Lexicon(dec.BitWords(b"\xff" * (1 << 21), 24), most=20), dec.Lexicon(frozenset())
    x, y = (dec.shapes(list(map(dec.pieces_of, texts)), lex) for lex in (lexicon, none))
    for i, t in enumerate(texts):
        surface, shape, capitals = dec.canonical(t)
        own = x.text == i
        first = int(np.flatnonzero(own)[0]) if own.any() else 0
        assert x.low(lexicon, first, first + len(surface)) == y.low(none, first, first + len(surface)) == surface and x.place[own].tolist() == list(range(len(surface)))
        assert x.one[own].tolist() == dec._codes(shape).tolist() and x.exact[own].tolist() == dec._codes(surface).tolist()
        assert np.flatnonzero(x.capital[own]).tolist() == capitals and x.slot[own].tolist() == [c in dec.SLOTS for c in shape]
    assert x.known.all() and not y.known.any() and not lexicon.fresh().pieces
    # without any word of the benchmark the plain words have no number, and all else is as before
    assert (x.text == y.text).all() and (x.capital == y.capital).all() and (x.slot == y.slot).all()
    rest = y.ids > 1
    assert (x.one[rest] == y.one[rest]).all() and (x.one[x.slot] == y.one[x.slot]).all() and 0 < rest.sum() < len(rest)


def test_regions_hold_every_window_that_can_match():
    rng = random.Random(5)
    known = frozenset("the old man sea and".split())
    parts = ["the", "old", "man,", "sea.", "and", "other", "word;", "Ann", "12", "3.5km", "---", "Zed!", "kg", "don't", "x/y", "\n"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(400)] + [None, ""]
    lexicon = dec.Lexicon(known)
    found, text, offset = dec.regions(list(map(dec.pieces_of, texts)), lexicon, 4)
    x = dec.shapes(found, lexicon)
    got = {}
    for i in range(len(x.ids) - 3):
        if x.text[i] == x.text[i + 3] and (x.slot | x.known | x.capital)[i:i + 4].all():
            own = x.text[i]
            got.setdefault(int(text[own]), set()).add((int(offset[own] + x.place[i]), tuple(x.one[i:i + 4].tolist() if not x.capital[i:i + 4].any() else ())))
    want = {}
    for j, t in enumerate(texts):
        surface, shape, capitals = dec.canonical(t)
        fine = [c in dec.SLOTS or w in known or k in capitals for k, (w, c) in enumerate(zip(surface, shape))]
        for i in range(len(shape) - 3):
            if all(fine[i:i + 4]):
                plain = not any(k in capitals for k in range(i, i + 4))
                want.setdefault(j, set()).add((i, tuple(dec._codes(shape[i:i + 4]).tolist()) if plain else ()))
    assert got == want and want


def test_a_single_word_is_no_item(spark):
    docs = spark.createDataFrame([(1, "I like Paris in spring"), (2, "the answer is yes, we said"), (3, "Paris")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "Paris"), (2, "Yes"), (3, "...")], "item_id long, text string")
    assert dec.leaking(docs, bench).count() == 0 and dec.decontaminate(docs, bench).count() == 3
    assert {r.item_id for r in dec.unfiled(bench).collect()} == {1, 2, 3}


def test_a_text_of_megabytes(spark):
    item = "Which river flows through the old town and under the seven bridges of stone?"
    long = "word and Other words. " * 100_000
    docs = spark.createDataFrame([(1, long), (2, long + item + long)], "doc_id long, text string")
    assert [(r.doc_id, r.cover) for r in dec.leaking(docs, spark.createDataFrame([(5, item)], "item_id long, text string")).collect()] == [(2, 1.0)]
