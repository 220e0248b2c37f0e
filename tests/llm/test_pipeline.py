"""Decontamination, the pipeline and its stages against plain Python."""

import brute
import corpus_pipeline
from tessera.llm import decontaminate
from tessera.llm.queries import QUERIES


def test_every_item_text_in_a_document_is_a_leak(spark, sf):
    items = {r["item_id"]: r["text"] for r in brute.rows(sf, "benchmark")}
    want = {(d["doc_id"], i) for d in brute.rows(sf, "documents") for i, t in items.items() if t in (d["text"] or "")}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op7_decontamination"](spark, sf).collect()}
    assert got == want and want


def test_changed_slots_and_consistency(spark):
    item = "Anna buys 12 apples for 3 dollars each and Anna sells 12 apples again for 5 dollars each at the market"
    again = item.replace("12", "40").replace("Anna", "Maria").replace("3 dollars", "7 dollars")
    mixed = item.replace("12", "40", 1)  # one number, two values
    docs = spark.createDataFrame([(1, "Once upon a time. " + item + " the end"), (2, again), (3, mixed), (4, "something else entirely " * 9),
                                  (5, None), (6, ""), (2, again)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (3, item), (8, None), (9, ""), (10, "Two words"), (None, "12 kg 5 km")], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, list(r.item_ids)) for r in decontaminate.leaking(docs, bench).collect())
    assert got == [(1, 3, [3, 7]), (2, 3, [3, 7]), (2, 3, [3, 7])]
    clean = decontaminate.decontaminate(docs, bench)
    assert sorted(r.doc_id for r in clean.collect()) == [3, 4, 5, 6] and clean.columns == docs.columns
    assert decontaminate.leaking(docs.limit(0), bench).count() == decontaminate.leaking(docs, bench.limit(0)).count() == 0


def test_short_item_inside_a_sentence(spark):
    item = "Which river flows through the old town?"
    docs = spark.createDataFrame([(1, "She asked: " + item), (2, "Quiz. " + item + " Yes"), (3, "Which road leads through the old town?"),
                                  (4, "they wondered, Which river flows through the old town, and left")], "doc_id long, text string")
    bench = spark.createDataFrame([(5, item)], "item_id long, text string")
    assert sorted((r.doc_id, r.cover) for r in decontaminate.leaking(docs, bench).collect()) == [(1, 1.0), (2, 1.0), (4, 1.0)]


def found(spark, items, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in decontaminate.leaking(docs, bench).collect()}


def test_one_conflicting_value_drops_its_windows_only(spark):
    item = ("the farmer counts 12 brown hens in the yard before lunch and then he walks over to the long barn where he finds another 12 white "
            "hens that sleep on the warm straw near the door, and his wife brings 12 more in the evening when the sun goes down behind the hill")
    fruit = ("in the small kitchen there are 5 green apples on the wide table and in the cold cellar there are 5 yellow pears in a basket "
             "so how many pieces of fruit are there in the whole old house of the family")
    edited = item.replace("12", "40", 1)
    got = found(spark, [item, fruit], [edited, fruit.replace("5", "3", 1).replace("5 y", "7 y"), item, item.replace("12", "x")])
    assert got[0, 0].n_matched < got[0, 0].n_windows and got[0, 0].n_changed == 0 and got[1, 1].cover > 0.5 and got[2, 0].cover == 1
    assert set(got) >= {(0, 0), (1, 1), (2, 0)} and got[0, 0].cover > 0.8


def test_items_with_few_plain_words_match_verbatim(spark):
    items = ["What is 17 + 25 + 38 + 41 + 56 + 73?", "Old Tom Bell, Ann Lee Ross, Max Oak Field", "+++ ???", "12 3"]
    texts = ["Sums: What is 17 + 25 + 38 + 41 + 56 + 73? 282", "what is 17 + 25 + 38 + 41 + 56 + 74", "and Old Tom Bell, Ann Lee Ross, Max Oak Field met", "x +++ ??? y"]
    got = found(spark, items, texts)
    assert set(got) == {(0, 0), (2, 1)} and all(r.cover == 1 for r in got.values())
    bench = spark.createDataFrame([*enumerate(items), (9, None), (10, "")], "item_id long, text string")
    assert {r.item_id for r in decontaminate.unfiled(bench).collect()} == {2, 9, 10}


def test_names_at_sentence_starts(spark):
    items = ["Ann has 3 red pens. Bob has 5 blue pens. How many pens do they have in all?",
             "yesterday the old Mr. Smith walked to the shop and bought two loaves",
             "in the morning the young\nJones walked over the hill and bought two loaves"]
    texts = [items[0].replace("Ann", "Sue").replace("Bob", "Tim"), items[1].replace("Smith", "Jones"),
             items[2].replace("\nJones", " Peter"), "the pens of Ann are red. The cat of Bob has 5 blue pens and all is well"]
    got = found(spark, items, texts)
    assert {k: r.cover for k, r in got.items()} == {(0, 0): 1, (1, 1): 1, (2, 2): 1} and got[0, 0].n_changed == 2


def test_forms_of_windows():
    text = "Ann sat. Bob ran. How far is it. We ask. " * 3
    surface, shape, capitals = decontaminate.canonical(text)
    one = decontaminate._codes(shape)
    got = [(int(i), int(b), int(h)) for at, bits, hs in decontaminate._named(one, decontaminate._rolled(one, 8), capitals, 8, decontaminate._spare(shape, 8, 4))
           for i, b, h in zip(at, bits, hs)]
    want = set()
    for i in range(len(shape) - 7):
        for b in range(1, 256):
            if all(i + k in capitals for k in range(8) if b >> k & 1) and b.bit_count() <= 4:
                form = [decontaminate.NAME if b >> k & 1 else shape[i + k] for k in range(8)]
                want.add((i, b, int(decontaminate.hashes(form, 8)[0])))
    assert set(got) == want and len(got) == len(want)


def test_hashes_of_windows():
    shape = "a b c a b c d".split()
    h = decontaminate.hashes(shape, 3)
    assert h[0] == h[3] and len(set(h.tolist())) == 4 and len(decontaminate.hashes(shape, 8)) == 0


def test_stages(spark, sf, odd_docs):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    scored = {r.doc_id: r.predicted for r in QUERIES["op6_toxicity"](spark, sf).collect()}
    kept = text
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name == "packing":
            assert {r.doc_id for r in out.collect()} == set(kept)
            break
        path = docs.sparkSession.sparkContext.getCheckpointDir() + f"/test-{name}"
        out.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        now = {r.doc_id: r.text for r in docs.collect()}
        assert len(now) == docs.count()
        if name == "toxicity":
            assert set(now) == {d for d, p in scored.items() if not p}
        if name == "near_duplicates":
            assert set(now) == set(brute.components([{"doc_id": d, "text": t} for d, t in kept.items()]).values())
        if name == "decontamination":
            items = [r["text"] for r in brute.rows(sf, "benchmark")]
            assert set(now) == {d for d, t in kept.items() if not any(i in t for i in items)}
        if name == "secrets":
            assert set(now) == set(kept)
            for d, t in kept.items():
                assert (now[d] == t) or brute.secrets(t)
                assert not brute.secrets(now[d])
        kept = now


def test_stages_on_odd_rows(spark, sf, odd_docs):
    for docs in (odd_docs, odd_docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            assert out.count() >= 0 and (name == "packing" or out.columns == docs.columns)
