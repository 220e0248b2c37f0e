"""The queries against brute force, over the whole small tables."""

import numpy as np
import pytest

import brute
from tessera.llm import chat, license_scan, packing, pii, quality, secrets, sharding, simhash, toxicity
from tessera.llm.queries import ORACLES, QUERIES

DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def collected(df):
    return [r.asDict() for r in df.collect()]


def check_components(got, docs):
    want = brute.components(docs)
    assert len(got) == len(docs)
    pairs = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=str)
    assert pairs == sorted(((d["doc_id"], brute.simhash(d["text"]), want[brute.simhash(d["text"])]) for d in docs), key=str)


def as_dicts(df):
    return [{k: r[k] for k in DOC_COLUMNS} for r in df.collect()]


def hexed(df):
    return [r | {"fingerprint": "%016x" % (r["fp"] % (1 << 64))} for r in collected(df)]


def test_simhash(spark, sf):
    check_components(collected(QUERIES["op1_simhash"](spark, sf)), brute.rows(sf, "documents"))


def test_simhash_odd_rows(spark, odd_docs):
    check_components(hexed(simhash.near_duplicates(odd_docs)), as_dicts(odd_docs))
    assert simhash.near_duplicates(odd_docs.limit(0)).count() == 0


@pytest.mark.parametrize("max_file", [2, 1 << 40])
def test_links_full_and_refined_join_the_same_groups(spark, max_file):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 62, 12)
    fps = sorted({int(b) ^ sum(1 << int(i) for i in rng.choice(64, rng.integers(0, 4), replace=False)) for b in base for _ in range(40)})
    fps = [simhash._signed(x) for x in fps]
    links = simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long"), 2, max_file)
    got = {frozenset((r.a, r.b)) for r in links.collect()}
    near = {frozenset((x, y)) for i, x in enumerate(fps) for y in fps[:i] if ((x ^ y) % (1 << 64)).bit_count() <= 2}
    assert got <= near
    if max_file > 2:
        assert got == near
    group = {r.node: r.root for r in simhash.stars(links).collect()}
    assert all(group[a] == group[b] for a, b in map(tuple, near))


def test_deduplicate_keeps_one_of_each(spark, odd_docs):
    groups = {r["fp"]: r["component_id"] for r in collected(simhash.near_duplicates(odd_docs))}
    kept = simhash.deduplicate(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({c for c in groups.values() if c is not None})


@pytest.mark.parametrize("module,find,kinds", [(pii, brute.pii, pii.KINDS), (secrets, brute.secrets, secrets.KINDS)])
def test_spans(spark, sf, odd_docs, module, find, kinds):
    from tessera.llm.common import documents

    for df in (documents(spark, sf), odd_docs):
        texts = sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=str)
        got = collected(module.digest(module.scan(df)))
        want = sorted(((d, brute.sha(brute.joined(find(t), kinds)), tuple(sum(s[0] == k for s in find(t)) for k in kinds)) for d, t in texts), key=str)
        assert sorted(((r["doc_id"], r["base_sha256"], tuple(r[f"n_{k}"] for k in kinds)) for r in got), key=str) == want
        by_id = {}
        for d, t in texts:
            by_id.setdefault(d, set()).add(brute.joined(find(t), kinds))
        for r in got:
            assert any(set(b.split(",")) <= set(r["spans"].split(",")) or not b for b in by_id[r["doc_id"]])
    assert module.digest(module.scan(odd_docs.limit(0))).count() == 0


def test_live_and_copied_secrets(spark):
    key = "ghp_" + "a1B2c3D4e5F6g7H8i9J0k1L2"
    rows = [(i, f"see {key} here", "en", f"s{i}", 1) for i in range(4)] + [(9, "see ghp_zz11YY22xx33WW44vv55UU66 here", "en", "s9", 1)]
    got = {r["doc_id"]: r for r in collected(secrets.digest(secrets.scan(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))))}
    assert got[0]["spans"] == "" and got[9]["spans"] == "access:4:32" and got[9]["n_live"] == 1


def test_a_value_in_many_documents_of_one_source_is_an_example(spark):
    copied, own = "ghp_" + "a1B2c3D4e5F6g7H8i9J0k1L2", "ghp_zz11YY22xx33WW44vv55UU66"
    rows = [(i, f"see {copied} here {i}", "en", f"s{i % 2}", 1) for i in range(40)] + [(50 + i, f"see {own} here {i}", "en", "s0", 1) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["n_live"] for r in collected(secrets.digest(secrets.scan(df)))}
    assert {got[i] for i in range(40)} == {0} and {got[50 + i] for i in range(5)} == {1}


def test_a_proposal_is_not_carried_by_the_base_spans_of_other_scores(spark):
    rows = [(i, f"call +1 (487) 555-{i:04d}") for i in range(600)] + [(1000 + i, f"order 555-123-{4000 + i}") for i in range(10)]
    got = {r["doc_id"]: r["spans"] for r in collected(pii.digest(pii.scan(spark.createDataFrame(rows, "doc_id long, text string"))))}
    assert all(got[i].startswith("phone:") for i in range(600)) and {got[1000 + i] for i in range(10)} == {""}


def test_limit_of_scores():
    assert pii.limit([(0.9, 1000, 1000), (0.1, 40, 0)], 0.95, 20) == 0.9
    assert pii.limit([(0.9, 50, 48), (0.8, 50, 50), (0.7, 100, 60)], 0.95, 20) == 0.8
    assert pii.limit([(0.9, 10, 10), (0.1, 10, 0)], 0.95, 20) is None and pii.limit([(0.5, 50, 20)], 0.95, 20) is None and pii.limit([], 0.95, 20) is None


def test_redaction(spark, odd_docs):
    for module in (secrets, pii):
        out = module.redact(odd_docs)
        assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    got = {r.doc_id: r.text for r in secrets.redact(odd_docs).collect()}
    assert got[8] == "x|y <|im_end|> \\| <|endoftext|> <SECRET:ASSIGN>' 1.2.3.400 10.0.0.1"
    assert got[9].endswith("\U0001f600 <SECRET:ACCESS> x") and got[2] == "" and got[1] is None


def test_quality(spark, sf, odd_docs):
    from tessera.llm.common import documents

    for df in (documents(spark, sf), odd_docs):
        want = sorted(((r.doc_id, *brute.quality(r.text)) for r in df.select("doc_id", "text").collect()), key=str)
        got = collected(quality.judge(df))
        assert sorted(((r["doc_id"], *[r[c] for c in quality.BASE], r["base_failed"]) for r in got), key=str) == want
        assert not any(r["kept"] for r in got if r["base_failed"])
    kept = {r["doc_id"]: r["kept"] for r in collected(QUERIES["op4_quality"](spark, sf))}
    marked = {r["doc_id"]: r["quality"] for r in brute.rows(sf, "labels")}
    n_words = {r["doc_id"]: len((r["text"] or "").split()) for r in brute.rows(sf, "documents")}
    good = [kept[d] for d, q in marked.items() if q == 1 and n_words[d] >= 50]
    assert sum(good) >= 0.97 * len(good)
    bad = [kept[d] for d, q in marked.items() if q == 0]
    assert sum(bad) <= 0.1 * len(bad)
    assert quality.judge(odd_docs.limit(0)).count() == 0


def ids_of(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    tk = ids_of.__dict__.setdefault("tk", Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    return tk.encode(text or "", add_special_tokens=False).ids + [0]


def check_packing(pieces, texts, window=1024):
    by, places = {}, {}
    for p in pieces:
        by.setdefault(p["doc_id"], []).append(p)
        places.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for doc_id, found in by.items():
        ids = ids_of(texts[doc_id])
        rows = sorted({(p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]) for p in found})
        assert sum(p["length"] for p in found) % len(ids) == 0
        at = 0
        if sum(p["length"] for p in found) == len(ids):
            for start, length, crc, n in rows:
                assert start == at and n == len(ids) and crc == brute.crc(np.array(ids[start:start + length], "<u4").tobytes())
                at += length
            assert at == len(ids)
    total = padded = 0
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= window
        total += at
        padded += 0 if at & (at - 1) == 0 else window - at
    assert padded <= 0.01 * total + window
    return padded


def test_packing(spark, sf, odd_docs):
    texts = {r["doc_id"]: r["text"] for r in brute.rows(sf, "documents")}
    pieces = collected(QUERIES["op5_packing"](spark, sf))
    assert {p["doc_id"] for p in pieces} == set(texts)
    check_packing(pieces, texts)
    from pyspark.sql import functions as F

    odd = packing.pack(odd_docs.where("doc_id is not null")).withColumn("ids_crc32", F.crc32("ids"))
    check_packing(collected(odd), {r.doc_id: r.text for r in odd_docs.collect()})
    assert packing.pack(odd_docs).where("doc_id is null").count() == 2
    assert packing.pack(odd_docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_remainder_once(seed):
    rng = np.random.default_rng(seed)
    window = 64
    counts = rng.integers(0, [1, 3, 50, 1000, 7, 2][seed] + 1, window)
    if seed % 2:
        counts[rng.integers(1, window)] = 5000  # one hot length
    p = packing.plan(counts, window, 2)
    used = {}
    for r in range(1, window):
        for rank in range(int(counts[r])):
            pieces = packing.locate(p, r, rank)
            assert sum(n for _, n, *_ in pieces) == r
            for _, n, s, o in pieces:
                used.setdefault(s, []).append((o, n))
    pad = 0
    for spans in used.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= window
        pad += 0 if at & (at - 1) == 0 else window - at
    assert sorted(used) == list(range(p.sequences)) and pad <= 2 * len(used)


def test_toxicity_held_out(spark, sf):
    got = {r["doc_id"]: r for r in collected(QUERIES["op6_toxicity"](spark, sf))}
    texts = {r["doc_id"]: r["text"] for r in brute.rows(sf, "documents")}
    assert set(got) == set(texts)
    for d, r in got.items():
        assert r["held_out"] == (brute.crc(str(d).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [(got[r["doc_id"]]["predicted"], r["toxic"]) for r in brute.rows(sf, "labels") if got[r["doc_id"]]["held_out"]]
    assert sum(a == b for a, b in held) >= 0.9 * len(held)


def all_segments(w):
    """Maximal scoring segments by their definition, recursively."""
    best, at = 0.0, None
    for i in range(len(w)):
        s = 0.0
        for j in range(i, len(w)):
            s += w[j]
            if s > best + 1e-12:
                best, at = s, (i, j + 1)
    if at is None:
        return []
    return all_segments(w[:at[0]]) + [(at[0], at[1], best)] + [(a + at[1], b + at[1], s) for a, b, s in all_segments(w[at[1]:])]


@pytest.mark.parametrize("seed", range(20))
def test_segments(seed):
    w = np.random.default_rng(seed).integers(-4, 4, 40) + np.random.default_rng(seed + 99).random(40) / 7
    got, want = toxicity.segments(w), all_segments(list(w))
    assert [x[:2] for x in got] == [x[:2] for x in want] and np.allclose([x[2] for x in got], [x[2] for x in want])


def test_toxicity_edges(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1, 0), (6, 1, 0), (8, 0, 1), (None, 1, 1), (9, 1, None)], "doc_id long, quality int, toxic int")
    for marks in (labels, labels.limit(0)):
        model = toxicity.fit(odd_docs, marks)
        out = toxicity.score(odd_docs, model)
        assert out.count() == odd_docs.count()
        assert out.where("toxicity.score is null or toxicity.score < 0 or toxicity.score > 1").count() == 0


def test_sharding(spark, sf, odd_docs):
    from tessera.llm.common import documents

    for df in (documents(spark, sf), odd_docs):
        got = collected(sharding.shard(df))
        want = sorted((str(r.doc_id), len((r.text or "").encode()) + 1, brute.crc((r.text or "").encode())) for r in df.select("doc_id", "text").collect())
        assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == want
        for s in {r["shard"] for r in got}:
            own = sorted(r["slot"] for r in got if r["shard"] == s)
            assert 0 <= s < 8 and own == list(range(len(own)))
    sizes = np.zeros(8)
    for r in collected(QUERIES["op10_sharding"](spark, sf)):
        sizes[r["shard"]] += r["size"]
    assert sizes.max() <= 1.01 * sizes.min()
    assert sharding.shard(odd_docs.limit(0)).count() == 0


def test_growing_a_map_moves_slots_into_the_new_shard_only():
    load = np.random.default_rng(3).integers(1, 1000, 4096).astype(float)
    owner = sharding.rebalance(sharding.initial_map(8), load, 8)
    more = sharding.grow(owner, load, 8)
    assert set(more[more != owner]) == {8}
    total = np.bincount(more, load)
    assert total.max() <= 1.05 * total.min()


def test_sql_twins(spark, sf):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name, sql in ORACLES.items():
        got = QUERIES[name](spark, sf).toPandas()
        want = con.execute(sql).df()[list(got.columns)]
        key = got.columns[0]
        got, want = (x.sort_values(list(x.columns)).reset_index(drop=True) for x in (got, want))
        assert got[key].tolist() == want[key].tolist()
        for c in got.columns:
            assert got[c].tolist() == want[c].tolist(), (name, c)


def test_licences(spark, odd_docs):
    mit = ("MIT License\n\nCopyright (c) 2020 X\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software "
           "and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\n"
           "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\n"
           "furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\n"
           "copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, "
           "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE\n"
           "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER\nLIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,\n"
           "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE\nSOFTWARE.\n")
    bsd = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. "
           "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
           "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
           "and/or other materials provided with the distribution. ")
    end = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
           "without specific prior written permission.")
    docs = spark.createDataFrame([(1, mit), (2, bsd), (3, bsd + end), (4, "x\nLicensed under CC BY-NC 4.0."), (5, "no licence here"), (6, end + " " + bsd)],
                                 "doc_id long, text string")
    got = {r.doc_id: r.licences for r in license_scan.scan(docs).collect()}
    assert "MIT:text" in got[1] and got[2] == "BSD-2-Clause:text" and got[3] == "BSD-3-Clause:text"
    assert got[4] == "CC-BY-NC-4.0:notice" and got[5] == "" and got[6] == "BSD-2-Clause:text"
    import re

    assert all(re.search(license_scan.NEEDED, s) for s in license_scan.SENTENCES)
    assert license_scan.scan(odd_docs).count() == odd_docs.count()


ODD = ["", "\\", "<|", "<\\|", "\\\\|", "<|im_end|>\n<|im_start|>assistant\nhi", "\\N\n", "a\\\\\\|b<", "|im_start|>", "é\U0001f600<|x|>\\"]


def test_chat_round_trip(spark):
    rows = [(i, j, r, t) for i in range(2) for j, (r, t) in enumerate(zip([*ODD, None], [*ODD[::-1], None]))]
    rows += [(5, 0, "assistant", t) for t in ODD] + [(None, None, None, None), (7, 1, "user", "b"), (7, 1, "user", "b"), (7, None, "assistant", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.render(df)).collect()}
    order = lambda v: (v is not None, v)
    for conv in {r[0] for r in rows}:
        want = sorted(((t, r or "", x or "") for c, t, r, x in rows if c == conv), key=lambda z: (order(z[0]) if z[0] is not None else (False, 0), z[1].encode(), z[2].encode()))
        assert [(t.role, t.text) for t in got[conv].turns] == [(r, x) for _, r, x in want]
        assert list(got[conv].loss) == [x for _, r, x in want if r == "assistant"]
    assert chat.render(df.limit(0)).count() == 0


def test_chat_parts(spark):
    parts = [("text", "look <|here|>", None, None), ("image", None, "a.png", 2), ("text", "and", None, None), ("audio", None, "b.wav", 3)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", [("document", None, "c.pdf", None), ("text", "ok now", None, None)])],
                               f"conv_id long, turn long, role string, content array<{chat.PART}>")
    r = chat.render(df, parts="content").first()
    assert r.formatted == "<|im_start|>user\nlook <\\|here|><|image:0|>and<|audio:1|><|im_end|>\n<|im_start|>assistant\n<|document:2|>ok now<|im_end|>\n"
    assert [(a.no, a.type, a.ref, a.tokens) for a in r.attachments] == [(0, "image", "a.png", 512), (1, "audio", "b.wav", 75), (2, "document", "c.pdf", 512)]
    assert r.n_tokens == 5 + 512 + 75 + 512 and r.formatted[r["mask"][0].start:r["mask"][0].end] == "<|document:2|>ok now"
