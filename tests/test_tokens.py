"""Token operators against FIXTURES 7 and 11 and brute-force re-statements."""

import random

from pyspark.sql import functions as F

from tessera.operators import tokens as tk


def test_windows_fixture(spark):
    toks = spark.createDataFrame([(g, g + 1) for g in range(7)], "g long, id int")
    w = tk.strided_windows(toks, F.lit(7), 4, 2).orderBy("win_start").collect()
    got = [(r.win_start, r.input_ids, r.trg_len, r.target_ids) for r in w]
    assert got == [(0, [1, 2], 2, [1, 2]), (2, [1, 2, 3, 4], 2, [-100, -100, 3, 4]),
                   (4, [3, 4, 5, 6], 2, [-100, -100, 5, 6]), (6, [5, 6, 7], 1, [-100, -100, 7])]


def reference_windows(n, L, S):
    out = []
    for i in range(0, n, S):
        b, e = max(i + S - L, 0), min(i + S, n)
        ids = list(range(b, e))
        t = e - i
        out.append((i, b, e, t, ids, [-100] * (len(ids) - t) + ids[len(ids) - t:]))
    return out


def test_windows_random(spark):
    rnd = random.Random(3)
    for _ in range(4):
        n, L = rnd.randint(1, 40), rnd.randint(1, 9)
        S = rnd.randint(1, L)
        toks = spark.createDataFrame([(g, g) for g in range(n)], "g long, id int")
        got = [(r.win_start, r.begin_loc, r.end_loc, r.trg_len, r.input_ids, r.target_ids)
               for r in tk.strided_windows(toks, F.lit(n), L, S).orderBy("win_start").collect()]
        assert got == reference_windows(n, L, S)
        cuts = sorted(rnd.sample(range(1, n), min(n - 1, rnd.randint(0, 6)))) if n > 1 else []
        bounds = [0] + cuts + [n]
        rows = [(a, b - a, list(range(a, b))) for a, b in zip(bounds, bounds[1:])]
        st = spark.createDataFrame(rows, "start long, n long, ids array<int>")
        by_rows = [(r.win_start, r.begin_loc, r.end_loc, r.trg_len, r.input_ids, r.target_ids)
                   for r in tk.strided_windows_rows(st, F.lit(n), L, S).orderBy("win_start").collect()]
        assert by_rows == reference_windows(n, L, S)
        doc = spark.createDataFrame([(list(range(n)),)], "ids array<int>")
        per_doc = [(r.win_start, r.begin_loc, r.end_loc, r.trg_len, r.input_ids, r.target_ids)
                   for r in tk.document_windows(doc, "ids", L, S).orderBy("win_start").collect()]
        assert per_doc == reference_windows(n, L, S)


def reference_pack(ns, limit):
    packs, cur, tot = [], [], 0
    for n in ns:
        if cur and tot + n <= limit:
            cur.append(n)
            tot += n
        else:
            if cur:
                packs.append(cur)
            cur, tot = [n], n
    if cur:
        packs.append(cur)
    return packs


def test_packing_fixture_and_random(spark):
    assert reference_pack([3, 4, 2, 6, 1, 9], 7) == [[3, 4], [2], [6, 1], [9]]
    rnd = random.Random(11)
    rows = []
    for d in range(30):
        ns = [rnd.randint(1, 9) for _ in range(rnd.randint(1, 25))]
        rows.append((d, [" ".join(["w"] * n) for n in ns]))
    df = spark.createDataFrame(rows, "doc long, s array<string>")
    got = {}
    for r in tk.pack_sentences(df, "s", 12, keep=["doc"]).collect():
        got.setdefault(r.doc, []).append((r.pack, r.n_tokens, r.n_sentences))
    for d, sents in rows:
        want = reference_pack([len(x.split()) for x in sents], 12)
        assert [(i, sum(p), len(p)) for i, p in enumerate(want)] == sorted(got[d])


def reference_truncate(a, b, budget):
    a, b = list(a), list(b)
    while len(a) + len(b) > budget:
        if len(a) > len(b):
            a.pop()
        else:
            b.pop()
    return a, b


def test_truncate_pair_matches_one_at_a_time(spark):
    rnd = random.Random(2)
    rows = [(list(range(rnd.randint(0, 12))), list(range(100, 100 + rnd.randint(0, 12))), rnd.randint(1, 16))
            for _ in range(200)]
    df = spark.createDataFrame([(i, a, b, m) for i, (a, b, m) in enumerate(rows)],
                               "i int, a array<int>, b array<int>, m int")
    for budget in (1, 5, 8, 13):
        ta, tb = tk.truncate_pair("a", "b", budget)
        got = {r.i: (r.x, r.y) for r in df.select("i", ta.alias("x"), tb.alias("y")).collect()}
        for i, (a, b, _) in enumerate(rows):
            assert got[i] == reference_truncate(a, b, budget)


def test_pad_truncate_argmax(spark):
    df = spark.createDataFrame([([5, 6, 7],), ([9] * 6,)], "ids array<int>")
    ids, mask = tk.pad_truncate("ids", 4)
    out = df.select(ids.alias("i"), mask.alias("m")).collect()
    assert (out[0].i, out[0].m) == ([5, 6, 7, 3], [1, 1, 1, 0])
    assert (out[1].i, out[1].m) == ([9, 9, 9, 9], [1, 1, 1, 1])
    r = spark.createDataFrame([([0.1, 0.9, 0.9, 0.2],)], "a array<double>").select(tk.argmax("a").alias("k")).first()
    assert r.k == 1


def test_encode_decode_identity(spark):
    docs = spark.createDataFrame([(1, ["le", "chat", "noir"]), (2, ["le", "zèbre"]), (3, [])],
                                 "k long, tokens array<string>")
    voc = tk.build_vocab(docs.select(F.explode("tokens").alias("tok")), max_size=3)
    ids = {r.tok: r.id for r in voc.collect()}
    assert ids["</s>"] == 0 and ids["<mask>"] == 4 and ids["le"] == 5
    enc = tk.encode(docs, "k", voc)
    got = {r.k: r.input_ids for r in enc.collect()}
    assert got[1] == [5, ids["chat"], ids["noir"]] and got[3] == []
    dec = {r.k: r.text for r in tk.decode(enc, "k", voc).collect()}
    assert dec[1] == "le chat noir" and dec[3] == ""


def test_token_stream_offsets(spark):
    rows = [(d, p, ["t"] * ((d * 7 + p * 3) % 5)) for d in range(30) for p in range(4)]
    df = spark.createDataFrame(rows, "d long, p long, tokens array<string>")
    s = tk.token_stream(df, ["d", "p"], "tokens", blocks=5)
    got = {(r.d, r.p): r.start for r in s.collect()}
    off = 0
    for d, p, t in rows:
        if t:
            assert got[(d, p)] == off
        off += len(t)


def test_lookup_by_blocks_is_the_broadcast_lookup(spark):
    """A vocabulary over the bound: blocks ask for their distinct tokens; no token is a row of a shuffle."""
    rows = [(k, t, [f"w{(k * 7 + i * i) % 23}" for i in range((k * 5 + t) % 9)], f"x{k}") for k in range(40) for t in range(2)]
    rows += [(99, 0, [], None), (99, 1, None, "y"), (None, 2, ["w1", "new"], "z")]
    df = spark.createDataFrame(rows, "k long, t long, tokens array<string>, other string")
    voc = spark.createDataFrame([(0, "</s>"), (2, "<unk>"), *((5 + i, f"w{i}") for i in range(0, 23, 2))], "id int, tok string")
    order = lambda x: sorted(x.collect(), key=str)
    small, large = (tk.encode(df, ["k", "t"], voc, broadcast_rows=n) for n in (1000, 0))
    assert order(small.select("k", "t", "other", "input_ids")) == order(large.select("k", "t", "other", "input_ids"))
    assert small.columns == large.columns and {r.k: r.input_ids for r in large.where("t = 2").collect()} == {None: [2, 2]}
    assert order(tk.decode(small, ["k", "t"], voc, broadcast_rows=1000)) == order(tk.decode(large, ["k", "t"], voc, broadcast_rows=0))
    assert tk.encode(df.limit(0), ["k", "t"], voc, broadcast_rows=0).count() == 0
    for enc in (small, large):
        plan = enc._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(tok#" not in plan
