"""Cross-tokenizer alignment against plain loops over bytes."""

import random
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from tessera.llm import align
from tessera.llm.queries import QUERIES


@pytest.fixture(scope="module")
def tools():
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def byte_of():
    """Byte-level decoding: printable characters stand for themselves, the others for 256 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in keep)}


def plain(text, tools, back):
    """(A ids, B ids, groups, links) of one text."""
    if not text:
        return None
    a, b = tools
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    by_a = [bytes(back[c] for c in a.id_to_token(i)) for i in ids_a]
    by_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
    data = (" " + text).encode()
    if b"".join(by_a) != data or b"".join(by_b) != data:
        return None
    def spans(parts):
        at, out = 0, []
        for p in parts:
            out.append((at, at + len(p)))
            at += len(p)
        return out
    sa, sb = spans(by_a), spans(by_b)
    cuts = sorted({e for _, e in sa} & {e for _, e in sb})
    groups, links, i, j = [], [], 0, 0
    for c in cuts:
        ga, gb = [], []
        while i < len(sa) and sa[i][1] <= c:
            ga.append(i)
            i += 1
        while j < len(sb) and sb[j][1] <= c:
            gb.append(j)
            j += 1
        groups.append(",".join(str(ids_a[x]) for x in ga) + "|" + ",".join(str(ids_b[x]) for x in gb))
        links += [(ids_a[x], ids_b[y]) for x in ga for y in gb if max(sa[x][0], sb[y][0]) < min(sa[x][1], sb[y][1])]
    return ids_a, ids_b, groups, links


def expected(docs, tools):
    back, made = byte_of(), []
    known = {}
    for d, t in docs:
        if t not in known:
            known[t] = plain(t, tools, back)
        made.append((d, known[t]))
    n = Counter(p for _, x in made if x for p in set(x[3]))
    best = defaultdict(int)
    for (a, _), c in n.items():
        best[a] = max(best[a], c)
    return sorted(((d, 0, 0, 0, 0, 0, 0, "") if x is None else
                   (d, len(x[0]), len(x[1]), len(x[2]), len(x[3]), sum(n[p] == best[p[0]] for p in x[3]), sum(n[p] for p in x[3]),
                    brute.sha(";".join(x[2]))) for d, x in made), key=str)


def got(df):
    return sorted((tuple(r[c] for c in align.OUT) for r in df.collect()), key=str)


def test_whole_table(spark, sf, tools):
    docs = [(r["doc_id"], r["text"]) for r in brute.rows(sf, "documents")]
    assert got(QUERIES["op12_align"](spark, sf)) == expected(docs, tools)


@pytest.mark.parametrize("most", [0, 1 << 25])
def test_odd_rows_by_broadcast_and_by_join(spark, odd_docs, tools, most):
    more = spark.createDataFrame([(20, "aaaaa aa aaa <s> </s> <unk> <|endoftext|> <0x41>"), (21, "▁ a"), (22, "  two  spaces \n\n\ttab"),
                                  (23, "\x00 nul"), (24, " ﬁ Ａ é \U0001f468‍\U0001f469"), (25, " "), (26, "x" * 70_000),
                                  (2**60 + 1, "far id")], "doc_id long, text string")
    docs = odd_docs.unionByName(more, allowMissingColumns=True)
    assert got(align.alignments(docs, most=most)) == expected([(r.doc_id, r.text) for r in docs.collect()], tools)


def test_empty_table(spark, odd_docs):
    for most in (0, 1 << 25):
        assert align.alignments(odd_docs.limit(0), most=most).count() == 0


def test_pair_of_same_bytes_inside_an_irregular_group():
    """The map's pair may be linked off its place, too: it counts in the vector all the same."""
    pair = align.tokenizers()
    one, two = pair.bytes_a.index(b"a"), pair.bytes_a.index(b"aa")
    b_one, b_two = int(pair.same[one]), int(pair.same[two])
    x = align.align(np.array([two, one]), np.array([b_one, b_two]), np.array([2]), np.array([2]), pair)
    assert list(zip(x.a, x.b)) == [(two, b_one), (two, b_two), (one, b_two)] and x.n_groups.tolist() == [1] and x.n_links.tolist() == [3]


def test_ids_are_those_of_the_file(tools):
    pair = align.tokenizers()
    for text in ("Étion dans, çouelle  ", "<|endoftext|> 12\n\n x", "naïve \U0001f600"):
        assert np.frombuffer(align.encode([text], pair)[0][0], "<u2").tolist() == tools[0].encode(" " + text, add_special_tokens=False).ids


def test_word_by_word_is_the_whole_text(tools):
    """Spaces, other blanks and marks in any order: remembered words give the ids of the whole text."""
    pair, rng = align.tokenizers(), random.Random(6)
    assert pair.by_word
    parts = [" ", " ", " ", "\n", "\t", "\u00a0", "\u2003", "\r", "a", "Word", "don't", "'s", "12", "é", "!?", "-", "\U0001f600", "the"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(4000)]
    for text, (x, y), whole in zip(texts, align.encode(texts, pair), align._whole(texts, pair)):
        assert (x, y) == whole
        assert np.frombuffer(x, "<u2").tolist() == tools[0].encode(" " + text, add_special_tokens=False).ids
        assert np.frombuffer(y, "<u2").tolist() == tools[1].encode(text)
