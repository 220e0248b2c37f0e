"""What the boosted trees add to the fixed patterns, on planted texts with known truth."""

import random

import pytest
from tessera.llm import pii


def planted(seed, plain=300, loose=40):
    """[(doc_id, text, start, end, kind)] with kind None where the number is no personal data."""
    rng = random.Random(seed)
    words = "the old house by sea was sold to a man who came from north with his dog and two cats in autumn".split()
    out = []

    def add(before, span, kind, n):
        for _ in range(n):
            s = span()
            head = " ".join(rng.choices(words, k=rng.randint(2, 9))) + f" {before()} "
            out.append((len(out), head + s + " " + " ".join(rng.choices(words, k=5)), len(head), len(head) + len(s), kind))

    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    pick = lambda *xs: lambda: rng.choice(xs)
    add(pick("mail", "contact", "write to"), lambda: f"user{d(2)}@example{d(1)}.org", "base", plain)
    add(pick("phone", "call", "tel"), lambda: f"+1 (487) 555-{d(4)}", "base", plain)
    add(pick("host", "server"), lambda: f"10.{rng.randint(0, 255)}.0.{rng.randint(0, 255)}", "base", plain // 3)
    add(pick("mail", "contact"), lambda: f"user{d(2)} (at) example{d(1)} (dot) org", "email", loose)
    add(pick("phone", "call"), lambda: f"(487) 555-{d(4)}", "phone", loose)
    add(pick("host", "server"), lambda: ":".join(f"{rng.randint(4096, 65535):x}" for _ in range(8)), "ip", loose)
    add(pick("order", "invoice", "ref"), lambda: f"555-{d(3)}-{d(4)}", None, loose)
    add(pick("sold", "about"), lambda: f"{d(3)} {d(4)} {d(3)}", None, loose)
    add(pick("total", "serial"), lambda: f"{d(4)}-{d(4)}-{d(4)}-{d(4)}", None, loose)
    add(pick("at", "until"), lambda: f"{rng.randint(10, 23)}:{d(2)}:{d(2)}:{d(2)}", None, loose)
    return out


def added(spark, rows, **settings):
    df = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id long, text string")
    got = {}
    for r in pii.scan(df, **settings).collect():
        base = {(s.kind, s.start, s.end) for s in r.base}
        got[r.doc_id] = {(s.kind, s.start, s.end) for s in r.spans} - base
        assert base <= {(s.kind, s.start, s.end) for s in r.spans}
    return got


@pytest.mark.parametrize("plain", [300, 20])
def test_loosened_spans_beside_their_cues_are_added(spark, plain):
    rows = planted(plain, plain)
    got = added(spark, rows)
    hits = {k: 0 for k in ("email", "phone", "ip")}
    wrong = 0
    for i, _, start, end, kind in rows:
        right = {(kind, start, end)} if kind in hits else set()
        if kind in hits:
            hits[kind] += right <= got[i]
        wrong += len(got[i] - right)
    total = sum(hits.values())
    assert all(n >= 0.9 * 40 for n in hits.values()), hits
    assert total / (total + wrong) >= 0.95, (total, wrong)


def test_order_numbers_are_left_alone_however_many_base_spans(spark):
    rows = planted(5, 2000)
    got = added(spark, rows)
    assert not any(got[i] for i, *_, kind in rows if kind is None)


def test_without_cues_nothing_is_added(spark):
    rows = [(i, f"word {i} 555-123-{4000 + i} word", 0, 0, None) for i in range(60)] + [(100 + i, f"mail a{i}@b.org", 0, 0, "base") for i in range(60)]
    assert not any(added(spark, rows).values())


def test_empty_and_long(spark):
    df = spark.createDataFrame([(1, "x" * 2_000_000 + " mail a@b.org"), (2, None), (3, "")], "doc_id long, text string")
    got = {r.doc_id: len(r.spans) for r in pii.scan(df).collect()}
    assert got == {1: 1, 2: 0, 3: 0} and pii.scan(df.limit(0)).count() == 0
