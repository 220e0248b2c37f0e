"""One document of each near-duplicate group stays, whatever the ids."""

import random

import brute
import pytest
from tessera.llm import simhash

FIELDS = "doc_id long, text string, lang string, fp string, key string, root string"


def kept(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def groups(rows):
    """Components of fingerprints by pairs; {fingerprint: root}."""
    fps = sorted({int(brute.simhash(t), 16) for _, t in rows})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(fps):
        for y in fps[:i]:
            if (x ^ y).bit_count() <= 2:
                root[find(x)] = find(y)
    return {f: find(f) for f in fps}


def check(rows, out):
    root = groups(rows)
    of = lambda t: root[int(brute.simhash(t), 16)]
    assert len({of(t) for _, t in out}) == len(out) == len({of(t) for _, t in rows})  # one of each
    for d, t in out:
        ids = [i for i, x in rows if of(x) == of(t) and i is not None]
        assert (d, t) in rows and d == min(ids, default=None)


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "x", "y", "z") for d, t in rows], FIELDS)


def test_one_id_with_other_texts(spark):
    a, b, c = "the first text of all", "a second text that differs", "and a third one altogether"
    rows = [(3, a), (5, a), (5, b), (7, c)]
    out = simhash.deduplicate(frame(spark, rows))
    assert out.columns == FIELDS.replace(" long", "").replace(" string", "").split(", ")
    assert kept(out) == [(3, a), (5, b), (7, c)]


def test_two_groups_with_the_same_least_id(spark):
    rows = [(3, "one text here now"), (3, "quite another text there"), (4, "one text here now"), (4, "quite another text there")]
    assert kept(simhash.deduplicate(frame(spark, rows))) == [(3, "one text here now"), (3, "quite another text there")]


@pytest.mark.parametrize("seed", range(3))
def test_random_tables_with_repeated_ids(spark, seed):
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(60)]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 40))) for _ in range(12)] + ["", " ", None]
    texts += [t + " end" for t in texts[:4]]
    rows = [(rng.choice([None, *range(8)]), rng.choice(texts)) for _ in range(80)]
    rows += rows[:5]
    check(rows, kept(simhash.deduplicate(frame(spark, rows))))


def test_pipeline_stage(spark, sf):
    import corpus_pipeline

    rows = [(3, "a b c d"), (5, "a b c d"), (5, "e f g h i"), (None, "e f g h i"), (None, "x")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_duplicates(spark, docs, sf)
    assert out.columns == docs.columns and kept(out) == [(3, "a b c d"), (5, "e f g h i"), (None, "x")]
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), sf).count() == 0
