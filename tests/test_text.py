"""Golden strings for the text functions (FIXTURES 3, T5, T11, T13, T19-T21, S13, S15)."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions.udfs import clean_text_py, decode_refs_py, strip_paired_tags, strip_paired_tags_py

# FIXTURES 3: input, exact result, repeated-replacement result
TAGS = [
    ("<p>a <b>b <i>c</i></b></p>", "a b c", "a b c"),
    ("a<br/>b", "a<br/>b", "a<br/>b"),
    ('<p class="x">t</p>', "t", "t"),
    ("<b>x</i>", "<b>x</i>", "<b>x</i>"),
    ("<a>1</a><a>2</a>", "12", "12"),
    ("<p><p>n</p></p>", "<p>n</p>", "n"),
    ("<x><y>q</x></y>", "<y>q</y>", "q"),
    ("<<b>c</b>d</<b>", "c</b>d", "c</b>d"),
    ("no", "no", "no"),
    ("<b>l1\nl2</b>", "<b>l1\nl2</b>", "<b>l1\nl2</b>"),
]


@pytest.mark.parametrize("src,exact,_native", TAGS)
def test_strip_paired_tags_python(src, exact, _native):
    assert strip_paired_tags_py(src) == exact


def test_strip_paired_tags_spark(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _, _) in enumerate(TAGS)], "i int, s string")
    out = df.select("i", strip_paired_tags("s").alias("exact")).orderBy("i").collect()
    for r, (_, exact, _native) in zip(out, TAGS):
        assert r.exact == exact


def recursive_tags(text):
    """The paired-tag contract as the recursion that defines it."""
    return re.sub(r"<(.*?)(?: .*?)?>(.*?)</(\1)>", lambda m: recursive_tags(m.group(2)), text)


@pytest.mark.parametrize("pieces", ["</> ab", "<</>>a \n", ["<a>", "</a>", "<b x>", "</b>", " ", "t", "<", ">", "\n", "</", "<a b>"]])
def test_strip_paired_tags_equals_the_recursion(pieces):
    rng = random.Random(7)
    for _ in range(20000):
        s = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert strip_paired_tags_py(s) == recursive_tags(s), s


def test_strip_paired_tags_deep_and_long():
    n = 10000
    begin = time.perf_counter()
    named = [f"t{i}" for i in range(n)]
    assert strip_paired_tags_py("".join(f"<{t}>" for t in named) + "x" + "".join(f"</{t}>" for t in reversed(named))) == "x"
    assert strip_paired_tags_py("<a>" * n + "</a>" * n) == "<a>" * (n - 1) + "</a>" * (n - 1)
    for s in ("<" * 100_000, "< " * 50_000 + ">", "a < b > c " * 10_000, "a < b > c </x>" * 7_000):
        assert strip_paired_tags_py(s) == s
    assert time.perf_counter() - begin < 5


def test_references_are_decoded_once():
    assert decode_refs_py("caf&#233; &#xE9; &#38;lt; &amp;#233; &#0; &#xD800; &lt;b&gt; &nbsp;") == "caf\xe9 \xe9 &lt; &#233; &#0; &#xD800; <b> &nbsp;"


def test_clean_text_nfkd_then_tags():
    assert clean_text_py("<b>é</b>") == "é"


def test_unescape_tags_map_order(spark):
    r = spark.createDataFrame([("&lt;p&gt;x&lt;/p&gt; &amp;gt;",)], "s string").select(
        T.unescape_tags("s").alias("o")).first()
    assert r.o == "<p>x</p> &amp;gt;"


def test_decode_entities_amp_last(spark):
    r = spark.createDataFrame([("&amp;lt; &quot;a&quot; &lt;",)], "s string").select(
        T.decode_entities("s").alias("o")).first()
    assert r.o == '&lt; "a" <'


def test_strip_and_rstrip_unicode(spark):
    s = "　\t a b  \n"
    r = spark.createDataFrame([(s,)], "s string").select(
        T.strip_ws("s").alias("a"), T.rtrim_ws("s").alias("b")).first()
    assert r.a == s.strip()
    assert r.b == s.rstrip()


def test_strip_chars_repeats(spark):
    r = spark.createDataFrame([('""ab"',)], "s string").select(T.strip_chars("s", '"').alias("o")).first()
    assert r.o == "ab"


def test_sentences_and_truncate(spark):
    r = spark.createDataFrame([("Un. Deux ? Trois\n\nquatre, cinq",)], "s string").select(
        T.split_sentences("s").alias("s"), T.truncate_at_punct(F.lit("quatre, cinq")).alias("t")).first()
    assert r.s == ["Un.", "Deux ?", "Trois", "quatre, cinq"]
    assert r.t == "quatre,"


def test_tokenize_covers_every_non_space(spark):
    r = spark.createDataFrame([("l'été 2004, x+y=3…",)], "s string").select(
        T.tokenize("s").alias("t")).first()
    assert r.t == ["l", "'", "été", "2004", ",", "x", "+", "y", "=", "3", "…"]


def test_normalize_split_and_task_codes(spark):
    rows = [("/d/valid_0.tsv/part-0.csv",), ("test_0.xlm.tsv",), ("/x/train_0",), ("other.tsv",)]
    out = [r.s for r in spark.createDataFrame(rows, "p string").select(
        T.normalize_split("p").alias("s")).collect()]
    assert out == ["dev", "test", "train", None]
    t, sub = T.split_task_code(F.lit("CLS-Books"))
    t2, sub2 = T.split_task_code(F.lit("XNLI"))
    r = spark.range(1).select(t.alias("a"), sub.alias("b"), t2.alias("c"), sub2.alias("d")).first()
    assert (r.a, r.b, r.c, r.d) == ("cls", "Books", "xnli", None)


def test_run_key(spark):
    r = spark.range(1).select(T.run_key(F.lit(3), F.lit(5e-6), F.lit(16)).alias("k")).first()
    assert r.k == "3_5.0e-06_16"


def test_paired_tags_in_the_jvm(spark):
    """The fold of built-in expressions gives the recursive pattern's result on random markup."""
    from tessera.functions.text import paired_tags

    rng = random.Random(11)
    parts = ["<a>", "</a>", "<b c>", "</b>", "<", ">", "</", " ", "x", "\n", "<a b>", "</a b>", "<>", "</>", "$1", "\\", "é", "\r", "\u2028"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 18)))) for i in range(1500)]
    rows += [(5000, None), (5001, "<a>" * 40 + "x" + "</a>" * 40), (5002, "<a>" * 9 + "</a>" * 3)]
    df = spark.createDataFrame(rows, "i long, s string").select("i", paired_tags("s").alias("t"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    got = {r.i: r.t for r in df.collect()}
    assert got == {i: None if s is None else recursive_tags(s) for i, s in rows}
    assert "Python" not in plan and "Arrow" not in plan


def test_paired_tags_oracle_is_the_recursion():
    """The work list in SQL that stands against the fold gives the recursive pattern's result, too."""
    import duckdb
    import pandas as pd

    from tessera.plans.corpus import sql_paired_tags

    rng = random.Random(12)
    parts = ["<a>", "</a>", "<b c>", "</b>", "<", ">", "</", " ", "x", "\n", "<a b>", "</a b>", "<>", "</>", "é"]
    src = pd.DataFrame([(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))) for i in range(1200)], columns=["i", "s"])
    got = duckdb.sql(f"WITH RECURSIVE {sql_paired_tags('src', 'i', 's')} SELECT i, text FROM tagged").fetchall()
    assert dict(got) == {i: recursive_tags(s) for i, s in src.itertuples(index=False)}
