"""Index and article parsing against FIXTURES 1 and 2."""

import re
import unicodedata

from tessera.constants import ENTRY_PATTERN, SECTION_PATTERN
from tessera.operators import html as H
from tessera.plans.index_fixture import render_index_pages

INDEX = ('<span class="mw-headline" id="a">2004</span>\n'
         '<li>1 mai : <a class="x" href="/wiki/A" title="Aé">A</a></li>\n'
         '<li>2 mai : <a href="/wiki/B" title="B">B</a></li>\n'
         '<span class="mw-headline" id="b">2005</span><li>3 juin : <a href="/wiki/C" title="C">C</a></li>')
EDGE = ('x<li>1 y <span class="a" id="x">2004</span> <a href="/wiki/Aé" title="A">A</a>\n'
        '<li>2 <a href="/wiki/B" title="B">')


def python_parse(body):
    """Re-statement of the reference's nested loop (with D1 as None)."""
    dates = [(m.start(0), int(m.group(1))) for m in re.finditer(SECTION_PATTERN, body)]
    arts = [(m.start(0), m.group(1), m.group(2)) for m in re.finditer(ENTRY_PATTERN, body)]
    out = []
    for idx, ref, title in arts:
        prior = [d for (o, d) in dates if idx > o]
        out.append((idx, ref, title, prior[-1] if prior else None))
    return out


def test_index_page(spark):
    pages = spark.createDataFrame([(1, INDEX)], "page_id long, html string")
    got = [(r.ref, r.title, r.date) for r in H.parse_index(pages).orderBy("ord").collect()]
    assert got == [("A", "Aé", 2004), ("B", "B", 2004), ("C", "C", 2005)]


def test_edge_page_offsets_and_quarantine(spark):
    pages = spark.createDataFrame([(7, EDGE)], "page_id long, html string")
    anchors = H.index_anchors(pages).orderBy("kind", "start").collect()
    assert [(a.kind, a.start) for a in anchors] == [(0, 9), (1, 1), (1, 79)]
    arts = H.parse_index(pages).orderBy("ord").collect()
    assert [(a.ord, a.ref, a.date) for a in arts] == [(1, "Aé", None), (79, "B", 2004)]
    assert H.quarantine(H.parse_index(pages)).count() == 1
    assert [(o, r, d) for o, r, _, d in python_parse(EDGE)] == [(1, "Aé", None), (79, "B", 2004)]


def test_offsets_match_python_on_random_pages(spark):
    import random
    rnd = random.Random(5)
    bodies = []
    for p in range(20):
        parts = []
        for _ in range(rnd.randint(0, 12)):
            if rnd.random() < 0.3:
                parts.append(f'<span class="h" id="s{rnd.randint(0, 9)}">{rnd.randint(1990, 2020)}</span>')
            else:
                parts.append(f'<li>{rnd.randint(1, 99)} é <a x href="/wiki/R{rnd.randint(0, 999)}" '
                             f'title="T{rnd.randint(0, 9)}">z</a></li>')
            parts.append(rnd.choice(["\n", " ", "", "\nblah "]))
        bodies.append((p, "".join(parts)))
    pages = spark.createDataFrame(bodies, "page_id long, html string")
    got = {(r.page_id, r.ord, r.ref, r.title, r.date) for r in H.parse_index(pages).collect()}
    want = {(p, o, r, t, d) for p, b in bodies for (o, r, t, d) in python_parse(b)}
    assert got == want


PAYLOAD = ("<api><query><pages><page><extract>&lt;p&gt;Un &lt;b&gt;mot&lt;/b&gt;.&lt;/p&gt;"
           "&lt;p&gt; Deux &lt;/p&gt;</extract></page></pages></query></api>")


def test_article_payload(spark):
    rows = [("a", PAYLOAD), ("b", "<api><query/></api>"), ("c", "<api><extract>rien</extract></api>")]
    df = spark.createDataFrame(rows, "ref string, payload string")
    out = {r.ref: (r.content, r.ok) for r in H.parse_article(df, "ref", "payload", tag="extract").collect()}
    assert out["a"] == (["Un mot.", "Deux"], True)
    assert out["b"] == (None, False)
    assert out["c"] == ([], True)


def test_render_then_parse_roundtrip(spark):
    items = spark.createDataFrame(
        [(1, 2001, 10, "R10", "T ten"), (1, 2001, 11, "R11", "T11"), (1, 2003, 5, "R5", "T5"),
         (2, 1999, 1, "R1", "T1")], "p long, y int, k long, r string, t string")
    pages = render_index_pages(items, "p", "y", "r", "t", "k")
    got = {(r.page_id, r.ref, r.title, r.date) for r in H.parse_index(pages).collect()}
    assert got == {(1, "R10", "T ten", 2001), (1, "R11", "T11", 2001), (1, "R5", "T5", 2003),
                   (2, "R1", "T1", 1999)}


def test_script_is_dropped_before_paragraphs(spark):
    html = '<script>var t="</p>";</script><article><p>a &amp; b</p><p>c</p></article>'
    r = H.parse_article(spark.createDataFrame([(1, html)], "id long, h string"), "id", "h").first()
    assert r.content == ["a & b", "c"] and r.ok


def test_match_offsets_single_pattern(spark):
    body = "ab <li>1 x <li>22 y\n<li>3"
    pages = spark.createDataFrame([(1, body)], "page_id long, html string")
    got = [(r.start, r.n) for r in H.match_offsets(pages, "page_id", "html", r"<li>(\d+)", {"n": 1})
           .orderBy("start").collect()]
    assert got == [(m.start(0), m.group(1)) for m in re.finditer(r"<li>(\d+)", body)]


def test_numeric_character_references(spark):
    from tessera.functions.udfs import decode_char_refs
    r = spark.createDataFrame([("caf&#233; &#xE9;t&#233; &amp;#233;",)], "s string").select(
        decode_char_refs("s").alias("o")).first()
    assert r.o == "café été &#233;"


def test_article_with_references_and_a_sentinel(spark):
    page = "<article><p>caf&#233; &#38;lt; x</p></article>"
    r = H.parse_article(spark.createDataFrame([(1, page)], "page_id long, html string"), "page_id", "html").first()
    assert r.content == [unicodedata.normalize("NFKD", "caf\xe9 &lt; x")] and r.ok
    body = "\x01<li>1 \x01x<li>22 y\x01"
    pages = spark.createDataFrame([(1, body)], "page_id long, html string")
    got = [(r.start, r.n) for r in H.match_offsets(pages, "page_id", "html", r"<li>(\d+)", {"n": 1}).orderBy("start").collect()]
    assert got == [(m.start(0), m.group(1)) for m in re.finditer(r"<li>(\d+)", body)]


def test_years_carry_over_blocks_and_inside_the_row(spark):
    """J1 two ways, on a page with many sections and entries and with years that do not parse."""
    import random

    rng = random.Random(3)
    html, want, at, year = [], [], 0, None
    for i in range(700):
        if rng.random() < 0.3:
            y = rng.choice(["2001", "1999", "junk"])
            html.append(f"[{y}]")
            year = int(y) if y != "junk" else year
        else:
            html.append(f"{{r{i}|t{i}}}")
            want.append((at, f"r{i}", f"t{i}", year))
        at += len(html[-1])
    patterns = {"section_pattern": r"\[(.*?)\]", "entry_pattern": r"\{(.*?)\|(.*?)\}"}
    pages = spark.createDataFrame([(1, "".join(html)), (2, "{a|b}[2000]"), (3, ""), (4, None)], "page_id long, html string")
    rows = H.parse_index(pages, **patterns)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    anchors = H.index_anchors(pages, **patterns)
    for df in (rows, H.asof_section(anchors), H.asof_section(anchors, block=50)):
        got = sorted(((r.page_id, r.ord, r.ref, r.title, r.date) for r in df.collect()))
        assert got == [(1, *w) for w in want] + [(2, 0, "a", "b", None)]
