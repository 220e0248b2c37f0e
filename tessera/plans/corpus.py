"""Corpus-building queries.

Index pages are rendered from ``orders`` (FIXTURES 1, at scale): every order is
an article ``Commande_<key>`` listed under its order year, once on a "base"
page (``o_orderkey div 256``) and once on a "yearly" page
(``(year - 1900) * 1e13 + o_orderkey div 1024``) - the reference parses the base and
the yearly pages alike, so articles repeat (D4, U1).  Pages have a bounded
number of entries by construction of their key.  Article payloads are the
driver's ``pages`` (``<article>`` with ``<p>``), and a page ``n`` holds the
content of article ``Commande_<n>``.
"""

from __future__ import annotations

import unicodedata
import uuid

from pyspark.sql import functions as F

from ..constants import N_TEST, N_VALID
from ..functions import text as T
from ..functions.udfs import clean_udf
from ..operators import corpus as C
from ..operators import html as H
from ..operators.splits import sample_n, shuffle, split_fixed
from ..session import cut_lineage, scratch_path
from ..sources import archives, files
from ..sources.tables import load
from .index_fixture import render_index_pages
from .registry import query

#: Buckets of tables that are joined by ref; at scale, about the table's bytes / 128 MB.
BUCKETS = 8

# ------------------------------------------------------------- SQL helpers

def _nfkd_pairs():
    """NFKD of the Latin-1 letters, generated by rule from unicodedata."""
    out = []
    for cp in range(0xC0, 0x100):
        ch = chr(cp)
        d = unicodedata.normalize("NFKD", ch)
        if d != ch:
            out.append((ch, d))
    return out


def sql_nfkd(expr: str) -> str:
    for ch, d in _nfkd_pairs():
        parts = " || ".join(f"chr({ord(c)})" for c in d)
        expr = f"replace({expr}, chr({ord(ch)}), {parts})"
    return expr


def sql_decode(expr: str) -> str:
    for a, b in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "''"), ("&amp;", "&")]:
        expr = f"replace({expr}, '{a}', '{b}')"
    return expr


def sql_strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^\\s+|\\s+$', '', 'g')"


SQL_ORDERS = """
o AS (SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y,
             'Commande_' || o_orderkey AS ref,
             'Commande n°' || o_orderkey || ' – ' || o_orderpriority AS title FROM orders),
e AS (SELECT o_orderkey // 256 AS page_id, y, o_orderkey AS k, ref, title FROM o
      UNION ALL
      SELECT (CAST(y AS BIGINT) - 1900) * 10000000000000 + o_orderkey // 1024, y, o_orderkey, ref, title FROM o)"""

SQL_LINES = SQL_ORDERS + """,
l AS (SELECT page_id, y, k, ref, title, row_number() OVER w AS n,
             CASE WHEN lag(y) OVER w IS NULL OR lag(y) OVER w <> y
                  THEN '<h2><span class="mw-headline" id="y' || y || '">' || y || '</span></h2>' || chr(10)
                  ELSE '' END AS hdr
      FROM e WINDOW w AS (PARTITION BY page_id ORDER BY y, k)),
l2 AS (SELECT *, hdr || '<li>' || n || ' : <a class="x" href="/wiki/' || ref || '" title="'
                  || title || '">' || ref || '</a></li>' AS el FROM l),
l3 AS (SELECT *, 5 + coalesce(sum(length(el) + 1) OVER (PARTITION BY page_id ORDER BY y, k
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line_start FROM l2),
ia AS (SELECT page_id, CAST(line_start + length(hdr) AS BIGINT) AS ord, ref, title, y AS date FROM l3)"""

SQL_PAGES = f"""
pg AS (SELECT page_id, replace(replace(html, '&gt;', '>'), '&lt;', '<') AS h FROM pages),
ns AS (SELECT page_id, regexp_replace(regexp_replace(h, '(?is)<script\\b[^>]*>.*?</script\\s*>', '', 'g'),
                                      '(?is)<style\\b[^>]*>.*?</style\\s*>', '', 'g') AS h FROM pg),
bd AS (SELECT page_id, regexp_matches(h, '(?s)<article(?:\\s[^>]*)?>.*?</article\\s*>') AS ok,
              regexp_extract(h, '(?s)<article(?:\\s[^>]*)?>(.*?)</article\\s*>', 1) AS body FROM ns),
rp AS (SELECT page_id, ok, list_transform(regexp_extract_all(body, '(?s)<p(?:\\s[^>]*)?>(.*?)</p\\s*>', 1),
              lambda x: {sql_decode("regexp_replace(x, '<[^>]+>', '', 'g')")}) AS paras FROM bd),
ap AS (SELECT page_id, ok, CASE WHEN ok THEN list_transform(paras, lambda x: {sql_strip(sql_nfkd('x'))}) END
              AS content FROM rp)"""


# ------------------------------------------------------------- Spark helpers

def order_items(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("y"),
        F.concat(F.lit("Commande_"), F.col("o_orderkey")).alias("ref"),
        F.concat(F.lit("Commande n°"), F.col("o_orderkey"), F.lit(" – "), F.col("o_orderpriority"))
        .alias("title"))


def index_pages(spark, sf_dir):
    """Base pages and yearly pages, one bag of pages."""
    it = order_items(spark, sf_dir)
    base = it.withColumn("page", F.floor(F.col("o_orderkey") / 256).cast("long"))
    yearly = it.withColumn("page", ((F.col("y").cast("long") - 1900) * 10000000000000
                                    + F.floor(F.col("o_orderkey") / 1024)).cast("long"))
    return render_index_pages(C.union_pages([base, yearly]), "page", "y", "ref", "title", "o_orderkey")


def index_articles_df(spark, sf_dir):
    return H.parse_index(index_pages(spark, sf_dir))


def fetched(spark, sf_dir):
    """S9 + T15: the landed article payloads, parsed; failures kept as rows."""
    pages = load(spark, sf_dir, "pages").select(
        F.concat(F.lit("Commande_"), F.col("page_id")).alias("ref"), "page_id", "html")
    return H.parse_article(pages, "ref", "html", keep=["page_id"])


# ------------------------------------------------------------- index queries

@query("index_articles", f"WITH {SQL_LINES} SELECT page_id, ref, title, date FROM ia")
def index_articles(spark, sf_dir):
    """T4 (T1-T3 + J1) over the rendered index pages: every listed article
    with the year of its section."""
    return index_articles_df(spark, sf_dir).select("page_id", "ref", "title", "date")


@query("html_match_offsets", f"""WITH {SQL_LINES}
SELECT page_id, 1 AS kind, CAST(line_start + length(hdr) AS BIGINT) AS start, CAST(NULL AS INTEGER) AS year,
       ref, title FROM l3
UNION ALL
SELECT page_id, 0, CAST(line_start + 4 AS BIGINT), y, NULL, NULL FROM l3 WHERE hdr <> ''
""")
def html_match_offsets(spark, sf_dir):
    """Every section and entry anchor with its character offset (the
    oracle computes offsets from the rendered line lengths)."""
    return H.index_anchors(index_pages(spark, sf_dir))


@query("index_articles_ordered", f"WITH {SQL_LINES} SELECT page_id, ord, ref, date FROM ia")
def index_articles_ordered(spark, sf_dir):
    """The entry ordinal (offset) that keeps input order."""
    return index_articles_df(spark, sf_dir).select("page_id", "ord", "ref", "date")


@query("index_articles_years", f"""WITH {SQL_LINES}
SELECT page_id, ref, date FROM ia WHERE date >= 1994 AND date < 1998""")
def index_articles_years(spark, sf_dir):
    """Half-open year range [1994, 1998) (D3)."""
    return C.in_years(index_articles_df(spark, sf_dir), 1994, 1998).select("page_id", "ref", "date")


@query("index_articles_dedup", f"""WITH {SQL_LINES}
SELECT ref, arg_min(page_id, (page_id, ord)) AS page_id, arg_min(date, (page_id, ord)) AS date
FROM ia GROUP BY ref""")
def index_articles_dedup(spark, sf_dir):
    """U4: one row per ref, the first listing in (page, offset) order."""
    d = C.dedup_refs(index_articles_df(spark, sf_dir), ["page_id", "ord"])
    return d.select("ref", "page_id", "date")


@query("index_counts", f"""WITH {SQL_LINES}
SELECT page_id, count(*) AS n_articles, count(DISTINCT date) AS n_years FROM ia GROUP BY page_id""")
def index_counts(spark, sf_dir):
    """Listed articles per page."""
    return index_articles_df(spark, sf_dir).groupBy("page_id").agg(
        F.count(F.lit(1)).alias("n_articles"), F.count_distinct("date").alias("n_years"))


@query("index_urls", """
WITH b AS (SELECT min(year(o_orderdate)) AS y0, max(year(o_orderdate)) + 1 AS y1 FROM orders)
SELECT 0 AS ord, 'https://example.org/wiki/Index' AS url FROM b
UNION ALL
SELECT CAST(y - b.y0 + 1 AS INTEGER), 'https://example.org/wiki/Index/' || y
FROM b, range(b.y0, b.y1) t(y)""")
def index_urls(spark, sf_dir):
    """Base URL first, then one URL per year in [min, max) of the order
    years (the reference's year bounds are parameters; here they come from
    the data)."""
    years = load(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y"))
    return C.index_urls(years, "https://example.org/wiki/Index")


@query("page_intake_gaps", """
WITH b AS (SELECT min(year(o_orderdate)) AS y0, max(year(o_orderdate)) + 1 AS y1 FROM orders),
u AS (SELECT CAST(0 AS BIGINT) AS ord, 'https://example.org/wiki/Index' AS url FROM b
      UNION ALL SELECT CAST(y - b.y0 + 1 AS BIGINT), 'https://example.org/wiki/Index/' || y
      FROM b, range(b.y0, b.y1) t(y)
      UNION ALL SELECT min(page_id) + 10000, url FROM pages GROUP BY url)
SELECT ord, url, url IN (SELECT url FROM pages) AS landed FROM u""")
def page_intake_gaps(spark, sf_dir):
    """Which wanted URLs have a landed page: the index pages, which the
    driver's ``pages`` lack, and every page URL."""
    years = load(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y"))
    pages = load(spark, sf_dir, "pages")
    urls = C.index_urls(years, "https://example.org/wiki/Index").select(F.col("ord").cast("long").alias("ord"), "url")
    urls = urls.unionByName(pages.groupBy("url").agg((F.min("page_id") + 10000).alias("ord")))
    return C.intake_gaps(urls, pages)


LINK = '<li><a href="/(.*?)">(.*?)</a></li>'


@query("payload_files", "SELECT CAST(page_id AS VARCHAR) AS ref, html AS payload FROM pages")
def payload_files(spark, sf_dir):
    """Page payloads landed as one file each and read back whole."""
    p = load(spark, sf_dir, "pages").select("page_id", "html")
    path = files.write_payload_files(p, "page_id", "html", scratch_path(spark, "payloads"))
    found = files.read_payload_files(spark, path, name=files.payload_name("page_id"), nested=True)
    ref = F.url_decode("ref")  # names are URL-encoded keys
    return found.select(ref.alias("ref"), F.regexp_replace("payload", "\\n\\z", "").alias("payload"))  # the line end


def _members(spark, sf_dir):
    """Archive lines of the pages: each as fetched, and a second try of the pages of odd length that was cut off."""
    p = load(spark, sf_dir, "pages").select(F.concat(F.lit("Commande_"), F.col("page_id")).alias("ref"), "html")
    whole = p.select(archives.member(F.col("ref"), F.col("html")).alias("value"))
    cut = F.left("html", F.floor(F.length("html") / 2).cast("int"))
    torn = p.where(F.length("html") % 2 == 1).select(archives.member(F.col("ref"), cut, archives.checksum(F.col("html"))))
    return whole.unionByName(torn.toDF("value"))


SQL_ARCHIVES = """
SELECT 'Commande_' || page_id AS ref, html AS payload, TRUE AS ok, CAST(NULL AS VARCHAR) AS reason FROM pages
UNION ALL SELECT 'Commande_' || page_id, NULL, FALSE, 'checksum' FROM pages WHERE length(html) % 2 = 1"""


@query("archive_pages", SQL_ARCHIVES)
def archive_pages(spark, sf_dir):
    """S8 + S9: pages landed in archives and read back; members cut off on the way are rows with a reason."""
    path = archives.write_archives(_members(spark, sf_dir), scratch_path(spark, "archives"))
    return archives.read_archives(spark.read, path)


@query("stream_archives", SQL_ARCHIVES)
def stream_archives(spark, sf_dir):
    """S9 under Structured Streaming: archives read as they land, into a Parquet sink."""
    from ..streaming.corpus_stream import write_parquet_stream
    from ..streaming.keyed import finish
    path = archives.write_archives(_members(spark, sf_dir), scratch_path(spark, "archives"))
    out = scratch_path(spark, "stream_members")
    rows = archives.read_archives(spark.readStream.option("maxFilesPerTrigger", 64), path)
    finish(write_parquet_stream(rows, out, scratch_path(spark, "stream_members_ckpt")))
    return spark.read.schema(rows.schema).parquet(out)


@query("materialized", "SELECT doc_id, lang, n_chars FROM documents")
def materialized(spark, sf_dir):
    """A finished table is reused, so the second call gives the first
    call's rows whatever it is handed."""
    d = load(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    path = scratch_path(spark, "materialized")
    files.materialize(d, path)
    return files.materialize(d.where("false"), path)


@query("page_links", f"""
WITH m AS (SELECT page_id, regexp_extract_all(html, '{LINK}', 0) AS ms, regexp_extract_all(html, '{LINK}', 1) AS refs,
                  regexp_extract_all(html, '{LINK}', 2) AS titles, regexp_split_to_array(html, '{LINK}') AS parts FROM pages),
i AS (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM m)
SELECT page_id, CAST(list_sum(list_transform(parts[1:i], lambda x: length(x)))
                     + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS ord,
       refs[i] AS ref, titles[i] AS title FROM i""")
def page_links(spark, sf_dir):
    """T1 + T3 on the real pages: every navigation link with its offset, the
    entry pattern as a parameter."""
    return H.parse_index(load(spark, sf_dir, "pages"), entry_pattern=LINK).select("page_id", "ord", "ref", "title")


# ------------------------------------------------------------- article queries

@query("xml_unescape", "SELECT page_id, replace(replace(html, '&gt;', '>'), '&lt;', '<') AS html FROM pages")
def xml_unescape(spark, sf_dir):
    """T5 on the page payloads."""
    return load(spark, sf_dir, "pages").select("page_id", T.unescape_tags("html").alias("html"))


@query("page_article_body", f"WITH {SQL_PAGES} SELECT page_id, ok, body FROM bd")
def page_article_body(spark, sf_dir):
    """First ``<article>`` element (scripts and styles dropped first)."""
    body, ok = H.body_of(F.col("html"))
    return load(spark, sf_dir, "pages").select("page_id", ok.alias("ok"), body.alias("body"))


@query("page_paragraphs", f"""WITH {SQL_PAGES}
SELECT page_id, CAST(generate_subscripts(paras, 1) - 1 AS INTEGER) AS pos, unnest(paras) AS paragraph
FROM rp""")
def page_paragraphs(spark, sf_dir):
    """T7 + T8 + T8b: paragraph texts in document order."""
    body, _ = H.body_of(F.col("html"))
    p = load(spark, sf_dir, "pages").select("page_id", H.raw_paragraphs(body).alias("paras"))
    return (p.select("page_id", T.posexplode_nonempty("paras").alias("pos", "paragraph"))
            .where(F.col("pos").isNotNull()))


@query("page_entities", f"""WITH {SQL_PAGES.split(',rp AS')[0]}
SELECT page_id, CAST(coalesce(list_sum(list_transform(
          regexp_extract_all(body, '(?s)<p(?:\\s[^>]*)?>(.*?)</p\\s*>', 1),
          lambda x: length(regexp_replace(x, '<[^>]+>', '', 'g'))
                    - length({sql_decode("regexp_replace(x, '<[^>]+>', '', 'g')")}))), 0) AS BIGINT)
       AS chars_decoded
FROM bd""")
def page_entities(spark, sf_dir):
    """Characters removed by entity decoding in each page's paragraphs."""
    body, _ = H.body_of(F.col("html"))
    raw = F.transform(T.elements(body, "p"), lambda x: T.inner_text(x))
    diff = F.aggregate(F.transform(raw, lambda x: F.length(x) - F.length(T.decode_entities(x))),
                       F.lit(0).cast("long"), lambda a, b: a + b)
    return load(spark, sf_dir, "pages").select("page_id", diff.alias("chars_decoded"))


@query("article_parse", f"WITH {SQL_PAGES} SELECT page_id, ok, content FROM ap")
def article_parse(spark, sf_dir):
    """Payload -> cleaned paragraph list, with the failure flag."""
    return H.parse_article(load(spark, sf_dir, "pages"), "page_id", "html")


@query("stream_article_parse", f"WITH {SQL_PAGES} SELECT page_id, ok, content FROM ap")
def stream_article_parse(spark, sf_dir):
    """T15 under Structured Streaming: the pages are landed as files in the
    shared folder, parsed by a ``readStream`` query (available-now trigger,
    up to 64 files per micro-batch) into a Parquet sink, and the sink is read
    back."""
    from ..streaming.corpus_stream import article_stream, write_parquet_stream
    landed = scratch_path(spark, "landed_pages")
    load(spark, sf_dir, "pages").write.parquet(landed)
    out, ckpt = scratch_path(spark, "stream_articles"), scratch_path(spark, "stream_articles_ckpt")
    q = write_parquet_stream(article_stream(spark, landed, max_files_per_trigger=64), out, ckpt)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(out).select("page_id", "ok", "content")


@query("clean_paragraphs", f"""WITH {SQL_PAGES}
SELECT page_id, CAST(generate_subscripts(content, 1) - 1 AS INTEGER) AS pos, unnest(content) AS paragraph
FROM ap WHERE ok""")
def clean_paragraphs(spark, sf_dir):
    """NFKD -> paired-tag removal -> strip, per paragraph."""
    a = H.parse_article(load(spark, sf_dir, "pages"), "page_id", "html").where("ok")
    return (a.select("page_id", T.posexplode_nonempty("content").alias("pos", "paragraph"))
            .where(F.col("pos").isNotNull()))


@query("collect_paragraphs", f"WITH {SQL_PAGES} SELECT page_id, content FROM ap WHERE ok AND len(content) > 0")
def collect_paragraphs(spark, sf_dir):
    """Cleaned paragraph rows (one per paragraph, as a streaming or
    per-row stage would leave them) collected back in document order."""
    rows = clean_paragraphs(spark, sf_dir)
    return C.collect_paragraphs(rows, "page_id", "pos", "paragraph")


@query("nfkd_text", f"SELECT doc_id, {sql_nfkd('text')} AS text FROM documents")
def nfkd_text(spark, sf_dir):
    """T10 on whole documents (Arrow-batched pandas UDF)."""
    from ..functions.udfs import nfkd
    return load(spark, sf_dir, "documents").select("doc_id", nfkd("text").alias("text"))


@query("strip_ws", f"SELECT conv_id, turn, {sql_strip('text')} AS text FROM conversations")
def strip_ws(spark, sf_dir):
    """Unicode white space stripped at both ends."""
    return load(spark, sf_dir, "conversations").select("conv_id", "turn", T.strip_ws("text").alias("text"))


def _tagged_paragraphs(spark, sf_dir):
    body, _ = H.body_of(F.col("html"))
    p = load(spark, sf_dir, "pages").select("page_id", T.elements(body, "p").alias("paras"))
    return (p.select("page_id", T.posexplode_nonempty("paras").alias("pos", "raw"))
            .where(F.col("pos").isNotNull()))


def sql_paired_tags(source: str, keys: str, expr: str) -> str:
    """CTEs up to ``tagged`` (keys, text): T9 by a recursive work list.  A piece of a line with a match becomes what
    is before it, its inner text and what is after it; the latter two are searched again.  A match begins at the
    leftmost ``<`` after which a name, a prefix up to a space or the next ``>``, has a closing tag, the shortest first."""
    rest, head = "array_to_string(ps[k + 1:], '<')", "split_part(array_to_string(ps[k + 1:], '<'), '>', 1)"
    names = f"list_transform(range(1, len(string_split({head}, ' ')) + 1), lambda w: array_to_string(string_split({head}, ' ')[1:w], ' '))"
    match = f"""list_filter(list_transform(range(1, len(ps)), lambda k: {{'k': k, 'n': list_filter({names},
        lambda n: contains({rest}[length({head}) + 2:], '</' || n || '>'))[1]}}), lambda x: x.n IS NOT NULL)[1]"""
    found = f"CASE WHEN contains(seg, '</') THEN {match} END AS m"
    return f"""
lines AS (SELECT {keys}, unnest(string_split({expr}, chr(10))) AS seg,
                 generate_subscripts(string_split({expr}, chr(10)), 1) AS line FROM {source}),
work AS (SELECT {keys}, line, '' AS path, seg, ps, {found} FROM (SELECT *, string_split(seg, '<') AS ps FROM lines)
         UNION ALL
         SELECT {keys}, line, path, seg, ps, {found} FROM (SELECT *, string_split(seg, '<') AS ps FROM (
           SELECT {keys}, line, path || c AS path,
                  CASE c WHEN '1' THEN before WHEN '2' THEN tail[1:strpos(tail, close) - 1]
                         ELSE tail[strpos(tail, close) + length(close):] END AS seg
           FROM (SELECT {keys}, line, path, array_to_string(ps[1:m.k], '<') AS before, '</' || m.n || '>' AS close,
                        array_to_string(ps[m.k + 1:], '<')[length(split_part(array_to_string(ps[m.k + 1:], '<'), '>', 1)) + 2:] AS tail
                 FROM work WHERE m IS NOT NULL), (VALUES ('1'), ('2'), ('3')) t(c)))),
whole AS (SELECT {keys}, line, string_agg(seg, '' ORDER BY path) AS seg FROM work WHERE m IS NULL GROUP BY {keys}, line),
tagged AS (SELECT {keys}, string_agg(seg, chr(10) ORDER BY line) AS text FROM whole GROUP BY {keys})"""


@query("page_tags", f"WITH RECURSIVE {sql_paired_tags('pages', 'page_id', 'html')} SELECT page_id, text FROM tagged")
def page_tags(spark, sf_dir):
    """T9 on whole page payloads: every pair of tags of a page's lines, nested as they are."""
    return load(spark, sf_dir, "pages").select("page_id", T.paired_tags("html").alias("text"))


@query("tags_exact", f"""WITH RECURSIVE {SQL_PAGES.split('rp AS')[0]}
rw AS (SELECT page_id, CAST(generate_subscripts(p, 1) - 1 AS INTEGER) AS pos, unnest(p) AS raw
       FROM (SELECT page_id, regexp_extract_all(body, '(?s)<p(?:\\s[^>]*)?>(.*?)</p\\s*>', 1) AS p FROM bd)),
{sql_paired_tags('rw', 'page_id, pos', 'raw')}
SELECT page_id, pos, text FROM tagged""")
def tags_exact(spark, sf_dir):
    """T9 (recursive paired-tag removal) on paragraph markup, as a fold of built-in expressions."""
    p = _tagged_paragraphs(spark, sf_dir)
    return p.select("page_id", "pos", T.paired_tags("raw").alias("text"))


@query("clean_text_exact", f"""WITH RECURSIVE {sql_paired_tags('conversations', 'conv_id, turn', sql_nfkd('text'))}
SELECT conv_id, turn, {sql_strip('text')} AS text FROM tagged""")
def clean_text_exact(spark, sf_dir):
    """T14 on conversation turns through the single-crossing UDF."""
    c = load(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", T.strip_ws(clean_udf("text")).alias("text"))


# ------------------------------------------------------------- content join

SQL_ATTACH = f"""WITH {SQL_LINES}, {SQL_PAGES},
f AS (SELECT 'Commande_' || page_id AS ref, content FROM ap WHERE ok)"""


@query("attach_content", SQL_ATTACH + """
SELECT ia.page_id, ia.ref, ia.title, ia.date, f.content FROM ia JOIN f USING (ref)""")
def attach_content(spark, sf_dir):
    """J2 + J3 + P3: fetched content on every listing of its ref; unfetched
    refs are dropped; an empty paragraph list is content."""
    a = C.attach_content(index_articles_df(spark, sf_dir), fetched(spark, sf_dir))
    return a.select("page_id", "ref", "title", "date", "content")


@query("attach_bucketed", SQL_ATTACH + """
SELECT ia.page_id, ia.ref, ia.title, ia.date, f.content FROM ia JOIN f USING (ref)""")
def attach_bucketed(spark, sf_dir):
    """S12 + J2: listing and fetched articles as tables in buckets of the ref, attached without an exchange."""
    listing = files.materialize_bucketed(index_articles_df(spark, sf_dir), f"listing_{uuid.uuid4().hex}", ["ref"], BUCKETS)
    got = files.materialize_bucketed(fetched(spark, sf_dir), f"fetched_{uuid.uuid4().hex}", ["ref"], BUCKETS)
    return C.attach_content(listing, got).select("page_id", "ref", "title", "date", "content")


@query("stream_attach", SQL_ATTACH + """,
dd AS (SELECT ref, arg_min(page_id, (page_id, ord)) AS page_id, arg_min(date, (page_id, ord)) AS date FROM ia GROUP BY ref)
SELECT dd.ref, dd.page_id, dd.date, f.content FROM dd JOIN f USING (ref)""")
def stream_attach(spark, sf_dir):
    """J2 + U4 with state by key: listings arrive as a stream and the first one of a ref stays; fetched articles
    arrive twice, an early version without content and then the final one, and the last one wins."""
    from ..streaming import keyed
    listing, got = index_articles_df(spark, sf_dir), fetched(spark, sf_dir).where("ok").select("ref", "content")
    early = got.select("ref", F.lit(0).alias("version"), F.array().cast("array<string>").alias("content"))
    versions = early.unionByName(got.select("ref", F.lit(1).alias("version"), "content"))
    tables = {}
    for name, rows, pick, order in (("listing", listing.select("ref", "page_id", "ord", "date"), keyed.earliest, ["page_id", "ord"]),
                                    ("fetched", versions, keyed.latest, ["version"])):
        landed, table = scratch_path(spark, f"landed_{name}"), scratch_path(spark, f"keyed_{name}")
        rows.write.parquet(landed)
        events = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 64).parquet(landed)
        keyed.finish(keyed.write_keyed(pick(events, "ref", order), table, scratch_path(spark, f"{name}_ckpt")))
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
        tables[name] = keyed.read_keyed(spark, table, "ref", kinds)
    return tables["listing"].join(tables["fetched"], "ref").select("ref", "page_id", "date", "content")


@query("attach_content_semi", SQL_ATTACH + """
SELECT page_id, ref FROM ia WHERE ref IN (SELECT ref FROM f)""")
def attach_content_semi(spark, sf_dir):
    """J3 as a semi join: the listings whose ref was fetched."""
    ok = fetched(spark, sf_dir).where("ok").select("ref")
    return index_articles_df(spark, sf_dir).join(ok, "ref", "left_semi").select("page_id", "ref")


SQL_RECORDS = SQL_ATTACH + """,
dd AS (SELECT ref, arg_min(date, (page_id, ord)) AS date, arg_min(title, (page_id, ord)) AS title
       FROM ia GROUP BY ref),
rec AS (SELECT dd.ref, dd.date, dd.title, f.content FROM dd JOIN f USING (ref)),
rr AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || ref), ref) AS rn FROM rec),
sp AS (SELECT ref, date, title, content,
              CASE WHEN rn <= 60 THEN 'test' WHEN rn <= 120 THEN 'valid' ELSE 'train' END AS split FROM rr)"""


def corpus_records(spark, sf_dir, n_test=N_TEST, n_valid=N_VALID, listing=None):
    """The corpus build: deduplicated listings with content, seeded split.
    The records are written once to the shared folder: the split's top-k and
    the sink both read them instead of re-running the index parse and the
    content join."""
    listing = listing if listing is not None else index_articles_df(spark, sf_dir)
    arts = C.dedup_refs(listing, ["page_id", "ord"])
    rec = C.attach_content(arts, fetched(spark, sf_dir)).select("ref", "date", "title", "content")
    rec = cut_lineage(rec, "corpus_records")
    return split_fixed(rec, "ref", n_test=n_test, n_valid=n_valid, seed=42)


@query("corpus_split", SQL_RECORDS + " SELECT ref, split FROM sp")
def corpus_split(spark, sf_dir):
    """R2 on the built corpus: 60 test, 60 valid, the rest train."""
    return corpus_records(spark, sf_dir).select("ref", "split")


@query("sink_jsonl_roundtrip", SQL_RECORDS + " SELECT ref, date, title, content, split FROM sp")
def sink_jsonl_roundtrip(spark, sf_dir):
    """Records written as JSON lines, one file set per split (nulls kept),
    then read back with the declared schema."""
    rec = corpus_records(spark, sf_dir)
    path = files.write_jsonl(rec, scratch_path(spark, "corpus_jsonl"), "split")
    back = spark.read.schema("ref string, date int, title string, content array<string>").json(path)
    return back.select("ref", "date", "title", "content", "split")


@query("sink_titles_roundtrip", f"WITH {SQL_LINES} SELECT title FROM ia")
def sink_titles_roundtrip(spark, sf_dir):
    """One title per line, read back."""
    path = files.write_titles(index_articles_df(spark, sf_dir), scratch_path(spark, "titles"))
    return spark.read.text(path).select(F.col("value").alias("title"))


@query("extend_train", SQL_RECORDS + """,
good AS (SELECT ref, date, title FROM ia WHERE title LIKE '%URGENT%'),
tr AS (SELECT ref, date, title FROM sp WHERE split = 'train')
SELECT 0 AS set, ref, date, title FROM good UNION ALL SELECT 1, ref, date, title FROM tr""")
def extend_train(spark, sf_dir):
    """Good articles (here the urgent orders' listings) first, then the
    training split, as a bag with a set ordinal."""
    listing = cut_lineage(index_articles_df(spark, sf_dir), "listing")    # parsed once, read twice
    good = listing.where(F.col("title").contains("URGENT"))
    train = corpus_records(spark, sf_dir, listing=listing).where("split = 'train'")
    return C.extend_train(good.select("ref", "date", "title"), train.select("ref", "date", "title"))


# ------------------------------------------------------------- splits on documents

SQL_DOC_RANK = """
r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS rn FROM documents)"""


@query("split_fixed", f"""WITH {SQL_DOC_RANK}
SELECT doc_id, CASE WHEN rn <= 60 THEN 'test' WHEN rn <= 120 THEN 'valid' ELSE 'train' END AS split FROM r""")
def split_fixed_q(spark, sf_dir):
    """60 test, 60 valid, the rest train, by seeded md5 order."""
    return split_fixed(load(spark, sf_dir, "documents").select("doc_id"), "doc_id").select("doc_id", "split")


@query("train_shuffle", f"""WITH {SQL_DOC_RANK}
SELECT doc_id, row_number() OVER (ORDER BY md5('7:' || doc_id), doc_id) AS ord FROM r WHERE rn > 120""")
def train_shuffle(spark, sf_dir):
    """Seeded shuffle of the training split, with its ordinal."""
    d = split_fixed(load(spark, sf_dir, "documents").select("doc_id"), "doc_id")
    return shuffle(d.where("split = 'train'").select("doc_id"), "doc_id", seed=7, ordinal="ord")


@query("sample_rows", """
SELECT doc_id, lang FROM documents ORDER BY md5('3:' || doc_id), doc_id LIMIT 3""")
def sample_rows(spark, sf_dir):
    """Three rows for inspection (a top-k, not a sort)."""
    return sample_n(load(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", 3, seed=3)
