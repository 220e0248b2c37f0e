"""Index-page parsing and article extraction.

Match offsets (T1): Spark has no "all matches with positions" function, so
each match is prefixed with a sentinel by ``regexp_replace`` and the text is
split on it; piece ``i`` starts with match ``i`` and its offset is the sum of
the lengths of the pieces before it, a running sum inside the page's row.
U+0001, a character HTML forbids, is the sentinel; one in a page reads as
U+FFFD, which keeps every offset.

Section years and entries are scanned *separately* (one alternation would
lose a year anchor that lies inside an entry's lazy span).  A page is one row,
so its entries take their year there (J1), by a two-level search among the
page's section offsets: index parsing needs no shuffle and no window, and a
page with any number of entries costs its own length.  Anchors that come as
rows go through :func:`asof_section`, a carry-forward in blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import ENTRY_PATTERN, SECTION_PATTERN
from ..functions import text as T
from ..functions.arrays import last_before, running_starts
from ..functions.udfs import clean_array_udf, clean_markup_udf

SENTINEL = "\u0001"


def _matches(df: DataFrame, keep: list[str], col: str, patterns: dict[str, str]) -> DataFrame:
    """For each name of ``patterns`` an array ``name`` of ``(start, piece)``: every match's offset and the text
    from it up to the next match."""
    df = df.select(*keep, *(_split_at_matches(col, p).alias(f"_{n}_p") for n, p in patterns.items()))
    df = df.select("*", *(F.transform(f"_{n}_p", lambda x: F.length(x)).alias(f"_{n}_n") for n in patterns))
    df = df.select("*", *(running_starts(F.col(f"_{n}_n")).alias(f"_{n}_s") for n in patterns))
    rest = lambda c: F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0)))  # noqa: E731  the first piece is before any match
    return df.select(*keep, *(F.arrays_zip(rest(F.col(f"_{n}_s")).alias("start"), rest(F.col(f"_{n}_p")).alias("piece")).alias(n)
                              for n in patterns))


def _group(piece: str, pattern: str, g: int):
    """Capture group of the match that a piece starts with (the anchored pattern yields the same match)."""
    return F.regexp_extract(piece, f"(?d)^(?:{pattern})", g)


def match_offsets(df: DataFrame, id_col: str, col: str, pattern: str,
                  groups: dict[str, int]) -> DataFrame:
    """Every match of ``pattern`` with its 0-based start offset (Python's
    ``m.start()``) and the named capture groups: ``(id, start, g...)``."""
    m = _matches(df, [id_col], col, {"m": pattern}).select(id_col, T.explode_nonempty("m").alias("m")).where("m is not null")
    m = m.select(id_col, "m.start", F.col("m.piece").alias("_piece"))
    return m.select(id_col, "start", *(_group("_piece", pattern, g).alias(name) for name, g in groups.items()))


def _split_at_matches(col: str, pattern: str):
    """``col`` split before every match of ``pattern``."""
    clear = F.translate(F.col(col), SENTINEL, "\uFFFD")
    return F.split(F.regexp_replace(clear, f"(?d)({pattern})", SENTINEL + "$1"), SENTINEL)


def index_anchors(pages: DataFrame, id_col: str = "page_id", col: str = "html",
                  section_pattern: str = SECTION_PATTERN,
                  entry_pattern: str = ENTRY_PATTERN) -> DataFrame:
    """T2 + T3 + T1: section years and entries with offsets, one row per anchor
    ``(page_id, kind, start, year, ref, title)``; kind 0 = section, 1 = entry.
    Groups are extracted in a code-generated projection after the explode."""
    m = _matches(pages, [id_col], col, {"s": section_pattern, "e": entry_pattern})
    anchor = lambda kind: lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["piece"].alias("piece"))
    both = F.concat(F.transform("s", anchor(0)), F.transform("e", anchor(1)))
    rows = m.select(id_col, T.explode_nonempty(both).alias("a")).where("a is not null").select(
        id_col, "a.kind", "a.start", F.col("a.piece").alias("_piece"))
    section, entry = F.col("kind") == 0, F.col("kind") == 1
    return rows.select(id_col, "kind", "start", F.when(section, _group("_piece", section_pattern, 1)).try_cast("int").alias("year"),
                       F.when(entry, _group("_piece", entry_pattern, 1)).alias("ref"),
                       F.when(entry, _group("_piece", entry_pattern, 2)).alias("title"))


def asof_section(anchors: DataFrame, id_col: str = "page_id", block: int = 1 << 20) -> DataFrame:
    """Each entry takes the year of the last section anchor with a
    strictly smaller offset on the same page; none -> null (D1, quarantine).
    A carry-forward in blocks of ``block`` offsets: the last year inside the
    block, else the last one of the blocks before it (one row per block)."""
    keyed = anchors.withColumn("_blk", F.floor(F.col("start") / block))
    inside = Window.partitionBy(id_col, "_blk").orderBy("start").rangeBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(id_col).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    lasts = keyed.groupBy(id_col, "_blk").agg(F.max_by("year", F.when(F.col("year").isNotNull(), F.col("start"))).alias("_last"))
    carry = lasts.select(F.col(id_col).alias("_id"), F.col("_blk").alias("_b"), F.last("_last", ignorenulls=True).over(before).alias("_carry"))
    dated = keyed.withColumn("_own", F.last("year", ignorenulls=True).over(inside)).where(F.col("kind") == 1)
    dated = dated.join(carry, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_blk") == F.col("_b")))
    return dated.select(id_col, F.col("start").alias("ord"), "ref", "title", F.coalesce("_own", "_carry").alias("date"))


def parse_index(pages: DataFrame, id_col: str = "page_id", col: str = "html", section_pattern: str = SECTION_PATTERN,
                entry_pattern: str = ENTRY_PATTERN) -> DataFrame:
    """T4: ``(page_id, ord, ref, title, date)`` for every listed article; ``ord``
    is the entry's offset (input order, R6).  Every entry has the year of the
    last section before it, found inside the page's row (J1).  Rows with a null
    date are the quarantine of D1 (see :func:`quarantine`)."""
    m = _matches(pages, [id_col], col, {"s": section_pattern, "e": entry_pattern})
    years = F.transform("s", lambda x: F.struct(x["start"].alias("start"), F.regexp_extract(
        x["piece"], f"(?d)^(?:{section_pattern})", 1).try_cast("int").alias("year")))
    m = m.select(id_col, "e", years.alias("s")).withColumn("s", F.filter("s", lambda x: x["year"].isNotNull()))
    m = m.select(id_col, "e", F.col("s.start").alias("_at"), F.col("s.year").alias("_year"), F.col("e.start").alias("_es"))
    m = m.withColumn("_date", last_before(F.col("_at"), F.col("_year"), F.col("_es")))
    rows = m.select(id_col, T.explode_nonempty(F.arrays_zip(F.col("_es").alias("start"), F.col("e.piece").alias("piece"),
                                                           F.col("_date").alias("date"))).alias("a")).where("a is not null")
    rows = rows.select(id_col, F.col("a.start").alias("ord"), F.col("a.piece").alias("_piece"), F.col("a.date").alias("date"))
    return rows.select(id_col, "ord", _group("_piece", entry_pattern, 1).alias("ref"), _group("_piece", entry_pattern, 2).alias("title"), "date")


def quarantine(articles: DataFrame) -> DataFrame:
    return articles.where(F.col("date").isNull())


# --------------------------------------------------------------------------
# Article payload -> clean paragraphs
# --------------------------------------------------------------------------

def body_of(payload, tag: str = "article"):
    """T5 then T6: entity replacement, scripts and styles dropped, first element."""
    clean = T.drop_script_style(T.unescape_tags(payload))
    return T.first_element(clean, tag), F.coalesce(T.has_element(clean, tag), F.lit(False))


def raw_paragraphs(body, tag: str = "p"):
    """T7 + T8 + T8b: element texts in document order, entities decoded."""
    return F.transform(T.elements(body, tag), lambda x: T.decode_entities(T.inner_text(x)))


def markup_paragraphs(body, tag: str = "p"):
    """T7 + T8: element texts in document order, references not yet decoded."""
    return F.transform(T.elements(body, tag), lambda x: T.inner_text(x))


def clean_paragraphs(arr):
    """T14 on every element: NFKD and paired-tag removal (one Arrow crossing
    per batch), then the Unicode strip natively."""
    return F.transform(clean_array_udf(arr), lambda x: T.strip_ws(x))


def parse_article(df: DataFrame, key: str, payload: str, tag: str = "article",
                  para_tag: str = "p", keep: list[str] | None = None) -> DataFrame:
    """``(key, content array<string>, ok)``; ``ok = false`` when the body
    element is missing (D5: failures are rows, never dropped silently), and an
    element without paragraphs gives ``ok = true`` with ``[]``.  References are
    decoded (T8b), normalised and cleaned in one crossing."""
    body, ok = body_of(F.col(payload), tag)
    clean = F.transform(clean_markup_udf(markup_paragraphs(body, para_tag)), lambda x: T.strip_ws(x))
    return df.select(key, *(keep or []), F.when(ok, clean).alias("content"), ok.alias("ok"))
