"""Corpus tables: content attach, dedup, unions, year ranges, URL lists
(J2, J3, P3, P9, S7, S8, U1-U4)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_years(df: DataFrame, y0: int, y1: int, col: str = "date") -> DataFrame:
    """Half-open year range ``[y0, y1)`` (D3)."""
    return df.where((F.col(col) >= y0) & (F.col(col) < y1))


def with_content(df: DataFrame) -> DataFrame:
    """Rows that have content; an empty list counts as content."""
    return df.where(F.col("content").isNotNull())


def dedup_refs(df: DataFrame, order: list[str], key: str = "ref") -> DataFrame:
    """U4: one row per ``key``, the first in ``order``.  An aggregate with a
    map-side partial (``min_by``), so a ref listed millions of times is merged
    before the shuffle rather than sorted in one window task."""
    cols = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("_r"))
    return best.select(key, *[F.col("_r")[c].alias(c) for c in cols])


def attach_content(articles: DataFrame, fetched: DataFrame, key: str = "ref",
                   order: str = "page_id") -> DataFrame:
    """J2 + J3 + P3: each listing gets the content fetched for its ref.  The
    fetched side is reduced to one row per ref first (the last fetch wins, as
    repeated assignment does in the reference), so skew can only sit on the
    listing side, where AQE splits it."""
    ok = fetched.where(F.col("ok"))
    one = ok.groupBy(key).agg(F.max_by("content", order).alias("content"))
    return with_content(articles.join(one, key, "inner"))


def collect_paragraphs(df: DataFrame, key: str, pos: str = "pos", text: str = "paragraph",
                       out: str = "content") -> DataFrame:
    """Paragraph rows back into one ordered array per article (a group is
    one article's paragraphs)."""
    g = df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"),
                                                                 F.col(text).alias("t")))).alias("_a"))
    return g.select(key, F.transform("_a", lambda s: s["t"]).alias(out))


def union_pages(frames: list[DataFrame]) -> DataFrame:
    """Bag union of page sets."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def extend_train(good: DataFrame, train: DataFrame) -> DataFrame:
    """Good articles first, then the training split (bag union)."""
    return (good.withColumn("set", F.lit(0)).unionByName(train.withColumn("set", F.lit(1)))
            .select("set", *good.columns))


def union_sources(frames: dict[str, DataFrame]) -> DataFrame:
    """Several sources into one corpus, missing columns as nulls."""
    tagged = [df.withColumn("source", F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def index_urls(years: DataFrame, base: str, year_col: str = "y") -> DataFrame:
    """``(ord, url)``: the base URL (ord 0), then ``base/<y>`` for every
    year in ``[min, max + 1)`` of ``years`` - one aggregate row exploded."""
    b = years.agg(F.min(year_col).alias("y0"), F.max(year_col).alias("y1"))
    ys = b.select("y0", F.explode(F.sequence("y0", "y1")).alias("y"))
    per_year = ys.select((F.col("y") - F.col("y0") + 1).cast("int").alias("ord"),
                         F.concat(F.lit(base + "/"), F.col("y")).alias("url"))
    first = b.select(F.lit(0).alias("ord"), F.lit(base).alias("url"))
    return first.unionByName(per_year)


def intake_gaps(urls: DataFrame, pages: DataFrame) -> DataFrame:
    """Every wanted URL with whether a landed page exists for it."""
    landed = pages.groupBy("url").agg(F.count(F.lit(1)).alias("_n"))
    return urls.join(landed, "url", "left").select(
        "ord", "url", F.coalesce(F.col("_n") > 0, F.lit(False)).alias("landed"))
