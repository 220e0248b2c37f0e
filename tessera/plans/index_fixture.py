"""Index pages built from a table: the input of the index queries, which parse
them back (the driver's ``pages`` hold no year sections)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def render_index_pages(items: DataFrame, page: str, year: str, ref: str, title: str,
                       key: str) -> DataFrame:
    """One index page per ``page`` value: a ``<h2><span ...>YEAR</span></h2>``
    header before each year, one numbered ``<li>`` entry per item in
    (year, key) order, lines joined with newlines.  Lines are built per row
    (code-generated projection; numbering and section breaks from a window on
    the page key, which shares the exchange of the final grouping); pages are
    bounded by the caller's page key."""
    w = Window.partitionBy("page_id").orderBy("y", "k")
    rows = items.select(F.col(page).alias("page_id"), F.col(year).alias("y"), F.col(key).alias("k"),
                        F.col(ref).alias("r"), F.col(title).alias("t"))
    rows = rows.withColumn("_n", F.row_number().over(w)).withColumn("_py", F.lag("y").over(w))
    ys = F.col("y").cast("string")
    header = F.concat(F.lit('<h2><span class="mw-headline" id="y'), ys, F.lit('">'), ys,
                      F.lit("</span></h2>\n"))
    entry = F.concat(F.lit("<li>"), F.col("_n").cast("string"), F.lit(' : <a class="x" href="/wiki/'),
                     F.col("r"), F.lit('" title="'), F.col("t"), F.lit('">'), F.col("r"), F.lit("</a></li>"))
    new_sec = F.col("_py").isNull() | (F.col("_py") != F.col("y"))
    lines = rows.select("page_id", "_n", F.concat(F.when(new_sec, header).otherwise(F.lit("")), entry)
                        .alias("_line"))
    g = lines.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("_n", "_line"))).alias("_e"))
    body = F.array_join(F.transform("_e", lambda e: e["_line"]), "\n")
    return g.select("page_id", F.concat(F.lit("<ul>\n"), body, F.lit("\n</ul>")).alias("html"))
