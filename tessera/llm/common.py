"""Helpers shared by the training-data operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import cut_lineage
from tessera.sources.tables import load

#: The white space that separates words in every contract of this package.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"

#: Whole texts cross into Python: this many rows at most in one Arrow batch.
ARROW_ROWS = 512

#: A lookup table is broadcast by hand only up to this many bytes; a larger one is joined.
BROADCAST_BYTES = 32 << 20


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` in the shared folder and go on from the written table."""
    return cut_lineage(df, f"llm-{name}")


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small, whoever built the session."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000") or 0)
    if now <= 0 or now > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return load(spark, sf_dir, "documents")


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order (null: none)."""
    parts = F.split(F.coalesce(text, F.lit("")), BLANK_RUN, -1)
    return F.filter(parts, lambda w: w != "")


def text_key(text: Column) -> Column:
    """Key of a text's content; rows of equal text share it (null: as empty)."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def _scan(xs: Column, base: Column) -> Column:
    zero = F.struct(F.array().cast("array<int>").alias("a"), base.cast("int").alias("s"))
    return F.aggregate(
        xs, zero,
        lambda acc, x: F.struct(F.concat(acc["a"], F.array(acc["s"])).cast("array<int>").alias("a"),
                                (acc["s"] + x).cast("int").alias("s")),
        lambda acc: acc["a"])


def running_starts(lengths: Column, step: int = 128) -> Column:
    """Sum of the lengths before each entry.  Runs of ``step`` entries are
    summed first, so a long array costs far less than its square.  ``lengths``
    should be a column, not an expression."""
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / step).cast("int")),
                         lambda c: F.slice(lengths, c * step + 1, step))
    sums = F.transform(chunks, lambda ch: F.aggregate(ch, F.lit(0), lambda a, x: (a + x).cast("int")))
    return F.when(F.size(lengths) == 0, F.array().cast("array<int>")).otherwise(
        F.flatten(F.zip_with(chunks, _scan(sums, F.lit(0)), _scan)))


def with_matches(df: DataFrame, out: str, text: str, pattern: str, group: int = 0,
                 when: Column | None = None) -> DataFrame:
    """Add ``out``: array<struct<start:int, end:int, m:string, g:string>> of the
    leftmost non-overlapping matches of ``pattern`` in column ``text`` (code
    points, end exclusive; ``g`` is the capture group).  ``when`` is a cheap
    necessary condition that spares the search.  The pieces between matches
    give the positions, so no Python is needed."""
    m, g, p, n, at = (f"__{out}_{x}" for x in "mgpna")
    empty = F.array().cast("array<string>")
    cond = F.col(text).isNotNull() if when is None else F.coalesce(when, F.lit(False))
    df = df.withColumn(m, F.when(cond, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(empty))
    some = F.size(m) > 0
    df = df.withColumn(p, F.when(some, F.transform(F.split(text, pattern, -1), lambda x: F.length(x)))
                       .otherwise(F.array().cast("array<int>")))
    df = df.withColumn(g, F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).otherwise(empty)
                       if group else F.col(m))
    df = df.withColumn(n, F.zip_with(F.slice(p, 1, F.size(m)), F.col(m), lambda a, x: (a + F.length(x)).cast("int")))
    df = df.withColumn(at, running_starts(F.col(n)))  # of a column: lambdas evaluate an expression for each entry
    spans = F.transform(F.arrays_zip(F.col(at).alias("a"), F.slice(p, 1, F.size(m)).alias("p"),
                                     F.col(m).alias("m"), F.col(g).alias("g")),
                        lambda x: F.struct((x["a"] + x["p"]).cast("int").alias("start"),
                                           (x["a"] + x["p"] + F.length(x["m"])).cast("int").alias("end"),
                                           x["m"].alias("m"), x["g"].alias("g")))
    return df.withColumn(out, F.when(some, spans).otherwise(
        F.array().cast("array<struct<start:int,end:int,m:string,g:string>>"))).drop(m, g, p, n, at)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def merged(spans: Column) -> Column:
    """Disjoint spans that cover sorted spans; the first kind of a run stays."""
    kind = "array<struct<start:int,end:int,kind:string>>"
    own = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                s["kind"].alias("kind")))

    def step(acc, s):
        last = F.element_at(acc, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"),
                          last["kind"].alias("kind"))
        return F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] > s["start"]),
                      F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(longer))).otherwise(
            F.concat(acc, F.array(s))).cast(kind)

    return F.aggregate(own, F.array().cast(kind), step)


def redacted(text: Column, spans: Column, label: str) -> Column:
    """``text`` with each of the disjoint ``spans`` replaced by ``<label:KIND>``."""
    n = F.size(spans)
    pieces = F.transform(F.sequence(F.lit(0), n), lambda i: F.concat(
        F.when(i == 0, F.lit("")).otherwise(F.concat(F.lit(f"<{label}:"), F.upper(F.get(spans, i - 1)["kind"]), F.lit(">"))),
        F.substring(text, F.when(i == 0, F.lit(0)).otherwise(F.get(spans, i - 1)["end"]) + 1,
                    F.when(i == n, F.length(text)).otherwise(F.get(spans, i)["start"])
                    - F.when(i == 0, F.lit(0)).otherwise(F.get(spans, i - 1)["end"]))))
    return F.when(n > 0, F.array_join(pieces, "")).otherwise(text)


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
