"""Secrets by corpus-wide ownership frequency, in DataFrame operations only.

Spans of the fixed patterns always stand.  Further candidates (provider
tokens, signed tokens, passwords in addresses, values behind credential words)
are hashed with the fixed ones; each hash is counted by distinct repositories
and owners over the whole corpus.  A value of ``example_owners`` owners or of
``example_repos`` repositories or more is a widely copied example; a varied
value of fewer of both looks live.  Live further candidates become spans.

Counts are by (hash, owner, repository), then (hash, owner), then hash, each
combined before its shuffle, so a value that a third of the corpus repeats
costs one row a task.  Verdicts go back by the key of the text, so rows of
equal text are judged once and repeated rows alike.

Null and empty texts have no span.  A null owner or repository counts as one
of its own.  Offsets are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, merged, redacted, span_text, text_key, union, with_matches

#: Fixed patterns and least lengths of the contract.
ASSIGN = (r"""(?:(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
          r"""|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex")

#: Further candidates: (kind they are reported as, pattern, group of the value, a cheap necessary condition).
FURTHER = (
    ("access", r"(?<![A-Za-z0-9])(?:gh[pousr]_[A-Za-z0-9]{20,}|xox[abprs]-[A-Za-z0-9-]{12,}|sk-[A-Za-z0-9_-]{20,}|AIza[A-Za-z0-9_-]{30,}"
               r"|glpat-[A-Za-z0-9_-]{16,})", 0, r"gh[pousr]_|xox[abprs]-|sk-|AIza|glpat-"),
    ("access", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, r"eyJ"),
    ("assign", r"://[^\x20\x09-\x0D/:@]{1,64}:([^\x20\x09-\x0D/:@]{6,64})@", 1, r"://"),
    ("assign", r"(?i:bearer|authorization|credential|pwd|private_?key|access_?key|client_?id)[\"']?\x20{0,4}[:=]?\x20{0,4}[\"']?"
               r"([A-Za-z0-9+/_.=-]{16,})", 1, r"(?i:bearer|authorization|credential|pwd|private_?key|access_?key|client_?id)"),
)
EXAMPLE_OWNERS = 3
EXAMPLE_REPOS = 20
SPAN = "array<struct<start:int,no:int,end:int,kind:string,h:bigint,base:boolean,varied:boolean>>"


def _varied(value: Column) -> Column:
    """Digits and at least six different characters."""
    return value.rlike("[0-9]") & (F.size(F.array_distinct(F.split(value, ""))) >= 6)


def _as_span(kind: str, base: bool):
    return lambda s: F.struct(
        s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("no"), s["end"].alias("end"), F.lit(kind).alias("kind"),
        F.xxhash64(s["g"]).alias("h"), F.lit(base).alias("base"), _varied(s["g"]).alias("varied"))


def candidates(docs: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """Add ``out``: all candidates of the text in order (SPAN), base and further."""
    df = docs.withColumn("__t", F.coalesce(F.col(text), F.lit("")))
    searches = [("assign", ASSIGN, 1, "[:=]", True), ("access", ACCESS, 0, "AKIA", True), ("hex", HEX, 0, None, True)]
    searches += [(k, p, g, c, False) for k, p, g, c in FURTHER]
    parts = []
    for i, (kind, pattern, group, needs, base) in enumerate(searches):
        df = with_matches(df, f"__s{i}", "__t", pattern, group, F.col("__t").rlike(needs) if needs else None)
        found = F.col(f"__s{i}")
        if pattern is ASSIGN:
            found = F.filter(found, lambda s: F.length(s["g"]) >= 8)
        parts.append(F.transform(found, _as_span(kind, base)))
    return df.withColumn(out, F.array_sort(F.concat(*parts)).cast(SPAN)).drop("__t", *[f"__s{i}" for i in range(len(searches))])


def ownership(found: DataFrame) -> DataFrame:
    """(h, n_owners, n_repos) over the whole corpus; ``found`` has owner, repo, spans."""
    one = found.select("owner", "repo", F.explode(F.array_distinct(F.transform("spans", lambda s: s["h"]))).alias("h")).distinct()
    by_owner = one.groupBy("h", "owner").agg(F.count("*").alias("n"))
    return by_owner.groupBy("h").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repos"))


def scan(docs: DataFrame, owner: str = "source", repo: str = "doc_id", keep: tuple[str, ...] = ("doc_id",),
         example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS) -> DataFrame:
    """``keep`` columns, key, spans (array of SPAN with ``live``) per row.
    Base spans and live further ones are kept."""
    own = docs.select(*[F.col(c).alias(f"k_{c}") for c in keep], F.col("text").alias("text"),
                      F.coalesce(F.col(owner).cast("string"), F.lit("\x00")).alias("owner"),
                      F.coalesce(F.col(repo).cast("string"), F.lit("\x00")).alias("repo"))
    rows = candidates(own).select(*[f"k_{c}" for c in keep], "owner", "repo", text_key(F.col("text")).alias("key"), "spans")
    rows = cut(rows, "sec-rows")
    some = rows.where(F.size("spans") > 0)
    stats = ownership(some)
    live = (some.select("key", F.explode("spans").alias("s")).where("s.varied").select("key", F.col("s.h").alias("h")).distinct()
            .join(stats.where((F.col("n_owners") < example_owners) & (F.col("n_repos") < example_repos)), "h").groupBy("key").agg(F.collect_set("h").alias("live")))
    none = F.array().cast("array<bigint>")
    marked = union([rows.where(F.size("spans") == 0).withColumn("live", none),
                    some.join(live, "key", "left").withColumn("live", F.coalesce("live", none))])
    spans = F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), s["no"].alias("no"), s["end"].alias("end"), s["kind"].alias("kind"), s["h"].alias("h"),
        s["base"].alias("base"), F.array_contains(F.col("live"), s["h"]).alias("live")))
    free = lambda s: ~F.exists("fixed", lambda b: (b["start"] < s["end"]) & (b["end"] > s["start"]))
    return (marked.select(*[F.col(f"k_{c}").alias(c) for c in keep], "key", spans.alias("spans"))
            .withColumn("fixed", F.filter("spans", lambda s: s["base"]))
            .withColumn("spans", F.array_distinct(F.filter("spans", lambda s: s["base"] | (s["live"] & free(s))))).drop("fixed"))


def redact(docs: DataFrame, **settings) -> DataFrame:
    """The documents with every span replaced by ``<SECRET:KIND>``; where a
    text changes and there is an ``n_chars``, it is counted anew."""
    found = scan(docs, keep=(), **settings)
    spans = cut(found.where(F.size("spans") > 0).dropDuplicates(["key"])
                .select(F.col("key").alias("__key"), merged(F.col("spans")).alias("__spans")), "sec-spans")
    df = docs.join(spans, text_key(F.col("text")) == F.col("__key"), "left")
    text = F.when(F.col("__spans").isNotNull(), redacted(F.col("text"), F.col("__spans"), "SECRET")).otherwise(F.col("text"))
    df = df.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        df = df.withColumn("n_chars", F.when(F.col("__spans").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return df.select(*docs.columns)


def digest(found: DataFrame) -> DataFrame:
    """Columns of the query from scan()'s rows."""
    base = F.filter("spans", lambda s: s["base"])
    count = lambda k: F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS], F.sha2(span_text(base), 256).alias("base_sha256"),
                        span_text(F.col("spans")).alias("spans"),
                        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"))
