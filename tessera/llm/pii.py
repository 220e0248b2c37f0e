"""Personal data by candidate gradient boosting, in DataFrame operations and MLlib.

Fixed patterns give the base spans, which always stand.  High-recall generators
propose further, looser spans (written-out addresses, IPv6, other card and
phone spellings) on the text with the base spans blanked out.  Boosted trees
are fitted on every candidate of the corpus, counted by its binned format and
context features.

What a proposal is, no pattern tells, so it is labelled by signals that did not
make it: its own plausibility (``fits``: a Luhn check, a top-level domain, the
digits of a national number, hexadecimal groups) and the words before it, a cue
of its kind (``phone``, ``card``) and no counter (``order``, ``ref``).  Positive are
base spans and proposals that have all of them, negative are failed base
matches and the other proposals.  The trees are fitted on three quarters of the
texts, by hash, and turned into one SQL expression; a kind's threshold comes
from the proposals of the last quarter alone, so base spans, however many,
lower no bar: it is the least score at which the share of positive proposals
(isotonic over the scores; each block counts the model's own score as one
more candidate, which decides where proposals are few) reaches ``precision``.
Proposals at or over it are added.

The table that is fitted has at most as many rows as there are combinations of
bins, whatever the corpus.  Without candidates of both classes nothing is
added.  Null and empty texts have no span.  Offsets are code points, ends
exclusive.  Rows are independent of each other, so repeated rows are alike; an empty
table gives no row; other columns are not used.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, merged, redacted, span_text, with_matches

KINDS = ("email", "ip", "card", "phone")
#: The contract's patterns; possessive, so that long runs need no recursion.  An address starts
#: where a run of its characters starts, or where the last match ended.
BASE = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", "[0-9][\\x20-]?[0-9]"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
}
PROPOSED = {
    "email": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|\(at\)|\[at\]|\{at\}|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}+"
              r"(?:\x20?(?:\(dot\)|\[dot\]|\{dot\}|\x20dot\x20|\.)\x20?[A-Za-z0-9-]{2,24}+){1,4}", r"@|\(at\)|\[at\]|\{at\}|\x20at\x20"),
    "ip": (r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])", "[0-9A-Fa-f]:[0-9A-Fa-f]"),
    "card": (r"(?<![0-9])[0-9](?:[\x20./-]?[0-9]){12,18}(?![0-9])", "[0-9]{3}"),
    "phone": (r"(?<![0-9A-Za-z])\(?[0-9]{2,4}\)?[\x20./-]?[0-9]{3,4}[\x20./-][0-9]{3,4}(?![0-9])", "[0-9]{3}"),
}
PART = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: Words before a span that tell what it is, or that it counts something.
CUES = {
    "email": "e?-?mail|contact|write|reach|address",
    "ip": "ip|ipv6|host|server|address|login|node",
    "card": "card|visa|mastercard|credit|debit|pay|payment",
    "phone": "phone|telephone|tel|call|fax|mobile|cell|contact",
}
COUNTER = "(?i)(?<![a-z])(?:order|invoice|isbn|issn|ref|version|ver|sku|serial|total|no)(?![a-z])|[#$]"
FEATURES = ("digits", "length", "marks", "distinct", "left", "right", "cue", "counter", "fits")
CONTEXT = 24
SPAN = ("array<struct<start:int,no:int,end:int,kind:string,base:boolean,proposed:boolean,"
        + ",".join(f"{f}:int" for f in FEATURES) + ">>")


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True where a string of up to 19 digits passes the Luhn check."""
    r = F.reverse(digits)
    value = lambda i: F.substring(r, i, F.lit(1)).cast("int")
    total = F.aggregate(F.sequence(F.lit(1), F.length(r)), F.lit(0), lambda s, i: (
        s + F.when(i % 2 == 1, value(i)).otherwise(value(i) * 2 - F.when(value(i) > 4, 9).otherwise(0))).cast("int"))
    return (F.length(digits) > 0) & (total % 10 == 0)


def valid(kind: str, s: Column) -> Column:
    n = F.length(_digits(s))
    return {"email": F.lit(True), "ip": s.rlike(rf"^0*{PART}(?:\.0*{PART}){{3}}$"),
            "card": F.when(n.between(14, 19), luhn(_digits(s))).otherwise(False), "phone": n.between(10, 15)}[kind]


def fits(kind: str, s: Column) -> Column:
    """Whether a looser span is plausible in itself, by what its pattern does not ask."""
    n = F.length(_digits(s))
    return {"email": s.rlike(r"[A-Za-z]{2,24}$") & s.rlike("[A-Za-z]"), "ip": s.rlike("[A-Fa-f]") | s.rlike("^(?:[0-9A-Fa-f]+:){7}"),
            "card": F.when(n.between(13, 19), luhn(_digits(s))).otherwise(False), "phone": n.between(9, 11)}[kind]


def _side(c: Column) -> Column:
    return (F.when(c.rlike("^[\\x20\\x09-\\x0D]?$"), 0).when(c.rlike("[0-9]"), 1).when(c.rlike("[.,;:!?()\"']"), 2).otherwise(3))


def _features(kind: str, text: Column):
    cues = f"(?i)(?<![a-z])(?:{CUES[kind]})(?![a-z])"

    def run(s: Column, base: Column, proposed: bool) -> Column:
        m = s["m"]
        left = F.substring(text, F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT)))
        after = F.substring(text, s["end"] + 1, F.lit(1))
        return F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("no"), s["end"].alias("end"), F.lit(kind).alias("kind"), base.alias("base"),
            F.lit(proposed).alias("proposed"),
            F.least(F.length(_digits(m)), F.lit(20)).alias("digits"), F.least(F.floor(F.length(m) / 4), F.lit(12)).cast("int").alias("length"),
            F.least(F.length(F.regexp_replace(m, "[A-Za-z0-9]", "")), F.lit(7)).alias("marks"),
            F.least(F.size(F.array_distinct(F.split(_digits(m), ""))), F.lit(6)).alias("distinct"),
            _side(F.right(left, F.lit(1))).alias("left"), _side(after).alias("right"),
            left.rlike(cues).cast("int").alias("cue"), left.rlike(COUNTER).cast("int").alias("counter"),
            (fits(kind, m) if proposed else base).cast("int").alias("fits"))

    return run


def _blanked(text: Column, spans: Column) -> Column:
    """``text`` with line feeds in place of the disjoint ``spans``; same length."""
    n = F.size(spans)
    end = lambda i: F.get(spans, i - 1)["end"]
    pieces = F.transform(F.sequence(F.lit(0), n), lambda i: F.concat(
        F.when(i == 0, F.lit("")).otherwise(F.repeat(F.lit("\n"), end(i) - F.get(spans, i - 1)["start"])),
        F.substring(text, F.when(i == 0, F.lit(0)).otherwise(end(i)) + 1,
                    F.when(i == n, F.length(text)).otherwise(F.get(spans, i)["start"]) - F.when(i == 0, F.lit(0)).otherwise(end(i)))))
    return F.when(n > 0, F.array_join(pieces, "")).otherwise(text)


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``base`` (valid spans in order) and ``other`` (failed matches and
    proposals), arrays of SPAN."""
    df = docs.withColumn("__t", F.coalesce(F.col(text), F.lit("")))
    t = F.col("__t")
    good, bad = [], []
    for kind, (pattern, needs) in BASE.items():
        df = with_matches(df, f"__{kind}", "__t", pattern, when=t.rlike(needs))
        df = df.withColumn(f"__{kind}", F.transform(f"__{kind}", _judged(kind, t)))
        good.append(F.filter(f"__{kind}", lambda s: s["base"]))
        bad.append(F.filter(f"__{kind}", lambda s: ~s["base"]))
    df = df.withColumn("base", F.array_sort(F.concat(*good)).cast(SPAN))
    df = df.withColumn("__b", merged(F.col("base")))  # a column: lambdas evaluate an expression for each entry
    df = df.withColumn("__m", F.when(F.size("base") > 0, _blanked(t, F.col("__b"))).otherwise(t))
    for kind, (pattern, needs) in PROPOSED.items():
        df = with_matches(df, f"__p_{kind}", "__m", pattern, when=F.col("__m").rlike(needs))
        make = _features(kind, t)
        bad.append(F.transform(f"__p_{kind}", _proposed(make)))
    return df.withColumn("other", F.array_sort(F.concat(*bad)).cast(SPAN)).drop(
        "__t", "__m", "__b", *[f"__{k}" for k in KINDS], *[f"__p_{k}" for k in KINDS])


def _judged(kind: str, text: Column):
    make = _features(kind, text)
    return lambda s: make(s, valid(kind, s["m"]), False)


def _proposed(make):
    return lambda s: make(s, F.lit(False), True)


def _tree(text: str, value) -> Column:
    """A fitted tree's printed form as a Column; ``value(i)`` is feature i."""
    lines = [line.strip() for line in text.splitlines()[1:] if line.strip()]
    at = 0

    def node() -> Column:
        nonlocal at
        line = lines[at]
        at += 1
        if line.startswith("Predict:"):
            return F.lit(float(line.split(":")[1]))
        i, op, bound = re.match(r"If \(feature (\d+) (<=|in) (.+)\)$", line).groups()
        test = value(int(i)) <= float(bound)
        yes = node()
        at += 1  # its Else
        return F.when(test, yes).otherwise(node())

    return node()


def limit(bins: list[tuple[float, float, float]], precision: float, support: int = 0) -> float | None:
    """Lowest score from which on the share of positives reaches ``precision``, from (score, candidates, positives);
    the share never falls with the score, as neighbours where it would are pooled, and a block's share counts its
    score as one candidate more.  None if no block reaches it, or fewer than ``support`` positives lie there."""
    blocks: list[list[float]] = []
    for p, n, good in sorted(bins):
        blocks.append([p, p * n, n, good])
        while len(blocks) > 1 and blocks[-2][3] * blocks[-1][2] >= blocks[-1][3] * blocks[-2][2]:
            _, mass, n, good = blocks.pop()
            blocks[-1][1:] = [blocks[-1][1] + mass, blocks[-1][2] + n, blocks[-1][3] + good]
    over = [b for b in blocks if (b[3] + b[1] / b[2]) / (b[2] + 1) >= precision]
    return over[0][0] if over and sum(b[3] for b in over) >= support else None


def fit(rows: DataFrame, precision: float = 0.95, trees: int = 10, depth: int = 4):
    """(score(span) -> Column, threshold by kind) from candidates()'s rows with ``held`` (not fitted on), or None."""
    both = rows.select("held", F.explode(F.concat("base", "other")).alias("s"))
    sure = F.col("s.proposed") & (F.col("s.fits") == 1) & (F.col("s.cue") == 1) & (F.col("s.counter") == 0)
    counted = cut(both.groupBy("held", "s.no", *[f"s.{f}" for f in FEATURES], "s.proposed", (F.col("s.base") | sure).cast("int").alias("label"))
                  .agg(F.count("*").cast("double").alias("weight")), "pii-bins")
    fitted = counted.where(~F.col("held"))
    if {r.label for r in fitted.select("label").distinct().collect()} != {0, 1}:
        return None
    names = ["no", *FEATURES]
    bins = fitted.groupBy(*names, "label").agg(F.sum("weight").alias("weight")).coalesce(1).sortWithinPartitions(*names, "label")  # one row a bin
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(bins)
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=7, weightCol="weight", labelCol="label").fit(vectors)

    def score(span) -> Column:
        total = F.lit(0.0)
        for tree, weight in zip(model.trees, model.treeWeights):
            total = total + float(weight) * _tree(tree.toDebugString, lambda i: span[names[i]])
        return 1 / (1 + F.exp(-2 * total))

    asked = counted.where("held and proposed").select("no", F.round(score(counted), 3).alias("p"), "label", "weight")
    found = asked.groupBy("no", "p").agg(F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("label")).alias("good")).collect()  # at most 1,001 a kind
    limits = {}
    for no in range(len(KINDS)):
        least = limit([(r.p, r.n, r.good) for r in found if r.no == no], precision)
        if least is not None:
            limits[no] = least
    return score, limits


def scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), precision: float = 0.95) -> DataFrame:
    """``keep`` columns, base and spans (arrays of SPAN) per row."""
    own = docs.select(*[F.col(c).alias(f"k_{c}") for c in keep], F.col("text").alias("text"))
    held = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(4)) == 0
    rows = cut(candidates(own).select(*[f"k_{c}" for c in keep], held.alias("held"), "base", "other"), "pii-rows")
    names = [F.col(f"k_{c}").alias(c) for c in keep]
    fitted = fit(rows, precision)
    if fitted is None or not fitted[1]:
        return rows.select(*names, "base", F.col("base").alias("spans"))
    score, limits = fitted

    def chosen(s: Column) -> Column:
        least = F.lit(2.0)
        for no, bound in limits.items():
            least = F.when(s["no"] == no, bound).otherwise(least)
        return s["proposed"] & (F.round(score(s), 3) >= least)

    free = lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (b["end"] > s["start"]))
    added = F.when(F.size("other") > 0, F.filter("other", lambda s: chosen(s) & free(s))).otherwise(F.array().cast(SPAN))
    return rows.select(*names, "base", F.array_distinct(F.array_sort(F.concat("base", added))).alias("spans"))


def redact(docs: DataFrame, **settings) -> DataFrame:
    """The documents with every span replaced by ``<PII:KIND>``; rows keep their order in no way."""
    keep = tuple(docs.columns)
    found = scan(docs.withColumnsRenamed({c: f"k{i}" for i, c in enumerate(keep)}).withColumn("text", F.col(f"k{keep.index('text')}")),
                 keep=tuple(f"k{i}" for i in range(len(keep))), **settings)
    found = found.withColumn("__spans", merged(F.col("spans")))
    return found.select(*[F.when(F.size("__spans") > 0, redacted(F.col(f"k{i}"), F.col("__spans"), "PII")).otherwise(F.col(f"k{i}")).alias(c)
                          if c == "text" else F.col(f"k{i}").alias(c) for i, c in enumerate(keep)])


def digest(found: DataFrame) -> DataFrame:
    """Columns of the query from scan()'s rows."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS], F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
                        span_text(F.col("spans")).alias("spans"))
