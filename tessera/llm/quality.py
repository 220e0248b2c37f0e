"""Quality rules and robust multivariate outliers, in DataFrame operations only.

Base rules count words, symbols, repeated lines and repeated word windows in
the whole text.  The others are judged by a vector of transformed statistics:
per language and source, a minimum-covariance-determinant estimate of centre
and scatter starts from histogram medians and repeats concentration steps (the
``support`` share of rows with the least distance gives the next estimate);
rows beyond the chi-square quantile of ``alpha`` are rejected.

Groups with fewer than ``min_group`` rows use their language's estimate, and
languages with fewer the corpus's.  All estimates are sums, combined before the
shuffle, and the quantiles come from fixed bins, so a group of any size costs
one row a task.  Variances have a floor, so constant statistics do no harm.
3-word windows are compared by their 64-bit hash.

Null and empty texts have no words and fail.  A null language or source is a
value of its own.  Repeated rows are judged alike.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, cut, words

SYMBOLS = "#*$%&|<>"
UPPER = "".join(map(chr, (*range(0x41, 0x5B), *range(0xC0, 0xD7), *range(0xD8, 0xDF))))
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Statistics of the vector, and the least standard deviation each is taken to have.
FLOORS = {"length": 0.06, "symbols": 0.25, "capitals": 0.25, "lines": 0.5, "repeats": 0.5}
DIM = tuple(FLOORS)
BIN = 16  # bins of distance: 16 for each doubling


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the base counts and the vector's statistics (length ... repeats)."""
    df = docs.withColumn("__t", F.coalesce(F.col(text), F.lit("")))
    t = F.col("__t")
    df = df.withColumn("__w", words(t)).withColumn("n_words", F.size("__w").cast("long"))
    w = F.col("__w")
    windows = F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - 2, F.lit(1))),
                          lambda i: F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)))
    df = df.withColumn("__h", F.when(F.size(w) >= 3, windows).otherwise(F.array().cast("array<bigint>")))
    # only texts with a window found twice are sorted
    pairs = F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = df.withColumn("__s", F.when(F.size(F.array_distinct("__h")) < F.size("__h"), F.sort_array(pairs))
                       .otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    s = F.col("__s")
    again = F.filter(F.transform(s, lambda x, j: F.when(
        F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)), x["i"])),
        lambda i: i.isNotNull())
    covered = F.size(F.array_distinct(F.flatten(F.transform(again, lambda i: F.array(i, i + 1, i + 2)))))
    df = df.withColumn("n_repeat_words", F.when(F.size(s) > 0, covered).otherwise(0).cast("long"))
    df = df.withColumn("__l", F.filter(F.split(t, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    bare = lambda chars: F.length(F.translate(t, chars, ""))
    df = (df.withColumn("n_dup_lines", (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"))
          .withColumn("word_chars", bare(BLANKS).cast("long")).withColumn("n_symbols", (F.length(t) - bare(SYMBOLS)).cast("long")))
    n, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return (df.withColumn("length", F.log1p(F.col("word_chars") / n)).withColumn("symbols", F.log1p(100 * F.col("n_symbols") / chars))
            .withColumn("capitals", F.log1p(100 * (F.length(t) - bare(UPPER)) / chars))
            .withColumn("lines", F.log1p(20 * F.col("n_dup_lines") / F.greatest(F.size("__l"), F.lit(1))))
            .withColumn("repeats", F.log1p(20 * F.col("n_repeat_words") / n)).drop("__t", "__w", "__h", "__s", "__l"))


def base_failed(min_words: int = 50, max_repeat: int = 50) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))


def chi_square(alpha: float, d: int) -> float:
    """Upper ``alpha`` quantile of chi-square with d degrees of freedom (Wilson and Hilferty)."""
    z = NormalDist().inv_cdf(1 - alpha)
    return d * (1 - 2 / (9 * d) + z * (2 / (9 * d)) ** 0.5) ** 3


def _factors(df: DataFrame) -> DataFrame:
    """Means and covariances (m_i, c_i_j) as columns a_i_j, e_i of the LDL' factorisation."""
    for i, x in enumerate(DIM):
        for j in range(i):
            v = F.col(f"c_{i}_{j}")
            for k in range(j):
                v = v - F.col(f"a_{i}_{k}") * F.col(f"a_{j}_{k}") * F.col(f"e_{k}")
            df = df.withColumn(f"a_{i}_{j}", v / F.col(f"e_{j}"))
        v = F.col(f"c_{i}_{i}") + F.lit(FLOORS[x] ** 2)
        for k in range(i):
            v = v - F.col(f"a_{i}_{k}") * F.col(f"a_{i}_{k}") * F.col(f"e_{k}")
        df = df.withColumn(f"e_{i}", F.greatest(v, F.lit(FLOORS[x] ** 2)))
    return df


def _with_distance(df: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance ``d2`` by forward substitution."""
    for i, x in enumerate(DIM):
        y = F.col(x) - F.col(f"m_{i}")
        for k in range(i):
            y = y - F.col(f"a_{i}_{k}") * F.col(f"y_{k}")
        df = df.withColumn(f"y_{i}", y)
    total = sum((F.col(f"y_{i}") * F.col(f"y_{i}") / F.col(f"e_{i}") for i in range(1, len(DIM))), F.col("y_0") * F.col("y_0") / F.col("e_0"))
    return df.withColumn("d2", total).drop(*[f"y_{i}" for i in range(len(DIM))])


def _moments(df: DataFrame) -> DataFrame:
    sums = [F.avg(x).alias(f"m_{i}") for i, x in enumerate(DIM)]
    sums += [F.covar_pop(x, y).alias(f"c_{i}_{j}") for i, x in enumerate(DIM) for j, y in enumerate(DIM[:i + 1])]
    return df.groupBy("g").agg(*sums)


def _quantile(df: DataFrame, keys: list[str], value: str, share: float, out: str) -> DataFrame:
    """(keys, out): upper edge of the fixed bin that holds the quantile; counts are combined first."""
    bins = df.groupBy(*keys, F.col(value).alias("__b")).agg(F.count("*").alias("__n"))
    over = f"partition by {', '.join(keys)}"
    ranked = bins.select(*keys, "__b", F.expr(f"sum(__n) over ({over} order by __b) as __c"), F.expr(f"sum(__n) over ({over}) as __t"))
    return ranked.where(F.col("__c") >= share * F.col("__t")).groupBy(*keys).agg(F.min("__b").alias(out))


def estimate(rows: DataFrame, support: float = 0.75, steps: int = 3) -> DataFrame:
    """(g, m_i, a_i_j, e_i): estimates by group from rows (g, statistics)."""
    long = rows.select("g", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.floor(F.col(x) * 64).alias("v"))
                                                for i, x in enumerate(DIM)])).alias("s")).select("g", "s.*")
    mid = cut(_quantile(long, ["g", "i"], "v", 0.5, "q").groupBy("g").agg(
        *[((F.max(F.when(F.col("i") == i, F.col("q"))) + 0.5) / 64).alias(f"m_{i}") for i in range(len(DIM))]), "q-mid")
    off = long.join(mid, "g")
    centre = sum((F.when(F.col("i") == i, F.col(f"m_{i}")).otherwise(0.0) for i in range(1, len(DIM))),
                 F.when(F.col("i") == 0, F.col("m_0")).otherwise(0.0))
    spread = _quantile(off.select("g", "i", F.floor(F.abs((F.col("v") + 0.5) / 64 - centre) * 64).alias("a")), ["g", "i"], "a", 0.5, "q")
    # 1.4826: the normal law's standard deviation in median absolute deviations
    start = mid.join(spread.groupBy("g").agg(*[F.pow(1.4826 * F.max(F.when(F.col("i") == i, F.col("q"))) / 64, F.lit(2)).alias(f"c_{i}_{i}")
                                               for i in range(len(DIM))]), "g")
    for i in range(len(DIM)):
        for j in range(i):
            start = start.withColumn(f"c_{i}_{j}", F.lit(0.0))
    now = cut(_factors(start), "q-start")
    for _ in range(steps):
        near = _with_distance(rows.join(now, "g")).select("g", *DIM, F.floor(F.log2(F.col("d2") + 1e-6) * BIN).alias("b"))
        edge = cut(_quantile(near, ["g"], "b", support, "q"), "q-edge")
        now = cut(_factors(_moments(near.join(edge, "g").where(F.col("b") <= F.col("q")).select("g", *DIM))), "q-step")
    return now


def judge(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), language: str = "lang", source: str = "source", alpha: float = 1e-7,
          min_group: int = 200, support: float = 0.75, steps: int = 3) -> DataFrame:
    """``keep`` columns, the base counts, base_failed, d2 (null where not judged) and kept."""
    own = docs.select(*[F.col(c).alias(f"k_{c}") for c in keep], F.col("text").alias("text"),
                      F.coalesce(F.col(language).cast("string"), F.lit("\x00")).alias("l"),
                      F.coalesce(F.col(source).cast("string"), F.lit("\x00")).alias("s"))
    rows = cut(statistics(own).drop("text").withColumn("base_failed", base_failed()), "q-rows")
    judged = rows.where(~F.col("base_failed"))
    sizes = judged.groupBy("l", "s").agg(F.count("*").alias("n"))
    langs = sizes.groupBy("l").agg(F.sum("n").alias("nl"))
    group = (F.when(F.col("n") >= min_group, F.struct(F.col("l").alias("l"), F.col("s").alias("s")))
             .when(F.col("nl") >= min_group, F.struct(F.col("l").alias("l"), F.lit(None).cast("string").alias("s")))
             .otherwise(F.struct(F.lit(None).cast("string").alias("l"), F.lit(None).cast("string").alias("s"))))
    groups = cut(sizes.join(langs, "l").select("l", "s", F.to_json(group).alias("g")), "q-groups")
    base = judged.select("l", "s", *DIM).join(groups, ["l", "s"])
    # an estimate of a language or the corpus uses all of its rows
    levels = F.array_distinct(F.array(F.col("g"), F.to_json(F.struct(F.col("l").alias("l"), F.lit(None).cast("string").alias("s"))),
                                      F.to_json(F.struct(F.lit(None).cast("string").alias("l"), F.lit(None).cast("string").alias("s")))))
    used = groups.select("g").distinct()
    fitted = estimate(base.withColumn("g", F.explode(levels)).join(used, "g", "left_semi").select("g", *DIM), support, steps)
    limit = chi_square(alpha, len(DIM))
    scored = _with_distance(rows.join(groups, ["l", "s"], "left").join(fitted, "g", "left"))
    kept = ~F.col("base_failed") & F.coalesce(F.col("d2") <= limit, F.lit(True))
    return scored.select(*[F.col(f"k_{c}").alias(c) for c in keep], *BASE, "base_failed",
                         F.when(~F.col("base_failed"), F.col("d2")).alias("d2"), kept.alias("kept"))
