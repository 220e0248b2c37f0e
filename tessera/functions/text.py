"""Column -> Column string functions (all JVM-side built-ins).

Regex dialect notes: Spark uses java.util.regex.  ``(?d)`` (UNIX_LINES) makes
``.`` stop only at ``\\n`` as Python's ``.`` does.  Shared patterns avoid
``(?U)`` because it means "Unicode classes" in Java but "ungreedy" in RE2.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import TAG_ENTITIES

# Word, number or symbol run; every non-whitespace character lands in a token.
TOKEN_PATTERN = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+"
# Python's str.strip() removes Unicode white space and the separators \x1c-\x1f.
_WS = r"[\t\n\x0B\f\r\x1c-\x1f \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tokenize(col) -> Column:
    """K1: word / number / symbol tokens, in text order."""
    return F.regexp_extract_all(_c(col), F.lit(TOKEN_PATTERN), 0)


def count_tokens(col) -> Column:
    """Number of K1 tokens, counted without materialising them."""
    return F.regexp_count(_c(col), F.lit(TOKEN_PATTERN))


def explode_nonempty(col) -> Column:
    """``explode`` for computed arrays.  Plain ``explode`` makes Catalyst infer
    a ``size(array) > 0`` filter that re-evaluates the whole array expression
    (a second regex pass over the text); ``explode_outer`` does not, and the
    single null row of an empty array is dropped by the caller."""
    return F.explode_outer(_c(col))


def posexplode_nonempty(col) -> Column:
    """``posexplode_outer`` for computed arrays (see :func:`explode_nonempty`);
    drop the ``pos IS NULL`` row of an empty array afterwards."""
    return F.posexplode_outer(_c(col))


def rtrim_ws(col) -> Column:
    """Right strip of Unicode white space (Python ``rstrip``)."""
    return F.regexp_replace(_c(col), _WS + r"+\z", "")


def strip_ws(col) -> Column:
    """Strip Unicode white space on both ends (Python ``strip``)."""
    return F.regexp_replace(_c(col), r"\A" + _WS + "+|" + _WS + r"+\z", "")


def strip_chars(col, chars: str) -> Column:
    """Strip any of ``chars`` at both ends, repeatedly."""
    return F.btrim(_c(col), F.lit(chars))


def unescape_tags(col, mapping=TAG_ENTITIES) -> Column:
    """T5: entity replacement in map order; ``&amp;gt;`` is left alone."""
    out = _c(col)
    for src, dst in mapping:
        out = F.replace(out, F.lit(src), F.lit(dst))
    return out


def decode_entities(col) -> Column:
    """T8b, named entities only, ``&amp;`` last; with character references too:
    :func:`tessera.functions.udfs.decode_char_refs`."""
    out = _c(col)
    for src, dst in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"),
                     ("&amp;", "&")]:
        out = F.replace(out, F.lit(src), F.lit(dst))
    return out


def drop_script_style(col) -> Column:
    """Remove ``<script>`` and ``<style>`` elements (they may hold ``</p>``)."""
    out = F.regexp_replace(_c(col), r"(?is)<script\b[^>]*>.*?</script\s*>", "")
    return F.regexp_replace(out, r"(?is)<style\b[^>]*>.*?</style\s*>", "")


def first_element(col, tag: str) -> Column:
    """Inner markup of the first ``<tag>`` element ('' when absent)."""
    return F.regexp_extract(_c(col), rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>", 1)


def has_element(col, tag: str) -> Column:
    return _c(col).rlike(rf"(?s)<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>")


def elements(col, tag: str) -> Column:
    """Inner markup of every ``<tag>`` element in document order; an element
    runs lazily up to the next closing tag."""
    return F.regexp_extract_all(_c(col), F.lit(rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>"), 1)


def inner_text(col) -> Column:
    """Descendant text of a markup fragment (all tags dropped)."""
    return F.regexp_replace(_c(col), r"<[^>]+>", "")


# Marks around inner texts, noncharacters of Unicode, which no text may hold.
_OPEN, _CLOSE = "\ufdd0", "\ufdd1"


def _pair_pattern(text: Column) -> Column:
    """The paired-tag contract ``<(.*?)(?: .*?)?>(.*?)</(\\1)>`` (fixed value; "." is any character but the line feed)
    for one text: a name holds no ``>``, or its part before that would be a shorter name that closes, so it is
    one of the closing tags' names, shortest first, and the tag ends at the next ``>``."""
    names = F.array_distinct(F.regexp_extract_all(text, F.lit("(?=</([^>\\n]*)>)"), F.lit(1)))
    names = F.array_sort(names, lambda a, b: F.length(a) - F.length(b))
    quoted = F.transform(names, lambda x: F.concat(F.lit("\\Q"), F.replace(x, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E")))
    return F.concat(F.lit("<("), F.array_join(quoted, "|"), F.lit(f")(?: [^>\\n{_OPEN}{_CLOSE}]*+)?>([^\\n{_OPEN}{_CLOSE}]*?)</\\1>"))


def paired_tags(col) -> Column:
    """Each paired tag replaced by its inner text, and only inner texts cleaned again.  One pass replaces the
    leftmost pairs and leaves marks around their inner texts; no later match crosses a mark, so the next pass works
    on the inner texts alone (what lies outside had no match before and has none now).  The fold ends when a pass
    changes nothing; it is as deep as the tags are nested, at most the number of closing tags."""
    text = F.translate(_c(col), _OPEN + _CLOSE, "")
    closings = F.regexp_count(_c(col), F.lit("</[^>\\n]*>"))
    zero = F.struct(text.alias("s"), _pair_pattern(text).alias("p"), F.lit(False).alias("done"))

    def step(acc, _):
        new = F.regexp_replace(acc["s"], acc["p"], F.lit(f"{_OPEN}$2{_CLOSE}"))
        return F.when(acc["done"], acc).otherwise(F.struct(new.alias("s"), acc["p"].alias("p"), (new == acc["s"]).alias("done")))

    folded = F.aggregate(F.sequence(F.lit(1), closings), zero, step, lambda acc: F.translate(acc["s"], _OPEN + _CLOSE, ""))
    return F.when(closings > 0, folded).otherwise(_c(col))


def split_part(col, sep_regex: str, idx: int) -> Column:
    """1-based piece of a split, null when missing (ANSI safe)."""
    return F.try_element_at(F.split(_c(col), sep_regex), F.lit(idx))


def split_sentences(col) -> Column:
    """Sentences end after ``.!?`` followed by white space, or at newlines;
    empty pieces are dropped."""
    parts = F.split(_c(col), r"(?<=[.!?])\s+|\n+")
    return F.filter(parts, lambda s: F.length(s) > 0)


def truncate_at_punct(col) -> Column:
    """Cut a completion after its first punctuation mark."""
    return F.regexp_extract(_c(col), r"^[^.,;:!?]*[.,;:!?]?", 0)


def split_task_code(col) -> tuple[Column, Column]:
    """``CLS-Books`` -> (``cls``, ``Books``); codes without a second part
    give a null subtask."""
    parts = F.split(_c(col), "-")
    return F.lower(F.try_element_at(parts, F.lit(1))), F.try_element_at(parts, F.lit(2))


def normalize_split(col) -> Column:
    """File path -> split: the last path component named ``valid_0``,
    ``test_0`` or ``train_0`` (optionally ``.xlm`` and an extension, or as the
    value of a ``key=value`` directory) gives ``dev``, ``test`` or ``train``;
    other names give null."""
    stem = F.regexp_extract(_c(col), r"(?:^|/|=)(train|valid|test)_0(?:\.xlm)?(?:\.[A-Za-z0-9]+)*(?:/[^/]*)?$", 1)
    return (F.when(stem == "valid", F.lit("dev"))
            .when(stem == "train", F.lit("train"))
            .when(stem == "test", F.lit("test")))


def run_key(seed, lr, bs) -> Column:
    """Run key from its columns (no path nesting, see README D16)."""
    return F.format_string("%d_%.1e_%d", _c(seed), _c(lr), _c(bs))


def md5_order_key(seed: int, key) -> Column:
    """Seeded, engine-independent order key: md5('<seed>:<key>')."""
    return F.md5(F.concat(F.lit(f"{seed}:"), _c(key).cast("string")))


def md5_unit(*parts) -> Column:
    """Deterministic u in [0, 1) from the first 32 bits of md5 of the parts."""
    s = F.concat_ws(":", *[_c(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
