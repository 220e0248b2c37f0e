"""The two places where Spark has no built-in: Unicode NFKD and the recursive
paired-tag removal.  Both are Arrow-batched UDFs (one Arrow crossing
per batch, never per row) and work on a string or on an array of strings, so
an article's paragraphs are cleaned in place without an explode / regroup
shuffle."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf, pandas_udf
from pyspark.sql.types import ArrayType, StringType

# FIXED VALUE of the paired-tag contract: <(.*?)(?: .*?)?>(.*?)</(\1)>, where "." stops at
# newlines, so no pair spans a line break.
_REF = re.compile(r"&(?:#([0-9]+)|#[xX]([0-9a-fA-F]+)|(lt|gt|quot|apos|amp));")
_NAMED = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&"}


def _strip_line(line: str) -> str:
    """Paired tags of one line.  The tag of an opening ``<`` ends at the next
    ``>``; its name is the shortest prefix, up to a space or that ``>``, that a
    later ``</name>`` closes (a longer name would contain ``>`` and so a shorter
    one that closes).  Closings are indexed by name once, and open pairs are kept
    on a stack with the position that bounds them."""
    closings: dict[str, list[int]] = {}
    at = line.find("</")
    while at >= 0:
        end = line.find(">", at + 2)
        if end < 0:
            break
        closings.setdefault(line[at + 2:end], []).append(at)
        at = line.find("</", at + 1)
    if not closings:
        return line
    last = max(found[-1] for found in closings.values())
    names = sorted(closings)
    cuts: list[tuple[int, int]] = []
    bounds = [(len(line), len(line))]  # (end of the region, where the outer one goes on)
    pos, q = 0, -1
    while bounds:
        high, resume = bounds[-1]
        i = line.find("<", pos, high)
        if i >= 0 and q <= i:
            q = line.find(">", i + 1)
            q = len(line) if q < 0 else q
        if i < 0 or q >= min(high, last):
            bounds.pop()
            pos = resume
            continue
        pos = i + 1
        p = i
        while p < q:
            space = line.find(" ", p + 1, q)
            p = space if space >= 0 else q
            name = line[i + 1:p]
            near = bisect_left(names, name)
            if near == len(names) or not names[near].startswith(name):
                break
            found = closings.get(name, ())
            k = bisect_left(found, q + 1)
            if k < len(found) and found[k] + len(name) + 3 <= high:
                close = found[k]
                after = close + len(name) + 3
                cuts += [(i, q + 1), (close, after)]
                bounds.append((close, after))
                pos = q + 1
                break
    if not cuts:
        return line
    kept, at = [], 0
    for start, end in sorted(cuts):
        kept.append(line[at:start])
        at = end
    return "".join(kept) + line[at:]


def strip_paired_tags_py(text: str | None) -> str | None:
    """Replace each paired tag by its inner text, cleaning only the inner text
    again (not the result of the replacement).  No recursion: deep nesting and
    long lines are bounded by the text's length."""
    if text is None or "</" not in text:
        return text
    return "\n".join(map(_strip_line, text.split("\n")))


def decode_refs_py(text: str) -> str:
    """Character references and the five XML entities, each decoded once.
    References to characters that XML forbids stay as they are."""
    def decoded(m: re.Match) -> str:
        if m.group(3):
            return _NAMED[m.group(3)]
        digits, base = (m.group(1), 10) if m.group(1) else (m.group(2), 16)
        digits = digits.lstrip("0")
        n = int(digits, base) if 0 < len(digits) <= 7 else 0
        legal = n in (9, 10, 13) or 0x20 <= n < 0xD800 or 0xE000 <= n < 0xFFFE or 0x10000 <= n < 0x110000
        return chr(n) if legal else m.group(0)

    return _REF.sub(decoded, text) if "&" in text else text


def clean_text_py(text: str | None) -> str | None:
    """NFKD, then paired-tag removal (strip is done natively afterwards)."""
    if text is None:
        return None
    return strip_paired_tags_py(unicodedata.normalize("NFKD", text))


def _map_strings(s: pd.Series, fn) -> pd.Series:
    return s.map(lambda v: None if v is None else fn(v))


#: Strings that are Python objects at a time; a batch of articles has its texts in Arrow's buffers otherwise.
SLICE = 512


def _map_arrays(s: pa.Array, fn) -> pa.Array:
    """``fn`` on every element of a list array, slice by slice of the elements."""
    flat, size = s.flatten(), pc.fill_null(pc.list_value_length(s), 0)
    done = [pa.array([None if v is None else fn(v) for v in flat.slice(i, SLICE).to_pylist()], pa.string()) for i in range(0, len(flat), SLICE)]
    ends = np.concatenate([[0], np.cumsum(size.to_numpy(zero_copy_only=False))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays(done) if done else pa.array([], pa.string()), mask=s.is_null())


@pandas_udf(StringType())
def _nfkd(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFKD")


@pandas_udf(StringType())
def _strip_tags(s: pd.Series) -> pd.Series:
    return _map_strings(s, strip_paired_tags_py)


@pandas_udf(StringType())
def _clean(s: pd.Series) -> pd.Series:
    return _map_strings(s, clean_text_py)


@arrow_udf(ArrayType(StringType()))
def _clean_array(s: pa.Array) -> pa.Array:
    return _map_arrays(s, clean_text_py)


@arrow_udf(ArrayType(StringType()))
def _clean_markup(s: pa.Array) -> pa.Array:
    return _map_arrays(s, lambda v: clean_text_py(decode_refs_py(v)))


@pandas_udf(StringType())
def _char_refs(s: pd.Series) -> pd.Series:
    return _map_strings(s, decode_refs_py)


def nfkd(col) -> Column:
    """Unicode NFKD normalisation."""
    return _nfkd(F.col(col) if isinstance(col, str) else col)


def strip_paired_tags(col) -> Column:
    """T9 exact: recursive paired-tag removal."""
    return _strip_tags(F.col(col) if isinstance(col, str) else col)


def clean_udf(col) -> Column:
    """T10 then T9 on one string, in a single Arrow crossing."""
    return _clean(F.col(col) if isinstance(col, str) else col)


def clean_array_udf(col) -> Column:
    """T10 then T9 on every element of an ``array<string>``."""
    return _clean_array(F.col(col) if isinstance(col, str) else col)


def clean_markup_udf(col) -> Column:
    """T8b, T10 and T9 on every element of an ``array<string>`` of markup text
    (tags already dropped, references not yet decoded), in one crossing."""
    return _clean_markup(F.col(col) if isinstance(col, str) else col)


def decode_char_refs(col) -> Column:
    """T8b in full: character references (``&#233;``, ``&#xE9;``) and the five
    named entities, each once (``&#38;lt;`` gives ``&lt;``)."""
    return _char_refs(F.col(col) if isinstance(col, str) else col)
