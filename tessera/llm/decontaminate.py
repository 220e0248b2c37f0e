"""Benchmark decontamination by canonical templates.

Numbers, names and units of a text become typed placeholders; windows of the
placeholder text are hashed and joined by hash with the benchmark's windows.
Windows that match on one diagonal (document position less item position) give
pairs of slot values.  On a diagonal an item value stands for the document value
it meets at most places, and for none if two are level; only windows that keep
to this count, which tells a question asked again with other numbers from
chance.  A document leaks an item if such windows cover ``min_cover`` of the
item's windows.

Every window is also filed with its surface words, so that one with too few
plain words to tell a question by (``least``) still matches a verbatim copy.  The
cover is the larger of two: over the windows with enough plain words, and over
all.  Items of fewer than ``MIN_ITEM`` tokens are not filed, as a word alone
would match anywhere; ``unfiled`` lists them and ``leaks`` logs their number.

The benchmark's words (a set, or a bit table beyond ``WORDS_HELD``) and a bit table
of fixed size (``2^bits``) of its windows spare the join the windows that cannot
match; the hash join and a comparison of the template itself decide.  Texts are
worked on many at a time, as arrays of token numbers, and only their stretches
without a plain word that the benchmark lacks.

A capital at a sentence start may begin a sentence or a name, so windows of items
and of documents are taken with each such word as itself and as a name; a
window counts once.

Null and empty texts or items match nothing.  An item shorter than a window is
one window of its own length.  Items of equal text are one item: the least id
stands for it and ``item_ids`` lists all (null ids last to be chosen).
Repeated documents give repeated rows.
"""

from __future__ import annotations

import logging
import re
from array import array
from collections import Counter
from collections.abc import Container, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, small_batches, text_key

WINDOW = 8
MIN_LITERALS = 4
MIN_COVER = 0.5
#: Tokens an item needs to be filed: a single word is in every other document.
MIN_ITEM = 2
TABLE_BITS = 24

NUMBER, NAME, UNIT = "<num>", "<name>", "<unit>"
SLOTS = {NUMBER, NAME, UNIT}
#: Units that count as a slot after a number.
UNITS = frozenset("""mm cm m km in ft yd mi mg g kg lb lbs oz t ml cl l gal s sec secs min mins h hr hrs ms
 second seconds minute minutes hour hours day days week weeks month months year years meter meters metre metres
 kilometer kilometers kilometre kilometres mile miles foot feet inch inches yard yards gram grams kilogram kilograms
 pound pounds ounce ounces ton tons liter liters litre litres gallon gallons dollar dollars cent cents euro euros
 percent degree degrees kmh mph kph hz khz mhz ghz w kw kwh v a j kj k c f""".split())
TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+(?:['’-][^\W\d_]+)*|[.!?\n]")
_P = np.uint64(0x9E3779B97F4A7C15)
_HASHES: dict[str, int] = {}

#: ``slots``: which of the window's tokens are placeholders; ``rich``: has enough plain words.
WINDOW_ROW = "pos int, h long, template string, tokens array<string>, slots array<int>, rich boolean"
ROWS = f"array<struct<{WINDOW_ROW.replace(' ', ':').replace(',:', ',')}>>"
_LOG = logging.getLogger(__name__)


def canonical(text: str | None) -> tuple[list[str], list[str], list[int]]:
    """(tokens in lower case, the same with placeholders, which may be names: capitals at a sentence start)."""
    surface, shape, capitals = [], [], []
    start, after_number = True, False
    for t in TOKEN.findall(text or ""):
        if t in ".!?\n":
            start = True
            continue
        low = t.lower()
        if t[0].isdigit():
            c = NUMBER
        elif after_number and low in UNITS:
            c = UNIT
        elif t[0].isupper():
            c = low if start else NAME
            if start:
                capitals.append(len(shape))
        else:
            c = low
        surface.append(low), shape.append(c)
        start, after_number = False, c == NUMBER
    return surface, shape, capitals


def _hash(token: str) -> int:
    h = _HASHES.get(token)
    if h is None:
        if len(_HASHES) > 200_000:
            _HASHES.clear()
        h = _HASHES[token] = xxhash.xxh64_intdigest(token)
    return h


_SLOT_OF = {_hash(c): c for c in SLOTS}


def _codes(tokens: list[str]) -> np.ndarray:
    return np.fromiter(map(_hash, tokens), dtype="<u8", count=len(tokens))


def _mixed(out: np.ndarray) -> np.ndarray:
    return (out ^ out >> np.uint64(29)).view("<i8")


def _rolled(one: np.ndarray, width: int) -> np.ndarray:
    """Sums of every window, to be mixed; linear in the tokens' codes."""
    n = len(one) - width + 1
    if n < 1 or width < 1:
        return np.empty(0, dtype="<u8")
    out = np.full(n, np.uint64(width))
    for k in range(width):
        out = out * _P + one[k:k + n]
    return out


def hashes(shape: list[str], width: int) -> np.ndarray:
    """Signed 64-bit hash of every window of ``width`` tokens."""
    return _mixed(_rolled(_codes(shape), width))


def _named(one: np.ndarray, sums: np.ndarray, capitals: list[int], width: int, spare: np.ndarray):
    """(window, which of its tokens are taken as names as bits, hash) of windows
    with some of their ``capitals`` taken as names, at most ``spare[window]``."""
    delta = np.zeros(len(one), dtype="<u8")
    delta[capitals] = np.uint64(_hash(NAME)) - one[capitals]
    is_capital = np.zeros(len(one), dtype=bool)
    is_capital[capitals] = True
    n = len(sums)
    some = np.flatnonzero(np.convolve(is_capital, np.ones(width, dtype=int))[width - 1:width - 1 + n])
    some = some[spare[some] > 0]
    power = [np.uint64(pow(int(_P), width - 1 - k, 1 << 64)) for k in range(width)]
    for part in range(0, len(some), 4096):  # a window has up to 2^width forms
        at = some[part:part + 4096]
        bits, total, left = np.zeros(len(at), dtype="<i8"), sums[at], spare[at]
        for k in range(width):
            more = np.flatnonzero(is_capital[at + k] & (left > 0))
            if len(more):
                added = at[more]
                at, bits = np.concatenate([at, added]), np.concatenate([bits, bits[more] | 1 << k])
                total, left = np.concatenate([total, total[more] + delta[added + k] * power[k]]), np.concatenate([left, left[more] - 1])
        new = np.flatnonzero(bits)
        yield at[new], bits[new], _mixed(total[new])


def _spare(shape: list[str], width: int, least: int) -> np.ndarray:
    """For every window, how many plain words it has over those it needs."""
    plain = np.fromiter((c not in SLOTS for c in shape), dtype=int, count=len(shape))
    return np.convolve(plain, np.ones(width, dtype=int))[width - 1:len(shape)] - min(least, max(1, width // 2))


def _named_row(surface, shape, width, i, bits, h):
    """The row of window ``i`` with the tokens of ``bits`` taken as names; rich, as its plain form is."""
    form = [NAME if bits >> k & 1 else c for k, c in enumerate(shape[i:i + width])]
    return {"pos": int(i), "h": int(h), "template": " ".join(form), "tokens": surface[i:i + width],
            "slots": [k for k, c in enumerate(form) if c in SLOTS], "rich": True}


def _rows(surface, shape, form, width, hs, at, least):
    """Rows of the windows ``at``, filed under the tokens of ``form``."""
    return [{"pos": int(i), "h": int(hs[i]), "template": " ".join(form[i:i + width]), "tokens": surface[i:i + width],
             "slots": [k for k in range(width) if shape[i + k] in SLOTS], "rich": _literal(shape, i, width, least)} for i in at]


def _literal(shape, i, width, least):
    return sum(c not in SLOTS for c in shape[i:i + width]) >= min(least, max(1, width // 2))


def item_windows(benchmark: DataFrame, width: int = WINDOW, least: int = MIN_LITERALS) -> DataFrame:
    """(item_id, item_ids, item_key, n_all, n_rich, width, pos, h, template,
    tokens, slots, rich): each window, with placeholders if it has enough plain
    words, and with its surface words."""

    @F.pandas_udf(f"struct<width:int,n_all:int,rows:{ROWS}>")
    def windows(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            surface, shape, capitals = canonical(text)
            w = min(width, len(shape)) if len(shape) >= MIN_ITEM else 0
            one = _codes(shape)
            sums = _rolled(one, w)
            hs = _mixed(sums)
            rich = [i for i in range(len(hs)) if _literal(shape, i, w, least)]
            rows = _rows(surface, shape, shape, w, hs, rich, least)
            done = set(rich)
            exact = [i for i in range(len(hs)) if i not in done or surface[i:i + w] != shape[i:i + w]]
            rows += _rows(surface, shape, surface, w, hashes(surface, w), exact, least)
            if capitals and w:
                for at, bits, named in _named(one, sums, capitals, w, _spare(shape, w, least)):
                    rows += [_named_row(surface, shape, w, *x) for x in zip(at, bits.tolist(), named)]
            out.append((w, len(hs), rows if w else []))
        return pd.DataFrame(out, columns=["width", "n_all", "rows"])

    items = (benchmark.where(F.col("text").isNotNull()).groupBy("text")
             .agg(F.min("item_id").alias("item_id"), F.sort_array(F.collect_set("item_id")).alias("item_ids")))
    n_rich = F.size(F.array_distinct(F.transform(F.filter("w.rows", lambda r: r["rich"]), lambda r: r["pos"])))
    return (items.select("item_id", "item_ids", "text", windows("text").alias("w"))
            .select("item_id", "item_ids", text_key(F.col("text")).alias("item_key"), "w.n_all", n_rich.alias("n_rich"), "w.width",
                    F.explode("w.rows").alias("r")).select("item_id", "item_ids", "item_key", "n_all", "n_rich", "width", "r.*"))


def _left_out(benchmark: DataFrame, windows: DataFrame) -> DataFrame:
    filed = windows.select(F.col("item_key").alias("__filed")).distinct()
    return benchmark.join(filed, text_key(F.col("text")) == F.col("__filed"), "left_anti")


def unfiled(benchmark: DataFrame, width: int = WINDOW, least: int = MIN_LITERALS) -> DataFrame:
    """The benchmark's rows that no document can match: null, empty or of fewer than ``MIN_ITEM`` tokens."""
    return _left_out(benchmark, item_windows(benchmark, width, least))


def bit_table(windows: DataFrame, bits: int = TABLE_BITS) -> bytes:
    """2^bits bits, set where a window's hash falls; its size never grows."""
    rows = (windows.groupBy(F.expr("shiftright(pmod(h, %d), 5)" % (1 << bits)).alias("i"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(h, 32) as int))")).alias("m")).collect())
    table = np.zeros(1 << (bits - 5), dtype="<u4")
    for r in rows:
        table[r.i] = r.m
    return table.tobytes()


PUNCT, DIGIT, UPPER, LOWER = range(4)
UNIT_FLAG, KNOWN_FLAG = 4, 8
#: Marks that may follow a word in its piece.
MARKS = ".,;:!?"
#: Words of the benchmark that a worker holds as a set; more are held as a bit table.
WORDS_HELD = 500_000
#: Texts that are worked on at a time.
TOGETHER = 256


class BitWords:
    """Words of a bit table: a set of fixed size that may hold others, too."""

    def __init__(self, table: bytes, bits: int):
        self.table, self.bits = table, bits

    def __contains__(self, word: str) -> bool:
        h = xxhash.xxh64_intdigest(word, 42) % (1 << self.bits)  # as Spark's xxhash64
        return bool(self.table[h >> 3] >> (h & 7) & 1)


class Lexicon:
    """Tokens by number, with lower case, hash and flags: kind, whether it may be a unit, whether it is one of the
    benchmark's ``words``.  Other plain words have no number of their own but ``PLAIN``, or ``CAPITAL`` with a capital:
    no window is hashed with them, unless as a name.  ``pieces`` remembers the tokens of all other pieces of a text between
    blanks; it is emptied between batches once it has ``most``."""

    PLAIN, CAPITAL = 0, 1

    def __init__(self, words: Container[str], most: int = 200_000):
        self.words, self.most = words, most
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.numbers: dict[str, int] = {}
        self.low, self.codes, self.flags = ["", ""], array("Q", [0, 0]), array("B", [LOWER, UPPER])
        self.mark = self.number(".")

    def number(self, t: str) -> int:
        n = self.numbers.get(t)
        if n is None:
            n, low = len(self.low), t.lower()
            kind = PUNCT if t in ".!?\n" else DIGIT if t[0].isdigit() else UPPER if t[0].isupper() else LOWER
            self.low.append(low)
            self.codes.append(_hash(low))
            self.flags.append(kind | (UNIT_FLAG if low in UNITS else 0) | (KNOWN_FLAG if low in self.words else 0))
            self.numbers[t] = n
        return n

    def tokens(self, piece: str) -> tuple[int, ...]:
        """Numbers of the piece's tokens."""
        out = self.pieces.get(piece)
        if out is None:
            word = piece.rstrip(MARKS)
            low = word.lower()
            if word.isalpha() and (word == low or low[1:] == word[1:]) and low not in self.words and low not in UNITS:
                one = self.PLAIN if word == low else self.CAPITAL  # a plain word, or one with a capital first
                return (one, self.mark) if len(word) < len(piece) and any(c in piece for c in ".!?") else (one,)
            out = self.pieces[piece] = tuple(map(self.number, TOKEN.findall(piece)))
        return out

    def words_in(self, piece: str) -> int:
        """How many tokens of the piece are no marks."""
        return 1 if piece.rstrip(MARKS).isalpha() else sum(self.flags[i] & 3 != PUNCT for i in self.tokens(piece))

    def fresh(self) -> Lexicon:
        return self if len(self.pieces) < self.most else Lexicon(self.words, self.most)


def pieces_of(text: str | None) -> list[str]:
    """A text between blanks: no token has a blank inside, and a line's end is a mark like a full stop."""
    return (text or "").replace("\n", " . ").split()


def regions(found: list[list[str]], lexicon: Lexicon, least: int) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
    """(pieces, text, place of the first token) of the stretches of ``least`` tokens or more without a plain word that
    the benchmark lacks, each with that word before it; no other window can match."""
    words, count = lexicon.words, lexicon.words_in
    flat = list(chain.from_iterable(found))
    # -1: a plain word that the benchmark lacks, one token; else the piece's tokens
    size = np.fromiter((1 if p in words else -1 if (q := p.rstrip(MARKS)).isalpha() and q.islower() and q not in words and q not in UNITS
                        else count(p) for p in flat), dtype=np.int64, count=len(flat))
    n = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    text, ends = np.repeat(np.arange(len(found)), n), np.cumsum(n)
    tokens = np.abs(size)
    before = np.cumsum(tokens) - tokens
    other = size < 0
    run = np.cumsum(other | (np.diff(text, prepend=-1) != 0))  # a run begins with a text or with such a word
    total = np.bincount(run, np.where(other, 0, size), int(run[-1]) + 1 if len(run) else 0)
    first = np.flatnonzero(np.diff(run, prepend=-1))
    first = first[total[run[first]] >= least]
    last = np.searchsorted(run, run[first], "right")
    own = text[first]
    base = before[np.minimum(ends - n, max(0, len(flat) - 1))] if len(flat) else np.zeros(len(found), np.int64)
    return [flat[i:j] for i, j in zip(first.tolist(), last.tolist())], own, before[first] - base[own]


@dataclass(frozen=True)
class Shapes:
    """The tokens of some texts end to end, without marks: number, piece it comes from, text, place in it, hash, hash
    with placeholders, and which are placeholders, capitals at a sentence start, words of the benchmark."""

    ids: np.ndarray
    piece: np.ndarray
    text: np.ndarray
    place: np.ndarray
    exact: np.ndarray
    one: np.ndarray
    slot: np.ndarray
    capital: np.ndarray
    known: np.ndarray
    pieces: list[str]

    def low(self, lexicon: Lexicon, start: int, stop: int) -> list[str]:
        """Tokens in lower case."""
        return [lexicon.low[i] or self.pieces[p].rstrip(MARKS).lower()
                for i, p in zip(self.ids[start:stop].tolist(), self.piece[start:stop].tolist())]


def shapes(found: list[list[str]], lexicon: Lexicon) -> Shapes:
    """:func:`canonical` of many texts, given by their pieces, at once."""
    pieces = list(chain.from_iterable(found))
    tokens = list(map(lexicon.tokens, pieces))
    n = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    each = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
    ids = np.fromiter(chain.from_iterable(tokens), dtype=np.int64, count=int(each.sum()))
    piece, text = np.repeat(np.arange(len(pieces)), each), np.repeat(np.repeat(np.arange(len(found)), n), each)
    flags = np.frombuffer(lexicon.flags, dtype=np.uint8)[ids]
    punct = flags & 3 == PUNCT
    start = np.ones(len(ids), dtype=bool)
    start[1:] = punct[:-1] | (text[1:] != text[:-1])
    keep = ~punct
    ids, piece, flags, text, start = ids[keep], piece[keep], flags[keep], text[keep], start[keep]
    number = flags & 3 == DIGIT
    unit = np.zeros(len(ids), dtype=bool)
    unit[1:] = number[:-1] & (text[1:] == text[:-1])
    unit &= ~number & (flags & UNIT_FLAG > 0)
    upper = (flags & 3 == UPPER) & ~unit
    exact = np.frombuffer(lexicon.codes, dtype="<u8")[ids]
    one = exact.copy()
    for mask, slot in ((number, NUMBER), (unit, UNIT), (upper & ~start, NAME)):
        one[mask] = _hash(slot)
    n = np.bincount(text, minlength=len(found))
    place = np.arange(len(ids)) - np.repeat(np.cumsum(n) - n, n)
    return Shapes(ids, piece, text, place, exact, one, number | unit | upper & ~start, upper & start, flags & KNOWN_FLAG > 0, pieces)


def _whole(mask: np.ndarray, width: int) -> np.ndarray:
    """How many of each window's tokens are in ``mask``."""
    total = np.concatenate([[0], np.cumsum(mask)])
    return total[width:] - total[:len(total) - width]


def candidate_windows(docs: DataFrame, items: DataFrame, widths: list[int], bits: int = TABLE_BITS,
                      least: int = MIN_LITERALS, words_held: int = WORDS_HELD) -> DataFrame:
    """(key, pos, h, template, tokens) of distinct texts' windows that may be windows of ``items``.  A window with a
    plain word that the items lack matches nothing and is not hashed; of the others the bit table of the items'
    hashes lets through what can match."""
    spark = docs.sparkSession
    words = items.select(F.explode("tokens").alias("t")).distinct()
    held = [r.t for r in words.limit(words_held + 1).collect()]
    held = frozenset(held) if len(held) <= words_held else BitWords(bit_table(words.select(F.xxhash64("t").alias("h")), bits), bits)
    shared = spark.sparkContext.broadcast((bit_table(items, bits), held))  # fixed sizes, whatever the benchmark's

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        marks = np.frombuffer(shared.value[0], dtype="<u4")
        top = np.uint64((1 << bits) - 1)
        lexicon, done = Lexicon(shared.value[1]), set()

        def marked(hs: np.ndarray) -> np.ndarray:
            low = hs.view("<u8") & top
            return np.flatnonzero(marks[low >> np.uint64(5)] >> (low & np.uint64(31)).astype("<u4") & np.uint32(1))

        def filed(x: Shapes, width: int) -> Iterator[tuple[np.ndarray, np.ndarray | None, np.ndarray, bool]]:
            """(windows, their tokens taken as names as bits, hashes, by surface words) that are in the table."""
            n = len(x.ids) - width + 1
            if n < 1:
                return
            inside = x.text[:n] == x.text[width - 1:]
            spare = _whole(~x.slot, width) - min(least, max(1, width // 2))
            sums = _rolled(x.one, width)
            at = np.flatnonzero(inside & (spare >= 0) & (_whole(x.slot | x.known, width) == width))
            hs = _mixed(sums[at])
            yes = marked(hs)
            yield at[yes], None, hs[yes], False
            some = inside & (_whole(x.slot | x.known | x.capital, width) == width)
            for at, named, hs in _named(x.one, sums, np.flatnonzero(x.capital), width, np.where(some, spare, 0)):
                yes = marked(hs)
                yield at[yes], named[yes], hs[yes], False
            at = np.flatnonzero(inside & (_whole(x.known, width) == width))
            hs = _mixed(_rolled(x.exact, width)[at])
            yes = marked(hs)
            yield at[yes], None, hs[yes], True

        def row(x: Shapes, width: int, i: int, named: int, surface: bool) -> tuple[str, str]:
            tokens = x.low(lexicon, i, i + width)
            own = " ".join(tokens)
            if surface:
                return own, own
            for k in np.flatnonzero(x.slot[i:i + width]).tolist():
                tokens[k] = _SLOT_OF[int(x.one[i + k])]
            for k in range(width) if named else ():
                if named >> k & 1:
                    tokens[k] = NAME
            return " ".join(tokens), own

        for batch in batches:
            lexicon = lexicon.fresh()
            if len(done) > lexicon.most:
                done.clear()
            batch = batch[[not (k in done or done.add(k)) for k in batch["key"]]]  # equal texts have equal windows
            texts, keys = batch["text"].tolist(), batch["key"].to_numpy()
            for part in range(0, len(texts), TOGETHER):
                found, text, offset = regions(list(map(pieces_of, texts[part:part + TOGETHER])), lexicon, min(widths))
                x = shapes(found, lexicon)
                for width in widths:
                    for at, named, hs, surface in filed(x, width):
                        names = [0] * len(at) if named is None else named.tolist()
                        both = [row(x, width, i, b, surface) for i, b in zip(at.tolist(), names)]
                        if both:
                            own = x.text[at]
                            yield pd.DataFrame({"key": keys[part + text[own]], "pos": offset[own] + x.place[at], "h": hs,
                                                "template": [f for f, _ in both], "words": [w for _, w in both]})

    found = docs.select(text_key(F.col("text")).alias("key"), "text").mapInPandas(
        windows, "key string, pos int, h long, template string, words string").dropDuplicates(["key", "pos", "h", "template"])
    return found.select("key", "pos", "h", "template", F.split("words", " ").alias("tokens"))


def agreed(diagonals: pd.Series) -> pd.DataFrame:
    """Of each diagonal's windows (at, rich, pairs): where those lie, and the rich
    of them, whose pairs keep to the readings of most places, and how many
    readings differ from the item's."""
    out = []
    for windows in diagonals:
        places = {p["place"]: (p["own"], p["theirs"]) for w in windows for p in w["pairs"]}
        votes: dict[str, Counter] = {}
        for own, theirs in places.values():
            votes.setdefault(own, Counter())[theirs] += 1
        reading = {}
        for own, c in votes.items():
            top = c.most_common(2)
            if len(top) == 1 or top[0][1] > top[1][1]:
                reading[own] = top[0][0]
        kept = [w for w in windows if all(reading.get(p["own"]) == p["theirs"] for p in w["pairs"])]
        changed = {p["own"] for w in kept for p in w["pairs"] if p["own"] != p["theirs"]}
        out.append((sorted({int(w["at"]) for w in kept}), sorted({int(w["at"]) for w in kept if w["rich"]}), len(changed)))
    return pd.DataFrame(out, columns=["at", "rich", "changed"])


def leaks(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, least: int = MIN_LITERALS,
          min_cover: float = MIN_COVER, bits: int = TABLE_BITS) -> DataFrame:
    """(key, item_id, item_ids, n_windows, n_matched, cover, n_changed): leaked
    items of each distinct text, ``key`` = md5 of the text.  ``n_changed``
    counts slot values that differ from the item's."""
    small_batches(docs.sparkSession)
    items = cut(item_windows(benchmark, width, least), "dec-items")
    lost = _left_out(benchmark, items).count()
    if lost:
        _LOG.warning("%d benchmark rows have too few tokens and are not matched", lost)
    widths = sorted(r.width for r in items.select("width").distinct().collect())  # at most ``width`` of them
    found = candidate_windows(docs, items, widths, bits, least) if widths else candidate_windows(docs, items, [width], bits, least)
    pairs = F.transform("i.slots", lambda k: F.struct((F.col("i.pos") + k).alias("place"), F.get("i.tokens", k).alias("own"),
                                                      F.get("d.tokens", k).alias("theirs")))
    of_item = ["item_id", "item_ids", "n_all", "n_rich"]
    hits = (found.alias("d").join(items.alias("i"), (F.col("d.h") == F.col("i.h")) & (F.col("d.template") == F.col("i.template")))
            .select("d.key", "i.item_key", *[f"i.{c}" for c in of_item], (F.col("d.pos") - F.col("i.pos")).alias("diagonal"),
                    F.struct(F.col("i.pos").alias("at"), "i.rich", pairs.alias("pairs")).alias("w")))
    same = [F.first(c).alias(c) for c in of_item]
    kind = "struct<at:array<int>,rich:array<int>,changed:int>"
    one = (hits.groupBy("key", "item_key", "diagonal").agg(*same, F.collect_list("w").alias("w"))
           .withColumn("w", F.pandas_udf(agreed, kind)("w")))
    places = lambda c: F.size(F.array_distinct(F.flatten(F.collect_list(c))))
    both = (one.select("key", "item_key", *of_item, "w.*").groupBy("key", "item_key")
            .agg(*same, places("at").alias("at"), places("rich").alias("rich"), F.max("changed").alias("n_changed")))
    by_rich = F.coalesce(F.try_divide("rich", "n_rich") >= F.col("at") / F.col("n_all"), F.lit(False))
    return (both.select("key", "item_id", "item_ids", F.when(by_rich, F.col("n_rich")).otherwise(F.col("n_all")).alias("n_windows"),
                        F.when(by_rich, F.col("rich")).otherwise(F.col("at")).alias("n_matched"), "n_changed")
            .withColumn("cover", F.col("n_matched") / F.col("n_windows")).where(F.col("cover") >= min_cover))


def leaking(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """(doc_id, item_id, item_ids, n_windows, n_matched, n_changed, cover) for every document row."""
    found = cut(leaks(docs, benchmark, **settings), "dec-leaks")
    own = docs.select("doc_id", text_key(F.col("text")).alias("key"))
    return own.join(found, "key").drop("key")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The documents that leak no item, with their columns."""
    found = cut(leaks(docs, benchmark, **settings).select(F.col("key").alias("__leak")).distinct(), "dec-keys")
    return docs.join(found, text_key(F.col("text")) == F.col("__leak"), "left_anti")
