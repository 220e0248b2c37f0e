"""Plain-Python versions of the contracts, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pandas as pd
import xxhash


def rows(sf, table):
    df = pd.read_parquet(f"{sf}/{table}.parquet")
    return df.to_dict("records")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def joined(spans, kinds):
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted((a, kinds.index(k), b, k) for k, a, b in spans))


def simhash(text):
    w = (text or "").encode().lower().split()
    if not w:
        return "0" * 16
    grams = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    hs = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return "%016x" % sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(docs, distance=2):
    by = defaultdict(list)
    for d in docs:
        by[simhash(d["text"])].append(d["doc_id"])
    fps = list(by)
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ints = [(int(f, 16), f) for f in fps]
    for i, (x, f) in enumerate(ints):
        for y, g in ints[:i]:
            if (x ^ y).bit_count() <= distance:
                root[find(f)] = find(g)
    least = defaultdict(list)
    for f in fps:
        least[find(f)] += [x for x in by[f] if x is not None and x == x]
    return {f: min(least[find(f)], default=None) for f in fps}


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def pii(text):
    t, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def secrets(text):
    t, out = text or "", []
    for m in re.finditer(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t):
        if len(m[2]) >= 8:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]
    return out


def quality(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    again = {j for i, g in enumerate(grams) if n[g] > 1 for j in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again),
            len(w) < 50 or 100 * len(again) > 50 * len(w))


def crc(data):
    return zlib.crc32(data)
