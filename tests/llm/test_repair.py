"""Conversation repair against a plain search over whole strings."""

import random
import re
import zlib

import brute
import pytest
from tessera.llm import repair
from tessera.llm.queries import QUERIES

FIELDS = "conv_id long, turn long, role string, text string"


def damage(rows):
    """[(conv_id, [(turn, role, text)])] after the contract's damage; nulls are one space."""
    out = {}
    for r in rows:
        c, t = (r[k] if r[k] == r[k] else None for k in ("conv_id", "turn"))
        own = out.setdefault(c, [])
        role, text = (" " if r[k] is None else r[k] for k in ("role", "text"))
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        if h:
            own += [(t, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        found = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """(cost, audit, repaired) by dynamic programming from the front over whole strings, inserts bounded by two at a place."""
    step = {"0": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}
    def better(into, state, value):
        if state not in into or value < into[state]:
            into[state] = value
    def inserts(live):
        for _ in range(4):
            for s, (c, audit, out) in list(live.items()):
                better(live, step[s], (c + 2, audit + "I", (*out, (name[step[s]], ""))))
    live = {"0": (0, "", ())}
    for (_, role, text), fault in zip(rows, found):
        inserts(live)
        new = {}
        for s, (c, audit, out) in live.items():
            better(new, s, (c + 3, audit + "D", out))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if role[:1] == step[s] or s == "0" and role[:1] == "s":
                    better(new, role[:1], (c + extra, audit + "K", (*out, (role, text))))
                better(new, step[s], (c + 2 + extra, audit + "R", (*out, (name[step[s]], text))))
        live = new
    inserts(live)
    return min(live[s] for s in "0a" if s in live)


def exhaustive(rows, found, most):
    """Every edit list of at most ``most`` inserts, for short conversations."""
    name, best = {"u": "user", "a": "assistant"}, None
    def go(i, inserted, cost, audit, out):
        nonlocal best
        if i == len(rows):
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in out)) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, out
        else:
            _, role, text = rows[i]
            go(i + 1, inserted, cost + 3, audit + "D", out)
            if found[i] not in ("blank", "duplicate"):
                extra = found[i] == "truncated"
                go(i + 1, inserted, cost + extra, audit + "K", (*out, (role, text)))
                for r in name.values():
                    go(i + 1, inserted, cost + 2 + extra, audit + "R", (*out, (r, text)))
        if inserted < most:
            for r in name.values():
                go(i, inserted + 1, cost + 2, audit + "I", (*out, (r, "")))
    go(0, 0, 0, "", ())
    return best


def summary(rows):
    found = faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum((x[1][:1], y[1][:1]) not in (("s", "u"), ("u", "a"), ("a", "u")) for x, y in zip(rows, rows[1:]))
    cost, audit, out = cheapest(rows, found)
    return (gaps, *(found.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            brute.sha("\n".join(f"{r}:{t}" for r, t in out)))


def by_turn(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def got(df):
    return {r.conv_id: tuple(r[c] for c in repair.SUMMARY) for r in df.collect()}


def test_whole_table(spark, sf):
    want = {c: summary(by_turn(rows)) for c, rows in damage(brute.rows(sf, "conversations")).items()}
    df = QUERIES["op13_repair"](spark, sf)
    assert got(df) == want and df.count() == len(want)


def random_rows(rng, n):
    return [(rng.choice([None, *range(n)]), rng.choice(["system", "user", "assistant", "tool", "", "unknown"]),
             rng.choice(["", " ", "Yes.", "No", "Why?", "é!\n", "a b"])) for _ in range(n)]


def searched(rows, found, mod=repair.MOD):
    c = repair.Conversation(1, mod=mod)
    for (turn, role, text), fault in zip(rows, found):
        c.add(turn, role, text, fault == "duplicate")
    return c.done()


def test_plain_search_is_exhaustive():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4):
        for _ in range(25):
            rows = by_turn(random_rows(rng, n))
            assert cheapest(rows, faults(rows)) == exhaustive(rows, faults(rows), 3)


@pytest.mark.parametrize("mod", [repair.MOD, 7, 1])
def test_random_conversations_also_with_colliding_hashes(mod):
    rng = random.Random(2)
    for n in [1, 2, 3, 5, 9, 30, 150] * 30:
        rows = by_turn(random_rows(rng, n))
        assert searched(rows, faults(rows), mod) == summary(rows)


def test_long_conversation_holds_its_open_end_only():
    rng = random.Random(3)
    c = repair.Conversation(1)
    most = 0
    for i in range(20_000):
        c.add(i, rng.choice(["user", "assistant"]), f"text {i}{rng.choice(['.', ''])}", False)
        most = max(most, len(c.open))
    audit = c.done()[-2]
    assert most <= 2 * repair.FLUSH and len(audit.replace("I", "")) == 20_000


def test_all_blank_rows():
    rows = [(i, "user", " ") for i in range(500)]
    assert searched(rows, faults(rows))[5:7] == (1500, "D" * 500)


def test_compare_lists():
    rng = random.Random(4)
    for mod in (repair.MOD, 5, 1):
        made = [repair.Node(mod=mod)]
        for _ in range(400):
            made.append(repair.Node(rng.choice(made[-30:]), rng.choice("DK"), mod))
        for _ in range(3000):
            x, y = rng.choice(made), rng.choice(made)
            assert repair.less(x, y) == (x.text() < y.text())


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 2, "user", "Hi."), (1, 2, "user", "Hi."), (1, 9, "assistant", "x" * 50_000), (None, 0, "user", "a"),
            (None, None, "assistant", None), (None, None, None, None), (3, 1, "tool", " \t"), (4, 5, "system", "S."), (5, 0, "user", "U?"),
            (5, 1, "assistant", "A!")]
    df = spark.createDataFrame(rows, FIELDS)
    for name in ("kept_", "row", "key", "again", "f_row", "h", "col", "place", "edit"):
        df = df.selectExpr("*", f"'extra' as {name}")
    named = [dict(zip(("conv_id", "turn", "role", "text"), r)) for r in rows]
    want = {c: summary(by_turn(x)) for c, x in damage(named).items()}
    assert got(repair.summaries(repair.damaged(df))) == want
    assert repair.summaries(df.limit(0)).count() == 0 and repair.repair(df.limit(0)).count() == 0


def test_conversation_that_loses_every_row(spark):
    c = next(i for i in range(10_000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    out = got(repair.summaries(repair.damaged(spark.createDataFrame([(c, 0, "user", "Hi.")], FIELDS))))
    assert out == {c: (0, 0, 0, 0, 0, 0, "", brute.sha(""))}


def test_repaired_rows_are_in_order_and_give_the_hash(spark, sf):
    df = repair.damaged(spark.read.parquet(f"{sf}/conversations.parquet"))
    want, by = got(repair.summaries(df)), {}
    for r in repair.repair(df).collect():
        by.setdefault(r.conv_id, []).append(r)
    for c, rows in by.items():
        kept = sorted((r for r in rows if r.place is not None), key=lambda r: r.place)
        assert [r.place for r in kept] == list(range(1, len(kept) + 1))
        assert brute.sha("\n".join(f"{r.role}:{r.text}" for r in kept)) == want[c][-1]
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[:1] for r in kept))
        assert sorted(r.edit for r in rows) == sorted(want[c][-2])
