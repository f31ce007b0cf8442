"""Conversation repair against a memoised search over all edits."""

import random
import sys
import zlib
from collections import Counter
from functools import cache
from hashlib import sha256

import pytest

from smogcast.llm import turns

SCHEMA = "conv_id long, turn long, role string, text string, conv string, kind string, hit int, digest string"
SPACES = " \t\n\x0b\x0c\r"


def plain_repair(rows):
    """(cost, audit, repaired rows): least cost, then least audit, over every order of edits."""
    seen, marked = set(), []
    for role, text in rows:
        said = text.rstrip(SPACES)
        fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else ""
        seen.add((role, text))
        marked.append((role, text, fault))

    def expected(state):
        return "user" if state in ("", "s", "a") else "assistant"

    @cache
    def best(i, state, inserted):
        ways = []
        if i == len(marked) and state in ("", "a"):
            ways.append((0, "", ()))
        if inserted < 3:
            role = expected(state)
            c, audit, out = best(i, role[0], inserted + 1)
            ways.append((c + 2, "I" + audit, ((role, ""), *out)))
        if i < len(marked):
            role, text, fault = marked[i]
            c, audit, out = best(i + 1, state, 0)
            ways.append((c + 3, "D" + audit, out))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if role[:1] == "s" and state == "" or role[:1] and role[:1] == expected(state)[0]:
                    c, audit, out = best(i + 1, role[0], 0)
                    ways.append((c + extra, "K" + audit, ((role, text), *out)))
                new = expected(state)
                c, audit, out = best(i + 1, new[0], 0)
                ways.append((c + 2 + extra, "R" + audit, ((new, text), *out)))
        return min(ways, key=lambda w: w[:2]) if ways else (10 ** 9, "", ())

    cost, audit, out = best(0, "", 0)
    return cost, audit, out, Counter(m[2] for m in marked)


def plain(table):
    """The whole contract, conversation by conversation."""
    convs = {}
    for conv, turn, role, text, *_ in table:
        own = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else text.translate({ord(c): None for c in ".!?"}) if hit == 2 else text
        own += [(turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        at = [r[0] for r in rows if r[0] is not None]
        gaps = max(at) - min(at) + 1 - len(set(at)) if at else 0
        initials = [r[1][:1] for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, kept, faults = plain_repair([r[1:] for r in rows])
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit,
                     sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest())
    return out


def got(frame):
    rows = [tuple(r) for r in frame.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def random_table(n=250):
    rng, table = random.Random(11), []
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "System", "ua"]
    texts = ["Hello there.", "Why?", "no stop", " \n ", "", None, "Ends. \t\n", "ß ja!", "x. ", "Same.", "Same."]
    for conv in range(n):
        at = rng.choice([0, 0, 0, 5, -3])
        for _ in range(rng.randint(1, 9)):
            odd = rng.random() < 0.08
            table.append((None if conv == 17 else conv, None if odd else at, rng.choice(roles[:5] if rng.random() < 0.7 else roles),
                          rng.choice(texts), "c", "row", 3, "d"))
            at += rng.choice([0, 1, 1, 1, 1, 2, 6])
    return table


def test_every_conversation(spark):
    table = random_table()
    frame = spark.createDataFrame(table + table[:40], SCHEMA).repartition(6)
    assert got(turns.repaired(*turns.damage(frame))) == plain(table + table[:40])


def test_a_long_conversation_spills_its_way_back(spark):
    sys.setrecursionlimit(20_000)  # for the plain search
    rng = random.Random(2)
    table = [(1, i, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "no", f"Say {rng.randint(0, 400)}.", ""]), "", "", 0, "")
             for i in range(300)]
    frame = spark.createDataFrame(table, SCHEMA)
    want = plain(table)
    for spill in (1, 64, 10 ** 6):
        assert got(turns.repaired(*turns.damage(frame), spill=spill)) == want


def test_states_do_not_grow_with_the_conversation():
    automaton, rng = turns.Automaton(), random.Random(1)
    talk = turns.Conversation("1", automaton, 1000)
    for i in range(20_000):
        talk.row(i, rng.choice(["system", "user", "assistant", "x"]), rng.choice(["a.", "b", ""]), b"%d" % i)
        assert len(talk.hashes) <= 4 and len(talk.way.tail) < 1000
    assert len(automaton.steps) < 600
    assert len(talk.result()[7]) >= 20_000


def test_random_orders_against_the_search():
    rng = random.Random(7)
    for _ in range(400):
        rows = [(rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["a.", "b", "", "c!"])) for _ in range(rng.randint(0, 8))]
        talk, before = turns.Conversation("x", turns.Automaton()), set()
        for i, (role, text) in enumerate(rows):
            digest = f"{role}:{text}".encode()
            if digest in before:
                talk.mark(i, digest)
            before.add(digest)
            talk.row(i, role, text, digest)
        cost, audit, kept, faults = plain_repair(rows)
        r = talk.result()
        assert (r[6], r[7]) == (cost, audit), rows
        assert r[8] == sha256("\n".join(f"{a}:{b}" for a, b in kept).encode()).hexdigest()


def test_lost_conversations_and_an_empty_table(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(gone, 0, "user", "All is lost.", "", "", 0, "")], SCHEMA)
    assert got(turns.repaired(*turns.damage(frame))) == {gone: (0,) * 6 + ("", sha256(b"").hexdigest())}
    assert turns.repaired(*turns.damage(spark.createDataFrame([], SCHEMA))).count() == 0


@pytest.mark.parametrize("roles, audit, cost", [("uaua", "KKKK", 0), ("sua", "KKK", 0), ("au", "IKKI", 4), ("ua" * 3 + "u", "K" * 7 + "I", 2),
                                                ("s", "D", 3), ("uu", "KR", 2)])
def test_known_repairs(roles, audit, cost):
    talk = turns.Conversation("x", turns.Automaton())
    for i, c in enumerate(roles):
        talk.row(i, {"u": "user", "a": "assistant", "s": "system"}[c], f"{i}.", b"%d" % i)
    assert (talk.result()[6], talk.result()[7]) == (cost, audit)


def test_sql_gives_the_same():
    import duckdb
    import pandas as pd

    from smogcast.llm.oracle import SQL
    table = random_table(120)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", [r[:4] for r in table])
    got = {None if pd.isna(r[0]) else r[0]: tuple(r[1:]) for r in con.sql(SQL["op13_turns"]).fetchall()}
    assert got == plain(table)
