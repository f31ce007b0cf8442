"""I-Match fingerprints against a plain version with Python integers, sets and sorted lists."""

import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from smogcast.llm import imatch, text

SCHEMA = "doc_id long, text string, tie long, row long, part string, head string, n_chars string"
M = (1 << 64) - 1
STEP = 0x9E3779B97F4A7C15


def mix(h):
    h = ((h ^ (h >> 33)) * 0xFF51AFD7ED558CCD) & M
    h = ((h ^ (h >> 33)) * 0xC4CEB9FE1A85EC53) & M
    return h ^ (h >> 33)


def word_hash(word):
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(text.span_hashes(raw, np.array([0]), np.array([len(raw)]))[0])


def plain_terms(value):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in value or "")
    return {word_hash(w) for w in set(re.findall(r"[^\x20\x09-\x0D]+", lowered))}


def list_hash(terms):
    total = sum(mix((h + i * STEP) & M) for i, h in enumerate(sorted(terms)))
    return max(1, mix((total + len(terms)) & M)) if terms else 0


def plain_fingerprint(value, lex):
    terms = plain_terms(value)
    terms = terms & lex or terms
    out, shift = f"{list_hash(terms):016x}", 0
    for bits, subsets in imatch.RUNGS:
        for s in range(subsets):
            part = list_hash({h for h in terms if mix((h + STEP) & M) >> shift & ((1 << bits) - 1) == s})
            out += f"{max(1, part >> 48) if part else 0:04x}"
        shift += bits
    return out


def plain_likeness(a, b):
    if a[:16] == b[:16]:
        return 1.0
    cut = lambda x: [x[16 + 4 * i:20 + 4 * i] for i in range(imatch.SUBSETS)]
    pairs, agree, held = list(zip(cut(a), cut(b))), 0, 0
    for _, subsets in reversed(imatch.RUNGS):
        if held < imatch.SEEN:
            rung = [p for p in pairs[-subsets:] if p != ("0000", "0000")]
            held, agree = held + len(rung), agree + sum(x == y for x, y in rung)
        pairs = pairs[:-subsets]
    return agree / max(held, 1)


def plain(table):
    df = Counter(h for _, t, *_ in table for h in plain_terms(t))
    n, pairs = len(table), sum(df.values())
    lex = {h for h, c in df.items() if max(n / imatch.RARE, pairs / imatch.MOST) <= c <= n / imatch.COMMON}
    rows = [(d, t or "") for d, t, *_ in table]
    out = Counter()
    for (d, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        k = len(t) // 2
        changed = t[:len(t) - k] + after[:k]
        fp, other, following = (plain_fingerprint(x, lex) for x in (t, changed, after))
        out[(d, len(t), sha256(changed.encode()).hexdigest(), fp, other, round(plain_likeness(fp, other), 9),
             round(plain_likeness(fp, following), 9))] += 1
    return out


def run(spark, table, parts=5):
    docs = spark.createDataFrame(table, SCHEMA).repartition(parts)
    got = imatch.fingerprinted(docs, imatch.lexicon(docs)).collect()
    return Counter(tuple(r)[:5] + (round(r["near_edited"], 9), round(r["near_next"], 9)) for r in got)


def row(i, t):
    return (i, t, 1, 2, "p", "h", "n")


@pytest.fixture(scope="module")
def table():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgéß") for _ in range(rng.randint(2, 8))) for _ in range(3000)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 400))) for _ in range(150)]
    texts += [None, "", " \n ", "the", "The THE the", "x" * 40_000, " ".join(words * 3), texts[0].upper(), "ß\t" * 500]
    rng.shuffle(texts)
    texts += [texts[2]] * 3
    rows = [row(None, "no id")] + [row(7 * i - 20, t) for i, t in enumerate(texts)]
    return rows + [row(10 ** 6, "last one"), row(10 ** 6, "last one")]


def test_every_column(spark, table):
    assert run(spark, table) == plain(table)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_few_rows(spark, n):
    rows = [row(i, f"some words here {i}") for i in range(n)]
    assert run(spark, rows, 3) == plain(rows)


def test_empty_table(spark):
    assert not run(spark, [])


def test_long_texts_in_pieces():
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(5000)]
    long = " ".join(words[i] for i in rng.integers(0, 5000, 700_000))       # several pieces
    texts = ["a b a", long, "", "y" * 3_000_000 + " z", "end"]              # and one word that is longer than a piece
    import pyarrow as pa
    rows, hashes = imatch.terms(*text.buffers(pa.array(texts)))
    for i, t in enumerate(texts):
        want = {word_hash(w) for w in set(t.split())}
        assert set(hashes[rows == i].tolist()) == want and (rows == i).sum() == len(want)


def test_lexicon_is_bounded(spark):
    docs = spark.createDataFrame([row(i, " ".join(f"t{(i * 7 + k) % 900}" for k in range(60))) for i in range(300)], SCHEMA)
    assert len(imatch.lexicon(docs, rare=300)) == 900
    assert len(imatch.lexicon(docs, rare=300, most=500)) <= 500
    assert len(imatch.lexicon(docs, common_share=10 ** 6)) == 0


def test_half_changed_texts_are_told_from_others(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(20_000)]
    rows = [row(i, " ".join(rng.choice(words) for _ in range(rng.choice([12, 80, 500, 3000])))) for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = imatch.fingerprinted(docs, imatch.lexicon(docs)).collect()
    assert sum(r["near_edited"] > r["near_next"] for r in got) >= 0.95 * len(got)
    assert all(0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1 for r in got)
