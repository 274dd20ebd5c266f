import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from offerloom.llm import substrings, suffixes


def brute(rows, length):
    bodies = [(t or "").encode() for _, t in rows]
    found = Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for (i, _), b in zip(rows, bodies):
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            if found[b[s : s + length]] > 1:
                gone[s : s + length] = [True] * length
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def texts(rng, n):
    base = ["".join(rng.choice("abcdeé ") for _ in range(400)) for _ in range(3)]
    rows = []
    for i in range(n):
        a, b = rng.randrange(300), rng.randrange(300)
        t = rng.choice(base)[a : a + rng.randrange(120)] + "".join(rng.choice("xyz") for _ in range(rng.randrange(9))) + rng.choice(base)[b : b + rng.randrange(90)]
        rows.append((i, t))
    hot = base[0][:150]  # many near copies of one text
    rows += [(1000 + i, hot[: (k := rng.randrange(150))] + "#" + hot[k:]) for i in range(n)]
    return rows + [(5000, None), (5001, ""), (5002, "aaaa" * 60), (5003, base[1]), (5004, base[1]), (5004, base[1]), (None, base[2][:80]), (None, "q" * 39)]


@pytest.mark.parametrize("hot,length", [(256, 40), (4, 40), (2, 17)])
def test_against_brute_force(spark, monkeypatch, hot, length):
    monkeypatch.setattr(substrings, "HOT", hot)
    monkeypatch.setattr(substrings, "CLASS", 8)
    rows = texts(random.Random(hot), 40)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, key long, body string")
    got = sorted((tuple(r) for r in substrings.removed(docs, length).collect()), key=str)
    assert got == brute(rows, length)


@pytest.mark.parametrize("part,length", [(1, 40), (33, 17), (1000, 17)])
def test_texts_in_parts(spark, monkeypatch, part, length):
    """Texts longer than a part are cut into parts that overlap: repeats over a cut, at one, and all of a text."""
    monkeypatch.setattr(substrings, "PART", part)
    rng = random.Random(part)
    long = "".join(rng.choice("abé") for _ in range(700))
    rows = [*texts(rng, 6), (7000, long), (7001, "x" + long[50:]), (7002, long[100:300] * 3), (7003, long[: part + length]), (7004, long[part : part + length])]
    got = sorted((tuple(r) for r in substrings.removed(spark.createDataFrame(rows, "doc_id long, text string"), length).collect()), key=str)
    assert got == brute(rows, length)


def test_spans_and_what_is_left(spark):
    """The spans are apart, and what is left is the text without them."""
    rows = [r for r in texts(random.Random(3), 20) if r[0] is not None and r[0] != 5004]
    found = {r.id: r for r in substrings.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"), 40).collect()}
    assert len(found) == len(rows) and any(len(r.spans) > 1 for r in found.values())
    for i, t in rows:
        body, r = (t or "").encode(), found[i]
        edges = [0, *(x for s in r.spans for x in s), len(body)]
        left = b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2]))
        assert r.sha256 == hashlib.sha256(body).hexdigest() and (left == body if r.kept is None else left == r.kept != body)
        assert all(a < b for a, b in zip(edges[1:-1], edges[2:-1]))


def test_empty(spark):
    assert substrings.removed(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_prefixes_of_random_pieces():
    rng = random.Random(1)
    for _ in range(200):
        length = rng.choice([1, 2, 3, 5, 9, 20])
        base = bytes(rng.choice(b"ab\0\xff") for _ in range(60))
        pieces = [base[(a := rng.randrange(60)) : a + rng.randrange(40)] + bytes(rng.choice(b"abc") for _ in range(rng.randrange(9))) for _ in range(rng.randrange(7))]
        found = Counter(p[i : i + length] for p in pieces for i in range(len(p) - length + 1))
        expected = [[i + length <= len(p) and found[p[i : i + length]] > 1 for i in range(len(p))] for p in pieces]
        assert [list(map(bool, g)) for g in suffixes.repeated_starts([np.frombuffer(p, np.uint8) for p in pieces], length)] == expected
