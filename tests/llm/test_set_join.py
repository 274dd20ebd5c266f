import random

import numpy as np
import pytest

from offerloom.llm import set_join


def grams(text, window=4):
    w = (text or "").translate({c: c + 32 for c in range(65, 91)}).split()
    return {tuple(w[i : i + window]) for i in range(max(1, len(w) - window + 1))} if w else set()


def brute(rows, window=4, percent=85):
    sets = [grams(t, window) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    least = {}
    for (i, _), x in zip(rows, label):
        if i is not None:
            least[x] = min(least.get(x, i), i)
    return sorted(((i, len(s), least.get(x) if s else i) for (i, _), s, x in zip(rows, sets, label)), key=repr)


def corpus(rng, groups=30):
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for group in range(groups):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 6, 9, 14, 25, 60, 200, 500]))]
        for _ in range(rng.choice([1, 2, 5, 20])):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 6])):
                at = rng.randrange(len(copy))
                copy[at : at + rng.choice([0, 1])] = [rng.choice(vocabulary)]
            rows.append((len(rows), rng.choice([" ", "\n", " \t"]).join(copy)))
    rows += [(len(rows) + i, t) for i, t in enumerate(["a b a b " * 40, "a b a b " * 45, "", "  \n", "One", "oNE", "one two", "É b c d e", "é b c d e"])]
    rows += [(len(rows), None), rows[3], rows[3], (None, rows[5][1]), (None, "nothing like it"), (None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("tile,tile_bytes,seeds,percent", [(256, 4 << 20, 4, 85), (3, 4 << 20, 1, 85), (256, 900, 2, 70), (256, 4 << 20, 4, 95)])
def test_classes_against_all_pairs(spark, monkeypatch, tile, tile_bytes, seeds, percent):
    monkeypatch.setattr(set_join, "TILE", tile)
    monkeypatch.setattr(set_join, "TILE_BYTES", tile_bytes)
    monkeypatch.setattr(set_join, "SEEDS", seeds)
    rows = corpus(random.Random(tile + percent))
    docs = spark.createDataFrame([(*r, 7, "b", 1) for r in rows], "doc_id long, text string, node long, body string, row long").repartition(3)
    got = set_join.join_classes(docs, percent=percent).collect()
    assert sorted(((r.id, r.n, r.component) for r in got), key=repr) == brute(rows, percent=percent)


@pytest.mark.parametrize("percent", [50, 70, 85, 95])
def test_similar_sets_share_a_signature(percent):
    """Pairs as far apart as may be, of all small sizes and some large ones, at both ends of a band."""
    rng = np.random.default_rng(percent)
    for n in [*range(1, 120), 400, 1500, 3001]:
        for m in {n, n + 1, 100 * n // percent, min(100 * n // percent, n + 3)}:
            least = -(-percent * (n + m) // (100 + percent))
            if least > n:
                continue
            for common in {least, min(n, least + 1)}:
                universe = rng.integers(0, 1 << 63, n + m, dtype=np.uint64)
                a, b = np.sort(universe[:n]), np.sort(np.concatenate([universe[:common], universe[n : n + m - common]]))
                assert set_join.linked(np.int64(common), n + m, percent)
                if len(a) == len(b) and (a == b).all():
                    continue
                sig, of = set_join.signatures(np.concatenate([a, b]), np.repeat([0, 1], [n, m]), 2, percent)
                assert set(sig[of == 0].tolist()) & set(sig[of == 1].tolist()), (n, m, common)


def test_signatures_do_not_depend_on_the_batch():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 63, k, dtype=np.uint64)) for k in (3, 900, 40, 12, 5000)]
    whole, of = set_join.signatures(np.concatenate(sets), np.repeat(np.arange(5), [len(s) for s in sets]), 5, 85)
    for i, s in enumerate(sets):
        alone, _ = set_join.signatures(s, np.zeros(len(s), np.int64), 1, 85)
        assert sorted(alone.tolist()) == sorted(whole[of == i].tolist())


def test_intersections_by_parts(monkeypatch):
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, k).astype(np.uint64)) for k in (1, 5, 30, 50, 200)]
    assert (set_join._overlaps(sets, sets[1:]) == [[len(np.intersect1d(a, b)) for b in sets[1:]] for a in sets]).all()


def test_a_very_long_text_and_a_near_copy(spark, monkeypatch):
    monkeypatch.setattr(set_join, "SIGN_BYTES", 1000)
    rng = random.Random(6)
    long = [str(rng.randrange(10**6)) for _ in range(60_000)]
    near = list(long)
    for k in range(0, 60_000, 200):
        near[k] = "x"
    far = list(long)
    for k in range(0, 60_000, 20):
        far[k] = "y"
    rows = [(3, " ".join(long)), (2, " ".join(near)), (1, " ".join(far)), (4, "short text")]
    got = set_join.join_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.id: r.component for r in got} == {3: 2, 2: 2, 1: 1, 4: 4}


def test_hot_group_below_the_similarity(spark, monkeypatch):
    """Many copies of one base, each pair a little too far apart, and some that link: tiles find these alone."""
    monkeypatch.setattr(set_join, "TILE", 8)
    rng = random.Random(12)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        copy = list(base)
        for k in rng.sample(range(300), 7):
            copy[k] = f"c{i}x{k}"
        rows.append((i, " ".join(copy)))
    rows.append((60, rows[30][1].replace("w299", "other").replace("w0 ", "else ")))
    got = set_join.join_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.id, r.n, r.component) for r in got), key=repr) == brute(rows)


def test_no_rows(spark):
    assert set_join.join_classes(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_sketches_bound_distances_from_below():
    rng = np.random.default_rng(4)
    for n, m in [(1, 1), (1, 40), (30, 33), (200, 220), (700, 1500)]:
        for common in (0, n // 2, n):
            universe = rng.integers(0, 1 << 63, n + m, dtype=np.uint64)
            a, b = universe[:n], np.concatenate([universe[:common], universe[n : n + m - common]])
            apart = set_join.at_least_apart(set_join.sketch_of(a), [set_join.sketch_of(x) for x in (b, a, b)])
            assert apart[1] == 0 and apart[0] == apart[2] <= n + m - 2 * common
            assert common < n or n != m or apart[0] == 0
    far = set_join.at_least_apart(set_join.sketch_of(universe[:300]), [set_join.sketch_of(universe[300:600])])
    assert far[0] > 300
