import random
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from offerloom.llm import bagminhash, near_dups, words
from offerloom.llm import components as components_module
from offerloom.llm.components import components


def bag(text, window=5):
    w = (text or "").split()
    return Counter(tuple(w[i : i + window]) for i in range(max(1, len(w) - window + 1))) if w else Counter()


def jaccard(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def brute(rows):
    bags = [bag(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and bags[j] and jaccard(bags[i], bags[j]) >= 0.8:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    out = {}
    for (i, _), x in zip(rows, label):
        out[x] = min(out.get(x, i), i)
    return {i: out[x] for (i, _), x in zip(rows, label)}


def corpus(rng):
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for group in range(25):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 60, 300]))]
        for _ in range(rng.choice([1, 2, 6, 30])):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), rng.choice([" ", "\n", " \t"]).join(copy)))
    rows += [(len(rows) + i, t) for i, t in enumerate(["a b a b " * 40, "a b a b " * 45, "a b a b " * 80, "", "", "  \n", "one", "one", "one two"])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("tile,tile_bytes,deviations", [(256, 4 << 20, 4.6), (3, 4 << 20, 4.6), (256, 900, None)])
def test_classes_against_all_pairs(spark, monkeypatch, tile, tile_bytes, deviations):
    monkeypatch.setattr(near_dups, "TILE", tile)
    monkeypatch.setattr(near_dups, "TILE_BYTES", tile_bytes)
    monkeypatch.setattr(components_module, "HUB", 1024 if tile == 256 else 2)
    rows = corpus(random.Random(5))
    docs = spark.createDataFrame([(*r, 7, "b") for r in rows], "doc_id long, text string, node long, body string")
    got = near_dups.classes(docs, deviations=deviations).collect()
    assert {r.id: r.class_id for r in got} == brute(rows) and len(got) == len(rows)


@pytest.mark.parametrize("sign_bytes", [1, 3000])
def test_long_texts_and_small_batches(spark, monkeypatch, sign_bytes):
    """Signatures don't depend on how many texts are signed at once; texts far longer than that are taken whole."""
    monkeypatch.setattr(near_dups, "SIGN_BYTES", sign_bytes)
    rng = random.Random(8)
    long = [f"v{rng.randrange(5000)}" for _ in range(30_000)]
    late = [*long[:29_000], *(f"u{i}" for i in range(9_000))]  # the beginnings are equal, the texts are not
    rows = [*corpus(rng)[:60], (9000, " ".join(long)), (9001, " ".join([*long[:-900], "end"])), (9002, " ".join(late)), (9003, " ".join(long[:22_000]))]
    got = near_dups.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.id: r.class_id for r in got} == brute(rows)


def test_texts_that_collide_in_64_bits(spark, monkeypatch):
    """All texts have the same first fingerprint; only the second one tells them apart."""
    whole = words.fingerprint
    monkeypatch.setattr(words, "fingerprint", lambda *parts: (F.lit(5).cast("long"), whole(*parts)[1]))
    rows = corpus(random.Random(7))[:120]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.id: r.class_id for r in near_dups.classes(docs).collect()} == brute(rows)


def test_pairs_below_the_similarity_in_one_bucket(spark, monkeypatch):
    """The exact step fetches only texts that registers leave, and decides them by their bags, very long texts too."""
    monkeypatch.setattr(near_dups, "TILE", 2)
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    rows = []
    for i in range(12):
        copy = list(base)
        for k in range(8):
            copy[(i * 31 + k * 47) % 400] = f"x{i}y{k}"
        rows.append((i, " ".join(copy)))
    rows += [(20, "long " + " ".join(base) * 300), (21, "long " + " ".join(base) * 300 + " end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r.class_id for r in near_dups.classes(docs).collect()}
    assert got == brute(rows) and got[21] == 20


def test_nulls_and_repeats(spark):
    rows = [(1, None), (2, None), (None, "x y z"), (5, "x y z"), (5, "x y z"), (9, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.id, r.class_id) for r in near_dups.classes(docs).collect()), key=str)
    assert got == sorted([(1, 1), (2, 2), (None, 5), (5, 5), (5, 5), (9, 9), (None, None)], key=str)
    kept = sorted((tuple(r) for r in near_dups.one_of_each(docs).collect()), key=str)
    assert kept == sorted([(1, None), (2, None), (5, "x y z"), (9, ""), (None, None)], key=str)
    assert near_dups.classes(docs.limit(0)).count() == 0


def test_signatures_are_unbiased():
    rng = np.random.default_rng(2)
    for weights_a, weights_b in [([1] * 40, [1] * 40), ([5, 1, 9], [2, 7, 9]), ([100, 3], [60, 3])]:
        a = {f"s{i}": w for i, w in enumerate(weights_a)}
        b = {f"s{i + (3 if len(weights_a) == 40 else 0)}": w for i, w in enumerate(weights_b)}
        true = sum(min(a.get(k, 0), b.get(k, 0)) for k in a | b) / sum(max(a.get(k, 0), b.get(k, 0)) for k in a | b)
        names = {k: rng.integers(1, 1 << 62) for k in a | b}
        signed = [bagminhash.signatures(np.array([names[k] for k in x], np.uint64), np.zeros(len(x), np.int64), np.array(list(x.values())), 1, 20000)[0] for x in (a, b)]
        assert abs((signed[0] == signed[1]).mean() - true) < 0.015


def test_words_and_bags():
    texts = ["a bb  ccc", "", " \n", "bb", "é ccc a"]
    data = "".join(texts).encode()
    ends = np.cumsum([len(t.encode()) for t in texts])
    hashes, owner = bagminhash.word_hashes(np.frombuffer(data, np.uint8), ends)
    names = [w for t in texts for w in t.split()]
    assert list(owner) == [0, 0, 0, 3, 4, 4, 4]
    assert all((hashes[i] == hashes[j]) == (names[i] == names[j]) for i in range(7) for j in range(7))
    rng = random.Random(1)
    for _ in range(50):
        a, b = (" ".join(rng.choice("xyz") for _ in range(rng.randrange(30))) for _ in range(2))
        common, union = bagminhash.overlap(bagminhash.bag_of(a.encode(), 2), bagminhash.bag_of(b.encode(), 2))
        x, y = bag(a, 2), bag(b, 2)
        assert (common, union) == (sum((x & y).values()), sum((x | y).values()))


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 101), (102, 101), (-5, 100)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, **{i: -5 for i in (100, 101, 102, -5)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    more = spark.createDataFrame([(20, 102), (7, 3), (500, 501)], "a long, b long")
    again = {r.node: r.label for r in components_module.merged(components(spark.createDataFrame(edges, "a long, b long")), more).collect()}
    assert again == {**{i: -5 for i in (*range(21), 100, 101, 102, -5)}, 500: 500, 501: 500}


def test_registered_query(spark, tmp_path):
    from offerloom.llm import queries

    rows = corpus(random.Random(11))[:200]
    spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, class_id string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op7_near_dups(spark, str(tmp_path))
    assert got.columns == ["doc_id", "class_id"] and {r.doc_id: r.class_id for r in got.collect()} == brute(rows)
