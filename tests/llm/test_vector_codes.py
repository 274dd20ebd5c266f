import hashlib
import math
import random

import numpy as np
import pytest

from offerloom.llm import vector_codes


def by_hand(rows, parts, entries, rounds):
    """Lloyd's rounds whole, with Python integers."""
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts)
    kept = [(i, v + [0] * (parts * width - len(v)), label) for i, v, label in kept]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0], r[1]))[:entries]
    cut = lambda v: [v[p * width : (p + 1) * width] for p in range(parts)]
    books = [[cut(v)[p] for _, v, _ in order] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    best = lambda p, x: min(range(len(books[p])), key=lambda e: (far(books[p][e], x), e))
    for _ in range(rounds):
        codes = [[best(p, x) for p, x in enumerate(cut(v))] for _, v, _ in kept]
        new = [list(b) for b in books]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut(v)[p] for (_, v, _), c in zip(kept, codes) if c[p] == e]
                if own:
                    new[p][e] = [sum(c) // len(own) for c in zip(*own)]
        books = new
    out = []
    for i, v, label in kept:
        code = [best(p, x) for p, x in enumerate(cut(v))]
        out.append((i, "".join(f"{c:02x}" for c in code), sum(far(books[p][c], cut(v)[p]) for p, c in enumerate(code)), label))
    total = {}
    for _, _, e, label in out:
        total[label] = total.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(y) for b in books for x in b for y in x).encode()).hexdigest()
    return sorted(((i, c, e, total[label]) for i, c, e, label in out), key=repr), digest


def vectors(rng, n, width, few=False):
    draw = (lambda: rng.choice([-0.5, 0.0, 0.5])) if few else (lambda: rng.gauss(0, 0.4))
    return [(i, [draw() for _ in range(width)], rng.choice([None, 0, 0, 0, 1])) for i in rng.sample(range(10 * n), n)]


@pytest.mark.parametrize("parts,entries,rounds,width,few", [(4, 8, 2, 8, False), (4, 8, 3, 10, True), (16, 64, 2, 32, False), (2, 256, 1, 4, False), (3, 5, 0, 6, False)])
def test_against_whole_rounds(spark, monkeypatch, parts, entries, rounds, width, few):
    monkeypatch.setattr(vector_codes, "CELLS", 64)
    rng = random.Random(parts * width)
    rows = vectors(rng, 150, width, few)
    odd = [(5000, None, 1), (5001, [None] + [0.1] * (width - 1), 1), (5002, [float("nan")] * width, 1), (5003, [float("inf")] * width, None), rows[3], rows[3], (rows[4][0], rows[5][1], 2), (None, rows[6][1], 0), (5004, [0.25], 2), (5005, [], 2), (5006, [900.0] * width, 2)]
    schema = "vec_id long, embedding array<double>, label int, v string, code string, error long"
    frame = spark.createDataFrame([(*r, "a", "b", 1) for r in rows + odd], schema).repartition(3)
    found = vector_codes.train(frame, parts, entries, rounds)
    got = vector_codes.with_label_errors(found.rows).collect()
    expected, digest = by_hand(rows + odd, parts, entries, rounds)
    assert sorted(((r.vec_id, bytes(r.code).hex(), r.error, r.label_error) for r in got), key=repr) == expected
    assert found.sha256 == digest


def test_rounds_shuffle_only_what_changed(spark):
    """Parts that stay add nothing: the second round's changes are those of the parts that moved, and make the whole sums."""
    rng = random.Random(2)
    rows = spark.createDataFrame([(i, [rng.gauss(0, 1) for _ in range(4)], 0) for i in range(200)], "vec_id long, embedding array<double>, label int")
    kept = vector_codes.kept(rows, 256, "vec_id", "embedding", "label")
    books = np.array([[[-100, 0], [100, 0]], [[0, -100], [0, 100]]])
    first = vector_codes._assigned(kept.withColumn("code", vector_codes.F.lit(None).cast("binary")), books).cache()
    moved = books + 30
    second = vector_codes._assigned(first, moved).cache()
    total = {}
    for table in (first, second):
        for r in vector_codes.changes(table, 2, 2, 2).collect():
            total[r.part, r.entry, r.place] = total.get((r.part, r.entry, r.place), 0) + r.delta
    whole = {(r.part, r.entry, r.place): r.delta for r in vector_codes.changes(second.withColumn("was", vector_codes.F.lit(None).cast("binary")), 2, 2, 2).collect()}
    assert {k: v for k, v in total.items() if v} == whole
    third = vector_codes._assigned(second, moved)
    assert vector_codes.changes(third, 2, 2, 2).count() == 0
    gone = sum(a != b for r in second.collect() for a, b in zip(r.was, r.code))
    assert 0 < gone < 400


def test_few_rows_and_none(spark):
    schema = "vec_id long, embedding array<float>, label string"
    none = vector_codes.train(spark.createDataFrame([], schema))
    assert none.rows.collect() == [] and none.sha256 == hashlib.sha256(b"").hexdigest()
    one = vector_codes.train(spark.createDataFrame([(1, [0.5] * 16, "-"), (2, [0.5] * 16, None)], schema))
    assert {(r.vec_id, bytes(r.code), r.label_error) for r in vector_codes.with_label_errors(one.rows).collect()} == {(1, bytes(16), 0), (2, bytes(16), 0)}


def test_limits(spark):
    rows = spark.createDataFrame([(1, [1e30, 0.0], 0)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="too large"):
        vector_codes.train(rows, parts=2, rounds=0).rows.collect()
    with pytest.raises(ValueError):
        vector_codes.train(rows, entries=300)


def test_codes_stand_for_entries(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)], 0) for i in range(64)]
    found = vector_codes.train(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), parts=4, entries=16)
    for r in found.rows.collect():
        assert int(((vector_codes.decoded(bytes(r.code), found.codebooks) - np.array(r.v)) ** 2).sum()) == r.error
