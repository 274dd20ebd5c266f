import hashlib
import random
import re

import pytest

from offerloom.llm import fim

#: How units are cut by hand.
UNITS = {"codepoint": lambda t: list(t), "word": lambda t: re.findall(r"[ \t\n\x0b\x0c\r]*[^ \t\n\x0b\x0c\r]+", t), "line": lambda t: t.splitlines(keepends=True) if t else []}


def by_hand(doc_id, text, unit="codepoint", seed=1):
    digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    units = UNITS[unit](text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle = "".join(units[:a]), "".join(units[a:b])
    suffix = text[len(prefix) + len(middle) :]
    if b == n:
        middle, suffix = text[len(prefix) :] if a < n else "", "" if a < n else suffix
    if a == n:
        prefix, middle, suffix = text, "", ""
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("block", [1, 3, 64, 1 << 16])
def test_units_and_their_starts(monkeypatch, block):
    monkeypatch.setattr(fim, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(200):
        text = "".join(rng.choice("ab é漢😀\t\n<") for _ in range(rng.randrange(60)))
        for unit, cut in UNITS.items():
            if unit == "line" and re.search("[\x0b\x0c\x85]", text):
                continue
            marks, units = fim.Marks.of(text.encode(), unit), cut(text)
            assert marks.n == len(units)
            if unit != "word":
                assert [marks.start(k) for k in range(marks.n)] == [len("".join(units[:k]).encode()) for k in range(marks.n)]
            else:  # a word begins with itself, the white space before it is the one before's
                assert [marks.start(k) for k in range(1, marks.n)] == [len(text[: m.start()].encode()) for m in list(re.finditer("[^ \t\n]+", text))[1:]]
            assert marks.start(marks.n) == len(text.encode()) or not units


def test_against_slices(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("abcé漢😀 \n<>PSM") for _ in range(rng.randrange(200))), 5, "x") for i in range(400)]
    rows += [(1000, None, 1, "y"), (1001, "", 1, "y"), (1002, "a<P>b", 1, "y"), (7, rows[7][1], 5, "x"), (None, "abc", 1, "z"), (1003, "né漢" * 300_000, 1, "z"), (1004, "<" * 50, 1, ""), (1005, "<S<M<P", 1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long, output string").repartition(3)
    got = fim.restore(fim.transform(docs)).collect()
    expected = sorted(repr((i, *(x := by_hand("" if i is None else i, t or ""))[:4], x[4].encode(), (t or "").encode())) for i, t, _, _ in rows)
    assert sorted(repr((r.id, r.n, r.form, r.prefix_units, r.middle_units, bytes(r.output), bytes(r.text))) for r in got) == expected
    assert {r.form for r in got} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("unit", ["word", "line"])
def test_other_units_restore(spark, unit):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice("ab é\n\t") for _ in range(rng.randrange(80)))) for i in range(200)]
    got = fim.restore(fim.transform(spark.createDataFrame(rows, "k long, body string"), unit=unit, rate=100, spm_rate=50, id_col="k", text_col="body")).collect()
    texts = dict(rows)
    assert all(bytes(r.text).decode() == texts[r.id] for r in got) and {r.form for r in got if texts[r.id]} == {"psm", "spm"}
    for r in got:
        units = UNITS[unit](texts[r.id])
        if r.form == "psm" and 0 < r.prefix_units < r.n and unit == "line":
            assert bytes(r.output).decode().startswith("<P>" + "".join(units[: r.prefix_units]) + "<S>")


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert fim.restore(fim.transform(docs)).collect() == []


def test_unknown_unit():
    with pytest.raises(ValueError):
        fim.Marks.of(b"a", "page")
