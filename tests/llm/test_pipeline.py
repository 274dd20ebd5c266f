import random
from collections import Counter

import public_tokenizers

import corpus_pipeline
from offerloom.llm import bpe
from tests.llm.test_native import brute_quality

LINE = "this line of forty characters and more is in many documents"
OTHER = "this line is in fewer of them, under a tenth of each source"


def corpus(rng):
    words = [f"word{i}" for i in range(300)]
    text = lambda n: "\n".join(" ".join(rng.choice(words) for _ in range(12)) for _ in range(n))
    rows = [(i, text(rng.randrange(2, 9)) + (f"\n{LINE}" if i % 4 == 0 else "") + (f"\n{OTHER}" if i % 18 == 1 else ""), "en", rng.choice("abc")) for i in range(150)]
    long = text(30)
    rows += [(1000 + i, long.replace(f"word{i}", "other", 1), "en", "a") for i in range(5)] + [(1010, long, "en", "b"), (1011, long, "en", "b")]
    rows += [(2000, "too short", "en", "a"), (2001, "same words here again now " * 30, "en", "a"), (2002, None, "en", None), (2003, "", None, "a")]
    return [(*r, len(r[1] or "")) for r in rows]


def test_stages_against_brute_force(spark, tmp_path):
    rows = corpus(random.Random(2))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/sf/documents.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/sf/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, f"{tmp_path}/sf")
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append({r.doc_id: r for r in docs.collect()} if k != 3 else docs.collect())

    keeps, cleaned = brute_quality([(r[0], r[1], r[3]) for r in rows])
    good = {r[0]: cleaned[n] for n, r in enumerate(rows) if keeps[n]}
    assert all(LINE not in t for t in good.values()) and sum(OTHER in t for t in good.values()) >= 5
    assert {1000, 1010} & set(good) and not {2000, 2001, 2002, 2003} & set(good)
    assert {i: r.text for i, r in kept[0].items()} == good

    counts = Counter(x for t in good.values() for x in set(t.split("\n")) if len(x) >= 40)
    repeated = {x: max(i for i, t in good.items() if x in t.split("\n")) for x, n in counts.items() if n >= 5}
    deduped = {i: "\n".join(x for x in t.split("\n") if x not in repeated or i == repeated[x]) for i, t in good.items()}
    assert {i: r.text for i, r in kept[1].items()} == deduped
    assert all(r.n_chars == len(r.text) for r in kept[1].values())

    def bag(t):
        w = t.split()
        return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()

    label = {i: i for i in deduped}
    bags = {i: bag(t) for i, t in deduped.items()}
    for a in bags:
        for b in bags:
            if a < b and bags[a] and bags[b] and sum((bags[a] & bags[b]).values()) >= 0.8 * sum((bags[a] | bags[b]).values()):
                low, high = sorted((label[a], label[b]))
                label = {i: low if x == high else x for i, x in label.items()}
    assert {i: r.text for i, r in kept[2].items()} == {i: deduped[i] for i in set(label.values())}

    times = Counter(r.doc_id for r in kept[3])
    assert set(times) <= set(kept[2]) and max(times.values()) <= 2
    size = {i: len(r.text.split()) for i, r in kept[2].items()}
    spare = 1.5 * sum(size.values()) - sum(size[i] * n for i, n in times.items())
    assert 0 <= spare < 3 * max(size.values())  # three sources, whole documents

    enc = bpe.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    final = docs.collect()
    assert Counter(r.doc_id for r in final) == times
    assert all(r.round_trip and list(r.tokens) == enc.encode_ordinary(kept[2][r.doc_id].text) and r.n_tokens == len(r.tokens) for r in final)


def test_run_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/sf/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/sf").count() == 0
