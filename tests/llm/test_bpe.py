import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from offerloom.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list("ab l'lsretv  \n\t 　\x1c9.,'é漢😀")), st.characters(exclude_categories=["Cs"])), max_size=80), st.integers(1, 9))
def test_tree_equals_whole(text, leaf):
    enc = bpe.encoder(PATH, PATTERN)
    ids = bpe.encode_text(text, enc.encode_ordinary, leaf)
    assert ids == enc.encode_ordinary(text)
    assert bpe.decode_ids(ids, enc.decode_bytes, leaf) == text.encode()


def test_long_texts_without_sure_boundaries():
    enc = bpe.encoder(PATH, PATTERN)
    for text in ("漢字" * 3000, "x" * 5000, " " * 5000, "a 'll" * 2000, "\n \n" * 2000, "word " * 20000):
        assert bpe.encode_text(text, enc.encode_ordinary, 100) == enc.encode_ordinary(text)


def test_frame(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 6), (3, "Hello world", 7), (3, "Hello world", 7)], "doc_id int, text string, tokens int")
    rows = bpe.decode(bpe.encode(docs, PATH, PATTERN), PATH, PATTERN).collect()
    assert [bytes(r.decoded).decode() for r in rows] == ["", "", "Hello world", "Hello world"]
    assert [len(r.tokens) for r in rows] == [0, 0, 2, 2]
    both = bpe.encode_and_decode(docs, PATH, PATTERN)
    assert both.columns == ["doc_id", "text", "tokens", "decoded"] and both.collect() == rows
    assert bpe.encode(docs.limit(0), PATH, PATTERN).count() == 0


def test_registered_query(spark, tmp_path):
    """Digests of the registered query against the library's own encoding of each whole text, very long ones too."""
    import hashlib

    from offerloom.llm import queries

    rows = [(1, None), (2, ""), (3, "Grüße, 'll  x\n\ny"), (4, "word list " * 30_000), (5, "漢字" * 4000), (6, "same"), (7, "same"), (2**60 + 1, " \t ")]
    spark.createDataFrame([(*r, "s", 3) for r in rows], "doc_id long, text string, tokens string, n_tokens int").write.parquet(f"{tmp_path}/documents.parquet")
    enc = bpe.encoder(PATH, PATTERN)
    digest = lambda b: hashlib.sha256(b).hexdigest()
    ids = {i: enc.encode_ordinary(t or "") for i, t in rows}
    expected = {i: (len(ids[i]), digest(" ".join(map(str, ids[i])).encode()), digest((t or "").encode())) for i, t in rows}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op6_bpe(spark, str(tmp_path)).collect()}
    assert got == expected
