"""Byte-level BPE as a tree reduction over a text, and back.

Encoded texts form a monoid: the tokens of two neighbours follow from their own
tokens and the text around the cut. A text is halved down to leaves, and each
join re-encodes a window about the cut that grows on either side until it ends
at a boundary that no context can move: white space after a letter, a digit or
punctuation. No match of the split pattern holds white space anywhere but at its
start (or is white space only), so one match ends there whatever surrounds it,
and tokens outside the window are the same in the whole text as in the half.
Decoding maps leaves of tokens to bytes and concatenates up the same tree.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Characters of a leaf; most documents have more, so joins make most of the token lists. Against one leaf a text it costs a third more time.
LEAF_CHARS = 256
FIRST_WINDOW = 32
#: Rows that a worker encodes before it hands them on.
BATCH_ROWS = 128
#: ASCII punctuation that is no apostrophe; with letters and digits, what may come before a sure boundary.
_SURE = frozenset('!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~')


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str):
    """The vocabulary of a rank file, loaded once in a worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _sure(text: str, i: int) -> bool:
    return text[i] in " \n" and (text[i - 1].isalnum() or text[i - 1] in _SURE)


def join(text: str, start: int, cut: int, end: int, left: list[int], right: list[int], encode) -> list[int]:
    """Tokens of text[start:end] from those of its two parts."""
    low, width = cut, FIRST_WINDOW
    while True:
        at = max(start, cut - width)
        low = next((i for i in range(low - 1, at, -1) if _sure(text, i)), at)
        if low > at or at == start:
            break
        width *= 2
    high, width = cut, FIRST_WINDOW
    while True:
        at = min(end, cut + width)
        high = next((i for i in range(high + 1, at) if _sure(text, i)), at)
        if high < at or at == end:
            break
        width *= 2
    keep = len(left) - len(encode(text[low:cut])) if low > start else 0
    skip = len(encode(text[cut:high])) if high < end else len(right)
    return left[:keep] + encode(text[low:high]) + right[skip:]


def encode_text(text: str, encode, leaf: int = LEAF_CHARS) -> list[int]:
    """Token ids of a whole text."""

    def part(start: int, end: int) -> list[int]:
        if end - start <= leaf:
            return encode(text[start:end])
        cut = (start + end) // 2
        return join(text, start, cut, end, part(start, cut), part(cut, end), encode)

    return part(0, len(text))


def decode_ids(ids: list[int], decode, leaf: int = LEAF_CHARS) -> bytes:
    """Bytes of a list of token ids."""
    if len(ids) <= leaf:
        return decode(ids)
    cut = len(ids) // 2
    return decode_ids(ids[:cut], decode, leaf) + decode_ids(ids[cut:], decode, leaf)


def _mapped(df: DataFrame, source: str, outs: list[tuple[str, T.DataType, pa.DataType]], make) -> DataFrame:
    """``df`` with columns ``outs`` that the functions of ``make()`` give, the first one of ``source``, each other of the one before.

    Values are made a row at a time and kept as Arrow arrays; no batch is ever a list of Python numbers.
    """
    names = [c for c in df.columns if c not in [o[0] for o in outs]]
    schema = T.StructType([df.schema[c] for c in names] + [T.StructField(name, kind) for name, kind, _ in outs])
    row_names = [name for name, _, _ in outs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = make()
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                made: list[list] = [[] for _ in outs]
                for x in batch.column(source):
                    x = x.as_py()
                    for f, column, (_, _, arrow) in zip(chain, made, outs):
                        x = f(x)
                        column.append(np.asarray(x, np.int32) if pa.types.is_list(arrow) else x)
                got = [pa.array(column, arrow) for column, (_, _, arrow) in zip(made, outs)]
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + got, names=[*names, *row_names])

    return df.mapInArrow(run, schema)


def _encoding(ranks_path: str, pattern: str, leaf: int):
    enc = encoder(ranks_path, pattern).encode_ordinary
    return lambda text: encode_text(text, enc, leaf) if text else []


def _decoding(ranks_path: str, pattern: str, leaf: int):
    dec = encoder(ranks_path, pattern).decode_bytes
    return lambda ids: decode_ids(ids, dec, leaf) if ids else b""


def _ids(name: str) -> tuple[str, T.DataType, pa.DataType]:
    return name, T.ArrayType(T.IntegerType()), pa.list_(pa.int32())


def _bytes(name: str) -> tuple[str, T.DataType, pa.DataType]:
    return name, T.BinaryType(), pa.binary()


def encode(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", out_col: str = "tokens", leaf: int = LEAF_CHARS) -> DataFrame:
    """Adds ``out_col`` array<int>: the token ids of the whole text, without special tokens.

    A null or empty text has no tokens; a text of any length is encoded whole. ``out_col`` replaces a column of that
    name; all others stay, and each row is encoded by itself, so repeated rows
    repeat. ``ranks_path`` must be readable on every executor.
    """
    return _mapped(df, text_col, [_ids(out_col)], lambda: [_encoding(ranks_path, pattern, leaf)])


def decode(df: DataFrame, ranks_path: str, pattern: str, ids_col: str = "tokens", out_col: str = "decoded", leaf: int = LEAF_CHARS) -> DataFrame:
    """Adds ``out_col`` binary: the bytes that the ids stand for; none for null or no ids."""
    return _mapped(df, ids_col, [_bytes(out_col)], lambda: [_decoding(ranks_path, pattern, leaf)])


def encode_and_decode(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", ids_col: str = "tokens", out_col: str = "decoded", leaf: int = LEAF_CHARS) -> DataFrame:
    """``encode``, then ``decode`` of the ids, in one pass: a task has one Python worker and not two."""
    return _mapped(df, text_col, [_ids(ids_col), _bytes(out_col)], lambda: [_encoding(ranks_path, pattern, leaf), _decoding(ranks_path, pattern, leaf)])
