"""Fill-in-the-middle: a text's prefix, middle and suffix in another order, cut between units by big integers.

A text's UTF-8 bytes are translated to class masks, one binary digit a byte, and a
mask is read as one integer whose bit i is byte i. Shifts and boolean operations of
whole masks mark the bytes where a unit begins, ``bit_count`` counts the units, and
the byte where the kth one begins is found by halving the mask: the lower half's
count says which half holds it. Masks are made of ``BLOCK`` bytes at a time, so a
text of any length needs the memory of its bytes and of one mask.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text in a mask.
BLOCK = 1 << 16
#: Bytes of output that a worker holds before it hands them on, and the text that is above.
OUTPUT_BYTES = 1 << 20
#: The marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, SPM, PSM = "plain", "spm", "psm"


def _class(members) -> bytes:
    """A translation of the bytes that says which of them are ``members``, as binary digits."""
    held = frozenset(members)
    return bytes(ord("1") if b in held else ord("0") for b in range(256))


_CONTINUED = _class(range(0x80, 0xC0))
_BLANK = _class(b" \t\n\x0b\x0c\r")
_NEWLINE = _class(b"\n")


def _mask(block: bytes, members: bytes) -> int:
    """Bit i says whether byte i of ``block`` is a member."""
    return int(block[::-1].translate(members), 2)


def _begins(block: bytes, unit: str, before: int) -> tuple[int, int]:
    """(mask of the bytes where a unit begins, what the next block's first byte has to know); ``before`` is that of this block."""
    full = (1 << len(block)) - 1
    if unit == "codepoint":
        return full & ~_mask(block, _CONTINUED), 0
    if unit == "word":  # a word with the white space before it; white space at the end is a unit of its own or the last word's
        blank = _mask(block, _BLANK)
        word = full & ~blank
        return word & (blank << 1 | before), blank >> len(block) - 1
    if unit == "line":  # a line with its newline
        newline = _mask(block, _NEWLINE)
        return full & (newline << 1 | before), newline >> len(block) - 1
    raise ValueError(f"unit must be codepoint, word or line, not {unit!r}")


@dataclass(frozen=True)
class Marks:
    """Where the units of a text begin: a count a block, and the blocks' masks made again when they are asked for."""

    data: bytes
    unit: str
    counts: tuple[int, ...]
    carried: tuple[int, ...]

    @classmethod
    def of(cls, data: bytes, unit: str = "codepoint") -> Marks:
        counts, carried, before = [], [], 1
        for at in range(0, len(data), BLOCK):
            carried.append(before)
            mask, before = _begins(data[at : at + BLOCK], unit, before)
            counts.append(mask.bit_count())
        return cls(data, unit, tuple(counts), tuple(carried))

    @property
    def n(self) -> int:
        return sum(self.counts)

    def start(self, k: int) -> int:
        """The byte where unit k begins; the end of the text if there is none. Unit 0 begins with the text."""
        if k <= 0:
            return 0
        for i, count in enumerate(self.counts):
            if k < count:
                at = i * BLOCK
                block = self.data[at : at + BLOCK]
                return at + _select(_begins(block, self.unit, self.carried[i])[0], len(block), k)
            k -= count
        return len(self.data)


def _select(mask: int, width: int, k: int) -> int:
    """The place of the kth set bit (from 0) of ``mask``, which has more than k, by halving."""
    if width == 1:
        return 0
    half = width >> 1
    low = mask & ((1 << half) - 1)
    below = low.bit_count()
    return _select(low, half, k) if k < below else half + _select(mask >> half, width - half, k - below)


def draws(seed: int, row_id: int | None) -> tuple[int, int, int, int]:
    """h1 to h4: the first four groups of eight digits of the SHA-256 of ``seed:id``, without an id of ``seed:``."""
    digest = hashlib.sha256(f"{seed}:{'' if row_id is None else row_id}".encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in range(0, 32, 8))


def rearranged(data: bytes, hashes: tuple[int, int, int, int], unit: str = "codepoint", rate: int = 90, spm_rate: int = 20) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, units of the prefix, units of the middle, output) of one text."""
    marks = Marks.of(data, unit)
    n, (h1, h2, h3, h4) = marks.n, hashes
    if not data or h3 % 100 >= rate or any(m in data for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, PLAIN, None, None, data
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = marks.start(low), marks.start(high)
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    if h4 % 100 < spm_rate:
        return n, SPM, low, high - low, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return n, PSM, low, high - low, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


def rebuilt(output: bytes, form: str) -> bytes:
    """The text of an output: no part holds a mark, and a mark begins and ends with bytes that it has once, so the first marks found are those put in."""
    if form == PLAIN:
        return output
    first, second = (SUFFIX, PREFIX) if form == SPM else (PREFIX, SUFFIX)
    one, _, rest = output[len(first) :].partition(second)
    two, _, middle = rest.partition(MIDDLE)
    return two + middle + one if form == SPM else one + middle + two


def transform(docs: DataFrame, seed: int = 1, unit: str = "codepoint", rate: int = 90, spm_rate: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, form, prefix_units, middle_units, output binary): a row a row of ``docs``, its text rearranged.

    ``unit`` is a code point, a word (with the white space before it) or a line (with
    its newline). ``rate`` percent of the texts are rearranged, of these ``spm_rate``
    percent suffix first; id and ``seed`` alone draw that and the cuts, so reruns
    agree and rows of one id are drawn alike. A null text is empty; empty texts and
    texts that hold a mark stay plain, with null counts. Rows with a null id are drawn
    as by an empty one. Repeated rows stay, other columns are ignored, and a very
    long text is cut whole, within the memory of a few copies of it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_pylist()
            out, held = [], 0
            for k, body in enumerate(batch.column("body"), 1):
                out.append((ids[k - 1], *rearranged(body.as_py(), draws(seed, ids[k - 1]), unit, rate, spm_rate)))
                held += len(out[-1][-1])
                if held >= OUTPUT_BYTES or k == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TYPES)], names=_NAMES)
                    out, held = [], 0

    rows = docs.select(F.col(id_col).cast("long").alias("id"), _bytes(F.col(text_col)).alias("body"))
    return rows.mapInArrow(run, "id long, n long, form string, prefix_units long, middle_units long, output binary")


def restore(rows: DataFrame) -> DataFrame:
    """``rows`` of ``transform`` with ``text`` (binary), rebuilt from output and form alone."""
    schema = T.StructType([*rows.schema.fields, T.StructField("text", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [rebuilt(o.as_py(), f) for o, f in zip(batch.column("output"), batch.column("form").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=[*batch.schema.names, "text"])

    return rows.mapInArrow(run, schema)


_NAMES = ["id", "n", "form", "prefix_units", "middle_units", "output"]
_TYPES = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())


def _bytes(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")
