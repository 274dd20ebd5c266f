"""Codes of vectors: parts by the nearest entry of a codebook each, trained by Lloyd rounds on deltas.

A round keeps the code that every vector had before. Only parts whose entry changed
contribute to the next codebook: minus the part where it was, plus where it is. A
task sums these by part position and entry, so a round shuffles a number for each
touched component of the codebook and task, and nothing once assignments settle.
All sums are of integers, so the order in which tasks end changes nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.llm.storage import materialize, release

#: Numbers that a worker holds at once of distances.
CELLS = 1 << 20
#: Below this, sums of products are exact in doubles and BLAS can make them.
EXACT = 1 << 53
#: Numbers in all codebooks together at most; they go to every task and to the driver.
CODEBOOK_CELLS = 1 << 22


@dataclass(frozen=True)
class Codes:
    """``rows`` (vec_id, label, v, code binary, error long), a byte of ``code`` a part; ``codebooks`` (parts, entries, width) int64."""

    rows: DataFrame
    codebooks: np.ndarray

    @property
    def sha256(self) -> str:
        """Of the decimal components by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()


def kept(vectors: DataFrame, scale: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, v array<long>): floor(scale * x) of every component; rows without a whole vector are left out."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), x.alias("x"))
    whole = rows.filter(F.col("x").isNotNull() & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    return whole.select("vec_id", "label", F.transform("x", lambda c: F.floor(c * scale).cast("long")).alias("v"))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of ``width`` numbers, shorter ones with zeros behind."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def nearest(rows: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entries (n, parts) uint8, squared distances summed over parts): the nearest entry of each part, the first of equals."""
    parts, entries, width = books.shape
    n = len(rows)
    code, error = np.zeros((n, parts), np.uint8), np.zeros(n, np.int64)
    if not n:
        return code, error
    most = max(abs(int(x)) for a in (rows, books) for x in (a.min(initial=0), a.max(initial=0)))
    if 4 * most * most * max(width, 1) * parts >= 1 << 62:
        raise ValueError("components are too large for the errors to be longs")
    kind = np.float64 if 4 * most * most * max(width, 1) < EXACT else np.int64
    step = max(1, CELLS // max(1, entries))
    for p in range(parts):
        book = books[p].astype(kind)
        norms = (book * book).sum(axis=1)
        for at in range(0, n, step):
            x = rows[at : at + step, p * width : (p + 1) * width].astype(kind)
            far = norms - 2 * (x @ book.T)  # less the part's own norm, which all entries share
            best = far.argmin(axis=1)
            code[at : at + step, p] = best
            error[at : at + step] += (far[np.arange(len(x)), best] + (x * x).sum(axis=1)).astype(np.int64)
    return code, error


def _assigned(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``rows`` (vec_id, label, v, code) with a new ``code``, the one before as ``was`` (null if there was none), and ``error``."""
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, error = nearest(_matrix(batch.column("v"), parts * width), books)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("vec_id", "label", "v")), batch.column("code"), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(error)],
                names=["vec_id", "label", "v", "was", "code", "error"],
            )

    label = rows.schema["label"].dataType.simpleString()
    return rows.select("vec_id", "label", "v", "code").mapInArrow(run, f"vec_id long, label {label}, v array<long>, was binary, code binary, error long")


def changes(rows: DataFrame, parts: int, entries: int, width: int) -> DataFrame:
    """(part, entry, place, delta) of ``rows`` (v, was, code): what the parts that moved add to their entries' sums, and to their counts at ``place`` -1.

    A task hands on what isn't zero of its sums, so rows are as many as the codebooks have numbers at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            v = _matrix(batch.column("v"), parts * width).reshape(-1, parts, width)
            code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, parts)
            was = np.array([np.frombuffer(w, np.uint8).astype(np.int64) if w is not None else np.full(parts, -1) for w in batch.column("was").to_pylist()], np.int64).reshape(-1, parts)
            for p in range(parts):
                moved = np.flatnonzero(code[:, p] != was[:, p])
                for entry, sign in ((code[moved, p].astype(np.int64), 1), (was[moved, p], -1)):
                    known = entry >= 0
                    np.add.at(sums[p], entry[known], sign * v[moved[known], p])
                    np.add.at(counts[p], entry[known], sign)
        both = np.concatenate([counts[:, :, None], sums], axis=2)
        part, entry, place = np.nonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array((place - 1).astype(np.int32)), pa.array(both[part, entry, place])], names=["part", "entry", "place", "delta"])

    return rows.select("v", "was", "code").mapInArrow(run, "part int, entry int, place int, delta long").groupBy("part", "entry", "place").agg(F.sum("delta").alias("delta"))


def train(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> Codes:
    """Codes of ``vectors``, by codebooks that start as the first ``entries`` vectors by id and take ``rounds`` of Lloyd.

    Each component x is floor(scale * x). A vector is cut into ``parts`` equal parts;
    vectors shorter than the longest, and lengths that ``parts`` doesn't divide, have
    zeros behind. Rows whose vector is null or holds a null or non-finite component
    are left out; an empty vector is whole. Repeated rows and ids stay, each a row; among equal ids
    the smaller vector starts, and rows with a null id come last. Of entries equally near
    the first is taken, and an entry that nothing is near stays as it is. With fewer
    rows than ``entries`` the codebooks are that small, and empty for an empty table.
    Any width is handled whole up to ``CODEBOOK_CELLS`` numbers in the codebooks,
    which is checked, as tasks and the driver hold them. Other columns are ignored.
    Components must be small enough that errors are longs, else ValueError.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a byte holds a part's code: 1 to 256 entries")
    rows = materialize(kept(vectors, scale, id_col, vector_col, label_col), "codes-rows")
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    width = -(-longest // parts)
    if parts * entries * width > CODEBOOK_CELLS:
        raise ValueError(f"codebooks of {parts * entries * width} numbers; at most {CODEBOOK_CELLS} go to every task")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    seeds = np.zeros((len(first), parts * width), np.int64)
    for i, r in enumerate(first):
        seeds[i, : len(r["v"])] = r["v"]
    books = np.ascontiguousarray(seeds.reshape(len(first), parts, width).transpose(1, 0, 2))
    counts, sums = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
    coded = rows.withColumn("code", F.lit(None).cast("binary"))
    for n in range(rounds):
        before, coded = coded, materialize(_assigned(coded, books), f"codes-round-{n}")
        release(before if n else rows)
        for r in changes(coded, *books.shape).collect():  # no more than the codebooks have numbers
            if r["place"] < 0:
                counts[r["part"], r["entry"]] += r["delta"]
            else:
                sums[r["part"], r["entry"], r["place"]] += r["delta"]
        books = np.where(counts[:, :, None] > 0, sums // np.maximum(counts, 1)[:, :, None], books)
    last = materialize(_assigned(coded, books), "codes")
    release(coded)
    return Codes(last.drop("was"), books)


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` (label, error, ...) with ``label_error``: the errors of equal labels together, those of nulls too."""
    key = F.coalesce(F.concat(F.lit("l"), F.col("label").cast("string")), F.lit("-"))  # not the label itself: the join is dealt anew, and Spark may split a hot label
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")).select(key.alias("_label"), "label_error")
    return coded.withColumn("_label", key).join(sums, "_label").drop("_label")


def decoded(code: bytes, books: np.ndarray) -> np.ndarray:
    """The integers that a code stands for."""
    return books[np.arange(len(books)), np.frombuffer(code, np.uint8)].ravel()
