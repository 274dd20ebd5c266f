"""Exact substring dedup: bytes inside long strings that also start elsewhere are removed.

Every window of ``length`` bytes is owned by its anchor, a short gram that equal
windows share at equal places (``suffixes.anchors``). The windows of an anchor
fall in classes by where it lies in them, and all windows of a class share a
longer string, so windows that could be equal meet by that string's hash, the
class's key. Stretches of text whose key occurs once are unique and drop out
before any text moves. The others are cut into contexts, the windows of one class
in one text with the bytes that they cover; equal contexts collapse, and the
distinct ones are dealt by key to tasks that suffix-sort half a megabyte at a
time and expand intervals on the BWT up to ``length``.

A key with more than ``HOT`` distinct contexts isn't handed to one task: its
windows are dealt anew in classes of ``CLASS`` places, and classes that are still
hot by whole windows, which then need no sorting as all that meet are equal.
Nothing is left out, at any size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.llm import suffixes, words
from offerloom.llm.line_rules import join_key
from offerloom.llm.storage import materialize

GRAM, HOT, CLASS, SIDES = 64, 256, 32, 2
#: Bytes that a task hashes or sorts at once.
HASH_BYTES, SORT_BYTES = 1 << 18, 1 << 19
#: A longer text is hashed in parts that overlap by one window.
PART = 1 << 23


def _digest(data: bytes) -> tuple[int, int]:
    import xxhash

    h = xxhash.xxh3_128_intdigest(data)
    return (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63)


def _batched(batch: pa.RecordBatch, column: str, most: int) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, values) of runs of rows with about ``most`` bytes."""
    start, held, out = 0, 0, []
    for i, x in enumerate(batch.column(column)):
        out.append(x.as_py() or b"")
        held += len(out[-1])
        if held >= most:
            yield start, out
            start, held, out = i + 1, 0, []
    if out:
        yield start, out


def text_anchors(texts: DataFrame, length: int) -> DataFrame:
    """(th1, th2, key, at, first, last) of every anchor and class of ``texts`` (th1, th2, body)."""
    gram = min(GRAM, max(1, length // 4))
    places = -(-(length - gram + 1) // SIDES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("th1", "th2"))
            for start, group in _batched(batch, "body", HASH_BYTES):
                parts = [(start + i, at, body[at : at + PART + length - 1]) for i, body in enumerate(group) for at in range(0, max(1, len(body) - length + 1), PART)]
                for part in ([p] for p in parts) if len(parts) > len(group) else [parts]:
                    rows, offsets = np.array([p[0] for p in part]), np.array([p[1] for p in part])
                    sizes = np.array([len(p[2]) for p in part], np.int64)
                    symbols = np.frombuffer(b"".join(p[2] for p in part), np.uint8).astype(np.uint64)
                    piece, at, first, last, key = suffixes.anchor_classes(symbols, np.cumsum(sizes) - sizes, sizes, length, gram, places)
                    off, row = offsets[piece], rows[piece]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (h1[row], h2[row], key, at + off, first + off, last + off)], names=["th1", "th2", "key", "at", "first", "last"])

    return texts.mapInArrow(run, "th1 long, th2 long, key long, at long, first long, last long")


def _contexts(texts: DataFrame, length: int, whole: bool) -> DataFrame:
    """Contexts of the flagged anchors of ``texts`` (th1, th2, body, anchors): their digest (c1, c2), and with ``whole``
    what they hold, else where they are."""
    schema = "k1 long, k2 long, c1 long, c2 long, anchor int, ctx binary" if whole else "th1 long, th2 long, first long, n int, c1 long, c2 long"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            seen, out = set(), []
            for x in frame.itertuples(index=False):
                for a in x.anchors:
                    ctx = x.body[a["first"] : a["last"] + length]
                    c1, c2 = _digest(ctx + int(a["key"]).to_bytes(8, "little", signed=True))
                    if not whole:
                        out.append((x.th1, x.th2, a["first"], a["last"] - a["first"] + 1, c1, c2))
                    elif (c1, c2) not in seen:
                        seen.add((c1, c2))
                        out.append((a["key"], 0, c1, c2, a["at"] - a["first"], ctx))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    return texts.mapInPandas(run, schema)


def _classes(contexts: DataFrame, length: int, places: int) -> tuple[DataFrame, DataFrame]:
    """Hot contexts cut by classes of ``places``: the parts as contexts, and where they lie in their parents."""

    def cut(x) -> Iterator[tuple]:
        n = len(x.ctx) - length + 1
        start = 0
        while start < n:
            # windows with their anchor at place o = anchor - start; a class holds o from c * places on
            c = (x.anchor - start) // places
            stop = min(n, x.anchor - c * places + 1)
            low = x.anchor - c * places - (places - 1)
            core = x.ctx[x.anchor - c * places : low + length]
            part = x.ctx[start : stop - 1 + length]
            k1, k2 = _digest(core + repr((x.k1, x.k2, c)).encode())
            c1, c2 = _digest(part + repr((k1, k2)).encode())
            yield k1, k2, c1, c2, x.anchor - start, part, start, stop - start
            start = stop

    def parts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([p[:6] for x in frame.itertuples(index=False) for p in cut(x)], columns=["k1", "k2", "c1", "c2", "anchor", "ctx"])

    def places_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([(x.c1, x.c2, p[6], p[7], p[2], p[3]) for x in frame.itertuples(index=False) for p in cut(x)], columns=["p1", "p2", "first", "n", "c1", "c2"])

    columns = contexts.select("k1", "k2", "c1", "c2", "anchor", "ctx")
    return (
        columns.mapInPandas(parts, "k1 long, k2 long, c1 long, c2 long, anchor int, ctx binary"),
        columns.mapInPandas(places_of, "p1 long, p2 long, first long, n int, c1 long, c2 long"),
    )


def _distinct(contexts: DataFrame, name: str) -> DataFrame:
    return materialize(contexts.groupBy("c1", "c2").agg(F.first("k1").alias("k1"), F.first("k2").alias("k2"), F.first("anchor").alias("anchor"), F.first("ctx").alias("ctx")), name)


def _sorted_apart(contexts: DataFrame, length: int) -> DataFrame:
    """(c1, c2, a, b): runs of windows, from start a to b, that start in another context too."""

    def solve(held: list[pd.DataFrame]) -> pd.DataFrame:
        frame = pd.concat(held, ignore_index=True)
        out = []
        for x, starts in zip(frame.itertuples(index=False), suffixes.repeated_starts([np.frombuffer(c, np.uint8) for c in frame["ctx"]], length)):
            edge = np.flatnonzero(np.diff(np.concatenate(([0], starts.view(np.int8), [0]))))
            out += [(x.c1, x.c2, int(a), int(b) - 1) for a, b in edge.reshape(-1, 2)]
        return pd.DataFrame(out, columns=["c1", "c2", "a", "b"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, tail = [], 0, pd.DataFrame()
        for frame in frames:
            frame = pd.concat([tail, frame], ignore_index=True) if len(tail) else frame
            if not len(frame):
                continue
            last = frame.iloc[-1]
            ends = (frame["k1"] != last["k1"]) | (frame["k2"] != last["k2"])
            n = int(ends.to_numpy().nonzero()[0].max(initial=-1)) + 1  # the last key's rows may go on
            done, tail = frame.iloc[:n], frame.iloc[n:]
            if len(done):
                held.append(done)
                size += int(done["ctx"].map(len).sum())
            if size >= SORT_BYTES:
                yield solve(held)
                held, size = [], 0
        if len(tail):
            held.append(tail)
        if held:
            yield solve(held)

    n = contexts.sparkSession.conf.get("spark.sql.shuffle.partitions")
    dealt = contexts.select("k1", "k2", "c1", "c2", "ctx").repartition(int(n), "k1", "k2").sortWithinPartitions("k1", "k2")
    return dealt.mapInPandas(run, "c1 long, c2 long, a long, b long")


def _several(places: DataFrame) -> DataFrame:
    """(c1, c2, a, b): all windows of contexts that lie in several places."""
    return places.groupBy("c1", "c2").agg(F.count("*").alias("places"), F.first("n").alias("n")).filter("places > 1").select("c1", "c2", F.lit(0).cast("long").alias("a"), (F.col("n") - 1).cast("long").alias("b"))


def _placed(found: DataFrame, places: DataFrame, *owner: str) -> DataFrame:
    """Runs in contexts as runs in what holds them: (owner columns, a, b)."""
    runs = found.select(join_key("c1", "c2").alias("ck"), "a", "b")
    return places.withColumn("ck", join_key("c1", "c2")).join(runs, "ck").select(*owner, (F.col("first") + F.col("a")).alias("a"), (F.col("first") + F.col("b")).alias("b"))


def repeated_windows(contexts: DataFrame, length: int) -> DataFrame:
    """(c1, c2, a, b) for distinct ``contexts``: windows that start in another one with the same key too."""
    found, asked = None, contexts
    chain: list[DataFrame] = []
    for places in (CLASS, 1):
        counts = asked.groupBy("k1", "k2").agg(F.count("*").alias("n_contexts"))
        sized = asked.withColumn("kk", join_key("k1", "k2")).join(counts.filter("n_contexts > 1").select(join_key("k1", "k2").alias("kk"), "n_contexts"), "kk")
        runs = _sorted_apart(sized.filter(F.col("n_contexts") <= HOT), length)
        for inner in reversed(chain):
            runs = _placed(runs, inner, "p1", "p2").toDF("c1", "c2", "a", "b")
        found = runs if found is None else found.unionByName(runs)
        hot = sized.filter(F.col("n_contexts") > HOT)
        parts, where = _classes(hot, length, places)
        where = materialize(where, "substrings-places")
        if where.isEmpty():
            return found
        chain.append(where)
        several = _several(where)
        for inner in reversed(chain):
            several = _placed(several, inner, "p1", "p2").toDF("c1", "c2", "a", "b")
        found = found.unionByName(several)
        asked = _distinct(parts, "substrings-classes") if places > 1 else asked
    return found


def dedup_substrings(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, spans, kept, sha256), a row a row of ``docs``: the removed runs as (start, stop) in bytes, and the
    bytes that are left, null where all are, as then the text is as it was; sha256 is that of the text before.

    Texts are UTF-8 bytes, null is empty. A byte goes if a string of ``length``
    bytes covers it that starts anywhere else too, in the same text or another;
    strings don't cross texts and are judged on the input. Repeated rows are
    copies of each other, so a row of at least ``length`` bytes that is repeated
    loses all. Texts shorter than ``length`` stay. Other columns are ignored.
    """
    body = F.encode(words.text_or_empty(F.col(text_col)), "UTF-8")
    rows = docs.select(F.col(id_col).alias("id"), body.alias("body"))
    h1, h2 = words.fingerprint(F.col("body"))
    rows = rows.withColumns({"th1": h1, "th2": h2})
    base = materialize(rows.select("id", "th1", "th2", F.octet_length("body").cast("long").alias("n_bytes"), F.sha2("body", 256).alias("sha256")), "substrings-base")

    copies = base.filter(F.col("n_bytes") >= length).groupBy("th1", "th2").agg(F.count("*").alias("copies"), F.max(F.struct("id")).alias("top")).select(join_key("th1", "th2").alias("tk"), "copies", "top.id")
    every = materialize(text_anchors(rows.filter(F.octet_length("body") >= length).select("th1", "th2", "body"), length), "substrings-anchors")
    # a key in one place of one text only is unique, however many copies the text has
    ends = every.groupBy("key").agg(F.min("th1").alias("t0"), F.max("th1").alias("t1"), F.min("at").alias("a0"), F.max("at").alias("a1"))
    often = ends.filter("t0 != t1 OR a0 != a1").select(F.hex("key").alias("hk"))
    flagged = every.withColumn("hk", F.hex("key")).join(often, "hk").groupBy("th1", "th2").agg(F.collect_set(F.struct("key", "at", "first", "last")).alias("anchors"))
    flagged = flagged.withColumn("tk", join_key("th1", "th2")).join(copies.select("tk", "copies", F.col("id").alias("top_id")), "tk").select(join_key("top_id", "th1", "th2").alias("rk"), "copies", "anchors")
    texts = rows.withColumn("rk", join_key("id", "th1", "th2")).join(flagged, "rk").select("id", "th1", "th2", "body", "copies", "anchors")
    texts = materialize(texts, "substrings-texts")

    places = materialize(_contexts(texts, length, False).distinct(), "substrings-places")
    contexts = _distinct(_contexts(texts, length, True), "substrings-contexts")
    found = repeated_windows(contexts, length).unionByName(_several(places))
    runs = _placed(found, places, "th1", "th2").groupBy("th1", "th2").agg(F.sort_array(F.collect_set(F.struct("a", "b"))).alias("runs"))
    runs = materialize(runs.select(join_key("th1", "th2").alias("tk"), "runs"), "substrings-runs")

    def strike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body, cuts in zip(batch.column("body").to_pylist(), batch.column("runs").to_pylist()):
                left, at, gone = [], 0, []
                for r in cuts:
                    start, stop = max(at, r["a"]), r["b"] + length
                    if stop <= at:
                        continue
                    if gone and start == at:
                        gone[-1]["stop"] = stop
                    else:
                        gone.append({"start": start, "stop": stop})
                    left.append(body[at:start])
                    at = stop
                left.append(body[at:])
                out.append((len(body), gone, b"".join(left), hashlib.sha256(body).hexdigest()))
            columns = [pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 4, (pa.int64(), pa.list_(pa.struct({"start": pa.int64(), "stop": pa.int64()})), pa.binary(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=["id", "n_bytes", "spans", "kept", "sha256"])

    # a text with copies goes whole; the others are rows of their own, so what is left of them needs no join
    once = texts.filter("copies = 1").withColumn("tk", join_key("th1", "th2")).join(runs, "tk").select("id", "body", "runs")
    spans = "array<struct<start: long, stop: long>>"
    struck = once.mapInArrow(strike, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, spans {spans}, kept binary, sha256 string")
    twice = copies.filter("copies > 1").select("tk", "copies")
    others = base.withColumn("tk", join_key("th1", "th2")).join(twice, "tk", "left")
    others = others.join(runs.select("tk", F.lit(True).alias("cut")), "tk", "left").filter("copies IS NOT NULL OR cut IS NULL")
    gone = F.col("copies").isNotNull()
    return others.select(
        "id",
        "n_bytes",
        F.when(gone, F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("stop")))).otherwise(F.array().cast(spans)).alias("spans"),
        F.when(gone, F.lit(b"")).alias("kept"),
        "sha256",
    ).unionByName(struck)


def removed(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256): what ``dedup_substrings`` takes and leaves, a row a row of ``docs``."""
    found = dedup_substrings(docs, length, id_col, text_col)
    return found.select(
        "id",
        "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["stop"] - x["start"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.coalesce(F.sha2("kept", 256), "sha256").alias("kept_sha256"),
    )
