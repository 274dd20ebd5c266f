"""Similarity join of sets of word n-grams by PartEnum signatures, exact.

Sets of a Jaccard similarity of ``percent`` or more differ in few elements: of sizes
n and m, in (n + m) (100 - percent) / (100 + percent) at most, k in short, and m lies
within percent of n. So sizes are cut into bands, and two such sets share a band or
lie in adjacent ones; a set takes part in its own band, and in the next one where a
partner could be that large. A band divides the domain of elements by hash into
groups of ``parts`` partitions. If there are more groups than k / (spare + 1), two sets
agree in some group on all but ``spare`` partitions, so they share the signature of one
of the subsets of parts - spare partitions, all of which are enumerated. A signature
is the sum of the hashes of the elements there.

Many sets have no element in some subset, and all would share its signature. Such
signatures aren't used: a set takes ``more`` groups than it must, and as long as no
more of them than that hold an empty subset, one that it shares with a partner is
filled. Sets that have more (about one in a hundred) are divided again by another
hash, with whom only their like can be partners by then, up to ``SEEDS`` times; in the
last one they use the empty subsets too. So no pair is lost, and no signature is
shared by a fixed share of all sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.llm import words
from offerloom.llm.bagminhash import mix, shingles, word_hashes
from offerloom.llm.components import components, joined, merged
from offerloom.llm.line_rules import join_key, moved
from offerloom.llm.storage import materialize

_U = np.uint64
#: Sets of a bucket that all others are compared with, before it is searched whole.
STARS = 3
#: Divisions of the domain that a set tries one after another.
SEEDS = 4
#: Bands up to so many elements enumerate the pairs of three partitions; larger ones have elements enough in a single one.
SMALL = 64
#: Bytes of text that a worker signs at once; about so many sets, and bytes of their texts, in a tile of a bucket.
SIGN_BYTES, TILE, TILE_BYTES = 1 << 18, 256, 4 << 20


class Band(NamedTuple):
    """Sizes up to ``most`` that don't fit the band before, and how it divides the domain."""

    most: int
    groups: int
    parts: int
    spare: int
    more: int


def distance(sizes: int, percent: int) -> int:
    """The most elements in which two sets with ``sizes`` elements together may differ."""
    return sizes * (100 - percent) // (100 + percent)


@lru_cache
def bands(percent: int, largest: int) -> tuple[Band, ...]:
    """The bands of all sizes up to ``largest`` and of one more, each so wide that partners lie in it or the next one."""
    out, least, before = [], 1, 1
    while not out or len(out) < 2 or out[-2].most < largest:
        most = max(least, least * 10000 // (percent * percent))
        k = distance(2 * most, percent)
        parts, spare = (3, 1) if k and most <= SMALL else (1, 0)
        smallest = max(1, before * percent // 100)  # a set of the band before that takes part
        more = 0
        while k:  # until the groups with an empty subset that such a set has are ``more`` at most, but for one set in a hundred
            groups = k // (spare + 1) + 1 + more
            expected = groups * parts * (1 - (parts - spare) / (groups * parts)) ** smallest
            need = 0 if expected < 0.005 else math.ceil(expected + 3 * expected**0.5)
            if need <= more or more > k:
                break
            more += 1
        out.append(Band(most, k // (spare + 1) + 1 + more, parts, spare, more))
        before, least = least, most + 1
    return tuple(out)


def elements(data: np.ndarray, ends: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of the distinct runs of ``window`` words of texts in ``data``, by text and hash; a shorter text is one run."""
    upper = (data >= 65) & (data <= 90)
    h, bag = shingles(*word_hashes(data + (upper.astype(np.uint8) << 5), ends), window)
    order = np.lexsort((h, bag))
    h, bag = h[order], bag[order]
    first = np.append(True, (h[1:] != h[:-1]) | (bag[1:] != bag[:-1])) if len(h) else np.zeros(0, bool)
    return h[first], bag[first]


def _sums(values: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.uint64)
    np.add.at(out, slot, values)
    return out


def _divided(h: np.ndarray, own: np.ndarray, groups: np.ndarray, band: Band, number: int, seed: int) -> tuple[np.ndarray, ...]:
    """(set, signature, filled, empty groups of each set) of sets with elements ``h`` of set ``own``, which take the first ``groups`` of the band's groups."""
    tag = mix(np.full(1, (number * SEEDS + seed + 1) % (1 << 62), np.uint64) * _U(0x9E3779B97F4A7C15))
    part = (mix(h ^ tag) % _U(band.groups * band.parts)).astype(np.int64)
    used = part // band.parts < groups[own]
    h, own, part = h[used], own[used], part[used]
    start = np.cumsum(groups) - groups
    slot = start[own] * band.parts + part
    n = int(groups.sum())
    sums = _sums(mix(h + tag), slot, n * band.parts).reshape(n, band.parts)
    count = np.bincount(slot, minlength=n * band.parts).reshape(n, band.parts)
    if band.spare:
        sums, count = sums.sum(axis=1, keepdims=True) - sums, count.sum(axis=1, keepdims=True) - count
    place = np.arange(n) - np.repeat(start, groups)
    names = mix((place[:, None] * band.parts + np.arange(band.parts)[None, :] + 1).astype(np.uint64) ^ tag)
    signature = mix(sums ^ names)
    of = np.repeat(np.arange(len(groups)), groups)
    filled = count > 0
    empty = np.bincount(of, weights=(~filled).any(axis=1), minlength=len(groups)).astype(np.int64)
    return np.repeat(of, band.parts), signature.ravel(), filled.ravel(), empty


def signatures(h: np.ndarray, own: np.ndarray, n_sets: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(signature, set) of sets that have the distinct elements ``h`` of set ``own``, in order of sets."""
    size = np.bincount(own, minlength=n_sets)
    every = bands(percent, int(size.max(initial=0)))
    edges = np.array([b.most for b in every])
    band_of = np.searchsorted(edges, size)
    partner = 100 * size // percent
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for number, band in enumerate(every):
        if band.groups == 1 and band.spare == 0:  # no difference is allowed: equal sets are one already
            continue
        sets = np.flatnonzero((size > 0) & ((band_of == number) | (band_of == number - 1) & (partner > edges[number - 1])))
        for seed in range(SEEDS):
            if not len(sets):
                break
            index = np.full(n_sets, -1)
            index[sets] = np.arange(len(sets))
            inside = index[own] >= 0
            k = (size[sets] + np.minimum(partner[sets], band.most)) * (100 - percent) // (100 + percent)
            groups = np.minimum(k // (band.spare + 1) + 1 + band.more, band.groups)
            of, signature, filled, empty = _divided(h[inside], index[own[inside]], groups, band, number, seed)
            poor = empty > band.more
            use = filled | poor[of] if seed == SEEDS - 1 else filled
            out.append((signature[use], sets[of[use]]))
            sets = sets[poor]
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    signature, of = (np.concatenate(x) for x in zip(*out))
    order = np.argsort(of, kind="stable")
    return signature[order], of[order]


def signed(texts: DataFrame, window: int, percent: int) -> DataFrame:
    """(id, th1, th2, n, s1, s2, signatures array<long>) of ``texts`` (id, th1, th2, body binary): size and 128-bit name of each text's set."""

    def sign(keys: list[pa.Array], bodies: list[bytes]) -> pa.RecordBatch:
        ends = np.cumsum([len(b) for b in bodies])
        h, own = elements(np.frombuffer(b"".join(bodies), np.uint8), ends, window)
        n = len(bodies)
        size = np.bincount(own, minlength=n)
        names = [_sums(mix(h + _U(salt)), own, n).view(np.int64) for salt in (1, 0x5DEECE66D)]
        signature, of = signatures(h, own, n, percent)
        offsets = np.append(0, np.cumsum(np.bincount(of, minlength=n))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(signature.view(np.int64)))
        return pa.RecordBatch.from_arrays([*keys, pa.array(size.astype(np.int64)), *map(pa.array, names), lists], names=["id", "th1", "th2", "n", "s1", "s2", "signatures"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, held, bodies = 0, 0, []
            for i, x in enumerate(batch.column("body"), 1):
                bodies.append(x.as_py())
                held += len(bodies[-1])
                if held >= SIGN_BYTES or i == batch.num_rows:
                    yield sign([batch.column(c)[start:i] for c in ("id", "th1", "th2")], bodies)
                    start, held, bodies = i, 0, []

    return texts.mapInArrow(run, "id long, th1 long, th2 long, n long, s1 long, s2 long, signatures array<long>")


def sketch_of(h: np.ndarray) -> bytes:
    """Whether the count of a set's elements is odd, for each of a power of two of cells that they fall in, 64 or two an element at least.

    Sets that differ in d elements differ in d cells at most, so a distance of sketches bounds theirs from below.
    """
    cells = max(64, 1 << (2 * len(h) - 1).bit_length())
    odd = np.bincount((h & _U(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _folded(sketches: np.ndarray, width: int) -> np.ndarray:
    """Sketches, a row each, with fewer cells."""
    while sketches.shape[1] > width:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def at_least_apart(sketch: bytes, others: list[bytes]) -> np.ndarray:
    """A lower bound of the distance of a set to others."""
    out = np.zeros(len(others), np.int64)
    widths = np.array([len(x) for x in others])
    own = np.frombuffer(sketch, np.uint8)[None, :]
    for width in np.unique(widths).tolist():
        at = np.flatnonzero(widths == width)
        rows = np.frombuffer(b"".join(others[i] for i in at), np.uint8).reshape(len(at), width)
        least = min(width, own.shape[1])
        out[at] = np.bitwise_count(_folded(rows, least) ^ _folded(own, least)).sum(axis=1, dtype=np.int64)
    return out


def _may_link(size: int, sizes: np.ndarray, sketch: bytes, others: list[bytes], percent: int) -> np.ndarray:
    """Which of the others a set may link with, by sizes and sketches: none is passed over that does."""
    ok = 100 * np.minimum(size, sizes) >= percent * np.maximum(size, sizes)
    at = np.flatnonzero(ok)
    ok[at] = at_least_apart(sketch, [others[i] for i in at]) <= (size + sizes[at]) * (100 - percent) // (100 + percent)
    return ok


def _sketched(bodies: DataFrame, window: int) -> DataFrame:
    """(node, size, sketch) of ``bodies`` (node, body)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, sketches = [], []
            for body in batch.column("body"):
                h = set_of(body.as_py(), window)
                sizes.append(len(h))
                sketches.append(sketch_of(h))
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary())], names=["node", "size", "sketch"])

    return bodies.select("node", "body").mapInArrow(run, "node long, size long, sketch binary")


def set_of(body: bytes, window: int) -> np.ndarray:
    """The hashes of one text's set in order."""
    return elements(np.frombuffer(body, np.uint8), np.array([len(body)]), window)[0]


def linked(common: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets that share ``common`` elements and have ``sizes`` together are similar enough."""
    return 100 * common >= percent * (sizes - common)


def _verified(pairs: DataFrame, bodies: DataFrame, sketches: DataFrame, window: int, percent: int) -> DataFrame:
    """The linked ones of ``pairs`` (a, b), a row each. Texts are fetched for those that sketches don't rule out."""

    def possible(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keep = [bool(_may_link(x.a_size, np.array([x.b_size]), x.a_sketch, [x.b_sketch], percent)[0]) for x in frame.itertuples(index=False)]
            yield frame.loc[keep, ["a", "b"]]

    of = lambda c: sketches.select(F.col("node").alias(c), F.col("size").alias(f"{c}_size"), F.col("sketch").alias(f"{c}_sketch"))
    pairs = materialize(pairs.join(of("b"), "b").join(of("a"), "a").mapInPandas(possible, "a long, b long"), "sets-possible")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}
        for frame in frames:
            keep = []
            for x in frame.itertuples(index=False):
                if x.a not in held:
                    if len(held) >= 16:
                        held.pop(next(iter(held)))
                    held[x.a] = set_of(x.a_body, window)
                a, b = held[x.a], set_of(x.b_body, window)
                at = np.minimum(np.searchsorted(a, b), len(a) - 1)
                keep.append(bool(linked((a[at] == b).sum(), len(a) + len(b), percent)))
            yield frame.loc[keep, ["a", "b"]]

    with_b = pairs.join(bodies.select(F.col("node").alias("b"), F.col("body").alias("b_body")), "b")
    with_both = with_b.join(bodies.select(F.col("node").alias("a"), F.col("body").alias("a_body")), "a")
    return with_both.select("a", "b", "a_body", "b_body").mapInPandas(run, "a long, b long")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, by one product of 0-1 matrices of the elements that occur in both."""
    shared, n = np.intersect1d(np.concatenate(left), np.concatenate(right)), 1 << 14
    out = np.zeros((len(left), len(right)), np.int64)
    for at in range(0, len(shared), n):  # as many elements at once as make matrices of a few MB
        some = shared[at : at + n]
        low, high = some[0], some[-1]

        def rows(sets: list[np.ndarray], some=some, low=low, high=high) -> np.ndarray:
            m = np.zeros((len(sets), len(some)), np.float32)
            for i, s in enumerate(sets):
                s = s[np.searchsorted(s, low) : np.searchsorted(s, high, "right")]
                at = np.searchsorted(some, s)
                m[i, at[some[at] == s]] = 1
            return m

        out += (rows(left) @ rows(right).T).astype(np.int64)
    return out


def across(members: DataFrame, bodies: DataFrame, window: int, percent: int) -> DataFrame:
    """(a, b): links that put different classes of a bucket together, all that are needed.

    ``members`` is (bucket, n, bytes, node, label, size, sketch). A bucket is cut by
    hash into tiles of about ``TILE`` sets and ``TILE_BYTES`` of elements at most. A
    task compares the sketches of two tiles and hands on one row of the sets that may
    link across classes, for which alone texts are fetched; the task that gets these
    finds the sizes of all intersections by products of matrices, and hands on a row
    for two classes that it joins, not for each link. Equal tiles of several buckets are one.
    """
    tiles = F.greatest(F.ceil(F.greatest(F.col("n") / TILE, F.col("bytes") / TILE_BYTES)).cast("int"), F.lit(1))
    dealt = members.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("node"), "tiles").cast("int"))
    held = dealt.groupBy("bucket", "tiles", "tile").agg(F.array_sort(F.collect_list(F.struct("node", "label", "size", "sketch"))).alias("sets"), F.min("label").alias("low"), F.max("label").alias("high"))
    held = materialize(held, "sets-tiles")
    left = held.withColumn("other", F.explode(F.sequence(F.col("tile"), F.col("tiles") - 1))).withColumn("tk", join_key("bucket", "other"))
    right = held.select(join_key("bucket", "tile").alias("tk"), F.col("sets").alias("others"), F.col("low").alias("low_b"), F.col("high").alias("high_b"))
    both = left.join(right, "tk").filter("least(low, low_b) < greatest(high, high_b)").withColumn("others", F.when(F.col("tile") != F.col("other"), F.col("others")))
    both = both.select("sets", "others", F.xxhash64("sets.node", "others.node").alias("k1"), F.xxhash64(F.lit(7), "sets.node", "others.node").alias("k2")).dropDuplicates(["k1", "k2"])

    def asked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for a, b in zip(frame["sets"], frame["others"]):
                b = a if b is None else b
                labels, sizes, sketches = np.array([t["label"] for t in b]), np.array([t["size"] for t in b]), [t["sketch"] for t in b]
                keep: set[int] = set()
                mine = []
                for t in a:
                    apart = np.flatnonzero(labels != t["label"])
                    found = apart[_may_link(t["size"], sizes[apart], t["sketch"], [sketches[i] for i in apart], percent)].tolist()
                    if found:
                        mine.append((t["node"], t["label"]))
                        keep.update(found)
                if mine:
                    theirs = [] if b is a else [(b[i]["node"], b[i]["label"]) for i in sorted(keep)]
                    yield pd.DataFrame({"sides": [[{"side": k, "node": n, "label": m} for k, side in enumerate((mine, theirs)) for n, m in side]]})

    lists = materialize(both.select("sets", "others").mapInPandas(asked, "sides array<struct<side:int,node:long,label:long>>").withColumn("pair", F.monotonically_increasing_id()), "sets-asked")
    wanted = lists.select("pair", F.explode("sides").alias("s")).select("pair", "s.*")
    texts = wanted.join(bodies, "node").groupBy("pair").agg(F.collect_list(F.struct("side", "node", "label", "body")).alias("texts"))

    def decided(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for texts in frame["texts"]:
                sides = [sorted((t for t in texts if t["side"] == side), key=lambda t: t["node"]) for side in (0, 1)]
                sides[1] = sides[1] or sides[0]
                sets = [[set_of(t["body"], window) for t in side] for side in sides]
                sizes = [np.array([len(s) for s in side]) for side in sets]
                labels = [np.array([t["label"] for t in side]) for side in sides]
                near = linked(_overlaps(*sets), sizes[0][:, None] + sizes[1][None, :], percent) & (labels[0][:, None] != labels[1][None, :])
                parent: dict[int, int] = {}
                found = [(sides[0][i]["node"], sides[1][j]["node"]) for i, j in zip(*(x.tolist() for x in np.nonzero(near))) if joined(parent, int(labels[0][i]), int(labels[1][j]))]
                yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return texts.select("texts").mapInPandas(decided, "a long, b long")


def _to_pivots(members: DataFrame) -> DataFrame:
    """(a, b): every set of a bucket with the bucket's first one, where their classes differ as far as is known; ``members`` is (bucket, node, pivot), or has ``label`` and ``pivot_label`` too."""
    apart = members.filter("node != pivot") if "label" not in members.columns else members.filter("node != pivot AND label != pivot_label")
    return apart.select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()


def _undecided(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, node, label, pivot, pivot_label): what ``members`` (bucket, node, pivot) holds besides the pivots, of the buckets where that is several classes yet, with new pivots."""
    rest = members.filter("node != pivot").select("bucket", "node").join(labels, "node", "left").select("bucket", "node", F.coalesce("label", "node").alias("label"))
    first = rest.groupBy("bucket").agg(F.min(F.struct("node", "label")).alias("p"), F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    first = first.select(F.hex("bucket").alias("hb"), F.col("p.node").alias("pivot"), F.col("p.label").alias("pivot_label"))
    return rest.withColumn("hb", F.hex("bucket")).join(first, "hb").drop("hb")


def join_classes(docs: DataFrame, window: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, component): a row a row of ``docs``, with the size of its set and the smallest id that links reach.

    A text's set is that of its distinct runs of ``window`` words, lower-cased in A-Z; a
    text of fewer words is one run. Two link when 100 * common >= percent * union.
    Texts without words, null and empty ones too, have empty sets and are alone. Rows
    with a null id count like others and get their class's id, null if no row of it has one; repeated
    rows share a class. Elements are told apart by 64 bits and whole sets by 128.
    Texts of any length are signed and compared whole; other columns are ignored.

    Equal sets are one node. Sets that share a signature are a bucket: all are
    compared with its first one, which joins copies in one comparison each; what a
    bucket holds besides, if it is of several classes, with the first one of that, and so on
    ``STARS`` times, which decides all small buckets. What is of several classes
    even then is searched whole (``across``). All of that looks at sketches first,
    that rule a pair out only for sure, and then at the texts' whole sets.
    """
    h1, h2 = words.fingerprint(F.col(text_col))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), h1.alias("th1"), h2.alias("th2"), F.encode(words.text_or_empty(F.col(text_col)), "UTF-8").alias("body"))
    every = materialize(signed(texts, window, percent).withColumn("row", F.monotonically_increasing_id()), "sets-signed")
    rows = every.select("id", "n", "s1", "s2", "row")
    nodes = materialize(rows.filter("n > 0").groupBy("s1", "s2").agg(F.min("row").alias("node")), "sets-nodes")
    set_key = lambda: join_key("s1", "s2").alias("sk")
    of_row = materialize(rows.filter("n > 0").withColumn("sk", set_key()).join(nodes.select(set_key(), "node"), "sk").select("row", "id", "node"), "sets-rows")

    shared = every.select("row", F.explode("signatures").alias("bucket"))
    meet = shared.groupBy("bucket").agg(F.count("*").alias("rows")).filter("rows > 1").select(*moved("bucket"))
    found = shared.select(*moved("bucket"), "row").join(meet, "m0").withColumnRenamed("m0", "bucket")
    found = found.join(of_row.select("row", "node"), "row").select("bucket", "node").distinct()
    members = materialize(found, "sets-members")
    first = members.groupBy("bucket").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).filter("pivot < last").select(F.hex("bucket").alias("hb"), "pivot")
    members = materialize(members.withColumn("hb", F.hex("bucket")).join(first, "hb").select("bucket", "node", "pivot"), "sets-buckets")

    wanted = members.select("node").distinct().join(every.select(F.col("row").alias("node"), "th1", "th2"), "node").select(*moved("th1", "th2"), "node")
    bodies = materialize(texts.select("body", *moved("th1", "th2")).join(wanted, ["m0", "m1"]).select("node", "body").dropDuplicates(["node"]), "sets-texts")
    sketches = materialize(_sketched(bodies, window), "sets-sketches")
    edges = materialize(_verified(_to_pivots(members), bodies, sketches, window, percent), "sets-stars")
    labels, left = components(edges), members
    for again in range(STARS):
        left = materialize(_undecided(left, labels), "sets-left")
        if again + 1 == STARS or left.isEmpty():
            break
        edges = materialize(_verified(_to_pivots(left), bodies, sketches, window, percent), "sets-stars")
        if not edges.isEmpty():
            labels = merged(labels, edges)
    weighed = left.join(sketches, "node")
    sizes = weighed.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(8 * F.col("size")).alias("bytes")).select(F.hex("bucket").alias("hb"), "n", "bytes")
    live = weighed.withColumn("hb", F.hex("bucket")).join(sizes, "hb").select("bucket", "n", "bytes", "node", "label", "size", "sketch")
    edges = materialize(across(live, bodies, window, percent), "sets-across")
    if not edges.isEmpty():
        labels = merged(labels, edges)

    placed = of_row.withColumn("nk", F.hex("node")).join(labels.select(F.hex("node").alias("nk"), "label"), "nk", "left").select("row", "id", F.coalesce("label", "node").alias("label"))
    least = placed.groupBy("label").agg(F.min("id").alias("component")).select(F.hex("label").alias("lk"), "component")
    classes = placed.withColumn("lk", F.hex("label")).join(least, "lk").select(F.hex("row").alias("rk"), "component")
    out = rows.withColumn("rk", F.hex("row")).join(classes, "rk", "left")
    return out.select("id", "n", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component"))
