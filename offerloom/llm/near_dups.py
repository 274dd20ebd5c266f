"""Near-duplicate documents: BagMinHash, banding, verified bag overlap, connected classes."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.llm import bagminhash, words
from offerloom.llm.components import components, joined, merged, root_of
from offerloom.llm.line_rules import join_key, moved, row_key
from offerloom.llm.storage import materialize

#: A pair at the similarity 0.8 shares no band with a probability of (1 - 0.8 ** 5) ** 30, under 1 in 100,000.
BANDS, ROWS, WINDOW, SIMILARITY = 30, 5, 5, 0.8
#: Bytes of text that a task signs at once; about so many texts, and bytes of them, in a tile of a bucket.
SIGN_BYTES, TILE, TILE_BYTES = 1 << 18, 256, 4 << 20
#: Standard deviations that an estimate by registers may lie below the similarity before its pair is passed over; None passes over none.
DEVIATIONS: float | None = 4.6


def bands(texts: DataFrame, window: int = WINDOW, n_bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(th1, th2, size, bands array<long>, registers binary) of ``texts`` (th1, th2, body); texts without words give no row.

    ``registers`` has a byte of each register, for estimates.
    """

    def sign(keys: list[np.ndarray], bodies: list[bytes]) -> pa.RecordBatch:
        sizes = np.array([len(b) for b in bodies])
        data = np.frombuffer(b"".join(bodies), np.uint8)
        ends = np.cumsum(sizes)
        hashes, bag = bagminhash.shingles(*bagminhash.word_hashes(data, ends), window)
        filled, place = np.unique(bag, return_inverse=True)
        signed = bagminhash.signatures(*bagminhash.weighed(hashes, place), len(filled), n_bands * rows)
        values = bagminhash.band_values(signed, rows)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(filled) + 1, dtype=np.int32) * n_bands), pa.array(values.ravel()))
        low = pa.array([bytes(x) for x in signed.astype(np.uint8)], pa.binary())
        return pa.RecordBatch.from_arrays([*(pa.array(x[filled]) for x in (*keys, sizes)), lists, low], names=["th1", "th2", "size", "bands", "registers"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("th1", "th2")]
            start, held, bodies = 0, 0, []
            for i, x in enumerate(batch.column("body")):
                bodies.append(x.as_py())
                held += len(bodies[-1])
                if held >= SIGN_BYTES or i + 1 == batch.num_rows:
                    yield sign([k[start : i + 1] for k in keys], bodies)
                    start, held, bodies = i + 1, 0, []

    return texts.mapInArrow(run, "th1 long, th2 long, size long, bands array<long>, registers binary")


def verified(pairs: DataFrame, texts: DataFrame, window: int, similarity: float) -> DataFrame:
    """(a, b, linked): whether the bags of ``pairs`` (a, b) have a weighted Jaccard similarity of ``similarity``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: OrderedDict[int, tuple] = OrderedDict()
        for frame in frames:
            linked = []
            for x in frame.itertuples(index=False):
                if x.a not in held:
                    if len(held) >= 16:
                        held.popitem(last=False)
                    held[x.a] = bagminhash.bag_of(x.a_body, window)
                common, union = bagminhash.overlap(held[x.a], bagminhash.bag_of(x.b_body, window))
                linked.append(common >= similarity * union - 1e-9 * union)
            yield pd.DataFrame({"a": frame["a"], "b": frame["b"], "linked": linked})

    with_b = pairs.join(texts.select(F.col("node").alias("b"), F.col("body").alias("b_body")), "b")
    with_both = with_b.join(texts.select(F.col("node").alias("a"), F.col("body").alias("a_body")), "a")
    return with_both.select("a", "b", "a_body", "b_body").mapInPandas(run, "a long, b long, linked boolean")


def _arrays(texts) -> tuple[np.ndarray, ...]:
    registers = np.frombuffer(b"".join(t["registers"] for t in texts), np.uint8).reshape(len(texts), -1)
    return np.array([t["node"] for t in texts]), np.array([t["label"] for t in texts]), np.array([t["bands"] for t in texts]), registers


def across_classes(members: DataFrame, similarity: float, n_registers: int, bodies: DataFrame | None = None, window: int = WINDOW, deviations: float | None = DEVIATIONS) -> DataFrame:
    """(a, b): pairs of a bucket's texts that would put different classes together.

    ``members`` is (bucket, n, bytes, node, label, bands, registers). A bucket is cut by
    hash into tiles of about ``TILE`` texts and ``TILE_BYTES`` of text at most, and a
    task compares the signatures of two tiles as arrays. Pairs whose registers rule
    the similarity out are passed over (none are if ``deviations`` is None), and so
    are those that share an earlier band, in whose bucket they meet too. Without
    ``bodies`` the most alike of the others come first, and those become rows that
    join two classes not yet joined in the task: guesses, fewer than there are texts,
    and of all tasks one a pair of classes, the most alike.

    With ``bodies`` every pair that is left is decided by its bags, and what doesn't
    come out links no two classes. A pair of tiles hands its candidates on as one row
    of positions, and only the texts that are in one are fetched for it: no text moves
    with the tiles.
    """
    least = 0.0 if deviations is None else n_registers * similarity - deviations * (n_registers * similarity * (1 - similarity)) ** 0.5
    tiles = F.ceil(F.greatest(F.col("n") / TILE, F.col("bytes") / TILE_BYTES)).cast("int")
    dealt = members.withColumn("tiles", F.greatest(tiles, F.lit(1))).withColumn("tile", F.pmod(F.xxhash64("node"), "tiles").cast("int"))
    held = dealt.groupBy("bucket", "tiles", "tile").agg(F.collect_list(F.struct("node", "label", "bands", "registers")).alias("texts"))
    held = materialize(held, "near-tiles")
    left = held.withColumn("other", F.explode(F.sequence(F.col("tile"), F.col("tiles") - 1)))
    right = held.select(join_key("bucket", "tile").alias("tk"), F.col("texts").alias("others"))
    both = left.withColumn("tk", join_key("bucket", "other")).join(right, "tk")
    both = both.select(join_key("bucket", "tile", "other").alias("pair"), "bucket", (F.col("tile") == F.col("other")).alias("same"), "texts", "others")
    exact = bodies is not None

    def candidates(x) -> tuple[np.ndarray, ...]:
        """Nodes and labels of both tiles, and the pairs to look at as (equal registers, positions in them), the most alike first."""
        nodes, labels, bands_a, registers = _arrays(x.texts)
        nodes_b, labels_b, bands_b, registers_b = _arrays(x.others)
        some: list[np.ndarray] = []
        for i in range(len(nodes)):
            equal = (registers_b == registers[i]).sum(axis=1)
            j = np.flatnonzero((equal >= least) & (labels_b != labels[i]) & ((nodes_b > nodes[i]) if x.same else True))
            common = bands_b[j] == bands_a[i]
            j = j[bands_a[i][np.argmax(common, axis=1)] == x.bucket] if len(j) else j
            some.append(np.stack([equal[j], np.full(len(j), i), j], axis=1))
        ranked = np.concatenate(some)
        return nodes, labels, nodes_b, labels_b, ranked[np.argsort(-ranked[:, 0], kind="stable")]

    def guesses(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for x in frame.itertuples(index=False):
                nodes, labels, nodes_b, labels_b, ranked = candidates(x)
                parent: dict[int, int] = {}
                out = []
                for equal, i, j in ranked:
                    p, q = int(labels[i]), int(labels_b[j])
                    if joined(parent, p, q):
                        out.append((int(nodes[i]), int(nodes_b[j]), min(p, q), max(p, q), int(equal)))
                yield pd.DataFrame(out, columns=["a", "b", "p", "q", "equal"], dtype="int64")

    def asked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for x in frame.itertuples(index=False):
                nodes, labels, nodes_b, labels_b, ranked = candidates(x)
                ranked = ranked[:, 1:]
                if len(ranked):
                    i, j = np.unique(ranked[:, 0]), np.unique(ranked[:, 1])
                    at = np.stack([np.searchsorted(i, ranked[:, 0]), len(i) + np.searchsorted(j, ranked[:, 1])], axis=1)
                    out.append((x.pair, np.concatenate([nodes[i], nodes_b[j]]), np.concatenate([labels[i], labels_b[j]]), at.astype(np.int32).tobytes()))
            yield pd.DataFrame(out, columns=["pair", "nodes", "labels", "at"])

    def decided(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for x in frame.itertuples(index=False):
                body = {t["node"]: t["body"] for t in x.texts}
                bags: dict[int, tuple] = {}
                parent: dict[int, int] = {}
                out = []
                for i, j in np.frombuffer(x.at, np.int32).reshape(-1, 2):
                    a, b, p, q = int(x.nodes[i]), int(x.nodes[j]), int(x.labels[i]), int(x.labels[j])
                    if root_of(parent, p) == root_of(parent, q):
                        continue
                    for node in (a, b):
                        if node not in bags:
                            bags[node] = bagminhash.bag_of(body[node], window)
                    common, union = bagminhash.overlap(bags[a], bags[b])
                    if common >= similarity * union - 1e-9 * union:
                        joined(parent, p, q)
                        out.append((min(a, b), max(a, b)))
                yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    if not exact:
        guessed = both.mapInPandas(guesses, "a long, b long, p long, q long, equal long")
        best = guessed.groupBy("p", "q").agg(F.max(F.struct("equal", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).alias("x"))
        return best.select("x.a", "x.b").distinct()
    lists = materialize(both.mapInPandas(asked, "pair string, nodes array<long>, labels array<long>, at binary"), "near-asked")
    wanted = lists.select("pair", F.explode(F.array_distinct("nodes")).alias("node")).join(bodies, "node")
    texts = wanted.groupBy("pair").agg(F.collect_list(F.struct("node", "body")).alias("texts"))
    ready = lists.withColumn("pk", F.concat(F.lit("p"), "pair")).join(texts.select(F.concat(F.lit("p"), "pair").alias("pk"), "texts"), "pk")
    return ready.select("nodes", "labels", "at", "texts").mapInPandas(decided, "a long, b long").distinct()


def classes(docs: DataFrame, similarity: float = SIMILARITY, window: int = WINDOW, n_bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text", deviations: float | None = DEVIATIONS) -> DataFrame:
    """(id, th1, th2, class_id): a row a row of ``docs``, with the smallest id of its class.

    A class is a connected component of links; texts link if the bags of their
    ``window``-word shingles have a weighted Jaccard similarity of ``similarity``.
    Equal texts are one node of that graph. A text of fewer words is one shingle;
    texts without words, null and empty ones too, are classes of their own each. Rows with a null
    id get their class's id, null if no row of the class has one; repeated rows
    share a class. Texts are told apart by 128-bit fingerprints, and numbered; other
    columns are ignored. Texts of any length are signed and compared whole.

    In every band all texts of a bucket are compared with its first one, which
    joins copies in one comparison each. Then likely pairs are tried that would
    join the classes that a bucket still holds. Buckets that hold several even
    then are searched whole for a link across them (``across_classes``), however
    large they are. All steps verify the bags themselves; ``deviations`` says which
    pairs of a bucket they needn't look at, None that they look at all.
    """
    body = F.encode(words.text_or_empty(F.col(text_col)), "UTF-8")
    h1, h2 = words.fingerprint(F.col(text_col))
    wordy = words.text_or_empty(F.col(text_col)).rlike(words.WORD)
    keyed = docs.select(F.col(id_col).alias("id"), h1.alias("th1"), h2.alias("th2"), body.alias("body"), wordy.alias("wordy"))
    texts = keyed.select("th1", "th2", "body")
    signed = bands(texts, window, n_bands, rows).groupBy("th1", "th2").agg(F.first("size").alias("size"), F.first("bands").alias("bands"), F.first("registers").alias("registers"))
    signed = materialize(signed.withColumn("node", F.monotonically_increasing_id()), "near-signed")  # numbers that hold once they are written
    members = signed.select("node", "size", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), F.min("node").alias("pivot")).filter("n > 1").select(F.hex("bucket").alias("hb"), "pivot")
    members = materialize(members.withColumn("hb", F.hex("bucket")).join(shared, "hb").select("bucket", "node", "size", "pivot"), "near-shared")
    wanted = members.select("node").distinct().join(signed.select("node", "th1", "th2"), "node").select(*moved("th1", "th2"), "node")
    bodies = materialize(texts.select("body", *moved("th1", "th2")).join(wanted, ["m0", "m1"]).select("node", "body").dropDuplicates(["node"]), "near-texts")

    pairs = members.filter("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()  # the pivot is the smaller node
    found = materialize(verified(pairs, bodies, window, similarity).filter("linked").select("a", "b"), "near-stars")
    labels = components(found)
    for last in (False, True):
        named = members.join(labels, "node", "left").select("bucket", "node", "size", F.coalesce("label", "node").alias("label"))
        split = named.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select(F.hex("bucket").alias("hb"), "n", "bytes")
        live = named.withColumn("hb", F.hex("bucket")).join(split, "hb").drop("hb").join(signed.select("node", "bands", "registers"), "node")
        more = across_classes(live, similarity, n_bands * rows, bodies if last else None, window, deviations)
        if not last:
            more = verified(more, bodies, window, similarity).filter("linked").select("a", "b")
        more = materialize(more, "near-across")
        if not more.isEmpty():
            labels = merged(labels, more)

    rows_of = materialize(keyed.select("id", "th1", "th2", "wordy"), "near-rows")
    label_of = signed.select("node", "th1", "th2").join(labels, "node", "left").select(*moved("th1", "th2"), F.coalesce("label", "node").alias("label"))
    named = rows_of.select("*", *moved("th1", "th2")).join(label_of, ["m0", "m1"], "left").select("id", "th1", "th2", "wordy", "label")
    smallest = named.groupBy("label").agg(F.min("id").alias("least")).select(F.hex("label").alias("hl"), "least")
    placed = named.withColumn("hl", F.hex("label")).join(smallest, "hl", "left")
    return placed.select("id", "th1", "th2", F.when(F.col("wordy"), F.col("least")).otherwise(F.col("id")).alias("class_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class, the one with the smallest id (of repeated rows one); rows with a null id stay if their class has no other."""
    found = classes(docs, id_col=id_col, text_col=text_col, **options)
    kept = found.filter(F.col("id").eqNullSafe(F.col("class_id"))).select(join_key("id", "th1", "th2").alias("_near_row")).distinct()
    keyed = docs.withColumn("_near_row", F.struct(*row_key(docs, id_col, text_col)))
    keyed = keyed.withColumn("_near_row", join_key("_near_row.id", "_near_row.th1", "_near_row.th2"))
    return keyed.join(kept, "_near_row", "left_semi").dropDuplicates(["_near_row"]).select(*docs.columns)
