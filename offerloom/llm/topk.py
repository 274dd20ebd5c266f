"""Exact top-k inner products by block-at-a-time pruning.

Candidates lie in tiles of consecutive documents, and each tile in blocks with
the maximum and minimum of every term (dimension). For a query, a block's summed
term maxima (its weight times the block's maximum, or minimum where the weight is
negative) bound every score in the block. A task takes the blocks of a tile in
falling order of their bound for each query, scores a block through its forward
index (the block's matrix), and is done with a query when the next bound is below
its kth score so far, which carries over from tile to tile.

Tasks share kth scores through a first wave: one tile in ``WAVES`` is searched, and
the kth score that a query has there is a floor for all other tiles. Below it a
block isn't scored, and a row isn't handed on, so what is shuffled are the few
candidates above the floors and not k a query and task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerloom.llm.storage import materialize

BLOCK, TILE, QUERY_TILE, TILES_AT_ONCE, WAVES = 128, 4096, 1024, 64, 16
#: Bytes of a candidate tile and of a query tile at most, or else one vector: the broadcast of ``TILES_AT_ONCE`` query tiles is 64 MB, whatever the width.
TILE_BYTES, QUERY_BYTES = 8 << 20, 1 << 20
#: Below this, sums of products are exact in doubles and BLAS can make them.
EXACT = float(1 << 53)


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int = 256) -> DataFrame:
    """(vec_id long, v array<long>): floor(scale * x) of every component, in doubles.

    Rows with a null id, a null vector or a null or non-finite component are left
    out; repeated rows stay.
    """
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x")).filter(F.col("vec_id").isNotNull() & F.col("x").isNotNull())
    whole = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.filter(whole).select("vec_id", F.transform("x", lambda c: F.floor(c * scale).cast("long")).alias("v"))


def _tiles(rows: DataFrame, size: int, most: int, name: str) -> DataFrame:
    """(tile, ids, values, width): ``size`` rows and ``most`` bytes at most (or one row), consecutive by id, as packed longs."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids: list[int] = []
        held: list[np.ndarray] = []
        width = 0

        def row() -> pd.DataFrame:
            m = np.zeros((len(held), width), np.int64)
            for i, v in enumerate(held):
                m[i, : len(v)] = v
            return pd.DataFrame({"ids": [np.array(ids, np.int64).tobytes()], "rows": [m.tobytes()], "width": [width]})

        for frame in frames:
            for x, v in zip(frame["vec_id"], frame["v"]):
                wider = max(width, len(v))
                if held and (len(held) >= size or 8 * wider * (len(held) + 1) > most):
                    yield row()
                    ids, held, wider = [], [], len(v)
                ids.append(x)
                held.append(np.asarray(v, np.int64))
                width = wider
        if held:
            yield row()

    n = max(1, rows.sparkSession.sparkContext.defaultParallelism)
    packed = rows.repartitionByRange(n, "vec_id").sortWithinPartitions("vec_id").mapInPandas(pack, "ids binary, rows binary, width int")
    return materialize(packed.withColumn("tile", F.monotonically_increasing_id()), name)


def _wide(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] == width else np.pad(m, ((0, 0), (0, width - m.shape[1])))


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """q @ v.T in longs."""
    peak = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(1, q.shape[1])
    if peak < EXACT:
        return (q.astype(np.float64) @ v.astype(np.float64).T).astype(np.int64)
    return q @ v.T


class Best:
    """The k best (score, id) so far of each query of a tile; ties go to the smaller id."""

    def __init__(self, n: int, k: int):
        self.score = np.full((n, k), np.iinfo(np.int64).min)
        self.id = np.full((n, k), np.iinfo(np.int64).max)

    def kth(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        s = np.concatenate([self.score[at], score], axis=1)
        i = np.concatenate([self.id[at], np.broadcast_to(ids, score.shape)], axis=1)
        k = self.score.shape[1]
        i[s == np.iinfo(np.int64).min] = np.iinfo(np.int64).max
        order = np.lexsort((i, -np.maximum(s, np.iinfo(np.int64).min + 1)), axis=1)[:, :k]
        self.score[at], self.id[at] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)


def search_tile(best: Best, qids: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, block: int = BLOCK, floor: np.ndarray | None = None) -> int:
    """Puts a tile's candidates into ``best``; gives the number of (query, block) pairs that were scored.

    ``floor`` is a score of each query that k candidates are known to reach.
    """
    starts = np.arange(0, len(ids), block)
    top, low = np.maximum.reduceat(v, starts, axis=0), np.minimum.reduceat(v, starts, axis=0)
    bounds = products(np.maximum(q, 0), top) + products(np.minimum(q, 0), low)
    order = np.argsort(-bounds, axis=1, kind="stable")
    alive, scored = np.arange(len(q)), 0
    for r in range(len(starts)):
        at = order[alive, r]
        going = bounds[alive, at] >= (best.kth() if floor is None else np.maximum(best.kth(), floor))[alive]
        alive, at = alive[going], at[going]
        if not len(alive):
            break
        for b in np.unique(at):
            who, part = alive[at == b], slice(starts[b], starts[b] + block)
            score = products(q[who], v[part])
            score[qids[who][:, None] == ids[part][None, :]] = np.iinfo(np.int64).min
            best.add(who, score, ids[part])
            scored += len(who)
    return scored


def top_k(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of every query row.

    ``queries`` says which rows (by the column ``vec_id``) are queries; candidates
    are all rows whose id isn't the query's own, repeated ones as often as they are
    there. Ties go to the smaller id; with fewer than k candidates all come. Vectors
    of different lengths are filled up with zeros. Ids should be keys: query rows
    equal in id and vector ask once, and where different vectors have one id, each
    of them answers and counts under it. An empty table gives no rows; other columns
    are ignored.

    Query tiles are broadcast in chunks of ``TILES_AT_ONCE``, of a bounded size in
    bytes, and the candidates are read once for each chunk: the work of a search
    grows with both sides, the memory of a task with neither. A chunk's result is
    written before the next one is searched, so the plan doesn't grow either.
    """
    rows = materialize(quantised(vectors, id_col, vector_col), "topk-rows")
    tiles = _tiles(rows, TILE, TILE_BYTES, "topk-tiles")
    asked = _tiles(rows.filter(queries).distinct(), QUERY_TILE, QUERY_BYTES, "topk-queries")
    # consecutive numbers for the query tiles, from one count a partition
    counts = sorted(asked.groupBy(F.shiftright("tile", 33).alias("p")).count().collect())
    n_tiles, first = 0, []
    for p, n in counts:
        first += [F.lit(p), F.lit(n_tiles - (p << 33))]
        n_tiles += n
    number = F.col("tile") + F.element_at(F.create_map(*first), F.shiftright("tile", 33)) if first else F.lit(0).cast("long")
    asked = asked.select(number.alias("n"), F.col("ids").alias("qids"), F.col("rows").alias("qrows"), F.col("width").alias("qwidth"))

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple] = {}
        for frame in frames:
            for x in frame.itertuples(index=False):
                ids = np.frombuffer(x.ids, np.int64)
                if x.n not in held:
                    qids = np.frombuffer(x.qids, np.int64)
                    floor = np.frombuffer(x.floor, np.int64) if x.floor is not None else np.full(len(qids), np.iinfo(np.int64).min)
                    held[x.n] = (qids, np.frombuffer(x.qrows, np.int64).reshape(len(qids), x.qwidth), floor, Best(len(qids), k))
                qids, q, floor, best = held[x.n]
                width = max(x.qwidth, x.width)
                search_tile(best, qids, _wide(q, width), ids, _wide(np.frombuffer(x.rows, np.int64).reshape(len(ids), x.width), width), floor=floor)
        for qids, _, floor, best in held.values():
            n = best.score.shape[1]
            keep = (best.score > np.iinfo(np.int64).min) & (best.score >= floor[:, None])
            yield pd.DataFrame({"query_id": np.repeat(qids, n)[keep.ravel()], "vec_id": best.id[keep], "score": best.score[keep]})

    def with_floor(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            floors = []
            for x in frame.itertuples(index=False):
                known = np.array([(f["query_id"], f["score"]) for f in x.floors], np.int64).reshape(-1, 2)
                known = known[np.argsort(known[:, 0])]
                qids = np.frombuffer(x.qids, np.int64)
                at = np.minimum(np.searchsorted(known[:, 0], qids), max(0, len(known) - 1))
                hit = known[at, 0] == qids if len(known) else np.zeros(len(qids), bool)
                floors.append(np.where(hit, known[at, 1] if len(known) else 0, np.iinfo(np.int64).min).tobytes())
            yield frame.drop(columns="floors").assign(floor=floors)

    found_schema = "query_id long, vec_id long, score long"
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = lambda found: found.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)
    early = F.pmod(F.xxhash64("tile"), F.lit(WAVES)) == 0
    found = None
    for at in range(0, max(1, n_tiles), TILES_AT_ONCE):
        chunk = asked.filter(F.col("n").between(at, at + TILES_AT_ONCE - 1)).withColumn("floor", F.lit(None).cast("binary"))
        wave = materialize(ranked(tiles.filter(early).crossJoin(F.broadcast(chunk)).mapInPandas(search, found_schema)), "topk-wave")
        # a number a query of the chunk, so no more than its tiles hold
        floors = wave.filter(F.col("rank") == k).agg(F.collect_list(F.struct("query_id", "score")).alias("floors"))
        chunk = materialize(chunk.drop("floor").crossJoin(F.broadcast(floors)).mapInPandas(with_floor, "n long, qids binary, qrows binary, qwidth int, floor binary"), "topk-floors")
        rest = tiles.filter(~early).crossJoin(F.broadcast(chunk)).mapInPandas(search, found_schema)
        part = materialize(ranked(rest.unionByName(wave.drop("rank"))), "topk-found")
        found = part if found is None else found.unionByName(part)
    # where several tiles asked under one id, their answers meet
    return ranked(found.drop("rank")).select("query_id", "rank", "vec_id", "score")
