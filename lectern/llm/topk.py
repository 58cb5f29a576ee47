"""Exact top-k search by inner product: columnar branch and bound.

Candidates lie in blocks in vertical layout, one row of the block for each dimension. A query adds up the scores of all candidates of a block
over one group of dimensions after the other, the group with most of the query's mass first. After each group the mass that
remains on both sides bounds what can still come (Cauchy-Schwarz); candidates whose best possible score is below the k-th best so far
are dropped and the rest is compacted. Scores are integers, so ties are exact; a candidate that could tie stays.

Queries and candidates meet in cells of at most QUERY_BLOCK queries and GROUP blocks of CANDIDATES vectors, so a task's memory does
not grow with the table; a cell gives at most k rows per query, and the best k of those are the result.

Defined results: rows with a null id, a null vector, or a null or non-finite component take no part; of repeated ids the smallest vector
counts; vectors only meet others of the same length; fewer candidates than k give fewer rows; an empty table gives none; scores beyond
the range of a long stay at its end; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.runtime import ship, stored

QUERY_BLOCK, CANDIDATES, GROUP, DIMENSIONS = 4096, 8192, 8, 16
LONG = np.iinfo(np.int64)
#: Doubles add integers without error below this.
EXACT = 2**53
BLOCKS = "block long, dims int, width int, ids binary, cells binary"
HITS = "query_id long, vec_id long, score long"


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components."""
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )


def quantise(vector: Column, scale: int = 64) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def _pack(rows: pd.DataFrame) -> pd.DataFrame:
    """Vertical layout in the narrowest integers that hold the values; one row for each length of vector."""
    out = []
    lengths = rows["vector"].map(len)
    for dims, part in rows.groupby(lengths):
        part = part.sort_values("vec_id")
        cells = np.array(part["vector"].tolist(), np.int64).reshape(len(part), dims).T
        top = max((abs(int(f(cells))) for f in (np.min, np.max)), default=0) if cells.size else 0
        width = next(w for w in (1, 2, 4, 8) if w == 8 or top < 1 << (8 * w - 1))
        ids = part["vec_id"].to_numpy(np.int64).tobytes()
        out.append((part["block"].iloc[0], dims, width, ids, np.ascontiguousarray(cells.astype(f"i{width}")).tobytes()))
    return pd.DataFrame(out, columns=["block", "dims", "width", "ids", "cells"])


def blocks_of(vectors: DataFrame, n_blocks: int) -> DataFrame:
    block = F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks))
    return vectors.select(block.alias("block"), "vec_id", "vector").groupBy("block").applyInPandas(_pack, BLOCKS)


def _unpack(row) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row.ids, np.int64)
    return ids, np.frombuffer(row.cells, f"i{row.width}").reshape(row.dims, len(ids))


class Block:
    """Candidates in vertical layout, with each candidate's mass in each group of dimensions."""

    def __init__(self, ids: np.ndarray, cells: np.ndarray):
        self.ids, self.whole = ids, cells
        # Python integers: the absolute value of the least long is no long.
        self.top = max(int(cells.max()), -int(cells.min())) if cells.size else 0
        self.cells = cells.astype(np.float64)
        self.groups = [slice(i, i + DIMENSIONS) for i in range(0, len(cells), DIMENSIONS)]
        self.mass = [np.einsum("dn,dn->n", self.cells[g], self.cells[g]) for g in self.groups]

    def best(self, query_id: int, query: np.ndarray, k: int, known: tuple[np.ndarray, np.ndarray]):
        """The k best of ``known`` (scores, ids) and this block."""
        scores, at = self._survivors(query, k, known[0][k - 1] if len(known[0]) >= k else None, query_id)
        scores, ids = np.concatenate([known[0], scores]), np.concatenate([known[1], self.ids[at]])
        order = np.lexsort((ids, -scores))[:k]
        return scores[order], ids[order]

    def _survivors(self, query: np.ndarray, k: int, floor: float | None, query_id: int):
        at = np.flatnonzero(self.ids != query_id)
        if max((abs(int(x)) for x in query), default=0) * self.top * max(1, len(query)) >= EXACT:
            exact = [int(x) for x in (query.astype(object)[:, None] * self.whole.astype(object)[:, at]).sum(0)]
            return np.array([min(max(x, LONG.min + 1), LONG.max) for x in exact], object), at
        q = query.astype(np.float64)
        held = [float(q[g] @ q[g]) for g in self.groups]
        order = sorted(range(len(held)), key=lambda g: -held[g])
        scores = np.zeros(len(at))
        for n, g in enumerate(order):
            scores += q[self.groups[g]] @ (self.cells[self.groups[g]] if len(at) == len(self.ids) else self.cells[self.groups[g]][:, at])
            rest = order[n + 1 :]
            if not rest or len(at) <= k:
                continue
            bound = np.sqrt(sum(held[r] for r in rest) * sum(self.mass[r][at] for r in rest)) * (1 + 1e-9) + 1e-6
            least = np.partition(scores - bound, len(at) - k)[len(at) - k]
            least = least if floor is None else max(least, float(floor))
            alive = scores + bound >= least
            if alive.sum() < 0.9 * len(at):
                at, scores = at[alive], scores[alive]
        return np.rint(scores).astype(np.int64), at


def _search(k: int):
    def search(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        blocks = [Block(*_unpack(row)) for row in candidates.itertuples()]
        dims = [row.dims for row in candidates.itertuples()]
        out = []
        for row in queries.itertuples():
            ids, cells = _unpack(row)
            for query_id, query in zip(ids.tolist(), cells.T, strict=True):
                best = np.array([], np.int64), np.array([], np.int64)
                for block, d in zip(blocks, dims, strict=True):
                    if d == row.dims:
                        best = block.best(query_id, query.astype(np.int64), k, best)
                out += [(query_id, int(v), int(s)) for s, v in zip(*best, strict=True)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return search


def top_k(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of (vec_id, vector of longs) that ``is_query`` marks, its k best other rows."""
    spark = ship(vectors.sparkSession)
    kept = stored(vectors.groupBy("vec_id").agg(F.min("vector").alias("vector")), "vectors")
    asked = kept.where(is_query)
    n, n_asked = kept.count(), asked.count()
    n_blocks = max(1, math.ceil(n / CANDIDATES))
    # A cell never holds more than QUERY_BLOCK queries; few queries are dealt to as many tasks as run at once.
    n_query_blocks = max(1, math.ceil(n_asked / QUERY_BLOCK), min(2 * spark.sparkContext.defaultParallelism, math.ceil(n_asked / 64)))
    n_groups = math.ceil(n_blocks / GROUP)
    queries = blocks_of(asked, n_query_blocks).select(
        F.col("block").alias("query_block"), F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))).alias("part"), "dims", "width", "ids", "cells"
    )
    candidates = blocks_of(kept, n_blocks).select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_query_blocks - 1).cast("long"))).alias("query_block"),
        (F.col("block") % n_groups).cast("int").alias("part"), "dims", "width", "ids", "cells",
    )
    cell = ["query_block", "part"]
    hits = queries.groupBy(*cell).cogroup(candidates.groupBy(*cell)).applyInPandas(_search(k), HITS)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return hits.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def search_embeddings(embeddings: DataFrame, *, every: int = 20, k: int = 20, scale: int = 64) -> DataFrame:
    """Top k over floor(scale * x) of each component; queries are the rows whose vec_id is divisible by ``every``."""
    rows = embeddings.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    vectors = rows.select(F.col("vec_id").cast("long"), quantise(F.col("embedding"), scale).alias("vector"))
    return top_k(vectors, F.col("vec_id") % every == 0, k)
