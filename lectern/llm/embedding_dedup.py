"""Near-duplicate vectors by a subspace pigeonhole join.

Two unit vectors have a cosine of t or more exactly if their squared distance is at most 2 - 2t. A fixed random rotation spreads
differences evenly over all dimensions; cut into blocks of dimensions, at least one block must then differ by no more than its
share of that budget, the share being its part of the dimensions. Each block is joined by range under its share, the union of what
the blocks find is a superset of all links, and each candidate is verified by the exact cosine in double precision.

Vectors are sorted by the cells of the blocks' leading axes and packed into tiles of TILE vectors with the box that they fill
in each block. The range join first meets tiles: slabs of a leading axis as wide as the radius are an equality key, and two tiles
come together if in some block they have slabs that are next to each other. Within a pair of tiles, boxes of SUB vectors that are too far apart in a block are
passed over, the rest is one matrix product per block.

Links are never listed. A pair of tiles gives, for each vector with a link, the number of its links there and one edge of a spanning
forest, so a group of n near copies costs n rows per tile pair. Exact copies are one vector with a multiplicity.

Defined results: null, empty or zero vectors and those with null or non-finite components link with nothing and keep a row;
vectors link only with others of the same length; of repeated ids the smallest vector counts, in one row; a row without an id links with nothing, has
no component and is kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.components import connected_components
from lectern.llm.runtime import ship, stored
from lectern.llm.topk import usable

TILE, SUB, BLOCK = 4096, 512, 16
#: Slack of the single-precision block distances, so that rounding loses no candidate.
SLACK = 1e-4
TILES = "tile string, dims int, n int, ids binary, copies binary, cells binary, low array<double>, high array<double>"
FOUND = "node long, links long, root long"


@lru_cache(maxsize=16)
def rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(dims).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def blocks(dims: int) -> list[slice]:
    return [slice(i, min(i + BLOCK, dims)) for i in range(0, dims, BLOCK)]


def unit(cells: np.ndarray) -> np.ndarray:
    wide = cells.astype(np.float64)
    wide = wide / np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.sqrt(np.einsum("nd,nd->n", wide, wide))[:, None]


def radius(dims: int, threshold: float, block: slice) -> float:
    """The block's share of the squared-distance budget, as a distance."""
    return float(np.sqrt((2 - 2 * threshold) * (block.stop - block.start) / dims))


def _place(threshold: float):
    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The slabs of the leading axis of each block, as sort key."""
        for rows in batches:
            keys = [None] * len(rows)
            lengths = rows["vector"].map(len).to_numpy()
            for dims in np.unique(lengths):
                at = np.flatnonzero(lengths == dims)
                turned = unit(np.array(rows["vector"].iloc[at].tolist())) @ rotation(int(dims))
                slabs = np.stack([np.floor(turned[:, b.start] / radius(int(dims), threshold, b)) for b in blocks(int(dims))], 1)
                for i, slab in zip(at, slabs.astype(np.int32).tolist(), strict=True):
                    keys[i] = [int(dims), *slab]
            yield rows.assign(key=keys)

    return place


def _tile(tile: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Consecutive vectors of one length, ``tile`` at a time."""
    held: list[tuple] = []
    made = 0

    def flush() -> pd.DataFrame:
        nonlocal made
        made += 1
        dims = len(held[0][2])
        cells = np.array([h[2] for h in held], np.float64)
        turned = unit(cells) @ rotation(dims)
        lead = [b.start for b in blocks(dims)]
        ids = np.array([h[0] for h in held], np.int64)
        narrow = cells.astype(np.float32)
        packed = narrow if (narrow == cells).all() else cells
        row = (
            f"{ids[0]}-{made}", dims, len(held), ids.tobytes(), np.array([h[1] for h in held], np.int64).tobytes(),
            packed.tobytes(), turned[:, lead].min(0).tolist(), turned[:, lead].max(0).tolist(),
        )
        held.clear()
        return pd.DataFrame([row], columns=[c.split()[0] for c in TILES.split(", ")])

    for rows in batches:
        for one in zip(rows["vec_id"], rows["copies"], rows["vector"], strict=True):
            if held and (len(held) == tile or len(held[0][2]) != len(one[2])):
                yield flush()
            held.append(one)
    if held:
        yield flush()


class _Side:
    def __init__(self, row, threshold: float, sub: int):
        self.sub = sub
        self.ids, self.copies = np.frombuffer(row.ids, np.int64), np.frombuffer(row.copies, np.int64)
        kind = np.float32 if len(row.cells) == 4 * row.n * row.dims else np.float64
        self.unit = unit(np.frombuffer(row.cells, kind).reshape(row.n, row.dims))
        self.threshold, self.n = threshold, row.n
        turned = self.unit @ rotation(row.dims)
        self.parts = []
        for b in blocks(row.dims):
            x = turned[:, b]
            half = np.einsum("nd,nd->n", x, x)[:, None] / 2
            one = np.ones_like(half)
            # left @ right.T is minus half the squared distance.
            boxes = [(x[i : i + sub].min(0), x[i : i + sub].max(0)) for i in range(0, row.n, sub)]
            self.parts.append((np.hstack([x, -half, one]).astype(np.float32), np.hstack([x, one, -half]).astype(np.float32),
                               boxes, radius(row.dims, threshold, b)))


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def _apart(a: tuple, b: tuple) -> float:
    gap = np.maximum(0, np.maximum(a[0] - b[1], b[0] - a[1]))
    return float(gap @ gap)


def _links(a: _Side, b: _Side, i: int, j: int) -> np.ndarray:
    """Which vectors of the i-th box of ``a`` and the j-th of ``b`` link: candidates of any block, then the exact cosine."""
    rows, cols = slice(i * a.sub, min((i + 1) * a.sub, a.n)), slice(j * b.sub, min((j + 1) * b.sub, b.n))
    near = np.zeros((rows.stop - rows.start, cols.stop - cols.start), bool)
    for (left, _, boxes, r), (_, right, others, _) in zip(a.parts, b.parts, strict=True):
        if _apart(boxes[i], others[j]) <= r * r + SLACK:
            near |= left[rows] @ right[cols].T >= -(r * r + SLACK) / 2
    x, y = np.nonzero(near)
    if len(x) > 4096:
        near &= a.unit[rows] @ b.unit[cols].T >= a.threshold
    elif len(x):
        near[x, y] = np.einsum("nd,nd->n", a.unit[rows][x], b.unit[cols][y]) >= a.threshold
    return near


def _meet(threshold: float, sub: int):
    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame([], columns=["node", "links", "root"])
        one = left["tile"].iloc[0] == right["tile"].iloc[0]
        a = _Side(next(left.itertuples()), threshold, sub)
        b = a if one else _Side(next(right.itertuples()), threshold, sub)
        shift = 0 if one else a.n
        ids = a.ids if one else np.concatenate([a.ids, b.ids])
        links, forest = np.zeros(len(ids), np.int64), _Forest(len(ids))
        for i in range(-(-a.n // sub)):
            for j in range(i if one else 0, -(-b.n // sub)):
                near = _links(a, b, i, j)
                if one and i == j:
                    np.fill_diagonal(near, False)
                if not near.any():
                    continue
                x0, y0 = i * sub, j * sub
                links[x0 : x0 + near.shape[0]] += near @ b.copies[y0 : y0 + near.shape[1]]
                if not (one and i == j):
                    links[shift + y0 : shift + y0 + near.shape[1]] += near.T @ a.copies[x0 : x0 + near.shape[0]]
                _span(near, x0, shift + y0, forest)
        at = np.flatnonzero(links)
        return pd.DataFrame({"node": ids[at], "links": links[at], "root": [ids[forest.root(x)] for x in at.tolist()]})

    return meet


def _span(near: np.ndarray, x0: int, y0: int, forest: _Forest) -> None:
    """Join what ``near`` links; with many links, by the smallest label around each vector until none changes."""
    x, y = np.nonzero(near)
    if len(x) <= 4096:
        for i, j in zip((x + x0).tolist(), (y + y0).tolist(), strict=True):
            forest.join(i, j)
        return
    none = near.shape[1]
    rows = np.where(near.any(1), near.argmax(1), none)
    while True:
        cols = np.where(near, rows[:, None], none).min(0)
        cols = np.where(near.any(0), cols, none)
        new = np.where(near, cols[None, :], none).min(1)
        new = np.where(near.any(1), np.minimum(new, rows), none)
        if (new == rows).all():
            break
        rows = new
    # Labels are columns; a label names a component of this part.
    for i in np.flatnonzero(rows < none).tolist():
        forest.join(x0 + i, y0 + int(rows[i]))
    for j in np.flatnonzero(cols < none).tolist():
        forest.join(y0 + j, y0 + int(cols[j]))


def _tile_pairs(tiles: DataFrame, threshold: float) -> DataFrame:
    """a, b: tiles that in some block have neighbouring slabs; each pair once, each tile with itself."""
    boxes = tiles.select("tile", "dims", F.posexplode(F.arrays_zip("low", "high")).alias("block", "span"))
    size = F.least(F.lit(BLOCK), F.col("dims") - F.col("block") * BLOCK)
    width = F.sqrt(F.lit(2 - 2 * threshold) * size / F.col("dims"))
    slab = F.sequence(F.floor(F.col("span.low") / width), F.floor(F.col("span.high") / width))
    slabs = boxes.select("tile", "dims", "block", F.explode(slab).alias("slab"))
    around = slabs.select(F.col("tile").alias("b"), "dims", "block", F.explode(F.sequence(F.col("slab") - 1, F.col("slab") + 1)).alias("slab"))
    met = slabs.withColumnRenamed("tile", "a").join(around.distinct(), ["dims", "block", "slab"]).where("a <= b")
    return met.select("a", "b").distinct()


def near_links(vectors: DataFrame, threshold: float, tile: int = TILE, sub: int = SUB) -> DataFrame:
    """node, links, root: per pair of tiles and vector of (vec_id, copies, vector), for vectors that have links there."""
    placed = stored(vectors.select("vec_id", "copies", "vector").mapInPandas(_place(threshold), f"{_ddl(vectors)}, key array<int>"), "placed")
    parts = max(1, -(-placed.count() // (4 * tile)))
    order = ["key", "vec_id"]
    tiles = stored(placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInPandas(partial(_tile, tile), TILES), "tiles")
    pairs = stored(_tile_pairs(tiles, threshold), "tile-pairs")
    slim = tiles.select("tile", "dims", "n", "ids", "copies", "cells")
    left = pairs.join(slim, F.col("a") == F.col("tile"))
    right = pairs.toDF(*pairs.columns).join(slim.toDF(*slim.columns), F.col("b") == F.col("tile"))
    return left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInPandas(_meet(threshold, sub), FOUND)


def _ddl(vectors: DataFrame) -> str:
    kind = vectors.schema["vector"].dataType.simpleString()
    return f"vec_id long, copies long, vector {kind}"


def near_duplicates(embeddings: DataFrame, *, threshold: float = 0.9, tile: int = TILE, sub: int = SUB) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector."""
    ship(embeddings.sparkSession)
    rows = stored(
        embeddings.select(F.col("vec_id").cast("long"), "embedding").where("vec_id is not null")
        .groupBy("vec_id").agg(F.min("embedding").alias("vector")), "vectors"
    )
    some = usable(F.col("vector")) & F.exists("vector", lambda x: x != 0)
    linkable = rows.where(F.coalesce(some, F.lit(False)))
    classes = stored(
        linkable.groupBy("vector").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")), "vector-classes"
    )
    found = stored(near_links(classes, threshold, tile, sub), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("node").alias("u"), F.col("root").alias("v")), "vector-components")
    several = classes.where("copies > 1").select("vector", F.col("vec_id").alias("first"), "copies")
    of_class = (
        rows.join(several, "vector", "left")
        .select("vec_id", F.coalesce("first", "vec_id").alias("node"), F.coalesce(F.col("copies") - 1, F.lit(0)).alias("same"))
        .join(links, "node", "left").join(parts, "node", "left")
    )
    out = of_class.select(
        "vec_id", (F.col("same") + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
    ).withColumn("kept", F.col("vec_id") == F.col("component_id"))
    unnamed = embeddings.where("vec_id is null").select(
        F.lit(None).cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept"),
    )
    return out.unionByName(unnamed)
