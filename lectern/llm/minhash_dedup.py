"""Near-duplicate texts: improved consistent weighted sampling over TF-IDF shingles, banded and verified.

A document is the weighted set of its five-word shingles (one shingle of all words, if there are fewer), of weight tf * idf with
``idf = 1 + ln(N / df) / ln(N)``, which lies between 1 and 2: a rare shingle counts twice a universal one. df and N are over all documents.

1. Documents are dealt into chunks by doc_id and text. A chunk sends the sorted hashes of its distinct shingles to ranges of the hash space as differences;
   a range adds up df and answers each chunk with those of its shingles that other documents have too.
   So a shingle travels in about four bytes, once, and the texts are shuffled once for both passes over a chunk.
2. Weighted Jaccard similarity t needs a share t of a document's weight in shingles with df >= 2. Documents below that have no partner, exactly,
   and go no further. For the others a chunk draws ROWS * BANDS consistent weighted samples and keeps the set.
3. Equal texts become one class. Classes that share a band are candidates; connected candidates form a group. In every group all sets are
   compared with the most central one, then the pairs that share a band and are not connected yet, by exact weighted Jaccard. A group of up to
   TILE sets and TILE_BYTES of hashes does both in one task; in larger ones the centre travels to the sets, and what that leaves open by the
   triangle inequality meets in pairs of tiles.
4. Connected components of the verified links, over class representatives; members follow their class.

No task holds a group of unbounded size and no list of pairs is made; links go out as spanning forests.

Defined results: null and empty texts, and those of white space, are like no other; rows without a doc_id are kept and have no group; texts with the
same words in order are equal; an empty table gives no rows; other columns are ignored. To ``near_duplicates`` rows of one doc_id are one document
with all their texts; ``repeated_texts`` judges each text by itself.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.components import connected_components
from lectern.llm.runtime import hold, mix64, ship, stored

SHINGLE, THRESHOLD, BANDS, ROWS = 5, 0.8, 20, 4
#: Bits of a shingle's hash.
BITS = 48
#: Bytes of text in a chunk, and of the texts whose shingles fall into one range; documents in a chunk.
CHUNK_BYTES, RANGE_BYTES, CHUNK_DOCS = 8_000_000, 8_000_000, 20_000
#: Sets that meet in one task, and bytes of their hashes; at most two tiles of them.
TILE, TILE_BYTES = 512, 6_000_000
#: Shingles whose samples are drawn at a time.
DRAW = 4096
#: Distinct words that a Python worker keeps.
KEPT = 200_000

PARTIAL = "range long, chunk long, hashes binary, counts binary"
SHARED = "chunk long, range long, hashes binary, df binary"
SETS = "text_key string, digest binary, docs array<long>, first long, bands array<long>, central double, weight double, hashes binary, tf binary, df binary"
LINKS = "u long, v long"
_C = [np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in range(SHINGLE)]


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word.encode())
        return out


_HASHES = _Hashes()


def _begin() -> None:
    hold("minhash", _HASHES.clear)


def shingle_table(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """hash, text number, tf of each distinct shingle of each text, sorted by hash and then text number."""
    hashes, owners = [], []
    for i, text in enumerate(texts):
        words = text.split()
        n = len(words)
        if n:
            hashes.append(_shingles(np.fromiter(map(_HASHES.__getitem__, words), np.uint64, n)))
            owners.append(np.full(len(hashes[-1]), i, np.uint32))
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int64)
    low = np.uint64(64 - BITS)
    keys, owner = np.concatenate(hashes), np.concatenate(owners)
    del hashes, owners
    if len(texts) < 1 << int(low):
        keys <<= low
        keys |= owner
        keys.sort()
        at = _runs(keys)
        tf = np.diff(np.r_[at, len(keys)])
        keys = keys[at]
        return keys >> low, (keys & np.uint64((1 << int(low)) - 1)).astype(np.uint32), tf
    order = np.lexsort((owner, keys))
    keys, owner = keys[order], owner[order]
    at = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])])
    return keys[at], owner[at], np.diff(np.r_[at, len(keys)])


def _shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of the runs of SHINGLE words, or of all words if there are fewer."""
    n = max(1, len(words) - SHINGLE + 1)
    mixed = np.zeros(n, np.uint64)
    for k, c in enumerate(_C[: len(words)]):
        mixed += mix64(words[k : k + n], k) * c
    return mix64(mixed) >> np.uint64(64 - BITS)


def _narrow(x: np.ndarray, *kinds) -> bytes:
    """In the first of the kinds that holds all values; the length tells which."""
    top = int(x.max(initial=0))
    return x.astype(next(k for k in kinds if top <= np.iinfo(k).max)).tobytes()


def _wide(data: bytes, n: int, *kinds) -> np.ndarray:
    return np.frombuffer(data, next(k for k in kinds if np.dtype(k).itemsize * n == len(data))).astype(np.uint64)


_STEPS, _COUNTS = (np.uint32, np.uint64), (np.uint8, np.uint32)


def _write_hashes(hashes: np.ndarray) -> bytes:
    return _narrow(np.diff(hashes, prepend=np.uint64(0)), *_STEPS) if len(hashes) else b""


def _read_hashes(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(_wide(data, n, *_STEPS), dtype=np.uint64) if n else np.zeros(0, np.uint64)


def _runs(sorted_hashes: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, sorted_hashes[1:] != sorted_hashes[:-1]]) if len(sorted_hashes) else np.zeros(0, np.int64)


def _texts(rows: pd.DataFrame) -> tuple[np.ndarray, list[str]]:
    """The number of each row's text among the distinct texts of a chunk, and those."""
    codes, texts = pd.factorize(rows["text"].to_numpy(object))
    return codes, list(texts)


def _bounds(ranges: int) -> np.ndarray:
    return np.array([-(-(i << BITS) // ranges) for i in range(ranges + 1)], np.uint64)


def _send(ranges: int):
    def send(rows: pd.DataFrame) -> pd.DataFrame:
        """A chunk's distinct shingles, with the number of its documents that have them, by range of the hash space."""
        _begin()
        codes, texts = _texts(rows)
        hashes, owner, _ = shingle_table(texts)
        at = _runs(hashes)
        counts = np.add.reduceat(np.bincount(codes)[owner], at) if len(at) else at
        hashes, bounds = hashes[at], _bounds(ranges)
        cuts = np.searchsorted(hashes, bounds)
        out = [
            (r, rows["chunk"].iloc[0], _write_hashes(hashes[a:b] - bounds[r]), _narrow(counts[a:b], *_COUNTS))
            for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a
        ]
        return pd.DataFrame(out, columns=["range", "chunk", "hashes", "counts"])

    return send


def _sizes(rows: pd.DataFrame) -> list[int]:
    """How many hashes each row has: the pairs of lengths fit one number only."""
    out = []
    for h, c in zip(rows["hashes"], rows["counts"], strict=True):
        fits = {len(h) // np.dtype(k).itemsize for k in _STEPS} & {len(c) // np.dtype(k).itemsize for k in _COUNTS}
        out.append(max(fits))
    return out


def _answer(rows: pd.DataFrame) -> pd.DataFrame:
    """df of the shingles of one range that more than one document has, to each chunk that has them."""
    sizes = _sizes(rows)
    hashes = np.concatenate([_read_hashes(h, n) for h, n in zip(rows["hashes"], sizes, strict=True)])
    counts = np.concatenate([_wide(c, n, *_COUNTS) for c, n in zip(rows["counts"], sizes, strict=True)]).astype(np.uint32)
    chunk = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)
    order = np.argsort(hashes, kind="stable")
    hashes, chunk, counts = hashes[order], chunk[order], counts[order]
    del order
    at = _runs(hashes)
    df = np.repeat(np.add.reduceat(counts, at), np.diff(np.r_[at, len(hashes)]))
    shared = np.flatnonzero(df > 1)
    shared = shared[np.argsort(chunk[shared], kind="stable")]
    cuts = np.searchsorted(chunk[shared], np.arange(len(rows) + 1))
    out = []
    for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if b > a:
            one = shared[a:b]
            out.append((rows["chunk"].iloc[i], rows["range"].iloc[0], _write_hashes(hashes[one]), df[one].astype(np.uint32).tobytes()))
    return pd.DataFrame(out, columns=["chunk", "range", "hashes", "df"])


def idf(df: np.ndarray, n_docs: int) -> np.ndarray:
    return 1 + np.log(n_docs / df) / math.log(max(n_docs, 2))


def _uniform(bits: np.ndarray, at: int, width: int) -> np.ndarray:
    return ((bits >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.float64) / (1 << width) + 0.5 / (1 << width)


def weighted_samples(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Improved consistent weighted sampling: BANDS * ROWS samples (shingle, step), each hashed into one number."""
    k = BANDS * ROWS
    seeds = mix64(np.arange(k, dtype=np.uint64), 7)[None, :]
    best, out = np.full(k, np.inf), np.zeros(k, np.uint64)
    for i in range(0, len(hashes), DRAW):
        h, w = hashes[i : i + DRAW, None], np.log(weights[i : i + DRAW, None])
        one, two = mix64(h ^ seeds, 1), mix64(h ^ seeds, 2)
        r = -np.log(_uniform(one, 0, 24) * _uniform(one, 24, 24))
        c = -np.log(_uniform(two, 0, 24) * _uniform(two, 24, 24))
        beta = _uniform((one >> np.uint64(48)) << np.uint64(16) | two >> np.uint64(48), 0, 32)
        step = np.floor(w / r + beta)
        a = np.log(c) - r * (step - beta) - r
        at = a.argmin(0)
        cols = np.arange(k)
        value = a[at, cols]
        sample = mix64(hashes[i + at] ^ mix64(step[at, cols].astype(np.int64).view(np.uint64), 3), 4)
        better = value < best
        best[better], out[better] = value[better], sample[better]
    return out


def bands_of(samples: np.ndarray) -> list[int]:
    """One key for each band."""
    mixed = np.zeros(BANDS, np.uint64)
    for row in samples.reshape(BANDS, ROWS).T:
        mixed = mix64(mixed ^ row, 5)
    return mix64(mixed ^ np.arange(BANDS, dtype=np.uint64), 6).view(np.int64).tolist()


def _sets(ranges: int, n_docs: int, threshold: float):
    def sets(rows: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
        """Sets and bands of the texts of a chunk that can have a partner."""
        _begin()
        names = [c.split()[0] for c in SETS.split(", ")]
        if rows.empty or shared.empty:
            return pd.DataFrame([], columns=names)
        codes, texts = _texts(rows)
        hashes, owner, tf = shingle_table(texts)
        shared = shared.sort_values("range")
        known_df = [np.frombuffer(x, np.uint32) for x in shared["df"]]
        firsts = _bounds(ranges)[shared["range"].to_numpy()]
        known = np.concatenate([_read_hashes(h, len(d)) + f for h, d, f in zip(shared["hashes"], known_df, firsts, strict=True)])
        known_df = np.concatenate(known_df)
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        df = np.where(known[at] == hashes, known_df[at], 1)
        weight = tf * idf(df, n_docs)
        n = len(texts)
        total = np.bincount(owner, weight, n)
        common = np.bincount(owner, np.where(df > 1, weight, 0), n)
        central = np.bincount(owner, tf * np.log(df), n) / np.maximum(np.bincount(owner, tf, n), 1)
        able = np.flatnonzero((total > 0) & (common >= threshold * total * (1 - 1e-9)))
        order = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[order], np.arange(n + 1))
        members = pd.Series(rows["doc_id"].to_numpy(np.int64)).groupby(codes).agg(lambda x: sorted(set(x)))
        out = []
        for i in able.tolist():
            one = order[cuts[i] : cuts[i + 1]]
            h = hashes[one]
            docs = members[i]
            out.append((
                xxhash.xxh3_128_hexdigest(" ".join(texts[i].split()).encode()), hashlib.md5(texts[i].encode()).digest(), docs, docs[0],
                bands_of(weighted_samples(h, weight[one])), central[i], total[i],
                h.view(np.uint8).reshape(-1, 8)[:, : BITS // 8].tobytes(), tf[one].astype(np.uint32).tobytes(), df[one].astype(np.uint32).tobytes(),
            ))
        return pd.DataFrame(out, columns=names)

    return sets


class _Group:
    """Sets over the shingles of a group, in one array after another."""

    def __init__(self, rows: pd.DataFrame, n_docs: int):
        raw = [np.frombuffer(h, np.uint8).reshape(-1, BITS // 8) for h in rows["hashes"]]
        flat = np.zeros((sum(map(len, raw)), 8), np.uint8)
        flat[:, : BITS // 8] = np.concatenate(raw)
        self.names, self.ids = np.unique(flat.view(np.uint64)[:, 0], return_inverse=True)
        tf = np.concatenate([np.frombuffer(x, np.uint32) for x in rows["tf"]])
        df = np.concatenate([np.frombuffer(x, np.uint32) for x in rows["df"]])
        self.weights = tf * idf(df, n_docs)
        self.sizes = np.array([len(x) for x in raw])
        self.starts = np.r_[0, np.cumsum(self.sizes)]
        self.totals = np.add.reduceat(self.weights, self.starts[:-1])
        self.dense = np.zeros(len(self.names))

    def compare(self, one: int, others: np.ndarray) -> np.ndarray:
        """Weighted Jaccard similarity of a set with others."""
        own = slice(self.starts[one], self.starts[one + 1])
        self.dense[self.ids[own]] = self.weights[own]
        sizes = self.sizes[others]
        firsts = np.r_[0, np.cumsum(sizes)[:-1]]
        at = np.repeat(self.starts[others] - firsts, sizes) + np.arange(sizes.sum())
        least = np.add.reduceat(np.minimum(self.weights[at], self.dense[self.ids[at]]), firsts)
        self.dense[self.ids[own]] = 0
        return least / (self.totals[one] + self.totals[others] - least)


def _verify(n_docs: int, threshold: float):
    def verify(rows: pd.DataFrame) -> pd.DataFrame:
        """A spanning forest of the links between sets that share a band; between two tiles, of those across."""
        group = _Group(rows, n_docs)
        side = rows["tile"].to_numpy()
        across = len(set(side)) > 1
        root = np.arange(len(rows))
        # Until all pairs of a bucket are compared or connected, its most central set that was not yet compared meets the others.
        central = np.lexsort((rows["node"].to_numpy(), -rows["central"].to_numpy()))
        rank = np.empty(len(rows), np.int64)
        rank[central] = np.arange(len(rows))
        met = np.zeros((len(rows), len(rows)), bool)
        keys = np.array(rows["bands"].tolist(), np.int64)
        links = []

        def meet(one: int, rest: np.ndarray) -> None:
            met[one, rest] = met[rest, one] = True
            for other in rest[group.compare(one, rest) >= threshold].tolist():
                if root[other] != root[one]:
                    links.append((one, other))
                    root[root == root[other]] = root[one]

        if rows["whole"].iloc[0] and len(rows) > 1:
            meet(int(central[0]), central[1:])
        for band in range(keys.shape[1]):
            order = np.lexsort((rank, keys[:, band]))
            at = _runs(keys[order, band])
            for bucket in np.split(order, at[1:]):
                for i, one in enumerate(bucket[:-1].tolist()):
                    rest = bucket[i + 1 :]
                    rest = rest[(root[rest] != root[one]) & ~met[one, rest]]
                    if across:
                        rest = rest[side[rest] != side[one]]
                    if not len(rest):
                        if (root[bucket] == root[bucket[0]]).all():
                            break
                        continue
                    meet(one, rest)
        node = rows["node"].to_numpy()
        return pd.DataFrame([(node[a], node[b]) for a, b in links], columns=["u", "v"])

    return verify


def _star(n_docs: int):
    def star(batches):
        """The similarity of each set to the centre of its group, which lies beside it."""
        for batch in batches:
            out = []
            for row in batch.itertuples():
                pair = pd.DataFrame({"hashes": [row.hashes, row.centre_hashes], "tf": [row.tf, row.centre_tf], "df": [row.df, row.centre_df]})
                out.append(float(_Group(pair, n_docs).compare(0, np.array([1]))[0]))
            yield pd.DataFrame({"node": batch["node"], "centre": batch["centre"], "similarity": out})

    return star


def _shared_df(docs: DataFrame, ranges: int) -> DataFrame:
    partial = docs.groupBy("chunk").applyInPandas(_send(ranges), PARTIAL)
    return partial.groupBy("range").applyInPandas(_answer, SHARED)


def dealt(docs: DataFrame, chunks: int) -> DataFrame:
    """Rows with their ``chunk``. The text takes part, so a doc_id that many texts share is spread."""
    return docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))


def candidate_sets(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, int]:
    """Texts that can have a partner, with their set and bands; and the number of documents."""
    ship(docs.sparkSession)
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    n_docs, n_bytes = named.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    chunks = max(1, math.ceil(n_bytes / CHUNK_BYTES), math.ceil(n_docs / CHUNK_DOCS))
    ranges = max(1, math.ceil(n_bytes / RANGE_BYTES))
    shared = _shared_df(dealt(named, chunks), ranges)
    sets = dealt(named, chunks).groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInPandas(_sets(ranges, n_docs, threshold), SETS)
    return stored(sets, "shingle-sets"), n_docs


def text_classes(sets: DataFrame) -> DataFrame:
    """node, text_key, first (smallest doc_id and text of the class), bands, volume; nodes are numbered in the order of ``first``."""
    found = sets.groupBy("text_key").agg(
        F.min(F.struct(F.col("first").alias("doc_id"), "digest")).alias("first"), F.first("bands").alias("bands"),
        F.max(F.octet_length("hashes")).alias("volume"))
    found = stored(found, "text-keys").orderBy("first.doc_id", "first.digest")
    return stored(found.select(F.monotonically_increasing_id().alias("node"), "text_key", "first", "bands", "volume"), "text-classes")


def _tiles(size: str, volume: str) -> Column:
    return F.greatest(F.ceil(F.col(size) / TILE), F.ceil(F.col(volume) / TILE_BYTES), F.lit(1))


def candidate_groups(classes: DataFrame) -> DataFrame:
    """node, component, tiles: groups of two or more classes that are connected by common bands."""
    keyed = classes.select("node", F.explode("bands").alias("key"))
    first = keyed.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first != last")
    edges = keyed.join(first.select("key", "first"), "key").where("node != first").select(F.col("node").alias("u"), F.col("first").alias("v"))
    parts = connected_components(edges.distinct(), "bands")
    both = parts.unionByName(parts.select(F.col("component").alias("node"), "component").distinct())
    both = stored(both.join(classes.select("node", "volume"), "node"), "group-volumes")
    sizes = both.groupBy("component").agg(F.count("*").alias("size"), F.sum("volume").alias("volume"))
    return stored(both.drop("volume").join(sizes.select("component", _tiles("size", "volume").alias("tiles")), "component"), "groups")


def verified_links(sets: DataFrame, classes: DataFrame, groups: DataFrame, n_docs: int, threshold: float = THRESHOLD) -> DataFrame:
    """u, v: a spanning forest of the links between classes."""
    named = classes.join(groups, "node").select("text_key", "first.doc_id", F.col("first.digest").alias("of"), "component", "tiles", "node")
    # The set of a class is that of its first text; other chunks may hold the class too.
    grouped = sets.join(named, "text_key").where("first = doc_id and digest = of").select(
        "component", "tiles", "node", "central", "bands", "hashes", "tf", "df", F.lit(True).alias("whole"))
    open_ = grouped.where("tiles = 1")
    large = groups.where("tiles > 1")
    linked = None
    if not large.isEmpty():
        wide = stored(grouped.where("tiles > 1").withColumn("whole", F.lit(False)), "large-groups")
        centre = wide.groupBy("component").agg(F.max_by(
            F.struct("node", "hashes", "tf", "df"), F.struct("central", -F.col("node"))).alias("c"))
        beside = wide.select("component", "node", "hashes", "tf", "df").join(centre, "component").select(
            "component", "node", "hashes", "tf", "df", F.col("c.node").alias("centre"), F.col("c.hashes").alias("centre_hashes"),
            F.col("c.tf").alias("centre_tf"), F.col("c.df").alias("centre_df"),
        )
        stars = stored(beside.mapInPandas(_star(n_docs), "node long, centre long, similarity double"), "stars")
        linked = stars.where((F.col("similarity") >= threshold) & (F.col("node") != F.col("centre"))).select(
            F.col("node").alias("u"), F.col("centre").alias("v"))
        # 1 - similarity is a metric. What is linked to the centre and further from all that is not than the threshold allows is done.
        away = stars.where(F.col("similarity") < threshold).groupBy("centre").agg(F.max("similarity").alias("nearest"))
        left = stars.join(away, "centre").where(
            (F.col("node") != F.col("centre")) & (F.col("nearest") - F.col("similarity") >= threshold - 1 - 1e-9)).select("node")
        rest = stored(wide.drop("tiles").join(left, "node"), "open-sets")
        counts = rest.groupBy("component").agg(F.count("*").alias("size"), F.sum(F.octet_length("hashes")).alias("volume"))
        rest = rest.join(counts.select("component", _tiles("size", "volume").alias("tiles")), "component")
        open_ = open_.unionByName(rest.select(*open_.columns))
    # Tile i meets each tile j >= i; a set of tile t goes to the pairs (t, j) and (i, t).
    tile = F.pmod(F.xxhash64("node"), F.col("tiles"))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1), lambda j: F.struct(
        F.least(j, F.col("tile")).alias("i"), F.greatest(j, F.col("tile")).alias("j")))
    paired = open_.withColumn("tile", tile).select("*", F.explode(pairs).alias("pair"))
    found = paired.groupBy("component", "pair").applyInPandas(_verify(n_docs, threshold), LINKS)
    return found if linked is None else found.unionByName(linked)


def _linked(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Texts of documents with their class (doc_id, digest, node), classes, and links between classes."""
    sets, n_docs = candidate_sets(docs, threshold)
    classes = text_classes(sets)
    found = stored(verified_links(sets, classes, candidate_groups(classes), n_docs, threshold), "text-links")
    held = sets.select("text_key", "digest", F.explode("docs").alias("doc_id"))
    member = stored(held.join(classes.select("text_key", "node"), "text_key").select("doc_id", "digest", "node"), "members")
    return member, classes, found


def _with_first(member: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """Members with the first document and text of their group, which is that of its smallest node."""
    parts = connected_components(links, "text-components")
    firsts = classes.select("node", "first").join(parts, "node", "left")
    own = classes.select(F.col("node").alias("component"), F.col("first").alias("leader"))
    firsts = firsts.join(own, "component", "left").select("node", F.coalesce("leader", "first").alias("leader"))
    return member.join(firsts, "node").select("doc_id", "digest", "leader")


def near_duplicates(docs: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, group_id (smallest doc_id of its group), kept (doc_id = group_id): one row per document."""
    member, classes, found = _linked(docs, threshold)
    # Several texts under one doc_id are one document.
    same = member.groupBy("doc_id").agg(F.min("node").alias("u"), F.max("node").alias("v")).where("u != v")
    texts = member.join(same.select("doc_id", F.col("u").alias("least")), "doc_id").where("node != least")
    links = found.unionByName(texts.select(F.col("node").alias("u"), F.col("least").alias("v")))
    grouped = _with_first(member, classes, links).groupBy("doc_id").agg(F.min("leader.doc_id").alias("group_id"))
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    out = named.join(grouped, "doc_id", "left").select("doc_id", F.coalesce("group_id", "doc_id").alias("group_id"))
    unnamed = docs.where("doc_id is null").select(
        F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("group_id"), F.lit(True).alias("kept"))
    return out.withColumn("kept", F.col("doc_id") == F.col("group_id")).unionByName(unnamed)


def repeated_texts(docs: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, digest (md5 of the text, binary): the texts that are near copies of one with a smaller doc_id, or digest for equal ones.

    Different texts of one doc_id are judged apart.
    """
    grouped = _with_first(*_linked(docs, threshold))
    return grouped.where("doc_id != leader.doc_id or digest != leader.digest").select("doc_id", "digest").distinct()
